"""Text expressions (pure Column → Column), all JVM-side built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters the username sanitiser deletes (apostrophe,
# blank, - ; @ # $ % ! . , /).
USERNAME_STRIP_CHARS = "' -;@#$%!.,/"

# Period-name cleaning pattern — a parenthesised note with its
# trailing blanks (shortest match), a leading word "period", the literal
# "6/7/8", and single blanks.  Applied to the lower-cased time-block name.
PERIOD_NOISE = r"\(.+?\)\s*|^period|6/7/8| "

# Unicode-aware "non-word" run: everything but letters, digits and '_'.
NON_WORD = r"[^\p{L}\p{N}_]+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_surname(c) -> Column:
    """drop every non-word character run (accents are kept)."""
    return F.regexp_replace(_c(c), NON_WORD, "")


def period_name(c) -> Column:
    """F8: time-block name → bare period label ('Period 3 (A)' → '3')."""
    return F.regexp_replace(F.lower(_c(c)), PERIOD_NOISE, "")


def initial(c) -> Column:
    """first character (SQL SUBSTR semantics: '' stays '')."""
    return F.substring(_c(c), 1, 1)


def initial_or_null(c) -> Column:
    """F3 (Python-side variant): empty or NULL text has no initial."""
    return F.nullif(F.substring(_c(c), 1, 1), F.lit(""))


def sanitize_username(c) -> Column:
    """delete the punctuation set, then lower-case."""
    return F.lower(F.translate(_c(c), USERNAME_STRIP_CHARS, ""))


def local_part(c) -> Column:
    """text before the first '@' (whole text when there is none)."""
    return F.substring_index(_c(c), "@", 1)


def domain_part(c) -> Column:
    """text after the first '@'; NULL when there is none."""
    return F.get(F.split(_c(c), "@", 2), 1)


def with_default_domain(c, domain: str) -> Column:
    """append '@domain' when an address has no '@'."""
    col = _c(c)
    return F.when(col.isNull(), None).when(~col.contains("@"), F.concat(col, F.lit("@" + domain))).otherwise(col)


def left(c, n: int) -> Column:
    """first n characters."""
    return F.substring(_c(c), 1, n)


def strip_blanks(c) -> Column:
    """remove every blank."""
    return F.replace(_c(c), F.lit(" "), F.lit(""))


def not_blank(c) -> Column:
    """`c != ''` — NULL also fails the test."""
    return _c(c) != F.lit("")


def ci_differs(a, b) -> Column:
    """Case-insensitive inequality (NULL when either side is NULL)."""
    return F.lower(_c(a)) != F.lower(_c(b))
