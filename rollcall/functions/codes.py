"""Code normalisers and flag expressions (P2–P4, P14, J12 constant maps)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.functions.text import _c

# Grade labels with a non-numeric spelling and their number.
GRADE_WORDS = {"K": 0, "TK": -1, "PRE": -2}


def flag(cond: Column, yes="1", no="0") -> Column:
    """Searched CASE → flag (NULL condition takes the `no` branch)."""
    return F.when(cond, F.lit(yes)).otherwise(F.lit(no))


def normalise_gender(c) -> Column:
    """Anything but M/F becomes 'U'; NULL stays NULL (NULL NOT IN … is unknown)."""
    col = _c(c)
    return F.when(~col.isin("M", "F"), F.lit("U")).otherwise(col)


def grade_number(label) -> Column:
    """K→0, TK→-1, PRE→-2, other text → integer; unparsable → NULL.

    The reference casts with a hard error; we return NULL so the caller can
    route the row to a quarantine instead of failing the whole job.
    """
    col = _c(label)
    expr = None
    for word, num in GRADE_WORDS.items():
        expr = (F.when(col == word, F.lit(num)) if expr is None
                else expr.when(col == word, F.lit(num)))
    return expr.otherwise(col.try_cast("int"))


def has_email_flag(c) -> Column:
    """R3 as written: '' counts as having an address; only NULL gives '0'."""
    col = _c(c)
    return F.when(col != "", F.lit("1")).when(col.isNotNull(), F.lit("1")).otherwise(F.lit("0"))


def missing_email_flag(c) -> Column:
    """Suspend flag of the staff extract: '' or NULL address → '1'."""
    col = _c(c)
    return F.when(col == "", F.lit("1")).when(col.isNull(), F.lit("1")).otherwise(F.lit("0"))


def suspended_flag(status, suspend, legacy: bool = False) -> Column:
    """P14/R1.  legacy: status + suspend >= 1 (flags every active row);
    fixed: suspended when not active (status 0) or the suspend flag is set."""
    s, k = _c(status), _c(suspend)
    if legacy:
        return F.when(s + k >= 1, F.lit(1)).otherwise(F.lit(0))
    return F.when((s == 0) | (k == 1), F.lit(1)).otherwise(F.lit(0))


def const_map(mapping: dict) -> Column:
    """A literal map column for small constant lookups."""
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def map_lookup(mapping: dict, key) -> Column:
    """Constant lookup; unknown key → NULL (never an error)."""
    return F.try_element_at(const_map(mapping), _c(key))
