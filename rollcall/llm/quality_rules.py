"""Operator 6: quality rules as one Spark projection, without user functions.

A table of thresholds (:data:`RULES`) names a ratio of per-text counts, its bounds and the smallest text it
applies to.  :func:`counts` makes the counts, :func:`verdict` compiles the table into one boolean
expression over them.  Everything is a projection over the row: no shuffle, no aggregate, no Python.

Repeated three-word windows are found inside the row by sorting (hash of the window, position) pairs, which
costs n log n for a text of n words, so a text that repeats one word 100,000 times is as harmless as any other.
Windows count as equal if their 64-bit hashes are; for a text of n windows a false match has a chance below
n^2 / 2^65.

Defined results: a null or empty text has no words and fails the base rules.  Rows are judged one by one, so
repeated rows, ties and extra columns change nothing; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK = r"[\x20\x09-\x0D]+"
#: Frequent short words of English, German, French and Spanish; a text of prose has some of them.
STOP_WORDS = list(dict.fromkeys((
    "the of and to in a is that for it was on are as with by be this from at or an "
    "der die und das in den von zu ist nicht mit ein eine im für auf dem des sich als "
    "le la les de des et un une en que qui pour dans est ce il au pas sur plus par "
    "el los las del que y en un una por con no se su para al es lo como").split()))


@dataclass(frozen=True)
class Rule:
    """``numerator`` over ``denominator`` (names of counts) must lie in [low, high] if ``n_words >= least_words``."""

    name: str
    numerator: str
    denominator: str
    low: float | None = None
    high: float | None = None
    least_words: int = 0


RULES = (
    Rule("mean word length", "word_chars", "n_words", low=2.0, high=14.0),
    Rule("symbols per word", "n_symbols", "n_words", high=0.3),
    Rule("stop words", "n_stop_words", "n_words", low=0.01, least_words=100),
    Rule("duplicate lines", "n_dup_lines", "n_lines", high=0.5),
    Rule("lines that end in an ellipsis", "n_ellipsis_lines", "n_lines", high=0.5),
)


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANK, -1), "")


def bind(value: Column, use) -> Column:
    """Evaluate ``value`` once and hand it to ``use``: a one-element array as a let-binding.

    The optimizer copies a column's expression to where a filter uses it; a bound value stays evaluated once.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _length_of(text: Column, other: str) -> Column:
    """Code points of ``text`` after what matches ``other`` is taken out."""
    return F.length(F.regexp_replace(text, other, "")).cast("long")


def repeat_words(words_col: Column, width: int = 3) -> Column:
    """Words that lie in a window of ``width`` words found twice or more in the array, the first one included."""
    last = F.size(words_col) - width
    hashes = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                         lambda i: F.xxhash64(*[F.get(words_col, i + k) for k in range(width)]))

    def twice(ordered: Column) -> Column:
        return F.filter(ordered, lambda x, j: (F.coalesce(F.get(ordered, j - 1)["h"] == x["h"], F.lit(False)))
                        | (F.coalesce(F.get(ordered, j + 1)["h"] == x["h"], F.lit(False))))

    def covered(at: Column) -> Column:
        gaps = F.transform(at, lambda p, j: F.least(F.lit(width), F.coalesce(F.get(at, j + 1) - p, F.lit(width))))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    def count(h: Column) -> Column:
        pairs = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        positions = bind(F.sort_array(pairs), lambda ordered: F.sort_array(F.transform(twice(ordered), lambda x: x["i"])))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(bind(positions, covered))

    return F.when(last < 0, F.lit(0)).otherwise(bind(hashes, count)).cast("long")


def counts(text: Column) -> Column:
    """Struct of the counts that the rules use."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.length(F.regexp_replace(x, BLANK, "")) > 0)
    fields = lambda w, l: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.concat_ws("", w)).cast("long").alias("word_chars"),
        _length_of(t, r"[^#*$%&|<>]+").alias("n_symbols"),
        (F.size(l) - F.size(F.array_distinct(l))).cast("long").alias("n_dup_lines"),
        repeat_words(w).alias("n_repeat_words"),
        F.size(l).cast("long").alias("n_lines"),
        F.size(F.filter(l, lambda x: x.endswith("...") | x.endswith("…"))).cast("long").alias("n_ellipsis_lines"),
        F.size(F.filter(w, lambda x: x.isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
    )
    return bind(words(t), lambda w: bind(lines, lambda l: fields(w, l)))


def base_failed(c: Column) -> Column:
    return (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])


def verdict(c: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """True if every rule that applies to the counts holds."""
    def holds(r: Rule) -> Column:
        top, below = c[r.numerator], c[r.denominator]
        bounds = [top >= r.low * below] if r.low is not None else []
        bounds += [top <= r.high * below] if r.high is not None else []
        return (c["n_words"] < r.least_words) | reduce(lambda a, b: a & b, bounds)

    return reduce(lambda a, b: a & b, [holds(r) for r in rules])


def judgement(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Struct of the counts, ``base_failed`` and ``kept``: the table of thresholds as one expression."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_ellipsis_lines", "n_stop_words")
    return bind(counts(text), lambda c: F.struct(
        *[c[n].alias(n) for n in names], base_failed(c).alias("base_failed"), (~base_failed(c) & verdict(c, rules)).alias("kept")))


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """Every row in struct ``doc`` with struct ``quality``, its judgement."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), judgement(docs[text], rules).alias("quality"))


def accepted(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows that the rules keep, with the columns of ``docs``."""
    return docs.where(judgement(docs["text"], rules)["kept"])


def report(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row: doc_id, the base counts and both verdicts, then the counts of the further rules."""
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
              "n_lines", "n_ellipsis_lines", "n_stop_words")
    rows = judge(docs.select("doc_id", "text"), rules)
    return rows.select("doc.doc_id", *[F.col(f"quality.{f}").alias(f) for f in fields])


def oracle_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """The same result in DuckDB SQL, the threshold table compiled anew."""
    def holds(r: Rule) -> str:
        parts = [f"{r.numerator} >= {r.low} * {r.denominator}"] if r.low is not None else []
        parts += [f"{r.numerator} <= {r.high} * {r.denominator}"] if r.high is not None else []
        return f"(n_words < {r.least_words} OR ({' AND '.join(parts)}))"

    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM docs),
grams AS (
  SELECT r, i, struct_pack(a := w[i], b := w[i + 1], c := w[i + 2]) AS g
  FROM (SELECT r, w, unnest(generate_series(1, len(w) - 2)) AS i FROM split WHERE len(w) > 2)),
repeated AS (
  SELECT r, count(DISTINCT p) AS n
  FROM (SELECT r, unnest(generate_series(i, i + 2)) AS p
        FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1)
  GROUP BY r),
counted AS (
  SELECT s.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(p.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(list_filter(lines, lambda x: x LIKE '%...' OR x LIKE '%…')) AS BIGINT) AS n_ellipsis_lines,
         CAST(len(list_filter(w, lambda x: x IN ({stop}))) AS BIGINT) AS n_stop_words
  FROM split s LEFT JOIN repeated p ON s.r = p.r),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {' AND '.join(holds(r) for r in rules)} AS kept,
       n_lines, n_ellipsis_lines, n_stop_words
FROM judged
"""
