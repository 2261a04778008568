"""Operator 3: secrets, by fixed patterns and by two character Markov models, in DataFrame functions only.

Base spans are the leftmost non-overlapping matches of three patterns (assignments, access keys, hex runs).  The
method adds runs of 20 or more key characters with a letter that a first-order Markov model of random strings explains
better than one of ordinary identifiers; of a run that base spans touch, the parts left and right of them are judged,
each as a run of its own.  Both models are counts of neighbouring characters in
labelled samples; their add-one log-likelihood ratios are rounded to thousandths, so a token's score is a
sum of integers, the same on every machine.  :func:`samples` labels tokens: random strings are digests in
several alphabets, ordinary ones the words and identifiers of ``sample_docs`` documents (the first by hash).

Positions come from the pieces between the matches: a match starts where the pieces and matches before it end, summed
in blocks; the base spans that touch a run are found by bisection.  So a text costs about its length, however many matches it
holds.  All of it is projections without a shuffle; only the training counts (at most 2 x 128 x 128 rows) are aggregated.

Defined results: a null or empty text has no spans.  Base spans stay; a method span never overlaps one.  Rows are
judged one by one, so ties and repeated rows repeat their result; a table without samples gives base spans only.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # a run of 20 or more from its first AKIA on; a shorter one holds no longer one
HEX = r"[0-9a-f]{24,}"  # the maximal runs of 24 or more
KEYLIKE = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "markov")
SAMPLE_DOCS, THRESHOLD, SEED, LEAST_RUN = 2_000, 12_000, 11, 20
_SIDE, _BLOCK, _LEVELS = 128, 32, 4


def sums_before(rows: DataFrame, sizes: str, out: str) -> DataFrame:
    """``rows`` with ``out``: for each element of the array column ``sizes`` the sum of those before it.

    Blocks of 32 elements are summed, then blocks of 32 blocks, and so on; going back down, an element adds to what lies
    before its block the less than 32 elements before it there.  So an array of n elements costs about 32 n steps.  Each level is a column
    that the next one names twice, else the planner would put its expression into the next one's loop.
    """
    zero, level = F.lit(0), [f"__{out}_{k}" for k in range(_LEVELS + 1)]
    add = lambda part: F.aggregate(part, zero, lambda total, x: total + x)
    many = F.size(sizes) > _BLOCK
    rows = rows.withColumn(level[0], F.col(sizes))
    for k in range(_LEVELS):
        below = F.col(level[k])
        blocks = F.transform(F.sequence(zero, F.floor((F.size(below) - 1) / _BLOCK).cast("int")), lambda b: add(F.slice(below, b * _BLOCK + 1, F.lit(_BLOCK))))
        rows = rows.withColumn(level[k + 1], F.when(many, blocks))
    top = F.col(level[_LEVELS])
    rows = rows.withColumn(out, F.transform(top, lambda x, i: add(F.slice(top, F.lit(1), i))))
    for k in range(_LEVELS - 1, -1, -1):
        own, before = F.col(level[k]), F.col(out)
        start = lambda i: F.when(F.size(before) > 0, F.get(before, F.floor(i / _BLOCK).cast("int")))
        deep = F.transform(own, lambda x, i: start(i) + add(F.slice(own, i - i % _BLOCK + 1, i % _BLOCK)))
        rows = rows.withColumn(out, F.when(many, deep) if k else F.when(many, deep).otherwise(F.transform(own, lambda x, i: add(F.slice(own, F.lit(1), i)))))
    return rows.drop(*level)


def with_matches(rows: DataFrame, text: str, pattern: str, out: str) -> DataFrame:
    """``rows`` with ``out``: (start, end, value) of the leftmost non-overlapping matches, in code points, end exclusive, ascending."""
    found, sizes, before = f"__{out}_found", f"__{out}_sizes", f"__{out}_before"
    rows = rows.withColumn(found, F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)))
    gaps = F.when(F.size(found) > 0, F.transform(F.slice(F.split(F.col(text), pattern, -1), F.lit(1), F.size(found)), F.length))
    steps = F.zip_with(F.coalesce(gaps, F.array().cast("array<int>")), F.transform(found, F.length), lambda gap, n: F.struct(gap.alias("gap"), n.alias("n")))
    rows = rows.withColumn(f"__{out}_steps", steps).withColumn(sizes, F.transform(f"__{out}_steps", lambda s: s["gap"] + s["n"]))
    rows = sums_before(rows, sizes, before)
    first = F.zip_with(before, f"__{out}_steps", lambda at, s: F.struct((at + s["gap"]).alias("start"), (at + s["gap"] + s["n"]).alias("end")))
    spans = F.zip_with(first, found, lambda p, v: F.struct(p["start"].alias("start"), p["end"].alias("end"), v.alias("value")))
    return rows.withColumn(out, spans).drop(found, sizes, before, f"__{out}_steps")


def samples(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, seed: int = SEED) -> DataFrame:
    """(token, random): labelled tokens, from the ``sample_docs`` documents that come first by hash."""
    first = docs.select("doc_id").where("doc_id IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(sample_docs)
    picked = docs.select("doc_id", "text").join(first, "doc_id").where("text IS NOT NULL")
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), ACCESS, " "), HEX, " ")
    words = picked.select(F.explode(F.regexp_extract_all(bare, F.lit(r"[A-Za-z_][A-Za-z_-]{4,}[0-9]{0,4}"), F.lit(0))).alias("token"))
    ordinary = words.unionByName(first.select(F.lit("https://www.example.org/index.html").alias("token")))
    digest = F.unhex(F.sha2(F.concat(F.col("doc_id").cast("string"), F.lit(f"/{seed}")), 512))
    code = F.base64(digest)
    random = first.select(F.explode(F.array(
        F.lower(F.hex(digest)), code, F.translate(code, "+/=", "-_"), F.upper(F.regexp_replace(code, "[^A-Za-z0-9]", "")),
        F.regexp_replace(code, "[^A-Za-z0-9]", ""))).alias("token"))
    return ordinary.select("token", F.lit(0).alias("random")).unionByName(random.select("token", F.lit(1).alias("random")))


def _steps(token: Column) -> Column:
    """The numbers of a token's neighbouring characters; the first follows character 0."""
    code = lambda c: F.least(F.ascii(c), F.lit(_SIDE - 1))
    chars = F.array_remove(F.split(token, "", -1), "")
    return F.transform(chars, lambda c, i: F.when(i == 0, F.lit(0)).otherwise(code(F.get(chars, i - 1))) * _SIDE + code(c))


def train(labelled: DataFrame) -> list[int]:
    """Log-likelihood ratios, random over ordinary, of each step in thousandths (add-one smoothing)."""
    counts = labelled.select("random", F.explode(_steps(F.col("token"))).alias("step")).groupBy("step").agg(
        F.sum(F.col("random")).alias("r"), F.sum(1 - F.col("random")).alias("o"))
    rows = counts.withColumn("before", F.floor(F.col("step") / _SIDE).cast("int"))
    whole = rows.groupBy("before").agg(F.sum("r").alias("all_r"), F.sum("o").alias("all_o"))
    ratio = F.log((F.col("r") + 1) / (F.col("all_r") + _SIDE)) - F.log((F.col("o") + 1) / (F.col("all_o") + _SIDE))
    unseen = F.log(1 / (F.col("all_r") + _SIDE)) - F.log(1 / (F.col("all_o") + _SIDE))
    table = [0] * (_SIDE * _SIDE)
    for before, value in whole.select("before", F.round(1000 * unseen).cast("int")).collect():  # at most 128 rows
        table[before * _SIDE:(before + 1) * _SIDE] = [value] * _SIDE
    for step, value in rows.join(whole, "before").select("step", F.round(1000 * ratio).cast("int")).collect():  # at most 128 x 128
        table[step] = value
    return table


def _first_where(spans: Column, holds) -> Column:
    """The index of the first span that a condition holds for, by bisection: it must hold for all behind it."""
    def step(acc: Column, _: Column) -> Column:
        middle = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        found = holds(F.get(spans, middle))
        return F.when(acc["lo"] >= acc["hi"], acc).otherwise(F.struct(
            F.when(found, acc["lo"]).otherwise(middle + 1).alias("lo"), F.when(found, middle).otherwise(acc["hi"]).alias("hi")))

    start = F.struct(F.lit(0).alias("lo"), F.size(spans).alias("hi"))
    steps = F.ceil(F.log2(F.size(spans) + 1)).cast("int") + 1
    return F.aggregate(F.sequence(F.lit(1), steps), start, step, lambda acc: acc["lo"])


def _touching(spans: Column, run: Column) -> Column:
    """The spans of one kind (ascending, disjoint) that overlap a run."""
    few = F.filter(spans, lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"]))
    first = _first_where(spans, lambda b: b["end"] > run["start"])
    last = _first_where(spans, lambda b: b["start"] >= run["end"])
    return F.when(F.size(spans) <= _BLOCK, few).otherwise(F.slice(spans, first + 1, F.greatest(last - first, F.lit(0))))


def parts(runs: Column, kinds: list[str]) -> Column:
    """What the spans of these columns (each ascending and disjoint) leave of each run: (start, end, value) of at least LEAST_RUN
    characters.  A part begins where the run does or a span ends, and ends where the next span of any kind begins; where another
    span covers its beginning, that is at or before it, and nothing is left."""
    def left(run: Column) -> Column:
        starts = F.array_distinct(F.concat(F.array(run["start"]), *[F.transform(_touching(F.col(k), run), lambda b: b["end"]) for k in kinds]))

        def piece(at: Column) -> Column:
            ahead = [F.when(F.size(k) > 0, F.get(F.col(k), _first_where(F.col(k), lambda b: b["end"] > at))["start"]) for k in kinds]
            return F.struct(at.alias("start"), F.least(run["end"], *ahead).alias("end"))

        free = F.filter(F.transform(starts, piece), lambda p: p["end"] - p["start"] >= LEAST_RUN)
        return F.transform(free, lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"), F.substring(
            run["value"], p["start"] - run["start"] + 1, p["end"] - p["start"]).alias("value")))

    return F.flatten(F.transform(runs, left))


def score(token: Column, table: list[int]) -> Column:
    ratios = F.from_json(F.lit(json.dumps(table)), "array<int>")
    return F.aggregate(_steps(token), F.lit(0), lambda a, s: a + F.get(ratios, s))


def scan(docs: DataFrame, table: list[int] | None, threshold: int = THRESHOLD, text: str = "text") -> DataFrame:
    """``docs`` in struct ``doc`` with ``base`` and ``spans``: arrays of (start, kind, end), kind its place in KINDS.

    ``table`` is what :func:`train` returns; without it there are base spans only.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), t.alias("t"))
    for kind, pattern in zip(KINDS, (ASSIGN, ACCESS, HEX)):
        rows = with_matches(rows, "t", pattern, kind)
    rows = rows.withColumn("assign", F.filter("assign", lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 1)) >= 6))
    tag = lambda spans, kind: F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))
    base = F.sort_array(F.concat(*[tag(k, i) for i, k in enumerate(KINDS[:3])]))
    if table is None:
        return rows.select("doc", base.alias("base")).withColumn("spans", F.col("base"))
    rows = with_matches(rows, "t", KEYLIKE, "runs").withColumn("base", base)
    free = F.filter(parts(F.col("runs"), list(KINDS[:3])), lambda s: s["value"].rlike("[A-Za-z]"))
    found = F.filter(free, lambda s: score(s["value"], table) >= threshold)
    return rows.select("doc", "base", F.sort_array(F.concat("base", tag(found, 3))).alias("spans"))


def joined(spans: str) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, the counts of base spans, base_sha256 and all spans."""
    slim = docs.select("doc_id", "text")
    found = scan(slim, train(samples(slim)), **options)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc.doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"), joined("spans").alias("spans"))
