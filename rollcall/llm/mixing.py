"""Operator 9: mixing sources to target weights by pivotal dependent rounding.

Each source gets a target number of words: a share of all words by its weight, at most ``most_copies`` times what
it has, the excess reshared by weight until no target is above.  A document of a source then stands for
c = target / source size copies: floor(c) for certain, and one more with probability c - floor(c).

The extra copies are drawn dependently.  The documents of a source are ordered by falling size class, salt, size and
hash, and a running unit goes along: two fractional probabilities meet, words (probability times size) move at
random from one to the other until one of them is 0 or 1, and the other goes on.  Every probability keeps its
expectation and every step keeps the sum of the words, so a source misses its target only by the rounding of its
last unit, which is a small document unless the source holds few.

Scale: only (source, size, hash) travel, never texts.  Leaves of the reduction are (source, size class, salt), with
salts so many that a leaf has about ``leaf_rows`` rows however large its source is; a leaf is streamed, holding one
running unit, and leaves at most one fractional residual.  Residuals are combined level by level, ``fan_in`` leaves at
a time in leaf order, down to one for each source, whose last fraction is a coin toss.  All draws are
hashes of the seed and the leaf's place, so reruns agree, whatever the partitions.

Defined results: a null or empty text has size 0; it takes part in the draw but adds no word.  A null source is a
source of its own, last in order.  A source without words has target 0 and is taken once per row at most zero times.
Repeated rows are separate documents, numbered so that they spread over leaves; which of several equal rows is drawn is not
told apart.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import U64, map_arrow, mix, stored, uniform
from rollcall.operators.ranking import sequence_within

MOST_COPIES, LEAF_ROWS, FAN_IN, SEED = 3, 20_000, 64, 20240229


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, most_copies: int = MOST_COPIES) -> DataFrame:
    """Per source of ``sizes`` (source, source_size): its weight and target.

    Capping and resharing ends where sources below a level of cap / weight have their cap and the others share the
    rest by weight; the level is found from running sums over the sources in order of cap / weight (one row a source).
    """
    ranked = sizes.withColumn("weight", (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % 3 + 1)
    cap, w = F.col("source_size") * most_copies, F.col("weight")
    order = Window.orderBy(cap / w, F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    weights = F.sum(w).over(order.rowsBetween(0, Window.unboundedFollowing))
    level = ranked.withColumn("level", left / weights).withColumn("cap", cap)
    # the first source whose share at its level is within its cap fixes the level of all that follow
    fixed = level.withColumn("share", F.first(
        F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level")), True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return fixed.select("source", "source_size", "weight", F.when(
        F.col("source_size") == 0, F.lit(0.0)).otherwise(F.least(F.col("cap").cast("double"), F.col("share") * F.col("weight"))).alias("target"))


def pivot(p: float, size_p: int, q: float, size_q: int, draw: float) -> tuple[float, float]:
    """Move words between two units until a probability is 0 or 1, keeping both expectations and the words."""
    up = min((1 - p) * size_p, q * size_q)
    down = min(p * size_p, (1 - q) * size_q)
    words = up if draw * (up + down) < down else -down
    return p + words / size_p, q - words / size_q


_NEAR = 1e-9


def _settle(p: float) -> float:
    return float(round(p)) if min(p, 1 - p) <= _NEAR else p


def _draw(*place) -> float:
    """A number in (0, 1) that depends on the place alone."""
    h = U64(0)
    for x in place:
        h = mix(np.asarray(h ^ U64(hash_of(x)), U64) + U64(0x9E3779B97F4A7C15))
    return float(uniform(h))


def hash_of(x) -> int:
    return int.from_bytes(hashlib.blake2b(repr(x).encode(), digest_size=8).digest(), "little")


class Reducer:
    """Pairs the units (key, p, size) of one leaf in order; ``rest`` is what is still fractional."""

    def __init__(self, *place):
        self.place, self.drawn, self.rest = place, 0, None

    def add(self, key, p: float, size: int) -> list[tuple]:
        """The units that this one settles, with p 0 or 1."""
        p = _settle(p)
        units = [(key, p, size)]
        if 0 < p < 1 and (self.rest is not None or size == 0):
            self.drawn += 1
            draw = _draw(*self.place, self.drawn)
            if size == 0:  # no words to move
                return [(key, float(draw < p), size)]
            held, self.rest = self.rest, None
            a, b = pivot(held[1], held[2], p, size, draw)
            units = [(held[0], _settle(a), held[2]), (key, _settle(b), size)]
        for unit in units:
            if 0 < unit[1] < 1:
                self.rest = unit
        return [u for u in units if not 0 < u[1] < 1]


UNIT = "leaf string, place string, key long, p double, size long"


def reduce_leaves(units: DataFrame, level: int, seed: int) -> DataFrame:
    """Settle units (leaf, place, key, p, size) leaf by leaf: all come back, at most one of each leaf still fractional.

    Rows are partitioned by leaf and streamed in order of place; nothing but the running unit is held.
    """
    def run(batches):
        leaf, reducer, schema = None, None, None
        for batch in batches:
            schema = batch.schema
            out: list[tuple] = []
            for name, place, key, p, size in zip(*(c.to_pylist() for c in batch.columns)):
                if name != leaf or reducer is None:
                    if reducer is not None and reducer.rest is not None:
                        out.append((leaf, *reducer.rest))
                    leaf, reducer = name, Reducer(seed, level, name)
                out += [(leaf, *u) for u in reducer.add((place, key), p, size)]
            yield record(out, schema)
        if reducer is not None and reducer.rest is not None:
            yield record([(leaf, *reducer.rest)], schema)

    def record(rows, schema):
        columns = [[r[0] for r in rows], [r[1][0] for r in rows], [r[1][1] for r in rows], [r[2] for r in rows], [r[3] for r in rows]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    ordered = units.select("leaf", "place", "key", "p", "size").repartition("leaf").sortWithinPartitions("leaf", "place", "key")
    return map_arrow(ordered, run, UNIT)


def _numbered_repeats(slim: DataFrame) -> DataFrame:
    """``slim`` with ``nth``: rows equal in doc_id, size and source are numbered, others hold 0, so that repeated rows spread over leaves."""
    equal = F.xxhash64("doc_id", "size", "source")
    often = slim.groupBy(equal.alias("equal")).agg(F.count("*").alias("n")).where("n > 1").select("equal")
    repeated = slim.withColumn("equal", equal).join(often, "equal", "left_semi").select("equal", "key")
    nth = sequence_within(repeated, ["equal"], ["key"], out="nth").select("key", "nth")
    return slim.join(stored(nth, "repeats"), "key", "left").withColumn("nth", F.coalesce("nth", F.lit(0)))


def copies(docs: DataFrame, most_copies: int = MOST_COPIES, leaf_rows: int = LEAF_ROWS, fan_in: int = FAN_IN,
           seed: int = SEED, row: Column | None = None) -> DataFrame:
    """Per row of ``docs``: key, doc_id, source, size, source_size, target and copies, how often the mix takes the row.

    ``row``, if given, comes back as column ``row``.
    """
    # the facts of the rows, numbered once and written: what follows refers to the number
    slim = stored(docs.select(F.monotonically_increasing_id().alias("key"), docs["doc_id"], docs["source"],
                              size_of(docs["text"]).alias("size"), (F.lit(None) if row is None else row).cast("binary").alias("row")), "sizes")
    # size classes of an eighth of a power of two; within them salts, about leaf_rows rows each
    kind = F.floor(8 * F.log2(F.col("size") + 1)).cast("int").alias("kind")
    kinds = slim.groupBy("source", kind).agg(F.sum("size").alias("words"), F.ceil(F.count("*") / leaf_rows).alias("salts"))
    plan = targets(kinds.groupBy("source").agg(F.sum("words").alias("source_size")), most_copies)
    plan = stored(plan.select(F.col("source").alias("s"), "source_size", "target").join(
        kinds.drop("words"), F.col("s").eqNullSafe(F.col("source"))).select("s", "kind", "salts", "source_size", "target"), "plan")
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(share + _NEAR).cast("long")
    planned = _numbered_repeats(slim).withColumn("k", kind).join(plan, F.col("source").eqNullSafe(F.col("s")) & (F.col("k") == F.col("kind")))
    spot = F.xxhash64(F.lit(seed), "doc_id", "size", "source", "nth")
    place = F.concat_ws("/", F.sha2(F.coalesce(F.concat(F.lit("s"), "source"), F.lit("-")), 256), F.lpad((9999 - F.col("kind")).cast("string"), 4, "0"),
                        F.lpad(F.pmod(spot, F.col("salts")).cast("string"), 12, "0"))
    units = planned.select(place.alias("leaf"), F.format_string("%019d", F.lit(10**18) - F.col("size")).alias("size_place"), F.hex(spot).alias("spot"),
                           "key", F.greatest(share - whole, F.lit(0.0)).alias("p"), whole.alias("whole"), "size", "source_size", "target")
    units = stored(units, "units")
    done = stored(reduce_leaves(units.select("leaf", F.concat("size_place", "spot").alias("place"), "key", "p", "size"), 0, seed), "leaves")
    settled = [done.where("p IN (0, 1)").select("key", "p")]
    rest = done.where("p NOT IN (0, 1)")
    level, n = 0, rest.groupBy(F.split("leaf", "/")[0]).count().agg(F.max("count")).first()[0] or 0
    while n:
        # leaves of a source in order; fan_in neighbours meet
        level += 1
        ranked = sequence_within(rest.withColumn("source", F.split("leaf", "/")[0]), ["source"], ["leaf", "key"], out="i").withColumn("i", F.col("i") - 1)
        up = ranked.select(F.concat_ws("/", "source", F.format_string("%012d", F.floor(F.col("i") / fan_in).cast("long"))).alias("leaf"),
                           F.format_string("%012d", F.col("i").cast("long")).alias("place"), "key", "p", "size")
        done = stored(reduce_leaves(up, level, seed), "residuals")
        settled.append(done.where("p IN (0, 1)").select("key", "p"))
        rest = done.where("p NOT IN (0, 1)")
        if n <= fan_in:
            toss = (F.pmod(F.xxhash64(F.lit(seed), "leaf"), F.lit(1 << 30)) + 0.5) / float(1 << 30)
            settled.append(rest.select("key", (toss < F.col("p")).cast("double").alias("p")))
            break
        n = -(-n // fan_in)
    extra = reduce(DataFrame.unionByName, settled)
    taken = units.select("key", "source_size", "target", "whole").join(extra, "key")
    return slim.join(taken, "key").withColumn("copies", F.col("whole") + F.col("p").cast("long")).drop("whole", "p")


def report(docs: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, size, source_size, target and taken, the words the mix takes of it (repeats counted)."""
    return copies(docs.select("doc_id", "text", "source"), **options).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix, each as often as it is taken, with the columns of ``docs``.

    Rows are found again by a digest of all their columns; equal rows are taken together as often as their sum.
    """
    def digest(columns):
        return F.unhex(F.md5(F.to_json(F.struct(*columns)).cast("binary")))

    taken = copies(docs, row=digest([docs[c] for c in docs.columns]), **options)
    per_row = taken.groupBy("row").agg(F.sum("copies").alias("copies"), F.count("*").alias("equal")).where("copies > 0")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), digest([docs[c] for c in docs.columns]).alias("row"))
    found = rows.join(stored(per_row, "taken"), "row")
    once = found.where("equal = 1").unionByName(found.where("equal > 1").dropDuplicates(["row"]))
    return once.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("i")).select("doc.*")
