"""Operator 12: similarity join of documents by a count-vector R-tree.

A document's set holds its distinct ``width``-word shingles (a text of fewer words, but not none, is one shingle); two
documents link when 100 * intersection >= ``percent`` * union.

Points.  Shingles are hashed into ``groups`` groups; a set's point counts its shingles by group.  The summed minima of two
points' coordinates bound the overlap of the sets from above.  So do those of the greatest coordinates of two boxes for
all sets inside, and their least sizes bound what an overlap must reach.  What the bounds let through is verified on the
sets.

One tree over all points prunes nothing near its root: counts of random groups differ by about the root of a set's
size, less than the slack that the threshold leaves, so every box overlaps every other.  The points are therefore
dealt to a forest first.  Of two linked sets, ordered by any one rule, the first (100 - percent) % of each share a
shingle; the rule is rare groups first, by counts of all documents in ``sketch`` groups.  Each such shingle that two
texts share roots a tree of the texts that have it.  In a tree:

1. *Pivots.*  In each of ``pivot_rounds`` rounds the members of a tree are tested against one pivot; links merge
   components.  A group of n near copies costs about n tests a round, not n * n / 2.
2. *Leaves.*  Trees that still hold several components are packed by size class, component and size into leaves
   of at most ``leaf`` points, cut wherever a task ends, so a tree of any size spans as many tasks as it needs.  Pairs of
   leaves of a tree are pruned by their boxes, and leaves of one same component are passed over.
3. *Points.*  In the pairs of leaves that are left, all pairs of points of different components are bounded by their
   summed minima, in the first tree that holds both, and the rest are verified.

Trees with the same members need the same tests: one of them stands for all.  So every pair of sets that can link is in one component before step 3, or is tested: no link is lost.  Bounds and tests are in
whole numbers.

Scale: texts are read three times (group counts, signatures, points) and travel once, one of each node per task; a signature
is a seventh of a text's shingles.  The only broadcast is the table of ``sketch`` groups.
Hot trees and components are reduced by partial aggregates and joined back between plain exchanges, where adaptive
execution may split the hot side.  Components come from rounds of star joins, never on the driver.

Defined results: equal texts share a component unless they have no words; texts without words, and nulls, have
n_shingles 0 and are alone.  component_id is the least doc_id of the component (null if it has none; of a text
without words its own doc_id).  Repeated rows are rows like any other.  Only doc_id and text are read.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import LOWER, U64, discard, map_arrow, mix, slices, span_hashes, staged, stored, utf8, word_spans
from rollcall.llm.near_dedup import components

WIDTH, PERCENT, GROUPS, SKETCH, LEAF, PIVOT_ROUNDS = 4, 85, 256, 1 << 16, 256, 2
_KEY_BITS = U64(54)
_KEY = U64((1 << 54) - 1)
_CLASS_BITS, _KEY_BYTES, _MANY = 14, 6, (1 << 16) - 1
_MULTIPLIERS = mix(np.arange(1, 65, dtype=U64) * U64(0xC2B2AE3D27D4EB4F)) | U64(1)

#: Bytes of a word: all but blank and 0x09 to 0x0D.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False


# ---------------------------------------------------------------- sets, signatures, points

def shingle_sets(buf: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Distinct shingles of at most 1,023 rows, as row << 54 | key, in ascending order."""
    starts, ends, first = word_spans(buf, offsets, NOT_BLANK)
    word = span_hashes(LOWER[buf], starts, ends)
    n = np.diff(first)
    short = (n > 0) & (n < width)
    key = np.zeros(len(word) + width, U64)
    for k in range(width):
        key[:len(word)] += np.concatenate([word[k:], np.zeros(min(k, len(word)), U64)]) * _MULTIPLIERS[k]
    row = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(word))
    whole = at + width <= first[1:][row]
    rows, keys = [row[whole]], [key[:len(word)][whole]]
    for r in np.flatnonzero(short):  # the whole sequence as one shingle
        own = word[first[r]:first[r + 1]]
        rows.append(np.array([r]))
        keys.append(np.array([(own * _MULTIPLIERS[:len(own)]).sum() + U64(len(own))], U64))
    tagged = (np.concatenate(rows).astype(U64) << _KEY_BITS) | (mix(np.concatenate(keys)) >> U64(10))
    tagged.sort()
    return tagged[np.concatenate([[True], tagged[1:] != tagged[:-1]])] if len(tagged) else tagged


def _sets(column: pa.Array, width: int):
    """(first row, rows, shingle_sets) of slices of a text column."""
    buf, offsets = utf8(column)
    for a, b in slices(offsets):
        yield a, b - a, shingle_sets(buf[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], width)


def group_counts(docs: DataFrame, sketch: int = SKETCH, width: int = WIDTH) -> np.ndarray:
    """How many documents' shingles fall into each of ``sketch`` groups."""
    def count(batches):
        total = np.zeros(sketch, np.int64)
        for batch in batches:
            for _, _, tagged in _sets(batch.column(0), width):
                total += np.bincount((tagged % U64(sketch)).astype(np.int64), minlength=sketch)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["part", "n"])

    parts = map_arrow(docs.select(F.col("text").cast("string")), count, "part long, n long").groupBy("part").agg(F.sum("n").alias("n"))
    found = parts.toPandas()  # at most ``sketch`` rows
    out = np.zeros(sketch, np.int64)
    out[found["part"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return out


def rarity(counts: np.ndarray) -> np.ndarray:
    """A class of 14 bits for each group, rare groups first."""
    rank = np.empty(len(counts), np.int64)
    rank[np.argsort(counts, kind="stable")] = np.arange(len(counts))
    return (rank * (1 << _CLASS_BITS) // len(counts)).astype(U64)


def first_length(n: np.ndarray, percent: int) -> np.ndarray:
    """How many first shingles of a set of n must meet those of any set that links with it."""
    return np.where(n > 0, n - (percent * n + 99) // 100 + 1, 0)


def text_key(text: Column) -> Column:
    """Identity of a text: its md5 (a null counts as empty)."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def signatures(docs: DataFrame, percent: int, width: int, sketch: int) -> DataFrame:
    """One row per distinct text: node, n and the first shingles in the order of rarity."""
    classes = docs.sparkSession.sparkContext.broadcast(rarity(group_counts(docs, sketch, width)))

    def sign(batches):
        order = classes.value
        for batch in batches:
            sizes, chosen = [], []
            for _, rows, tagged in _sets(batch.column(1), width):
                row = tagged >> _KEY_BITS
                n = np.bincount(row.astype(np.int64), minlength=rows)
                key = tagged & _KEY
                ranked = (row << _KEY_BITS) | (order[(tagged % U64(sketch)).astype(np.int64)] << U64(40)) | (key >> U64(14))
                ranked.sort()
                place = np.arange(len(ranked)) - np.repeat(np.cumsum(n) - n, n)
                chosen.append((ranked & _KEY)[place < np.repeat(first_length(n, percent), n)].view(np.int64))
                sizes.append(n)
            size = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
            cut = np.concatenate([[0], np.cumsum(first_length(size, percent))])
            keys = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(np.concatenate(chosen) if chosen else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), keys], ["node", "n", "first"])

    texts = docs.select(text_key(F.col("text")).alias("node"), F.col("text").cast("string"))
    found = map_arrow(texts, sign, "node binary, n long, first array<long>").dropDuplicates(["node"])
    return found.withColumn("id", F.monotonically_increasing_id())


def points(texts: DataFrame, groups: int, width: int) -> DataFrame:
    """(id, n, counts, keys) of texts (id, text): the point as ``groups`` unsigned 16-bit numbers (the greatest stands for all beyond),
    the set as 48-bit numbers, ascending."""
    def make(batches):
        for batch in batches:
            for a, rows, tagged in _sets(batch.column(1), width):
                row = (tagged >> _KEY_BITS).astype(np.int64)
                key = tagged & _KEY
                n = np.bincount(row, minlength=rows)
                spot = ((key >> U64(18)) % U64(groups)).astype(np.int64)
                counts = np.minimum(np.bincount(row * groups + spot, minlength=rows * groups), _MANY).astype("<u2").reshape(rows, groups)
                raw = (key >> U64(6)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_KEY_BYTES].tobytes()
                ends = _KEY_BYTES * np.cumsum(n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, rows), pa.array(n, pa.int64()), pa.array([c.tobytes() for c in counts], pa.binary()),
                     pa.array([raw[e - _KEY_BYTES * m:e] for e, m in zip(ends.tolist(), n.tolist())], pa.binary())], ["id", "n", "counts", "keys"])

    return map_arrow(texts, make, "id long, n long, counts binary, keys binary")


def _keys(raw) -> np.ndarray:
    """The numbers of a set."""
    wide = np.zeros((len(raw) // _KEY_BYTES, 8), np.uint8)
    wide[:, :_KEY_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, _KEY_BYTES)
    return wide.view("<u8").ravel()


# ---------------------------------------------------------------- bounds and tests

def reaches(overlap, size_a, size_b, percent: int):
    """True where an overlap of sets of these sizes is a link (columns or arrays)."""
    return (100 + percent) * overlap >= percent * (size_a + size_b)


def _counts(column: pa.Array) -> np.ndarray:
    """The points of a binary column, one row each."""
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.uint16)


def summed_minima(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row by row, what bounds the overlap from above; where both counts are too many to tell, anything may be shared."""
    least = np.minimum(x, y)
    total = least.sum(axis=1, dtype=np.int64)
    return np.where((least == _MANY).any(axis=1), np.int64(1) << 40, total)


@contextmanager
def small_batches(spark, rows: int):
    """Arrow batches of few rows, for tables with large ones; what is written inside keeps to it."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def bounded(pairs: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose summed minima may reach the threshold."""
    def check(batches):
        for batch in batches:
            n, m = (batch.column(k).to_numpy() for k in (4, 5))
            minima = summed_minima(_counts(batch.column(2)), _counts(batch.column(3))) if len(n) else n
            good = reaches(minima, n, m, percent)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(good)), batch.column(1).filter(pa.array(good))], ["a", "b"])

    left, right = (found.select(F.col("id").alias(s), F.col("counts").alias(f"counts_{s}"), F.col("n").alias(f"n_{s}")) for s in "ab")
    return map_arrow(pairs.join(left, "a").join(right, "b").select("a", "b", "counts_a", "counts_b", "n_a", "n_b"), check, "a long, b long")


def verified(pairs: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link, by their sets."""
    def check(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = _keys(x.as_buffer()), _keys(y.as_buffer())
                both = np.concatenate([x, y])
                both.sort()
                good.append(bool(reaches(int((both[1:] == both[:-1]).sum()), len(x), len(y), percent)))
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    left, right = (found.select(F.col("id").alias(s), F.col("keys").alias(f"keys_{s}")) for s in "ab")
    return map_arrow(pairs.join(left, "a").join(right, "b").select("a", "b", "keys_a", "keys_b"), check, "a long, b long")


# ---------------------------------------------------------------- leaves

LEAVES = ("tree long, leaf long, least long, most long, comp_lo long, comp_hi long, box array<long>, ids array<long>, comps array<long>, "
          "sizes array<long>, trees array<long>, counts binary, a array<long>, b array<long>")


@dataclass
class Leaf:
    """Points of one tree: ids, components, sizes, counts, and the trees that each of them is in (ascending, -1 fills up)."""

    ids: np.ndarray
    comps: np.ndarray
    n: np.ndarray
    counts: np.ndarray
    trees: np.ndarray


def near_points(left: Leaf, right: Leaf, tree: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of points of two leaves of a tree (or of one leaf) in different components whose summed minima may reach the
    threshold, unless an earlier tree holds both, which has them already."""
    a, b = [], []
    for i, (point, n) in enumerate(zip(left.counts, left.n)):
        on = (right.comps != left.comps[i]) & (100 * right.n >= percent * n) & (100 * n >= percent * right.n)
        if right is left:
            on[:i + 1] = False
        on = np.flatnonzero(on)
        on = on[reaches(summed_minima(right.counts[on], point[None, :]), right.n[on], n, percent)]
        if len(on):
            theirs = right.trees[on]
            shared = np.isin(theirs, left.trees[i][left.trees[i] >= 0])
            on = on[np.where(shared, theirs, _KEY.astype(np.int64)).min(axis=1) == tree]
        a.append(np.full(len(on), left.ids[i]))
        b.append(right.ids[on])
    a, b = np.concatenate(a), np.concatenate(b)
    return np.minimum(a, b), np.maximum(a, b)


def _padded(lists: pa.Array) -> np.ndarray:
    """A list column as rows of a matrix, -1 behind shorter lists."""
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.full((len(lists), int(sizes.max(initial=1))), -1, np.int64)
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = lists.flatten().to_numpy()
    return out


def leaves(rows: DataFrame, leaf: int, percent: int) -> DataFrame:
    """Pack (tree, id, comp, n, counts, trees) into leaves of at most ``leaf`` points of one tree.

    A tree that is one leaf, with no rows in another task, needs no box: its row holds its near points (a, b) instead.
    """
    empty = {"box": [], "ids": [], "comps": [], "sizes": [], "trees": [], "counts": b"", "a": [], "b": []}
    lists = pa.list_(pa.int64())
    kinds = {"tree": pa.int64(), "leaf": pa.int64(), "least": pa.int64(), "most": pa.int64(), "comp_lo": pa.int64(), "comp_hi": pa.int64(),
             "box": lists, "ids": lists, "comps": lists, "sizes": lists, "trees": lists, "counts": pa.binary(), "a": lists, "b": lists}

    def pack(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        held: list[pa.RecordBatch] = []
        headless = True  # whether leaves of the first tree held are out already, or may be: it may begin in the task before

        def row_of(part: pa.Table, whole: bool) -> dict:
            tree, ids, comps, n = (part.column(k).to_numpy() for k in range(4))
            counts = part.column(4).combine_chunks()
            own = Leaf(ids, comps, n, _counts(counts), _padded(part.column(5).combine_chunks()))
            row = empty | {"tree": int(tree[0]), "leaf": number, "least": int(n.min()), "most": int(n.max()),
                           "comp_lo": int(comps.min()), "comp_hi": int(comps.max())}
            if whole:
                a, b = near_points(own, own, int(tree[0]), percent)
                return row | {"a": a.tolist(), "b": b.tolist()}
            box = own.counts.max(axis=0).astype(np.int64)
            box[box == _MANY] = 1 << 40
            return row | {"box": box.tolist(), "ids": ids.tolist(), "comps": comps.tolist(), "sizes": n.tolist(),
                          "trees": own.trees.ravel().tolist(), "counts": b"".join(counts.to_pylist())}

        def full(last: bool):
            """Leaves of all that is held but, unless ``last``, the rows that may still belong to an open leaf."""
            nonlocal number, held, headless
            if not held:
                return
            part = pa.Table.from_batches(held)
            tree = part.column(0).to_numpy()
            start = np.flatnonzero(np.diff(tree, prepend=tree[0] - 1) != 0).tolist()
            out: list[dict] = []
            rest = len(tree)
            for a, b in zip(start, [*start[1:], len(tree)]):
                whole = b - a <= leaf and b < len(tree) and not (headless and a == 0)
                for at in range(a, b, leaf):
                    end = min(at + leaf, b)
                    if not last and end == len(tree):  # the tree may go on
                        rest = at
                        break
                    out.append(row_of(part.slice(at, end - at), whole))
                    number += 1
            headless = rest not in start or rest == 0 and headless
            held = part.slice(rest).to_batches()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], kind) for c, kind in kinds.items()], list(kinds))

        for batch in batches:
            held.append(batch)
            yield from full(False)
        yield from full(True)

    size_class = F.floor(F.log(F.col("n")) / F.log(F.lit(100 / percent)))
    order = [F.col("tree"), size_class, F.col("comp"), F.col("n"), F.col("id")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("tree", "id", "comp", "n", "counts", "trees")
    return map_arrow(dealt, pack, LEAVES)


def leaf_pairs(packed: DataFrame, percent: int) -> DataFrame:
    """Pairs of leaves of a tree whose boxes may hold a link between components."""
    slim = packed.where("size(ids) > 0").select("tree", "leaf", "least", "most", "comp_lo", "comp_hi", "box")
    x, y = slim.alias("x"), slim.alias("y")
    minima = F.aggregate(F.zip_with("x.box", "y.box", lambda a, b: F.least(a, b)), F.lit(0).cast("long"), lambda total, m: total + m)
    same = (F.col("x.comp_lo") == F.col("x.comp_hi")) & (F.col("y.comp_lo") == F.col("y.comp_hi")) & (F.col("x.comp_lo") == F.col("y.comp_lo"))
    sizes = (100 * F.col("x.most") >= percent * F.col("y.least")) & (100 * F.col("y.most") >= percent * F.col("x.least"))
    near = x.join(y, (F.col("x.tree") == F.col("y.tree")) & (F.col("x.leaf") <= F.col("y.leaf")) & sizes & ~same)
    return near.where(reaches(minima, F.col("x.least"), F.col("y.least"), percent)).select(F.col("x.tree").alias("tree"), F.col("x.leaf").alias("x"), F.col("y.leaf").alias("y"))


def point_pairs(packed: DataFrame, near: DataFrame, percent: int) -> DataFrame:
    """The near points (a, b) of trees that are one leaf, and of the pairs of leaves of the others; each pair once."""
    columns = ("ids", "comps", "sizes", "counts", "trees")

    def leaf_of(values) -> Leaf:
        ids, comps, n, counts, trees = values
        k = len(ids.values)
        return Leaf(*(v.values.to_numpy() for v in (ids, comps, n)), np.frombuffer(counts.as_buffer(), "<u2").reshape(k, -1),
                    trees.values.to_numpy().reshape(k, -1))

    def meet(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = [batch.column(c)[k] for c in range(batch.num_columns)]
                left = leaf_of(row[3:8])
                right = left if row[1] == row[2] else leaf_of(row[8:])
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in near_points(left, right, row[0].as_py(), percent)], ["a", "b"])

    blocks = packed.where("size(ids) > 0").select("leaf", *columns)
    left, right = (blocks.select(F.col("leaf").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in columns]) for s in "xy")
    both = near.join(left, "x").join(right, "y").select("tree", "x", "y", *[f"{c}_{s}" for s in "xy" for c in columns])
    whole = packed.where("size(a) > 0").select(F.inline(F.arrays_zip("a", "b")))
    return whole.unionByName(map_arrow(both, meet, "a long, b long"))


# ---------------------------------------------------------------- the join

def join_texts(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH, groups: int = GROUPS, sketch: int = SKETCH,
               leaf: int = LEAF, pivot_rounds: int = PIVOT_ROUNDS) -> tuple[DataFrame, DataFrame]:
    """The distinct texts (node, id, n), and the component (id, comp) of each that shares a first shingle with another."""
    spark = docs.sparkSession
    signed, signed_folder = staged(signatures(docs, percent, width, sketch), "join-signatures")
    names = stored(signed.select("node", "id", "n"), "join-names")
    spread = signed.select("id", F.explode(F.array_distinct("first")).alias("tree"))
    often = spread.groupBy("tree").agg(F.count("*").alias("m")).where("m > 1")
    every = stored(spread.join(often, "tree"), "join-every")
    discard(spark, signed_folder)
    # many trees have the same members: one of them says it all
    alike = every.groupBy("tree", "m").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.bit_xor(F.xxhash64("id")).alias("x"),
                                           F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y"))
    trees = alike.groupBy("m", "lo", "hi", "x", "y").agg(F.min("tree").alias("tree")).select("tree")
    members = stored(every.join(trees, "tree"), "join-members")
    own = stored(members.select("id").distinct().join(names, "id"), "join-own")
    # one text of each node per task travels, once
    texts = docs.select(text_key(F.col("text")).alias("node"), F.col("text").cast("string").alias("text")).dropDuplicates(["node"])
    texts = texts.join(own.select("node", "id"), "node").select("id", "text")
    found, found_folder = staged(points(texts, groups, width), "join-points")

    label = stored(own.select("id", F.col("id").alias("comp"), "n"), "join-label")
    tested: list[DataFrame] = []
    for turn in range(pivot_rounds + 1):
        now = (members if turn == 0 else members.where("m > 2")).join(label, "id")  # a tree of two is settled by its pivot
        spot = F.xxhash64("id", F.lit(turn))
        split = now.groupBy("tree").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min_by("id", spot).alias("pivot"),
                                        F.min_by("comp", spot).alias("pivot_comp"), F.min_by("n", spot).alias("pivot_n")).where("lo <> hi")
        if turn < pivot_rounds:
            fits = (100 * F.col("n") >= percent * F.col("pivot_n")) & (100 * F.col("pivot_n") >= percent * F.col("n"))
            pairs = now.join(split, "tree").where((F.col("comp") != F.col("pivot_comp")) & fits)
            pairs = pairs.select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct()
        else:
            rest = stored(now.join(split.select("tree"), "tree"), "join-rest")
            trees = rest.groupBy("id").agg(F.sort_array(F.collect_set("tree")).alias("trees"))  # a text has a seventh of its shingles at most
            rest = rest.join(found.select("id", "counts"), "id").join(trees, "id")
            packed, packed_folder = staged(leaves(rest, leaf, percent), "join-leaves")
            pairs = point_pairs(packed, stored(leaf_pairs(packed, percent), "join-near"), percent)
        if tested:
            pairs = pairs.join(reduce(DataFrame.unionByName, tested), ["a", "b"], "left_anti")
        with small_batches(spark, 32 if turn == pivot_rounds else 10_000):
            pairs = stored(pairs, "join-pairs")
        tested.append(pairs)
        kept = stored(bounded(pairs, found, percent), "join-bounded") if turn < pivot_rounds else pairs
        with small_batches(spark, 256):
            links = stored(verified(kept, found, percent), "join-links")
        for side in ("a", "b"):
            links = links.join(label.select(F.col("id").alias(side), F.col("comp").alias(f"{side}_comp")), side)
        joined = components(links.select(F.col("a_comp").alias("a"), F.col("b_comp").alias("b")))
        joined = joined.select(F.col("node").alias("comp"), F.col("comp").alias("to"))
        label = stored(label.join(joined, "comp", "left").select("id", F.coalesce("to", "comp").alias("comp"), "n"), "join-label")
    discard(spark, found_folder)
    discard(spark, packed_folder)
    return names, label.select("id", "comp")


def report(docs: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, n_shingles and component_id."""
    slim = docs.select("doc_id", "text")
    texts, label = join_texts(slim, **options)
    texts = stored(texts.join(label, "id", "left").select("node", "n", F.when(F.col("n") > 0, F.coalesce("comp", "id")).alias("comp")), "join-texts")
    rows = slim.select("doc_id", text_key(F.col("text")).alias("node")).join(texts, "node")
    rows = stored(rows.select("doc_id", "n", "comp"), "join-rows")
    heads = stored(rows.where("comp IS NOT NULL").groupBy("comp").agg(F.min("doc_id").alias("head")), "join-heads")
    linked = rows.where("comp IS NOT NULL").join(heads, "comp").select("doc_id", F.col("n").alias("n_shingles"), F.col("head").alias("component_id"))
    alone = rows.where("comp IS NULL").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)


ORACLE_SQL = r"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS spot, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS MATERIALIZED (
  SELECT spot, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
  FROM words),
each AS MATERIALIZED (SELECT spot, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS MATERIALIZED (
  SELECT a.spot AS x, b.spot AS y FROM each a JOIN each b ON a.shingle = b.shingle AND a.spot < b.spot
  GROUP BY a.spot, b.spot, a.n, b.n HAVING 185 * count(*) >= 85 * (a.n + b.n)),
both_ways AS MATERIALIZED (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT spot AS x, spot AS y FROM sets UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON b.x = r.y)
SELECT d.doc_id, len(d.s) AS n_shingles, min(o.doc_id) AS component_id
FROM sets d JOIN reach r ON r.x = d.spot JOIN sets o ON o.spot = r.y
GROUP BY d.spot, d.doc_id, len(d.s)
"""
