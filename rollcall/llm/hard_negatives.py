"""Operator 13: hard negatives by slot-decomposed selection.

An anchor's positives are its best rows of the same label.  Each positive opens a window of scores, from ``low`` to
``high`` percent of its own score, and the best rows of other labels in each window are wanted.  The windows of an
anchor overlap, so they are not searched one by one.  Their upper limits, in falling order, cut the scores into
disjoint slots: slot i lies above the upper limit of positive i + 1 and not above that of positive i.  Every task keeps
the first ``negatives`` rows of each slot of each anchor (a combiner), the slots of all tasks are merged by a window
whose limit Spark applies before its shuffle too, and an anchor's slots in a row are one list in falling order.  The
window of positive i holds what stands from slot i on, so its answer is the head of that suffix, down to its lower
limit.

Scale: anchors are handled in blocks of about ``block`` rows, the only thing that is broadcast; each block is scored
against all rows in tiles by matrix products, where the rows lie, so the rows are never shuffled.  A task emits at most
``positives`` or ``positives * negatives`` rows for each anchor, whatever the labels' sizes, and so a label that holds a third of the
rows costs no task more than another.  The driver holds one block and its positives at a time.

Scores are exact: products run in doubles where no sum can pass 2^53 and in whole numbers of any size elsewhere.

Defined results: rows with a null label, a null vector or a null or non-finite component take no part (nor do anchors
without another row of their label).  Higher scores come first, ties by smaller id, a null id last.  Rows with the
anchor's own id are never its positives.  Anchors that repeat entirely count once; other repeated rows are candidates
as often as they stand.  Missing components of a shorter vector count as 0.  Only the named columns are read.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import map_arrow, stored
from rollcall.session import ensure_checkpoint_dir

POSITIVES, NEGATIVES, LOW, HIGH, BLOCK = 5, 10, 30, 90, 8192
_TILE, _HELD = 1024, 1 << 20
_LAST = np.iinfo(np.int64).max  # stands for a null id
_NONE = np.iinfo(np.int64).min


def finite(vector: Column) -> Column:
    """True for vectors without null or non-finite entries."""
    return vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))


def matrix(vectors: pa.Array, width: int = 0) -> np.ndarray:
    """A list column as rows of whole numbers, at least ``width`` of them, zeros behind shorter vectors."""
    sizes = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(vectors), max(width, int(sizes.max(initial=0)))), np.int64)
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of the rows of two matrices of whole numbers, exactly."""
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, b))
    greatest = [max(int(m.max(initial=0)), -int(m.min(initial=0))) for m in (a, b)]
    most = greatest[0] * greatest[1] * width
    if most < 1 << 53:
        return a.astype(np.float64) @ b.astype(np.float64).T
    if most < 1 << 63:
        return a @ b.T
    return (a.astype(object) @ b.astype(object).T).astype(np.int64)  # raises if a score is no long


class Best:
    """The first ``k`` of each group by falling score, then rising id, of all that was offered."""

    def __init__(self, groups: int, k: int):
        self.k, self.least = k, np.full(groups, _NONE)
        self.parts: list[np.ndarray] = []
        self.held = 0

    def offer(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        on = score >= self.least[group]
        self.parts.append(np.stack([group[on], score[on], ids[on]]))
        self.held += int(on.sum())
        if self.held > _HELD:
            self.settle()

    def settle(self) -> np.ndarray:
        """What is kept, as rows group, score and id."""
        rows = np.concatenate(self.parts, axis=1) if self.parts else np.zeros((3, 0), np.int64)
        rows = rows[:, np.lexsort((rows[2], -rows[1], rows[0]))]
        place = np.arange(rows.shape[1]) - np.searchsorted(rows[0], rows[0])
        last = place == self.k - 1
        self.least[rows[0][last]] = rows[1][last]
        rows = rows[:, place < self.k]
        self.parts, self.held = [rows], rows.shape[1]
        return rows


def _tiles(batches, anchors: np.ndarray):
    """(first anchor, scores, ids, labels) of tiles of anchors against rows."""
    for batch in batches:
        ids = batch.column(0).fill_null(_LAST).to_numpy()
        labels, q = batch.column(1).to_numpy(), batch.column(2)
        for r in range(0, batch.num_rows, _TILE):
            part = matrix(q.slice(r, _TILE))
            for a in range(0, len(anchors), _TILE):
                yield a, products(anchors[a:a + _TILE], part), ids[r:r + _TILE], labels[r:r + _TILE]


def _positives(shared, k: int):
    def run(batches):
        ids, labels, q = shared.value
        best = Best(len(ids), k)
        for a, scores, others, kinds in _tiles(batches, q):
            same = (labels[a:a + _TILE, None] == kinds[None, :]) & (ids[a:a + _TILE, None] != others[None, :])
            x, y = np.nonzero(same & (scores >= best.least[a:a + _TILE, None]))
            best.offer(x + a, scores[x, y].astype(np.int64), others[y])
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in best.settle()], ["anchor", "score", "id"])

    return run


def _negatives(shared, k: int):
    def run(batches):
        ids, labels, q, upper, lower = shared.value
        slots = upper.shape[1]
        best = Best(len(ids) * slots, k)
        for a, scores, others, kinds in _tiles(batches, q):
            within = (scores <= upper[a:a + _TILE, :1]) & (scores >= lower[a:a + _TILE, None])
            x, y = np.nonzero(within & (labels[a:a + _TILE, None] != kinds[None, :]))
            score = scores[x, y].astype(np.int64)
            slot = (upper[x + a] >= score[:, None]).sum(axis=1) - 1
            best.offer((x + a) * slots + slot, score, others[y])
        group, score, other = best.settle()
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (group // slots, group % slots, score, other)], ["anchor", "slot", "score", "id"])

    return run


def _first(rows: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("id"))
    return rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
         high: int = HIGH, block: int = BLOCK) -> DataFrame:
    """Hard negatives of the anchors among ``rows`` (id long, label long, q array<long>, without nulls but for id).

    Returns anchor_id, positive_id, rank, negative_id, positive_score and negative_score.
    """
    spark = rows.sparkSession
    rows = stored(rows.select("id", "label", "q"), "vectors")
    anchors = stored(rows.where(is_anchor).distinct(), "anchors")
    blocks = max(1, -(-anchors.count() // block))
    base = f"{ensure_checkpoint_dir(spark)}/llm-hard-negatives-{uuid.uuid4().hex}"
    window = "anchor long, anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    for number in range(blocks):
        own = anchors.where(F.pmod(F.xxhash64("id", "label", "q"), F.lit(blocks)) == number).orderBy("id", "label", "q").toArrow()
        own = own.combine_chunks()
        ids, labels = own["id"].fill_null(_LAST).to_numpy(), own["label"].to_numpy()
        q = matrix(own["q"].combine_chunks() if own.num_rows else pa.array([], pa.list_(pa.int64())))
        shared = spark.sparkContext.broadcast((ids, labels, q))
        best = _first(map_arrow(rows, _positives(shared, positives), "anchor long, score long, id long"), positives, "anchor")
        best = stored(best, "positives")
        upper, lower = np.full((len(ids), positives), _NONE), np.full(len(ids), _LAST)
        for anchor, score, place in best.select("anchor", "score", "place").orderBy("anchor", "place").collect():  # of one block
            if score >= 0:
                upper[anchor, place - 1] = high * score // 100
                lower[anchor] = -(-low * score // 100)
        limits = spark.sparkContext.broadcast((ids, labels, q, upper, lower))
        slots = _first(map_arrow(rows, _negatives(limits, negatives), "anchor long, slot long, score long, id long"), negatives, "anchor", "slot")
        falling = slots.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("slot", (-F.col("score")).alias("down"), "id"))).alias("falling"))
        windows = best.where("score >= 0").join(falling, "anchor")
        suffix = F.filter("falling", lambda s: s["slot"] >= F.col("place") - 1)
        answer = F.filter(F.slice(suffix, 1, negatives), lambda s: F.lit(low) * F.col("score") <= -100 * s["down"])
        name = spark.createDataFrame([(i, None if x == _LAST else int(x)) for i, x in enumerate(ids)], "anchor long, anchor_id long")
        found = windows.select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), F.posexplode(answer).alias("at", "s"))
        named = lambda c: F.when(c != int(_LAST), c)
        found = found.join(name, "anchor").select(
            "anchor", "anchor_id", named(F.col("positive_id")).alias("positive_id"), (F.col("at") + 1).cast("int").alias("rank"),
            named(F.col("s.id")).alias("negative_id"), "positive_score", (-F.col("s.down")).alias("negative_score"))
        found.write.parquet(f"{base}/{number}")
        shared.destroy()
        limits.destroy()
    return spark.read.schema(window).parquet(f"{base}/*").drop("anchor")


def report(vectors: DataFrame, **options) -> DataFrame:
    """The contract's query: labels of ids divisible by 7 move on by one, components are floor(256 x)."""
    label = F.col("label").cast("long")
    rows = vectors.where(F.col("label").isNotNull() & finite(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("id"), F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        F.transform("embedding", lambda c: F.floor(256 * c.cast("double")).cast("long")).alias("q"))
    return mine(rows, F.col("id") % 100 == 0, **options)


ORACLE_SQL = """
WITH rows_in AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM rows_in a JOIN rows_in b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positive AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score
  FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank,
       n.other_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 100 * n.score BETWEEN 30 * p.positive_score AND 90 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id) <= 10
"""
