"""Per-group ranking and grouping, written to survive hot groups.

A window ``PARTITION BY k`` sorts every row of one key inside one task; if one
key holds a third of the data that task never finishes.  The helpers here
only aggregate (with map-side partial aggregation) and join back, or number
rows after a range repartition that splits a hot group over many tasks:

* :func:`annotate_groups` – W1 (count per group) and friends: groupBy + join.
* :func:`first_with_ties` – W2 (dense_rank … = 1): group minimum of the order
  key, joined back on equality so ties survive.
* :func:`latest_per_key` – J9/A1 (rows holding the group maximum).
* :func:`sequence_within` – exact consecutive numbering inside a group
  (row_number) from a range repartition + per-partition offsets.
* :func:`cumulative_within` – running sum inside a group, same split.
* :func:`last_wins` – A4 (one row per key, highest order value).
* :func:`hashed_sample` – O3 (deterministic random order + limit).
"""

from __future__ import annotations

import contextlib
import uuid
from functools import reduce
from typing import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


SLICE_BYTES = 1 << 30


def slices_of(df: DataFrame) -> int:
    """In how many slices to work ``df`` off: one per ``SLICE_BYTES`` of the files it is read from, a file read twice counted twice."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    unknown = int(df.sparkSession._jsparkSession.sessionState().conf().defaultSizeInBytes())
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return max(1, -(-sum(s for s in sizes if s < unknown) // SLICE_BYTES))


def materialize(df: DataFrame, by: Sequence[str] = (), slices: int = 1) -> DataFrame:
    """Cut lineage: the rows written as Parquet to the shared folder named by
    ``spark.checkpoint.dir`` (set by the cluster; tests set a scratch one) and
    read back.  Used where one intermediate feeds two branches, so it is computed
    once and a lost executor reads the files, not the source.  The shuffles behind
    the rows leave the disk when they are written.  Parquet packs the
    rows and tells the planner their size, unlike an RDD checkpoint, which serves
    for the types that Parquet lacks.

    With ``slices`` the rows are computed and written slice by slice, told apart by
    a hash of ``by``.  Where these are the keys of the shuffles behind the rows,
    the filter goes below them, so no more than a slice is on disk at a time, at
    the cost of reading the input once per slice."""
    return _kept(df, by, slices)[0]


@contextlib.contextmanager
def kept_for(df: DataFrame, by: Sequence[str] = (), slices: int = 1) -> Iterator[DataFrame]:
    """:func:`materialize` for what is read inside the block alone: the files go at its end."""
    from rollcall.session import remove

    rows, path = _kept(df, by, slices)
    try:
        yield rows
    finally:
        if path:
            remove(df.sparkSession, path)


def _kept(df: DataFrame, by: Sequence[str], slices: int) -> tuple[DataFrame, str | None]:
    from rollcall.session import ensure_checkpoint_dir, shuffles_freed

    folder = ensure_checkpoint_dir(df.sparkSession)
    if any(kind in df.schema.simpleString() for kind in ("void", "interval")):
        return df.checkpoint(eager=True), None
    path = f"{folder.rstrip('/')}/rollcall-kept-{uuid.uuid4().hex}"
    parts = [(path, df)] if slices == 1 else [
        (f"{path}/{i}", df.filter(F.pmod(F.xxhash64(*by), F.lit(slices)) == i)) for i in range(slices)]
    for to, part in parts:
        with shuffles_freed(df.sparkSession):
            part.write.option("compression", "zstd").parquet(to)
    return df.sparkSession.read.schema(df.schema).parquet(*[to for to, _ in parts]), path


def _by(group_cols: Sequence[str]):
    # An empty group list numbers the whole input; the window then spans only
    # the per-partition totals (one row per partition).
    return Window.partitionBy(*group_cols) if group_cols else Window.partitionBy(F.lit(0))


def join_back(df: DataFrame, stats: DataFrame, group_cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Join per-group values back onto the rows (NULL group keys match)."""
    s = stats.select(*[F.col(c).alias(f"__g_{c}") for c in group_cols],
                     *[c for c in stats.columns if c not in group_cols])
    cond = reduce(lambda a, b: a & b, [df[c].eqNullSafe(s[f"__g_{c}"]) for c in group_cols])
    return df.join(s, cond, how).drop(*[f"__g_{c}" for c in group_cols])


def annotate_groups(df: DataFrame, group_cols: Sequence[str], **aggs: Column) -> DataFrame:
    """Add per-group aggregates to every row (skew-safe COUNT(*) OVER …)."""
    stats = df.groupBy(*group_cols).agg(*[a.alias(n) for n, a in aggs.items()])
    return join_back(df, stats, group_cols)


def _order_key(order_cols: Sequence, nulls_last: bool = True, descending: bool = False) -> Column:
    parts = []
    for c in order_cols:
        col = _col(c)
        # (is-null flag, value): false sorts first → NULLS LAST under min().
        parts.append(F.struct(col.isNull().alias("n") if nulls_last else col.isNotNull().alias("n"),
                              col.alias("v")))
    key = F.struct(*parts)
    return key


def first_with_ties(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence,
                    nulls_last: bool = True) -> DataFrame:
    """Rows whose ascending order key equals the group's first key (dense_rank = 1)."""
    keyed = df.withColumn("__ord", _order_key(order_cols, nulls_last))
    mins = keyed.groupBy(*group_cols).agg(F.min("__ord").alias("__min"))
    out = join_back(keyed, mins, group_cols)
    return out.filter(F.col("__ord").eqNullSafe(F.col("__min"))).drop("__ord", "__min")


def latest_per_key(df: DataFrame, key_cols: Sequence[str], value_col: str) -> DataFrame:
    """Rows holding the per-key maximum of ``value_col``; ties all kept."""
    mx = df.groupBy(*key_cols).agg(F.max(value_col).alias("__max"))
    out = join_back(df, mx, key_cols)
    return out.filter(F.col(value_col) == F.col("__max")).drop("__max")


def sequence_within(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                    out: str = "seq", num_partitions: int | None = None, few_groups: bool = False) -> DataFrame:
    """Consecutive 1-based numbers per group in ``order_cols`` order.

    ``order_cols`` must be unique within a group for a deterministic result.
    The rows are range-partitioned on (group, order), so one group may span
    many partitions; each partition numbers its rows in sort order and adds
    the row count of the earlier partitions of the same group.  The offset
    table has at most (#groups + #partitions) rows; with ``few_groups`` it is
    broadcast and the numbered rows are not shuffled again.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) for c in (*group_cols, *order_cols)]
    ranged = materialize(df.repartitionByRange(n, *keys)
                         .sortWithinPartitions(*keys)
                         .withColumn("__mid", F.monotonically_increasing_id())
                         .withColumn("__pid", F.shiftright(F.col("__mid"), 33)))
    stats = ranged.groupBy(*group_cols, "__pid").agg(F.min("__mid").alias("__first"),
                                                     F.count(F.lit(1)).alias("__n"))
    before = _by(group_cols).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("__offset", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    joined = join_back(ranged, F.broadcast(stats) if few_groups else stats, [*group_cols, "__pid"])
    return (joined.withColumn(out, F.col("__offset") + F.col("__mid") - F.col("__first") + F.lit(1))
            .drop("__mid", "__pid", "__first", "__offset"))


def cumulative_within(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                      value: Column, out: str, num_partitions: int | None = None) -> DataFrame:
    """Running sum of ``value`` per group in ``order_cols`` order (inclusive).

    Same split as :func:`sequence_within`: a range repartition spreads a hot
    group over many partitions; each (group, partition) slice is summed by a
    window bounded by the partition size, plus the totals of the group's
    earlier partitions.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) for c in (*group_cols, *order_cols)]
    ranged = materialize(df.withColumn("__val", value).repartitionByRange(n, *keys)
                         .withColumn("__pid", F.spark_partition_id()))
    local_w = (Window.partitionBy(*group_cols, "__pid").orderBy(*order_cols)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    totals = ranged.groupBy(*group_cols, "__pid").agg(F.sum("__val").alias("__tot"))
    ranged = ranged.withColumn("__local", F.sum("__val").over(local_w))
    before = _by(group_cols).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("__offset", F.coalesce(F.sum("__tot").over(before), F.lit(0))).drop("__tot")
    joined = join_back(ranged, totals, [*group_cols, "__pid"])
    return (joined.withColumn(out, F.col("__offset") + F.col("__local"))
            .drop("__val", "__pid", "__local", "__offset"))


def last_wins(df: DataFrame, key_cols: Sequence[str], order_col: str) -> DataFrame:
    """A4: one row per key — the one with the highest ``order_col``."""
    rest = [c for c in df.columns if c not in key_cols]
    picked = df.groupBy(*key_cols).agg(F.max_by(F.struct(*rest), F.col(order_col)).alias("__row"))
    return picked.select(*key_cols, *[F.col(f"__row.{c}").alias(c) for c in rest])


def hashed_sample(df: DataFrame, n: int, seed: int, key_cols: Sequence[str]) -> DataFrame:
    """O3: random order with a seed, then LIMIT n (TakeOrdered, top-k bound).

    The order is a hash of the key and seed, so it does not depend on the
    partitioning, unlike ``rand(seed)``.
    """
    h = F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in key_cols], F.lit(str(seed))).cast("binary"))
    return df.withColumn("__h", h).orderBy("__h", *key_cols).limit(n).drop("__h")
