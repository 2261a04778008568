"""Change application as pure functions: snapshot × changes → new snapshot
(K1–K8, K13).

Parquet tables have no UPDATE/DELETE/MERGE, so every mutation is a join that
produces the next snapshot; the caller writes it to a new path (``run_id``)
and never overwrites a path it is reading.  Every function is one or two
shuffles on the key, whatever the size of the table.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, IntegralType, StringType, StructType


def _key_cond(a: DataFrame, b: DataFrame, keys: Sequence[str], prefix: str) -> Column:
    return reduce(lambda x, y: x & y, [a[k] == b[f"{prefix}{k}"] for k in keys])


def load_by_position(df: DataFrame, target: StructType) -> DataFrame:
    """K1: the i-th source column fills the i-th target column (names are
    ignored, as in INSERT … VALUES); values are cast to the target type."""
    if len(df.columns) != len(target.fields):
        raise ValueError(f"{len(df.columns)} source columns for {len(target.fields)} target columns")
    return df.select(*[F.col(f"`{c}`").cast(f.dataType).alias(f.name)
                       for c, f in zip(df.columns, target.fields)])


def load_by_name(df: DataFrame, target_columns: Sequence[str]) -> DataFrame:
    """K2: target columns are taken by name from the source (error if absent)."""
    return df.select(*target_columns)


def insert(target: DataFrame, rows: DataFrame) -> DataFrame:
    """K6: append rows; columns they lack become NULL."""
    return target.unionByName(rows, allowMissingColumns=True)


def upsert(target: DataFrame, changes: DataFrame, keys: Sequence[str],
           supplied_col: str | None = None, new_only_col: str | None = None) -> DataFrame:
    """K3: insert new keys; for existing keys update only supplied columns.

    A column is supplied when it is present in ``changes`` — or, with
    ``supplied_col`` (array<string>), when the row lists it, which tells
    "not supplied" from "supplied NULL".  ``changes`` must be unique per key.
    A change row with ``new_only_col`` (boolean) true is inserted where its key is
    new and leaves an existing row as it is.
    """
    return _merge(target, changes, keys, supplied_col, "full_outer", new_only_col)


def _text_keys(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> bool:
    """True where the keys are texts (or texts and whole numbers) of the same types on both sides: a join then compares a hash
    of them first, as texts that begin alike are slow to sort."""
    kinds = [a.schema[k].dataType for k in keys]
    return (kinds == [b.schema[k].dataType for k in keys] and all(isinstance(t, (StringType, IntegralType)) for t in kinds)
            and any(isinstance(t, StringType) for t in kinds))


def _spread(df: DataFrame, keys: Sequence[str], hashed: bool) -> Column:
    """A hash of the keys (0 if not ``hashed``), or for a NULL key (which matches nothing) of the row, so that such rows share no
    task in a join."""
    atoms = [f.name for f in df.schema.fields if isinstance(f.dataType, AtomicType)]
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return F.when(no_key, F.xxhash64(*atoms)).otherwise(F.xxhash64(*keys) if hashed else F.lit(0).cast("long"))


def _merge(target: DataFrame, changes: DataFrame, keys: Sequence[str], supplied_col: str | None, how: str,
           new_only_col: str | None = None) -> DataFrame:
    value_cols = [c for c in target.columns if c not in keys]
    ch_cols = [c for c in changes.columns if c not in keys and c not in (supplied_col, new_only_col)]
    hashed = _text_keys(target, changes, keys)
    ch = changes.select(*[F.col(k).alias(f"__k_{k}") for k in keys],
                        *[F.col(c).alias(f"__v_{c}") for c in ch_cols],
                        *([F.col(supplied_col).alias("__sup")] if supplied_col else []),
                        *([F.col(new_only_col).alias("__new_only")] if new_only_col else []),
                        F.lit(True).alias("__has"), _spread(changes, keys, hashed).alias("__ch_spread"))
    t = target.withColumn("__spread", _spread(target, keys, hashed))
    if new_only_col:
        t = t.withColumn("__stored", F.lit(True))
    j = t.join(ch, (t["__spread"] == ch["__ch_spread"]) & _key_cond(t, ch, keys, "__k_"), how)
    out = [F.coalesce(F.col(k), F.col(f"__k_{k}")).alias(k) for k in keys]
    for c in value_cols:
        if c not in ch_cols:
            out.append(F.col(c))
            continue
        supplied = F.col("__has").isNotNull()
        if supplied_col:
            supplied = supplied & F.array_contains(F.col("__sup"), c)
        if new_only_col:
            supplied = supplied & (F.col("__stored").isNull() | ~F.coalesce("__new_only", F.lit(False)))
        out.append(F.when(supplied, F.col(f"__v_{c}").cast(target.schema[c].dataType))
                   .otherwise(F.col(c)).alias(c))
    return j.select(*out).select(*target.columns)


def update(target: DataFrame, changes: DataFrame, keys: Sequence[str],
           supplied_col: str | None = None) -> DataFrame:
    """K4: like :func:`upsert` but keys absent from the target are ignored."""
    return _merge(target, changes, keys, supplied_col, "left")


def row_version(columns: Sequence[str]) -> Column:
    """A hash of a row's values (nulls and blanks differ), read along with the row and compared before it is written."""
    return F.xxhash64(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def compare_and_set(target: DataFrame, changes: DataFrame, keys: Sequence[str], version: str = "read_version") -> DataFrame:
    """K4 where others write too: ``changes`` hold only where the target row still is as it was read.

    ``changes`` has the keys (unique), the new values by column name and ``version``, the :func:`row_version` over the
    target's columns that was read with the row.  One full join returns the rows of the next snapshot and of the refused changes
    together: ``outcome`` is null for rows without a change, ``updated``, ``conflict`` (the row changed meanwhile: it stays
    as it is) or ``gone`` (no such row any more: no snapshot row).  See :func:`snapshot_of` and :func:`conflicts_of`.
    """
    values = [c for c in changes.columns if c not in (*keys, version)]
    ch = changes.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *[F.col(v).alias(f"__v_{v}") for v in values],
                        F.col(version).alias("__read"), F.lit(True).alias("__has"))
    now = target.withColumn("__now", row_version(target.columns))
    j = now.join(ch, _key_cond(now, ch, keys, "__k_"), "full_outer")
    outcome = (F.when(F.col("__has").isNull(), F.lit(None).cast("string")).when(F.col("__now").isNull(), F.lit("gone"))
               .when(F.col("__now") == F.col("__read"), F.lit("updated")).otherwise(F.lit("conflict")))
    out = [F.coalesce(F.col(k), F.col(f"__k_{k}")).alias(k) for k in keys]
    for c in target.columns:
        if c not in keys:
            out.append(F.when(F.col("outcome") == "updated", F.col(f"__v_{c}").cast(target.schema[c].dataType)).otherwise(F.col(c)).alias(c)
                       if c in values else F.col(c))
    return j.withColumn("outcome", outcome).select(*out, *[F.col(f"__v_{v}").alias(f"new_{v}") for v in values], "outcome").select(
        *target.columns, *[f"new_{v}" for v in values], "outcome")


def snapshot_of(found: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The next snapshot after :func:`compare_and_set`."""
    return found.filter(~F.col("outcome").eqNullSafe("gone")).select(*columns)


def conflicts_of(found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The changes that were not made, with the values they would have set."""
    wanted = [c for c in found.columns if c.startswith("new_")]
    return found.filter(F.col("outcome").isin("conflict", "gone")).select(*keys, *wanted, "outcome")


def update_or_insert(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K5: the change rows with the action they take ('update' for a known
    business key, 'insert_unmanaged' otherwise) — the log the reference writes."""
    known = target.select(*keys).distinct().withColumn("__known", F.lit(True))
    return (changes.join(known, list(keys), "left")
            .withColumn("_action", F.when(F.col("__known"), F.lit("update")).otherwise(F.lit("insert_unmanaged")))
            .drop("__known"))


def delete(target: DataFrame, doomed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K7: remove rows whose key appears in ``doomed``."""
    d = doomed.select(*[F.col(k).alias(f"__k_{k}") for k in keys])
    cond = _key_cond(target, d, keys, "__k_")
    if _text_keys(target, doomed, keys):
        # dealt as by an upsert on the same keys, so one after the other shuffles the target once
        cond = (_spread(target, keys, True) == F.xxhash64(*d.columns)) & cond
    return target.join(d, cond, "left_anti")


def replace_partitions(target: DataFrame, fresh: DataFrame, partition_keys: Sequence[str],
                       row_keys: Sequence[str] | None = None, overwrite: bool = True) -> DataFrame:
    """K8: refresh whole partitions (e.g. all members of each refreshed group).

    overwrite=True: every target row of a partition present in ``fresh`` is
    dropped and the fresh rows are added.  overwrite=False: upsert on
    ``row_keys``, older rows of the partition stay.
    """
    if not overwrite:
        return upsert(target, fresh, row_keys or list(fresh.columns))
    refreshed = fresh.select(*partition_keys).distinct()
    kept = delete(target, refreshed, partition_keys)
    return kept.unionByName(fresh.select(*target.columns))


def write_snapshot(df: DataFrame, base: str, run_id: str, table: str) -> str:
    """Write one table of a run's snapshot; returns its path."""
    path = f"{base.rstrip('/')}/run_id={run_id}/{table}"
    df.write.mode("errorifexists").parquet(path)
    return path


def read_snapshot(spark: SparkSession, base: str, run_id: str, table: str) -> DataFrame:
    """K13 restore: the table as of a run (restore = write it as the next run)."""
    return spark.read.parquet(f"{base.rstrip('/')}/run_id={run_id}/{table}")
