"""Desired-vs-current diffing: the heart of every sync job.

* :func:`missing` – J3: desired rows with no current counterpart.  The
  reference writes ``LEFT JOIN … WHERE right.col IS NULL``; Catalyst does not
  turn that into an anti-join, so we write ``left_anti`` directly.
* :func:`existing` – J13: semi-join.
* :func:`stale` – current rows with no desired counterpart.
* :func:`changed` – N8: field-level diff of two keyed tables, long form.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Pairs = Sequence[tuple[str, str]]


def _on(left: DataFrame, right: DataFrame, pairs: Pairs) -> Column:
    return reduce(lambda a, b: a & b, [left[lc] == right[rc] for lc, rc in pairs])


def missing(desired: DataFrame, current: DataFrame, pairs: Pairs,
            current_filter: Column | None = None) -> DataFrame:
    """Rows of ``desired`` without a match in ``current``.

    ``current_filter`` is the constant predicate the reference puts in the
    ON clause of the right side (type, role); it is applied before the join.
    """
    if current_filter is not None:
        current = current.filter(current_filter)
    cur = current.select(*[F.col(rc).alias(f"__r{i}") for i, (_, rc) in enumerate(pairs)])
    cond = reduce(lambda a, b: a & b,
                  [desired[lc] == cur[f"__r{i}"] for i, (lc, _) in enumerate(pairs)])
    return desired.join(cur, cond, "left_anti")


def existing(desired: DataFrame, current: DataFrame, pairs: Pairs,
             current_filter: Column | None = None) -> DataFrame:
    """Rows of ``desired`` with at least one match in ``current``."""
    if current_filter is not None:
        current = current.filter(current_filter)
    cur = current.select(*[F.col(rc).alias(f"__r{i}") for i, (_, rc) in enumerate(pairs)])
    cond = reduce(lambda a, b: a & b,
                  [desired[lc] == cur[f"__r{i}"] for i, (lc, _) in enumerate(pairs)])
    return desired.join(cur, cond, "left_semi")


def stale(current: DataFrame, desired: DataFrame, pairs: Pairs,
          desired_filter: Column | None = None) -> DataFrame:
    """Rows of ``current`` that nothing in ``desired`` asks for."""
    return missing(current, desired, pairs, desired_filter)


def changed(desired: DataFrame, current: DataFrame, key_cols: Sequence[str],
            fields: Sequence[str]) -> DataFrame:
    """One row per (key, field) whose values differ (NULL-aware).

    Output: key columns, ``field``, ``old_value``, ``new_value`` (text).
    Keys present on one side only produce nothing (unmanaged / new rows are
    handled by :func:`missing`).
    """
    d = desired.select(*key_cols, *[F.col(f).alias(f"__d_{f}") for f in fields])
    c = current.select(*[F.col(k).alias(f"__k_{k}") for k in key_cols],
                       *[F.col(f).alias(f"__c_{f}") for f in fields])
    j = d.join(c, reduce(lambda a, b: a & b, [d[k] == c[f"__k_{k}"] for k in key_cols]), "inner")
    diffs = F.array(*[
        F.when(~F.col(f"__d_{f}").eqNullSafe(F.col(f"__c_{f}")),
               F.struct(F.lit(f).alias("field"),
                        F.col(f"__c_{f}").cast("string").alias("old_value"),
                        F.col(f"__d_{f}").cast("string").alias("new_value")))
        for f in fields])
    return (j.select(*key_cols, F.inline(F.filter(diffs, lambda x: x.isNotNull())))
            .select(*key_cols, "field", "old_value", "new_value"))


def patch_documents(diff_rows: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Long-form diff → one JSON patch per key (explicit null for cleared fields)."""
    return (diff_rows.groupBy(*key_cols)
            .agg(F.map_from_entries(F.collect_list(F.struct("field", "new_value"))).alias("__m"))
            .select(*key_cols, F.to_json(F.col("__m"), {"ignoreNullFields": "false"}).alias("patch")))
