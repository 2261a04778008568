"""Runs whose stages commit.

A run is a folder ``base/run_id=<id>`` of stages.  Each attempt at a stage has a folder of its own; the stage's manifest (path, rows,
schema) is written after the data, so a stage counts only once all of its rows are there.  A run that ended midway is simply run
again under its id: stages with a manifest are read back, the first one without is computed anew (what a broken attempt left is
never read), and the plans that follow read the written rows instead of computing them a second time.  The run's own manifest
comes last; :func:`restore` and :func:`committed_runs` know only runs that have it.
"""

from __future__ import annotations

import json
import uuid
from typing import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rollcall.operators.routing import REJECTED, SINK
from rollcall.session import path_exists

MANIFEST = "run_id string, stage string, path string, rows long, rejects long, schema string"


def _root(base: str, run_id: str) -> str:
    return f"{base.rstrip('/')}/run_id={run_id}"


def _manifest(spark: SparkSession, path: str) -> list:
    """The rows of a manifest; none where there is no manifest, or only the start of one."""
    try:
        return spark.read.schema(MANIFEST).json(path).collect()  # a row per stage
    except AnalysisException:
        return []


class Run:
    """One run's stages."""

    def __init__(self, spark: SparkSession, base: str, run_id: str):
        self.spark, self.base, self.run_id = spark, base, run_id
        self.root = _root(base, run_id)
        self.stages: dict[str, tuple] = {}

    def stage(self, name: str, build: Callable[[], DataFrame], partition_by: Sequence[str] = ()) -> DataFrame:
        """The rows of a stage: read if it was committed before, else built, written and committed."""
        known = _manifest(self.spark, f"{self.root}/_stages/{name}")
        if known:
            row = tuple(known[0])
        else:
            from rollcall.sinks.export import audited

            df, seen = audited(build(), name, rejects=(F.col(SINK) == REJECTED) if SINK in partition_by else None)
            path = name if not path_exists(self.spark, f"{self.root}/{name}") else f"{name}-{uuid.uuid4().hex}"
            writer = df.write.partitionBy(*partition_by) if partition_by else df.write
            writer.parquet(f"{self.root}/{path}")
            row = (self.run_id, name, path, seen.get["rows"], seen.get["rejects"], df.schema.json())
            self._write([row], f"{self.root}/_stages/{name}")
        self.stages[name] = row
        return self._read(row)

    def commit(self) -> dict[str, int]:
        """Write the audit table (K14) and, last, the run's manifest; rows by stage."""
        rows = [self.stages[name] for name in sorted(self.stages)]
        self.spark.createDataFrame([(r[0], r[1], r[3], r[4]) for r in rows], "run_id string, output string, rows long, rejects long") \
            .coalesce(1).write.mode("overwrite").parquet(f"{self.root}/_audit")
        self._write(rows, f"{self.root}/_committed")
        return {name: row[3] for name, row in sorted(self.stages.items())}

    def _write(self, rows: list[tuple], path: str) -> None:
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").json(path)

    def _read(self, row: Sequence) -> DataFrame:
        return self.spark.read.schema(StructType.fromJson(json.loads(row[5]))).parquet(f"{self.root}/{row[2]}")


def committed_runs(spark: SparkSession, base: str) -> list[str]:
    """Ids of the runs that committed, in order."""
    try:
        found = spark.read.schema(MANIFEST).json(f"{base.rstrip('/')}/run_id=*/_committed")
        return [r[0] for r in found.select("run_id").distinct().orderBy("run_id").collect()]
    except AnalysisException:
        return []


def restore(spark: SparkSession, base: str, run_id: str, stage: str) -> DataFrame:
    """The rows of a stage of a committed run (to be written as a stage of the next run)."""
    for row in _manifest(spark, f"{_root(base, run_id)}/_committed"):
        if row["stage"] == stage:
            return Run(spark, base, run_id)._read(tuple(row))
    raise LookupError(f"run {run_id!r} did not commit a stage {stage!r}")
