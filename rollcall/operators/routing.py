"""Rejects without a second run: every row of a job is routed to a sink, and written once, partitioned by sink.

:func:`routed` keeps all rows: it adds the reasons that hold for a row and the sink they lead to, as one projection.  Reading
one sink back prunes the other's partition, so neither side computes the job again, and rows in equal rows accepted plus rows rejected.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SINK, REASONS = "sink", "reasons"
ACCEPTED, REJECTED = "accepted", "rejected"


def routed(rows: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``rows`` with ``reasons`` (the names of the rules whose condition holds, in order; a null condition does not) and ``sink``."""
    reasons = F.filter(F.array(*[F.when(condition, F.lit(name)) for name, condition in rules.items()]), lambda r: r.isNotNull())
    found = rows.withColumn(REASONS, reasons)
    return found.withColumn(SINK, F.when(F.size(REASONS) == 0, F.lit(ACCEPTED)).otherwise(F.lit(REJECTED)))


def accepted(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col(SINK) == ACCEPTED).drop(SINK, REASONS)


def rejected(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col(SINK) == REJECTED).drop(SINK)


def reason_counts(rows: DataFrame) -> DataFrame:
    """(reason, n_rows) of rejected rows; a row with several reasons counts for each."""
    return rejected(rows).select(F.explode(REASONS).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))
