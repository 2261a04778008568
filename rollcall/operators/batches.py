"""Change sets → an outbox of fixed-size request batches.

The reference slices a fetched list into chunks of 20 and sends one HTTP
batch per chunk.  Here every change row becomes an outbox row with
``action``, a ``request_id`` (for correlating responses, J15), a JSON
``payload`` and a ``batch_no``: rows are numbered 1..n per action in
request-key order by :func:`rollcall.operators.ranking.sequence_within`
(range-partitioned, so one action with a billion rows is numbered by many
tasks), and ``batch_no = (seq - 1) // batch_size`` — every batch is full
except the last of each action.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.operators.ranking import join_back, sequence_within

#: The order of delivery: a group is there before its members, and empty before it goes.
LEVELS = ("insert_group", "insert_member", "delete_member", "delete_group")


@dataclass(frozen=True)
class ChangeSet:
    action: str               # e.g. insert_group, insert_member, delete_member
    rows: DataFrame
    key_cols: Sequence[str]   # identify the target object of each request
    payload: Column           # struct column serialised as the request body


def request_key(cols: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])


def outbox(change_sets: Sequence[ChangeSet], batch_size: int = 20) -> DataFrame:
    parts = [cs.rows.select(F.lit(cs.action).alias("action"),
                            request_key(cs.key_cols).alias("request_key"),
                            F.to_json(cs.payload).alias("payload"))
             for cs in change_sets]
    rows = reduce(DataFrame.unionByName, parts)
    numbered = sequence_within(rows, ["action"], ["request_key", "payload"], out="seq", few_groups=True)
    return numbered.select(
        "action",
        F.floor((F.col("seq") - 1) / F.lit(batch_size)).cast("long").alias("batch_no"),
        "seq",
        F.concat(F.col("action"), F.lit(":"), F.col("request_key")).alias("request_id"),
        "payload")


def ordered_outbox(change_sets: Sequence[ChangeSet], batch_size: int = 20) -> DataFrame:
    """One outbox of all actions whose batches, delivered by number, never overtake what they need.

    The action is the level (``LEVELS``).  Rows are numbered within their level in one range-partitioned pass; a level begins
    with a batch of its own, numbered behind the last one of the levels before, so a batch holds one level and every request
    has a lower batch than those that need it.  ``after_batch`` is the last batch that must be done before (null in the first
    level).  A request that several change sets ask for (same action and key) is sent once.  Only the levels' sizes, a row
    each, are summed outside the pass.
    """
    unknown = {cs.action for cs in change_sets} - set(LEVELS)
    if unknown:
        raise ValueError(f"no level for {sorted(unknown)}")
    parts = [cs.rows.select(F.lit(LEVELS.index(cs.action)).alias("level"), F.lit(cs.action).alias("action"),
                            request_key(cs.key_cols).alias("request_key"), F.to_json(cs.payload).alias("payload"))
             for cs in change_sets]
    once = reduce(DataFrame.unionByName, parts).groupBy("level", "action", "request_key").agg(F.min("payload").alias("payload"))
    numbered = sequence_within(once, ["level"], ["request_key"], out="seq", few_groups=True)
    sizes = numbered.groupBy("level").agg(F.ceil(F.max("seq") / F.lit(batch_size)).alias("n"))  # a row per level
    first = Window.partitionBy(F.lit(0)).orderBy("level").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("level", F.coalesce(F.sum("n").over(first), F.lit(0)).alias("first"))
    batch = F.col("first") + F.floor((F.col("seq") - 1) / F.lit(batch_size))
    return join_back(numbered, F.broadcast(firsts), ["level"]).select(
        "level", "action", batch.cast("long").alias("batch_no"), "seq",
        F.when(F.col("first") > 0, F.col("first") - 1).cast("long").alias("after_batch"),
        F.concat(F.col("action"), F.lit(":"), F.col("request_key")).alias("request_id"), "payload")


def batch_summary(box: DataFrame) -> DataFrame:
    """Rows per (action, batch) — the invariant a delivery job checks."""
    return box.groupBy("action", "batch_no").agg(F.count(F.lit(1)).alias("n_requests"))
