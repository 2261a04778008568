"""A ledger of delivery attempts, and what it does to the stored memberships and groups.

A request may be answered several times: the delivery is tried again after a refusal that may pass, and a response may land
twice.  The ledger keeps one row per (request id, attempt); recording the same responses again adds nothing.  The state of a
request is folded from its attempts: an attempt that settled it counts, whatever came after, else the latest one.

* ``done``     – answered with success;
* ``exists``   – an insert answered 409: the object is there already, which is success;
* ``absent``   – a delete answered 404 or 410: the object is gone already, which is success too;
* ``retry``    – answered 408, 429 or 5xx, to be tried again;
* ``failed``   – the same after ``max_attempts`` attempts;
* ``rejected`` – any other answer;
* ``pending``  – no answer yet.

Recording moves the landed answers once; they are folded where they lie, as if they answered an insert and as if they answered
another request, and meet their requests there, which move once too.  Applying is an anti-join and an upsert on the members' key
that move the store once, from the settled requests written once.  A pair of group and member that several requests settled
follows the latest of them in outbox order (``seq``), so applying a ledger twice gives the same store as applying it once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.operators.apply import delete, upsert
from rollcall.operators.ranking import kept_for, materialize, sequence_within, slices_of

SETTLED = ("done", "exists", "absent")
MEMBER_KEY = ["google_groupid", "google_userid"]


def attempt_outcome(action: Column, status: Column) -> Column:
    """The outcome of one attempt."""
    insert = action.startswith("insert")
    return (F.when(status.isNull(), F.lit("pending"))
            .when((status >= 200) & (status < 300), F.lit("done"))
            .when(insert & (status == 409), F.lit("exists"))
            .when(~insert & status.isin(404, 410), F.lit("absent"))
            .when(status.isin(408, 429) | (status >= 500), F.lit("retry"))
            .otherwise(F.lit("rejected")))


def _spread(*keys: str) -> Column:
    """A number ahead of the text keys of a group or join: the texts begin alike, so sorting by them compares whole texts,
    sorting by the number first compares longs."""
    return F.xxhash64(*keys).alias("__h")


def _dealt(df: DataFrame, *keys: str) -> DataFrame:
    """The rows shuffled as a group or join by ``_spread`` and the keys wants them, without the number among the moved columns."""
    return df.repartition(F.xxhash64(*keys), *keys)


def record(ledger: DataFrame, landed: DataFrame) -> DataFrame:
    """The ledger with the landed responses (request_id, attempt, status, body) that it lacks.

    Of different answers landed under one attempt, the least counts (status first), so the order of landing does not
    matter; an answer that was recorded before stays.
    """
    fresh = (_dealt(landed.filter(F.col("request_id").isNotNull()), "request_id")
             .groupBy(_spread("request_id"), "request_id", "attempt")
             .agg(F.max(F.col("status").isNull()).alias("no_status"), F.min("status").alias("status"),
                  F.min_by("body", F.struct("status", "body")).alias("body"))
             .select("request_id", "attempt", F.when(~F.col("no_status"), F.col("status")).alias("status"), "body"))
    new = fresh.join(ledger.select("request_id", "attempt"), ["request_id", "attempt"], "left_anti")
    return ledger.select(*new.columns).unionByName(new)


def states(requests: DataFrame, ledger: DataFrame, max_attempts: int = 5) -> DataFrame:
    """``requests`` (request_id, action, …) with outcome, attempts, last_status and the body of the deciding attempt."""
    def order(action: str | None) -> Column:
        outcome = attempt_outcome(F.lit(action).cast("string"), F.col("status"))
        return F.struct(outcome.isin(*SETTLED).alias("settled"), F.col("attempt").alias("at"), outcome.alias("outcome"), F.col("status").alias("status"))

    def with_body(last: Column, body: str) -> Column:
        return F.when(last.isNotNull(), F.struct(last.alias("last"), F.col(body).alias("body")))

    # an attempt is folded as the answer to a request without an action, and to an insert or another one where that settles it
    tried = ledger.select("request_id", "attempt", "body", order(None).alias("any"), order("insert").alias("insert"), order("other").alias("other"))
    kinds = {"any": F.col("any"), **{k: F.when(~F.col("any.settled") & F.col(f"{k}.settled"), F.col(k)) for k in ("insert", "other")}}
    # the body stands apart, so it moves only where it is asked for
    folded = tried.groupBy(_spread("request_id").alias("f_h"), F.col("request_id").alias("f_id")).agg(
        F.max("attempt").alias("attempts"), *[F.max(o).alias(f"last_{k}") for k, o in kinds.items()],
        *[F.max_by("body", with_body(o, "body")).alias(f"body_{k}") for k, o in kinds.items()])
    asked = _dealt(requests, "request_id").withColumn("__h", _spread("request_id"))
    found = asked.join(folded, (F.col("__h") == F.col("f_h")) & (F.col("request_id") == F.col("f_id")), "left")
    insert = F.col("action").startswith("insert")
    last = {"any": F.col("last_any"), "insert": F.when(insert, F.col("last_insert")), "other": F.when(~insert, F.col("last_other"))}
    # of a request id that stands several times all rows follow the same answer
    rows = Window.partitionBy("__h", "request_id")
    best = F.greatest(*[with_body(o, f"body_{k}") for k, o in last.items()])
    found = (found.withColumn("last", F.max(F.greatest(*last.values())).over(rows))
             .withColumn("f_body", F.max_by(best["body"], best).over(rows)))
    attempts = F.coalesce("attempts", F.lit(0)).cast("int")
    given_up = (F.col("last.outcome") == "retry") & (attempts >= max_attempts)
    return found.select(*requests.columns, F.when(given_up, F.lit("failed")).otherwise(F.coalesce("last.outcome", F.lit("pending"))).alias("outcome"),
                        attempts.alias("attempts"), F.col("last.status").alias("last_status"), F.col("f_body").alias("body"))


def retry_queue(found: DataFrame, batch_size: int = 20) -> DataFrame:
    """The requests to deliver (again), with the number of the attempt they are for, in batches per action."""
    due = found.filter(F.col("outcome").isin("retry", "pending")).select("action", "request_id", (F.col("attempts") + 1).alias("attempt"))
    numbered = sequence_within(materialize(due), ["action"], ["request_id"], out="seq", few_groups=True)
    return numbered.select("action", F.floor((F.col("seq") - 1) / F.lit(batch_size)).cast("long").alias("batch_no"), "seq", "request_id", "attempt")


def refused(found: DataFrame) -> DataFrame:
    """Requests that will not be tried again, with the reason."""
    reason = F.concat(F.col("outcome"), F.lit(": status "), F.col("last_status").cast("string"))
    return found.filter(F.col("outcome").isin("rejected", "failed")).select("request_id", "action", "attempts", reason.alias("reason"))


def _latest(found: DataFrame, keys: list[str], *columns: str) -> DataFrame:
    """Per key the settled request that comes last in outbox order."""
    row = F.struct("action", "outcome", *columns)
    done = found.filter(F.col("outcome").isin(*SETTLED))
    return (_dealt(done, *keys).groupBy(_spread(*keys), *keys).agg(F.max_by(row, F.struct("seq", "request_id")).alias("r")).select(*keys, "r.*"))


def members_after(store: DataFrame, found: DataFrame) -> DataFrame:
    """The membership store after the settled member requests.

    An inserted member takes role, type and etag from the response where it has them, else from the request; a member that existed
    keeps the stored row, or is stored as requested where there is none.  A deleted member goes.
    """
    given = {"role": F.coalesce("body.role", "role"), "type": F.coalesce("body.type", F.lit("USER")), "etag": F.col("body.etag")}
    given = {c: v.alias(c) for c, v in given.items() if c in store.columns}
    # written before they are dealt by member, slice by slice, so that the shuffles by request leave the disk first
    settled = found.filter(F.col("outcome").isin(*SETTLED)).select(*MEMBER_KEY, "seq", "request_id", "action", "outcome", *given.values())
    slices = slices_of(found)
    with kept_for(settled, ["request_id"], slices) as rows:
        last = materialize(_latest(rows, MEMBER_KEY, *given), MEMBER_KEY, slices)
    inserted = last.filter(F.col("action") == "insert_member").select(*MEMBER_KEY, *given, (F.col("outcome") != "done").alias("if_new"))
    gone = last.filter(F.col("action") == "delete_member")
    # a pair is inserted or gone, not both, so the order does not matter
    return upsert(delete(store, gone, MEMBER_KEY), inserted, MEMBER_KEY, new_only_col="if_new")


def groups_after_deletes(groups: DataFrame, members: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups and members without those of the groups whose delete was confirmed and not followed by another request."""
    last = _latest(found.filter(F.col("action").isin("insert_group", "delete_group")), ["google_groupid"])
    gone = last.filter(F.col("action") == "delete_group").select("google_groupid")
    return delete(groups, gone, ["google_groupid"]), delete(members, gone, ["google_groupid"])
