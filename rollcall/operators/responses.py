"""Correlate landed responses with the requests of an outbox.

The reference matched batch callbacks to requests by id, treated HTTP 409
(already exists) as success after fetching the existing object, logged
other errors and upserted successes.  Here requests and responses are two
tables joined on ``request_id``; every request gets one outcome:

* ``created``   – 2xx; the stored row merges request and response fields,
  response wins where it has a value (N7);
* ``exists``    – 409 and an object with that address is already stored;
  the stored object's id is adopted (R14's second section of an address);
* ``unresolved``– 409 with nothing stored under that address;
* ``rejected``  – any other status;
* ``pending``   – no response landed yet.

``unique_attribute``, ``department_id`` and ``group_type`` are known to the store alone, so requests carry them: a
created group takes them from its request, a group that exists keeps its own and takes those it lacks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.operators.nested import merge_later_wins

STORE_FIELDS = ("unique_attribute", "department_id", "group_type")


def route_group_responses(requests: DataFrame, responses: DataFrame, groups: DataFrame) -> DataFrame:
    """Outcome per insert-group request with the group row to store."""
    existing = (groups.filter(F.col("group_email").isNotNull()).groupBy("group_email")
                .agg(F.min(F.struct("google_groupid", "group_name", "description", "etag", *STORE_FIELDS)).alias("g"))
                .select(F.col("group_email").alias("x_email"), "g"))
    j = (requests.alias("rq")
         .join(responses.alias("rs"), F.col("rq.request_id") == F.col("rs.request_id"), "left")
         .join(existing, F.col("rq.email") == F.col("x_email"), "left"))
    status = F.col("rs.status")
    ok = (status >= 200) & (status < 300)
    conflict = status == 409
    outcome = (F.when(status.isNull(), F.lit("pending"))
               .when(ok, F.lit("created"))
               .when(conflict & F.col("x_email").isNotNull(), F.lit("exists"))
               .when(conflict, F.lit("unresolved"))
               .otherwise(F.lit("rejected")))
    gid = F.when(ok, F.col("rs.body.id")).when(conflict, F.col("g.google_groupid"))
    answered_email, answered_name = merge_later_wins("rq", "rs.body", ["email", "name"])
    email = F.when(ok, answered_email).when(conflict, F.col("x_email"))
    name = (F.when(ok, answered_name)
            .when(conflict & F.col("x_email").isNotNull(), F.coalesce(F.col("g.group_name"), F.col("rq.name"))))
    etag = F.when(ok, F.col("rs.body.etag")).when(conflict, F.col("g.etag"))
    own = [F.when(ok, F.col(f"rq.{f}")).when(conflict & F.col("x_email").isNotNull(),
                                             F.coalesce(F.col(f"g.{f}"), F.col(f"rq.{f}"))).alias(f) for f in STORE_FIELDS]
    return j.select(F.col("rq.request_id").alias("request_id"), status.alias("status"), outcome.alias("outcome"),
                    gid.alias("google_groupid"), email.alias("group_email"), name.alias("group_name"),
                    F.when(ok, F.col("rq.description"))
                    .when(conflict & F.col("x_email").isNotNull(),
                          F.coalesce(F.col("g.description"), F.col("rq.description"))).alias("description"),
                    etag.alias("etag"), *own)


def applied_groups(routed: DataFrame) -> DataFrame:
    """The rows to upsert into the group store (created + exists), one per
    group id: when several requests resolve to the same stored group, the
    earliest request wins (a partial aggregate, no per-group collection)."""
    row = F.struct("group_email", "group_name", "description", "etag", *STORE_FIELDS)
    return (routed.filter(F.col("outcome").isin("created", "exists"))
            .groupBy("google_groupid").agg(F.min_by(row, F.col("request_id")).alias("r"))
            .select("google_groupid", "r.*"))
