"""Is a paged listing complete?  The chain of landed pages, followed by pointer doubling.

A listing lands as pages (token, next token).  One request after the other would follow the chain a page at a time;
here every page knows after k rounds where 2^k steps lead, so a chain of n pages takes about log2(n) rounds of joins,
for all listings at once.  Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.operators.ranking import materialize


def page_chain(pages: DataFrame, first_token: str = "") -> DataFrame:
    """``pages`` (listing, token, next_token) → one row per page of each listing: listing, token, position, n_landed, status.

    ``status``: ``chained`` – reached from the first page, landed once; ``repeated`` – reached, landed several times (the least next
    token counts); ``cycle`` – reached, and its next token leads back to a page at or before it; ``missing`` – named by a
    reached page, or the first page, but not landed; ``orphan`` – landed, but not reached (position null).
    A null token is read as the first one.
    """
    token = F.coalesce("token", F.lit(first_token))
    landed = materialize(pages.groupBy("listing", token.alias("token"))
                         .agg(F.min("next_token").alias("next"), F.count(F.lit(1)).alias("n_landed")))
    most = landed.groupBy("listing").count().agg(F.max("count")).first()[0] or 0
    jump = landed.filter(F.col("next").isNotNull()).select("listing", F.col("token").alias("from"), F.col("next").alias("to"))
    reach = landed.select("listing").distinct().select("listing", F.lit(first_token).alias("token"), F.lit(0).cast("long").alias("position"))
    step = 1
    while step <= most + 1:
        ahead = (reach.join(jump, (reach["listing"] == jump["listing"]) & (reach["token"] == jump["from"]))
                 .select(reach["listing"], F.col("to").alias("token"), (F.col("position") + step).alias("position")))
        reach = materialize(reach.unionByName(ahead).groupBy("listing", "token").agg(F.min("position").alias("position")))
        then = jump.select(F.col("listing").alias("l"), F.col("from").alias("mid"), F.col("to").alias("end"))
        jump = materialize(jump.join(then, (F.col("listing") == F.col("l")) & (F.col("to") == F.col("mid")))
                           .select("listing", "from", F.col("end").alias("to")))
        step *= 2
    found = landed.join(reach, ["listing", "token"], "full_outer")
    back = reach.select(F.col("listing").alias("l"), F.col("token").alias("next_page"), F.col("position").alias("next_position"))
    found = found.join(back, (F.col("listing") == F.col("l")) & (F.col("next") == F.col("next_page")), "left")
    status = (F.when(F.col("n_landed").isNull(), "missing").when(F.col("position").isNull(), "orphan")
              .when(F.col("next_position") <= F.col("position"), "cycle").when(F.col("n_landed") > 1, "repeated").otherwise("chained"))
    return found.select("listing", "token", "position", F.coalesce("n_landed", F.lit(0)).alias("n_landed"), status.alias("status"))


def complete_listings(chain: DataFrame) -> DataFrame:
    """(listing, n_pages, complete): complete where every page is chained, each landed once."""
    return chain.groupBy("listing").agg(F.count(F.lit(1)).alias("n_pages"), F.bool_and(F.col("status") == "chained").alias("complete"))
