"""New-account provisioning as one plan.

new accounts (Q03) ⋈ candidate records (Q10/Q12) → suspended ones skipped →
usernames allocated per domain against the stored addresses (C2) → request
payload (N3) → outbox rows; rejected candidates keep their reason, and a new person whose school and grade have no
org unit is rejected as ``no org unit``: rows out are as many as new accounts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.config import SyncConfig
from rollcall.functions.text import domain_part, local_part
from rollcall.operators.nested import payload
from rollcall.operators.usernames import allocate_usernames
from rollcall.plans import accounts as acc


def candidates(students: DataFrame, staff: DataFrame, accounts: DataFrame, orgunits: DataFrame,
               cfg: SyncConfig) -> DataFrame:
    """One candidate record per new (external_uid, user_type); a person with
    several stage rows (tied latest enrolments) keeps the smallest record."""
    new = acc.new_accounts(students, staff, accounts, cfg)
    recs = (acc.student_candidates(students, orgunits).unionByName(acc.staff_candidates(staff, cfg))
            .filter(F.col("suspended") == 0))
    rec = F.struct("email_override", "given_name", "family_name", "middle_name", "suspended", "change_password",
                   "global_addressbook", "ou_path")
    one = recs.groupBy("external_uid", "user_type").agg(F.min(rec).alias("r")).select(
        "external_uid", "user_type", "r.*")
    c = one.join(new, ["external_uid", "user_type"], "left_semi")
    return c.withColumn("domain", F.when(F.col("user_type") == "staff", F.lit(cfg.staff_domain))
                        .otherwise(F.lit(cfg.student_domain)))


def provision(students: DataFrame, staff: DataFrame, accounts: DataFrame, orgunits: DataFrame,
              cfg: SyncConfig) -> DataFrame:
    c = candidates(students, staff, accounts, orgunits, cfg)
    active = c.withColumnRenamed("email_override", "override")
    unplaced = acc.new_accounts(students, staff, accounts, cfg).join(c, ["external_uid", "user_type"], "left_anti")
    existing = (accounts.filter(F.col("primary_email").isNotNull())
                .select(domain_part("primary_email").alias("domain"), local_part("primary_email").alias("name")))
    named = allocate_usernames(active, existing, ["user_type", "external_uid"])
    email = F.concat(F.col("username"), F.lit("@"), F.col("domain"))
    body = payload({
        "primaryEmail": email,
        "name.givenName": F.col("given_name"),
        "name.familyName": F.col("family_name"),
        "suspended": F.lit(False),
        "changePasswordAtNextLogin": F.col("change_password") == 1,
        "includeInGlobalAddressList": F.col("global_addressbook") == 1,
        "orgUnitPath": F.col("ou_path"),
        "externalIds": F.array(F.struct(F.lit("custom").alias("type"), F.col("user_type").alias("customType"),
                                        F.col("external_uid").cast("string").alias("value"))),
    })
    out = named.select("external_uid", "user_type", "username",
                       F.when(F.col("username").isNotNull(), email).alias("primary_email"),
                       "reject_reason",
                       F.when(F.col("username").isNotNull(), body).alias("payload"))
    nothing = F.lit(None).cast("string")
    return out.unionByName(unplaced.select(
        "external_uid", "user_type", nothing.alias("username"), nothing.alias("primary_email"),
        F.lit("no org unit").alias("reject_reason"), nothing.alias("payload")))
