"""Account plans: who needs an account, what an account should look like,
and what differs from the stored account (Q03, Q04, Q07–Q17, C1, C3, C5).

The reference runs these per user (one point query per lookup); here each
lookup is one join over all pending users.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from rollcall.config import SyncConfig
from rollcall.functions import codes, dates, text
from rollcall.operators import apply
from rollcall.operators.documents import first_of
from rollcall.operators.reconcile import changed, missing

# Staff stage (store table) in load order; the extract's text flags land in
# integer columns (K1 load by position).
STAFF_STAGE = StructType([
    StructField("external_uid", LongType()), StructField("staffid", StringType()),
    StructField("schoolid", StringType()), StructField("teachernumber", StringType()),
    StructField("certificated", IntegerType()), StructField("given_name", StringType()),
    StructField("family_name", StringType()), StructField("middle_name", StringType()),
    StructField("gender", StringType()), StructField("external_userstatus", IntegerType()),
    StructField("staff_type", IntegerType()), StructField("suspend_account", IntegerType()),
    StructField("has_email", IntegerType()), StructField("email_address", StringType()),
    StructField("staff_conference", IntegerType()),
])

ACCOUNT_FIELDS = ("primary_email", "given_name", "family_name", "suspended", "change_password",
                  "global_addressbook", "ou_path")


def normalise_accounts(account: DataFrame) -> DataFrame:
    """Ingest rule R4: user types compared in lower case."""
    return account.withColumn("user_type", F.lower("user_type"))


def staff_stage(staff_extract: DataFrame) -> DataFrame:
    return apply.load_by_position(staff_extract, STAFF_STAGE)


# -------------------------------------------------------------- Q03/Q04/Q13
def _with_address(accounts: DataFrame, user_type: str) -> DataFrame:
    # R2: the reference tests "account e-mail IS NULL" after a LEFT JOIN, so an
    # account row without an address counts as missing.
    return accounts.filter((F.col("user_type") == user_type) & F.col("primary_email").isNotNull())


def new_students(students: DataFrame, accounts: DataFrame, cfg: SyncConfig, legacy: bool = False) -> DataFrame:
    active = 0 if legacy else 1
    sp = students.filter((F.col("external_userstatus") == active) & (F.col("suspend_account") == 0)
                         & dates.active_on(cfg.as_of, "entrydate", "exitdate"))
    if cfg.excluded_sites and not legacy:
        sp = sp.filter(~F.col("schoolid").isin(list(cfg.excluded_sites)))
    new = missing(sp, _with_address(accounts, "student"), [("external_uid", "external_uid")])
    return new.select("external_uid", F.lit("student").alias("user_type"))


def new_staff(staff: DataFrame, accounts: DataFrame, legacy: bool = False) -> DataFrame:
    """Q04."""
    active = 0 if legacy else 1
    sp = staff.filter((F.col("external_userstatus") == active) & (F.col("suspend_account") == 0))
    new = missing(sp, _with_address(accounts, "staff"), [("external_uid", "external_uid")])
    return new.select("external_uid", F.lit("staff").alias("user_type"))


def new_accounts(students: DataFrame, staff: DataFrame, accounts: DataFrame, cfg: SyncConfig,
                 legacy: bool = False) -> DataFrame:
    """Q03 (Q13 with ``legacy``: status 0 = active, no site exclusion).  UNION
    is a set union, hence the distinct."""
    return new_students(students, accounts, cfg, legacy).union(new_staff(staff, accounts, legacy)).distinct()


# ----------------------------------------------------------------- Q08/Q09
def desired_staff(staff: DataFrame, accounts: DataFrame, cfg: SyncConfig) -> DataFrame:
    """Q08: the account each managed staff member should have (R1 fixed
    unless ``cfg.legacy_suspend_rule``)."""
    bu = _with_address(accounts, "staff").select(
        "id", F.col("external_uid").alias("bu_uid"), F.col("primary_email").alias("bu_email"))
    sp = staff.filter(F.col("has_email") == 0)
    j = sp.join(bu, sp["external_uid"] == bu["bu_uid"])
    return j.select(
        "id", F.lit("staff").alias("user_type"),
        text.with_default_domain(F.coalesce("email_address", "bu_email"), cfg.staff_domain).alias("primary_email"),
        "given_name", "family_name", "external_uid",
        codes.suspended_flag("external_userstatus", "suspend_account", cfg.legacy_suspend_rule).alias("suspended"),
        F.lit(0).alias("change_password"), F.lit(1).alias("global_addressbook"),
        F.lit(cfg.staff_ou).alias("ou_path"))


def desired_students(students: DataFrame, accounts: DataFrame, orgunits: DataFrame, cfg: SyncConfig) -> DataFrame:
    """Q09: the account each student should have; org unit from (school, grade).  An address without a domain gets the
    students' one (F17), here as for staff."""
    bu = accounts.filter(F.col("user_type") == "student").select(
        "id", F.col("external_uid").alias("bu_uid"), F.col("primary_email").alias("bu_email"))
    ou = orgunits.select("department_id", "map_key", "ou_path")
    j = (students.join(bu, students["external_uid"] == bu["bu_uid"])
         .join(ou, (students["schoolid"] == ou["department_id"]) & (students["grade_level"] == ou["map_key"])))
    return j.select(
        "id", F.lit("student").alias("user_type"),
        text.with_default_domain(F.coalesce("email_override", "bu_email"), cfg.student_domain).alias("primary_email"),
        "given_name", "family_name", "external_uid",
        F.col("suspend_account").alias("suspended"),
        F.lit(0).alias("change_password"), F.lit(1).alias("global_addressbook"), "ou_path")


# ------------------------------------------------------------ Q10/Q11/Q12
def student_candidates(students: DataFrame, orgunits: DataFrame) -> DataFrame:
    """Q10 (+Q11 student number): new-account record for each student."""
    ou = orgunits.select("department_id", "map_key", "ou_path")
    j = students.join(ou, (students["schoolid"] == ou["department_id"]) & (students["grade_level"] == ou["map_key"]))
    return j.select(F.lit("student").alias("user_type"), "email_override", "given_name", "family_name",
                    "middle_name", "external_uid", F.col("suspend_account").alias("suspended"),
                    F.lit(0).alias("change_password"), F.lit(1).alias("global_addressbook"), "ou_path",
                    F.col("student_number").cast("string").alias("student_number"))


def staff_candidates(staff: DataFrame, cfg: SyncConfig) -> DataFrame:
    """Q12: new-account record for each staff member."""
    return staff.select(F.lit("staff").alias("user_type"), F.col("email_address").alias("email_override"),
                        "given_name", "family_name", "middle_name", "external_uid",
                        F.col("suspend_account").alias("suspended"), F.lit(1).alias("change_password"),
                        F.lit(1).alias("global_addressbook"), F.lit(cfg.staff_ou).alias("ou_path"),
                        F.lit(None).cast("string").alias("student_number"))


# ------------------------------------------------------ Q07/Q14–Q17 lookups
def user_key(accounts: DataFrame) -> DataFrame:
    """Q14: directory id, else the e-mail address."""
    return accounts.withColumn("user_key", F.coalesce("google_id", "primary_email"))


def account_state(accounts: DataFrame, orgunits: DataFrame) -> DataFrame:
    """Q17: stored account state; the org unit must exist (inner join)."""
    ou = orgunits.select(F.col("ou_path").alias("ou_ou_path"))
    j = accounts.join(ou, accounts["ou_path"] == ou["ou_ou_path"])
    return user_key(j).select("id", "user_type", "primary_email", "given_name", "family_name", "external_uid",
                              "suspended", "change_password", "global_addressbook", "ou_path", "user_key")


def account_lookup(students: DataFrame, staff: DataFrame, accounts: DataFrame) -> DataFrame:
    """Q15/Q11/Q14 as one join: for every staged person, the account id and
    user key stored for (uid, type) — NULL when there is none."""
    people = (students.select("external_uid", F.lit("student").alias("user_type"),
                              F.col("student_number").cast("string").alias("student_number"))
              .union(staff.select("external_uid", F.lit("staff").alias("user_type"),
                                  F.lit(None).cast("string").alias("student_number"))))
    acc = user_key(accounts).select(F.col("external_uid").alias("a_uid"), F.col("user_type").alias("a_type"),
                                    "id", "user_key")
    j = people.join(acc, (people["external_uid"] == acc["a_uid"]) & (people["user_type"] == acc["a_type"]), "left")
    return j.select("external_uid", "user_type", "student_number", "id", "user_key")


def account_by_email(accounts: DataFrame, emails: DataFrame) -> DataFrame:
    """Q07: stored accounts for a set of addresses (one semi-join)."""
    return accounts.join(emails.select("primary_email").distinct(), "primary_email", "left_semi")


def uid_by_email(people: DataFrame, lookup: DataFrame) -> DataFrame:
    """Q16 for all pending addresses at once: the new uid that the lookup table (primary_email, new_external_uid) holds for each
    address, null where it holds none.  ``lookup`` has one row per address (``ranking.last_wins``)."""
    known = lookup.select(F.col("primary_email").alias("l_email"), "new_external_uid")
    return people.join(known, F.col("primary_email") == F.col("l_email"), "left").drop("l_email")


def desired_accounts(staff: DataFrame, students: DataFrame, accounts: DataFrame, orgunits: DataFrame, cfg: SyncConfig) -> DataFrame:
    """Q08 and Q09, one row per account: of a person's tied stage rows (several latest enrolments) the least counts, as a whole row."""
    rows = desired_staff(staff, accounts, cfg).unionByName(desired_students(students, accounts, orgunits, cfg))
    return first_of(rows, ["id"], ["ou_path", "primary_email", "given_name", "family_name"])


# --------------------------------------------------------------------- C3
def account_patch(desired: DataFrame, accounts: DataFrame) -> DataFrame:
    """Per stored account, each field whose desired value differs.
    Accounts with no desired row (unmanaged) produce nothing."""
    d = desired.select("id", *[F.col(f).cast("boolean").alias(f) if f in ("suspended", "change_password",
                                                                         "global_addressbook")
                               else F.col(f) for f in ACCOUNT_FIELDS])
    return changed(d, accounts.select("id", *ACCOUNT_FIELDS), ["id"], ACCOUNT_FIELDS)
