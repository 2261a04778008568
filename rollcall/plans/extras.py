"""SIS write-back and portal exports (Q33–Q35), account listings (Q37, O3)
and org-unit lookup (Q40)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.config import SECONDARY_GRADES, SyncConfig
from rollcall.functions import dates, text
from rollcall.operators.ranking import hashed_sample


def email_writeback(students: DataFrame, accounts: DataFrame) -> DataFrame:
    """Q33: student addresses to write back to the SIS (P12 as written:
    the SIS value is missing or differs).  An account without an address is
    never written back (it would blank the SIS value)."""
    bu = accounts.filter(F.col("user_type") == "student").select(
        F.col("external_uid").alias("bu_uid"), "primary_email")
    j = students.filter(F.col("external_userstatus") == 1).join(bu, F.col("external_uid") == F.col("bu_uid"))
    cond = (F.col("student_web_id").isNull() | (F.col("primary_email") != F.col("student_web_id")))
    return (j.filter(cond & F.col("primary_email").isNotNull())
            .select("external_uid", "primary_email", "student_number"))


def portal_missing(src: dict[str, DataFrame], cfg: SyncConfig) -> DataFrame:
    """Q34: secondary students enrolled on as_of, with an e-mail, at an
    included site, who have no portal account (J4 interval join + J3)."""
    ssa = src["enrol"].filter(dates.active_on(cfg.as_of, "entry_date", "leave_date"))
    gl = src["grade_levels"].filter(F.col("short_name").isin(list(SECONDARY_GRADES)))
    sch = src["sites"].filter(F.col("exclude_from_state_reporting") == F.lit(False))
    s = src["students"].filter(F.col("email").isNotNull())
    j = (s.join(ssa.select(F.col("student_id").alias("e_sid"), "grade_level_id", "session_id"),
                F.col("student_id") == F.col("e_sid"))
         .join(gl.select(F.col("grade_level_id").alias("g_id")), F.col("grade_level_id") == F.col("g_id"))
         .join(src["sessions"].select(F.col("session_id").alias("ses_id"), F.col("site_id").alias("ses_site")),
               F.col("session_id") == F.col("ses_id"))
         .join(sch.select(F.col("site_id").alias("sch_id")), F.col("ses_site") == F.col("sch_id")))
    portal = src["portal"].select(F.col("student_id").alias("p_sid"))
    j = j.join(portal, F.col("student_id") == F.col("p_sid"), "left_anti")
    return j.select("local_student_id", F.lit(1).alias("enable_portal"))


def portal_export(accounts: DataFrame, students: DataFrame) -> DataFrame:
    """Q35: portal login export, ordered by family name.

    P11 mixed AND/OR keeps the reference's precedence, written with explicit
    parentheses.  The reference also derived initial passwords from public
    attributes (R15); those columns are not rebuilt.
    """
    bu = accounts.filter(F.col("user_type") == "student").select(
        F.col("external_uid").alias("bu_uid"), "primary_email", F.col("given_name").alias("bu_given"),
        F.col("family_name").alias("bu_family"))
    j = students.join(bu, F.col("external_uid") == F.col("bu_uid"))
    keep = (((F.col("student_web_id").isNull() | F.col("parent_web_id").isNull()) & (F.col("grade_level") > 1))
            | ((F.col("grade_level") > 6) & (F.col("student_allowwebaccess") == 0)
               & (F.col("external_userstatus") == 0)))
    access = F.when(F.col("grade_level") < 6, F.lit("0")).otherwise(F.lit("1"))
    return (j.filter(keep).select(
        "student_number",
        text.left(text.local_part("primary_email"), 20).alias("student_web_id"),
        access.alias("student_allowwebaccess"),
        access.alias("allowwebaccess"),
        text.left(text.strip_blanks(F.concat("bu_given", F.col("student_number").cast("string"))), 20).alias("web_id"),
        F.col("primary_email").alias("email_address"),
        F.col("bu_family").alias("family_name"))
        .orderBy("family_name", "student_number"))


def account_listing(accounts: DataFrame, user_type: str | None = None,
                    columns: Sequence[str] = ("id", "user_type", "primary_email", "given_name", "family_name",
                                              "external_uid", "suspended", "change_password",
                                              "global_addressbook", "ou_path")) -> DataFrame:
    """Current accounts, optionally of one type."""
    df = accounts if user_type is None else accounts.filter(F.col("user_type") == user_type)
    return df.select(*columns)


def account_sample(accounts: DataFrame, n: int, seed: int, user_type: str | None = None) -> DataFrame:
    """Q37 with shuffle + limit (O3): a reproducible random sample of n."""
    return hashed_sample(account_listing(accounts, user_type), n, seed, ["id"])


def ou_paths(people: DataFrame, orgunits: DataFrame, school_col: str, key_col: str,
             user_type: str | None = None) -> DataFrame:
    """Q40 re-aimed: org-unit path for every row of ``people`` by
    (department, map key[, type]) in one join; the path gets a leading '/'.
    Unmatched rows keep a NULL path instead of failing."""
    ou = orgunits
    if user_type:
        ou = ou.filter(F.col("user_type") == user_type)
    ou = ou.select(F.col("department_id").alias("ou_dept"), F.col("map_key").alias("ou_key"),
                   F.concat(F.lit("/"), F.col("ou_path")).alias("ou_full_path"))
    return people.join(ou, (F.col(school_col) == F.col("ou_dept")) & (F.col(key_col) == F.col("ou_key")),
                       "left").drop("ou_dept", "ou_key")


# Columns a caller may look accounts up by (P16: the key name is chosen at
# run time, so it is checked against this list before it becomes a column).
ACCOUNT_KEYS = ("id", "external_uid", "primary_email", "google_id")


def account_query(accounts: DataFrame, key_col: str, keys: DataFrame | None = None,
                  user_type: str | None = None, sample: tuple[int, int] | None = None) -> DataFrame:
    """P16/Q37/Q17 tail: compose the optional predicates of an account query.

    ``keys`` (one column named ``key_col``) restricts to those keys with a
    semi-join; ``user_type`` filters the type; ``sample=(n, seed)`` shuffles
    and limits (O3)."""
    if key_col not in ACCOUNT_KEYS:
        raise ValueError(f"not an account key: {key_col!r}")
    df = accounts
    if user_type is not None:
        df = df.filter(F.col("user_type") == user_type)
    if keys is not None:
        df = df.join(keys.select(key_col).distinct(), key_col, "left_semi")
    if sample is not None:
        df = hashed_sample(df, sample[0], sample[1], ["id"])
    return df
