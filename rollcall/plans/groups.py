"""Group reconciliation: what groups and memberships are missing, stale or
renamed (Q21–Q32, Q36, Q38, Q39).

Inputs (domain DataFrames):
  sections   – desired section groups (``extract.section_groups``)
  schedule   – current student schedule (``extract.student_schedule``)
  groups     – current groups (google_groupid, group_email, …, group_type, unique_attribute)
  members    – current memberships (google_groupid, google_userid, role, type)
  accounts   – current accounts with lower-case ``user_type`` (``accounts.normalise_accounts``)
  staff / students – stage tables.

Every "missing" is a ``left_anti`` join and every lookup an equi-join on
high-cardinality keys, so each plan is a handful of shuffles on
(group id, user id) regardless of data size.  ``unique_attribute`` is text
in the store but compared with numeric ids; it is cast explicitly (R5).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.config import (COHORT_GROUP, COURSE_GROUP, ROLE_MEMBER, ROLE_OWNER, SCHOOL_GROUP,
                             SECTION_GROUP, SyncConfig)
from rollcall.functions import dates, text
from rollcall.operators.reconcile import missing


def groups_of_type(groups: DataFrame, group_type: str) -> DataFrame:
    """Groups of one type with the numeric form of their unique attribute."""
    return (groups.filter(F.col("group_type") == group_type)
            .withColumn("ua_num", F.col("unique_attribute").try_cast("bigint")))


def accounts_of_type(accounts: DataFrame, user_type: str) -> DataFrame:
    return accounts.filter(F.col("user_type") == user_type)


def _members_role(members: DataFrame, role: str | None) -> DataFrame:
    return members if role is None else members.filter(F.col("role") == role)


def _missing_members(cand: DataFrame, members: DataFrame, role: str | None = None) -> DataFrame:
    """Candidate (google_groupid, google_id) pairs without a membership row."""
    gm = _members_role(members, role).select(F.col("google_groupid").alias("m_gid"),
                                             F.col("google_userid").alias("m_uid"))
    cond = (cand["google_groupid"] == gm["m_gid"]) & (cand["google_id"] == gm["m_uid"])
    return cand.join(gm, cond, "left_anti")


# ------------------------------------------------------------- Q21 / Q31
def section_groups_missing(sections: DataFrame, groups: DataFrame) -> DataFrame:
    """Q21: desired section groups with no StudentSection group yet."""
    g = groups_of_type(groups, SECTION_GROUP)
    new = missing(sections, g, [("section_id", "ua_num")])
    return new.select("group_email", "group_name", "group_description",
                      F.col("section_id").cast("string").alias("unique_attribute"),
                      F.col("school_id").alias("department_id"),
                      F.lit(SECTION_GROUP).alias("group_type"))


def course_groups_missing(sections: DataFrame, groups: DataFrame, cfg: SyncConfig) -> DataFrame:
    """Q31 (draft in the reference): one course group per section of the
    configured course numbers, when no 'Courses' group carries the section."""
    s = sections.filter(F.col("course_number").isin(list(cfg.course_group_numbers)))
    new = missing(s, groups_of_type(groups, COURSE_GROUP), [("section_id", "ua_num")])
    return new.select(
        F.col("group_email"),
        F.concat(F.lit("z-"), F.lower(F.regexp_replace("course_name", " ", "")),
                 F.lit("@" + cfg.group_domain)).alias("course_email"),
        "group_name", "group_description",
        F.col("section_id").cast("string").alias("unique_attribute"),
        F.col("school_id").alias("department_id"),
        F.lit(COURSE_GROUP).alias("group_type"))


# ------------------------------------------------------------------- Q22
def section_owners_missing(sections: DataFrame, groups: DataFrame, accounts: DataFrame,
                           members: DataFrame) -> DataFrame:
    """Q22: the section's owner (a staff account) is not an OWNER of its group."""
    g = groups_of_type(groups, SECTION_GROUP).select("google_groupid", "group_email", "ua_num")
    sp = sections.select(F.col("section_id").alias("sp_sec"), F.col("group_owner").alias("sp_owner"))
    bu = (accounts_of_type(accounts, "staff").filter(F.col("google_id").isNotNull())
          .select(F.col("external_uid").alias("bu_uid"), "google_id"))
    cand = (g.join(sp, F.col("ua_num") == F.col("sp_sec"))
            .join(bu, F.col("sp_owner") == F.col("bu_uid"))
            .select("google_groupid", "google_id", "group_email"))
    return (_missing_members(cand, members, ROLE_OWNER)
            .select("google_groupid", "google_id", F.lit(ROLE_OWNER).alias("role"), "group_email")
            .distinct())


# ------------------------------------------------------------- Q23 / Q32
def _schedule_members(schedule: DataFrame, groups: DataFrame, accounts: DataFrame, group_type: str,
                      cfg: SyncConfig) -> DataFrame:
    """(group, student account) pairs the schedule asks for on as_of."""
    sched = (schedule.filter(dates.active_on(cfg.as_of, "dateenrolled", "dateleft"))
             .select("sectionid", "studentid"))
    g = groups_of_type(groups, group_type).select("google_groupid", "group_email", "ua_num")
    # A member row needs a directory id; accounts without one go to rejects.
    bu = (accounts_of_type(accounts, "student").filter(F.col("google_id").isNotNull())
          .select("external_uid", "google_id", "given_name"))
    return (sched.join(g, sched["sectionid"] == g["ua_num"])
            .join(bu, sched["studentid"] == bu["external_uid"])
            .select("google_groupid", "google_id", "group_email", "given_name", "external_uid"))


def section_members_desired(schedule, groups, accounts, cfg: SyncConfig) -> DataFrame:
    """Every MEMBER row the section groups should have (for a full refresh, K8)."""
    return (_schedule_members(schedule, groups, accounts, SECTION_GROUP, cfg)
            .select("google_groupid", "google_id", F.lit(ROLE_MEMBER).alias("role")).distinct())


def _schedule_members_missing(schedule: DataFrame, groups: DataFrame, accounts: DataFrame,
                              members: DataFrame, group_type: str, cfg: SyncConfig) -> DataFrame:
    cand = _schedule_members(schedule, groups, accounts, group_type, cfg)
    return (_missing_members(cand, members)
            .select("google_groupid", "google_id", F.lit(ROLE_MEMBER).alias("role"), "group_email",
                    "given_name", "external_uid")
            .distinct())


def section_members_missing(schedule, groups, accounts, members, cfg: SyncConfig) -> DataFrame:
    """Q23: students scheduled on as_of who are not members of the section group."""
    return _schedule_members_missing(schedule, groups, accounts, members, SECTION_GROUP, cfg)


def course_members_missing(schedule, groups, accounts, members, cfg: SyncConfig) -> DataFrame:
    """Q32: same for course groups."""
    return _schedule_members_missing(schedule, groups, accounts, members, COURSE_GROUP, cfg)


def scheduled_in_groups(schedule: DataFrame, groups: DataFrame, accounts: DataFrame, cfg: SyncConfig) -> DataFrame:
    """(google_groupid, external_uid, google_id, account_uid) of students scheduled on as_of into a section that has a group;
    account_uid is null without an account."""
    sched = schedule.filter(dates.active_on(cfg.as_of, "dateenrolled", "dateleft")).select("sectionid", F.col("studentid").alias("external_uid"))
    g = groups_of_type(groups, SECTION_GROUP).select("google_groupid", "ua_num")
    held = accounts_of_type(accounts, "student").select(F.col("external_uid").alias("account_uid"), "google_id")
    return (sched.join(g, F.col("sectionid") == F.col("ua_num")).select("google_groupid", "external_uid").distinct()
            .join(held, F.col("external_uid") == F.col("account_uid"), "left").select("google_groupid", "external_uid", "google_id", "account_uid"))


def member_rejects(schedule: DataFrame, groups: DataFrame, accounts: DataFrame, cfg: SyncConfig) -> DataFrame:
    """Scheduled students whose account has no directory id (cannot be added)."""
    sched = schedule.filter(dates.active_on(cfg.as_of, "dateenrolled", "dateleft"))
    g = groups_of_type(groups, SECTION_GROUP)
    bu = accounts_of_type(accounts, "student").filter(F.col("google_id").isNull())
    return (sched.join(g, sched["sectionid"] == g["ua_num"])
            .join(bu, sched["studentid"] == bu["external_uid"])
            .select("google_groupid", "external_uid", F.lit("account without directory id").alias("reason"))
            .distinct())


# ------------------------------------------------------------------- Q24
def section_groups_renamed(sections: DataFrame, groups: DataFrame) -> DataFrame:
    """Q24: groups whose stored address differs (case-insensitively) from the
    derived one.  The two addresses get distinct names (R12)."""
    g = groups_of_type(groups, SECTION_GROUP).select("google_groupid", "group_email", "ua_num")
    j = g.join(sections.select("section_id", F.col("group_email").alias("new_email"), "group_name",
                               "group_description"),
               g["ua_num"] == F.col("section_id"))
    return (j.filter(text.ci_differs("group_email", "new_email"))
            .select(F.col("group_email").alias("old_email"), "new_email", "group_name", "group_description"))


# ------------------------------------------------------------- Q25 / Q26
def stale_owners(sections: DataFrame, groups: DataFrame, accounts: DataFrame, members: DataFrame) -> DataFrame:
    """Q25: OWNER rows of section groups that the desired sections do not name
    (the owner must be the section's staff owner)."""
    gm = members.filter(F.col("role") == ROLE_OWNER).select("google_groupid", "google_userid")
    g = groups_of_type(groups, SECTION_GROUP).select(F.col("google_groupid").alias("g_gid"), "ua_num")
    bu = accounts.select("google_id", "external_uid", "user_type")
    cur = (gm.join(g, gm["google_groupid"] == g["g_gid"])
           .join(bu, gm["google_userid"] == bu["google_id"]))
    want = sections.select(F.col("section_id").alias("w_sec"), F.col("group_owner").alias("w_owner"))
    cond = ((cur["ua_num"] == want["w_sec"]) & (cur["external_uid"] == want["w_owner"])
            & (cur["user_type"] == F.lit("staff")))
    return cur.join(want, cond, "left_anti").select("google_groupid", "google_userid")


def stale_members(schedule: DataFrame, groups: DataFrame, accounts: DataFrame, members: DataFrame,
                  cfg: SyncConfig) -> DataFrame:
    """Q26 (R10 fixed): a MEMBER is stale only when no schedule row active on
    as_of maps that student to the group's section."""
    gm = members.filter(F.col("role") == ROLE_MEMBER).select("google_groupid", "google_userid")
    g = groups_of_type(groups, SECTION_GROUP).select(F.col("google_groupid").alias("g_gid"), "ua_num")
    bu = accounts.select("google_id", "external_uid", "user_type", "primary_email")
    cur = (gm.join(g, gm["google_groupid"] == g["g_gid"])
           .join(bu, gm["google_userid"] == bu["google_id"]))
    active = (schedule.filter(dates.active_on(cfg.as_of, "dateenrolled", "dateleft"))
              .select(F.col("sectionid").alias("a_sec"), F.col("studentid").alias("a_stu")))
    cond = ((cur["ua_num"] == active["a_sec"]) & (cur["external_uid"] == active["a_stu"])
            & (cur["user_type"] == F.lit("student")))
    return cur.join(active, cond, "left_anti").select("google_groupid", "google_userid", "primary_email")


def course_groups_stale(sections: DataFrame, groups: DataFrame, cfg: SyncConfig) -> DataFrame:
    """Course groups (Q31) whose section is no more among those of the configured course numbers; groups whose unique
    attribute is no section number are left alone."""
    want = sections.filter(F.col("course_number").isin(list(cfg.course_group_numbers))).select("section_id")
    held = groups_of_type(groups, COURSE_GROUP).filter(F.col("ua_num").isNotNull())
    return missing(held, want, [("ua_num", "section_id")]).select("google_groupid", "group_email")


# ------------------------------------------------------------------- Q27
def school_members_missing(staff: DataFrame, groups: DataFrame, accounts: DataFrame,
                           members: DataFrame) -> DataFrame:
    """Q27: active, unsuspended staff not yet in their school's staff group."""
    bu = (accounts_of_type(accounts, "staff")
          .filter((F.col("suspended") == F.lit(False)) & F.col("google_id").isNotNull())
          .select("external_uid", "google_id"))
    sp = (staff.filter(F.col("external_userstatus") == 1)
          .select(F.col("external_uid").alias("sp_uid"), F.col("schoolid").try_cast("int").alias("school")))
    g = groups.filter(F.col("group_type") == SCHOOL_GROUP).select("google_groupid", "group_email",
                                                                  "department_id")
    cand = (bu.join(sp, bu["external_uid"] == sp["sp_uid"])
            .join(g, sp["school"] == g["department_id"])
            .select("google_groupid", "google_id", "group_email"))
    return (_missing_members(cand, members)
            .select("google_groupid", F.col("google_id").alias("google_userid"),
                    F.lit(ROLE_MEMBER).alias("role"), "group_email"))


# ------------------------------------------------------------- Q28 – Q30
def cohort_groups_missing(departments: DataFrame, sites: DataFrame, groups: DataFrame,
                          cfg: SyncConfig, type_filter: bool = True) -> DataFrame:
    """Q28: graduation-year groups that do not exist yet.

    The join key is computed (base year − unit, J6) and materialised on both
    sides.  ``type_filter`` (R6 fix) restricts the existing groups to the
    cohort type; the reference matched any group type.
    """
    base = cfg.cohort_base_year
    d = departments.join(sites, departments["siteid"] == sites["siteid"]).filter(
        (F.col("auto_exclude") == 0) & (F.col("upper_unit") > cfg.cohort_min_upper_unit))
    if cfg.excluded_sites:
        d = d.filter(~F.col("sitecode").isin(list(cfg.excluded_sites)))
    d = d.withColumn("class_of", F.lit(base) - F.col("unit")).withColumn(
        "attr", F.lit(base) - F.col("unique_identifier"))
    g = groups.withColumn("ua_num", F.col("unique_attribute").try_cast("bigint"))
    if type_filter:
        g = g.filter(F.col("group_type") == COHORT_GROUP)
    new = missing(d, g, [("attr", "ua_num"), ("sitecode", "department_id")])
    label = F.concat(F.col("description"), F.lit(" Class of "), F.col("class_of").cast("string"))
    return new.select(
        F.lower(F.concat(F.lit("y"), F.col("abbreviation"), F.lit("-classof-"), F.col("class_of").cast("string"),
                         F.lit("-students@" + cfg.group_domain))).alias("group_email"),
        label.alias("group_name"), label.alias("group_description"),
        F.col("attr").alias("unique_attribute"), F.col("sitecode").alias("department_id"),
        F.lit(COHORT_GROUP).alias("group_type"))


def _cohort_groups(groups: DataFrame) -> DataFrame:
    return groups_of_type(groups, COHORT_GROUP)


def stale_cohort_members(students: DataFrame, groups: DataFrame, accounts: DataFrame,
                         members: DataFrame, cfg: SyncConfig) -> DataFrame:
    """Q29: cohort-group members who are not a student of that school and year."""
    g = _cohort_groups(groups).select(F.col("google_groupid").alias("g_gid"), "ua_num", "department_id")
    cur = (members.join(g, members["google_groupid"] == g["g_gid"])
           .join(accounts.select("google_id"), members["google_userid"] == F.col("google_id")))
    want = (students.join(accounts_of_type(accounts, "student").select(F.col("external_uid").alias("a_uid"),
                                                                       F.col("google_id").alias("w_gid")),
                          students["external_uid"] == F.col("a_uid"))
            .select(F.col("schoolid").alias("w_school"),
                    (F.lit(cfg.cohort_base_year) - F.col("grade_level")).alias("w_attr"), "w_gid"))
    cond = ((cur["ua_num"] == want["w_attr"]) & (cur["department_id"] == want["w_school"])
            & (cur["google_userid"] == want["w_gid"]))
    return cur.join(want, cond, "left_anti").select("google_groupid", "google_userid")


def cohort_members_missing(students: DataFrame, groups: DataFrame, accounts: DataFrame,
                           members: DataFrame, cfg: SyncConfig) -> DataFrame:
    """Q30: enrolled students (grade ≥ 6, active on as_of) missing from their
    school's graduation-year group."""
    sp = students.filter(dates.active_on(cfg.as_of, "entrydate", "exitdate")
                         & (F.col("external_userstatus") == 1)
                         & (F.col("grade_level") >= cfg.cohort_min_grade))
    sp = sp.withColumn("attr", F.lit(cfg.cohort_base_year) - F.col("grade_level"))
    bu = (accounts_of_type(accounts, "student").filter(F.col("google_id").isNotNull())
          .select("external_uid", "google_id", "given_name"))
    g = _cohort_groups(groups).select("google_groupid", "group_email", "ua_num", "department_id")
    cand = (sp.select(F.col("external_uid").alias("sp_uid"), "schoolid", "attr")
            .join(bu, F.col("sp_uid") == bu["external_uid"])
            .join(g, (F.col("schoolid") == g["department_id"]) & (F.col("attr") == g["ua_num"]))
            .select("google_groupid", "google_id", "group_email", "given_name", "external_uid"))
    return (_missing_members(cand, members)
            .select("google_groupid", "google_id", F.lit(ROLE_MEMBER).alias("role"), "group_email",
                    "given_name", "external_uid"))


# ---------------------------------------------------------- Q36, Q38, Q39
def member_view(members: DataFrame, groups: DataFrame, accounts: DataFrame) -> DataFrame:
    """The store's member view: membership with group and user addresses."""
    return (members.join(groups.select("google_groupid", "group_email"), "google_groupid")
            .join(accounts.select(F.col("google_id").alias("google_userid"), "primary_email"), "google_userid")
            .select("google_groupid", "google_userid", "primary_email", "group_email"))


def group_members_of(view: DataFrame, wanted: DataFrame) -> DataFrame:
    """Q36 re-aimed: members of the groups listed in ``wanted`` (group_email),
    one semi-join instead of one query per group."""
    return view.join(wanted.select("group_email").distinct(), "group_email", "left_semi")


def groups_by_type(groups: DataFrame, group_type: str) -> DataFrame:
    """Q38."""
    return groups.filter(F.col("group_type") == group_type).select("google_groupid")


def all_groups(groups: DataFrame) -> DataFrame:
    """Q39."""
    return groups.select("google_groupid", "group_email")


def pending_section_members(schedule: DataFrame, sections: DataFrame, groups: DataFrame, accounts: DataFrame,
                            cfg: SyncConfig) -> DataFrame:
    """Stage barrier (E2): students scheduled on as_of into a section whose
    group does not exist yet.  They are keyed by the section and marked
    ``pending_group``; once the group's create response is applied they
    surface through :func:`section_members_missing`."""
    new = missing(sections.select("section_id").distinct(), groups_of_type(groups, SECTION_GROUP),
                  [("section_id", "ua_num")])
    sched = (schedule.filter(dates.active_on(cfg.as_of, "dateenrolled", "dateleft"))
             .select("sectionid", "studentid"))
    bu = (accounts_of_type(accounts, "student").filter(F.col("google_id").isNotNull())
          .select("external_uid", "google_id"))
    return (sched.join(new, sched["sectionid"] == new["section_id"])
            .join(bu, sched["studentid"] == bu["external_uid"])
            .select(F.col("section_id").cast("string").alias("unique_attribute"), "google_id",
                    F.lit(ROLE_MEMBER).alias("role"), F.lit("pending_group").alias("status"))
            .distinct())
