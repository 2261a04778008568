"""Source-of-truth extracts: staff, students, sections, schedules (Q01, Q02,
Q05/Q06 via X1, Q18, Q19, Q20).

Inputs are dicts of domain DataFrames (see ``rollcall.schemas``); outputs
are the stage tables that the reconcile plans diff against current state.
Join order is written small-side-first on purpose: Spark does not reorder
joins without cost-based statistics, so the filtered dimension chain
(terms → sessions → sites → grades) is joined before the fact rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.config import ELEMENTARY_GRADES, SECONDARY_GRADES, SECTION_GRADES, SyncConfig
from rollcall.functions import codes, dates, text
from rollcall.operators.ranking import latest_per_key
from rollcall.operators.routing import routed


# --------------------------------------------------------------------- Q01
def staff_extract(users: DataFrame) -> DataFrame:
    """Q01: SIS users → staff stage rows (flags as '0'/'1' text, R3 kept)."""
    u = users.filter(text.not_blank("local_user_id") & text.not_blank("address"))
    return u.select(
        F.col("user_id").alias("external_uid"),
        F.col("local_user_id").alias("staffid"),
        F.col("address").alias("schoolid"),
        F.col("local_user_id").alias("teachernumber"),
        codes.flag(F.col("state_id").isNotNull()).alias("certificated"),
        F.col("first_name").alias("given_name"),
        F.col("last_name").alias("family_name"),
        F.col("middle_name"),
        F.col("gender"),
        F.when(F.col("active"), F.lit(1)).otherwise(F.lit(0)).alias("external_userstatus"),
        F.lit(1).alias("staff_type"),
        codes.missing_email_flag("email1").alias("suspend_account"),
        codes.has_email_flag("email1").alias("has_email"),
        F.col("email1").alias("email_address"),
        codes.flag(F.col("state_id").isNotNull(), "1", "2").alias("staff_conference"),
    )


# --------------------------------------------------------------------- Q02
def latest_enrolments(enrol: DataFrame) -> DataFrame:
    """Per student, the primary enrolments that start on the student's
    latest entry date (ties kept; rows with entry = leave never count)."""
    real = enrol.filter(F.col("entry_date") != F.col("leave_date"))
    latest = latest_per_key(real, ["student_id"], "entry_date")
    return latest.filter(F.col("is_primary") == F.lit(True))


def placements(src: dict[str, DataFrame]) -> DataFrame:
    """Where each counted enrolment places a student: site, session, dates, the grade's label and number (P4: null for a
    label that is no grade)."""
    sites = src["sessions"].select("session_id", "site_id").join(src["sites"].select("site_id"), "site_id", "left_semi")
    grades = src["grade_levels"].select("grade_level_id", F.col("short_name").alias("grade_label"))
    return (latest_enrolments(src["enrol"]).select("student_id", "session_id", "grade_level_id", "entry_date", "leave_date")
            .join(sites, "session_id").join(grades, "grade_level_id").drop("grade_level_id")
            .withColumn("grade_level", codes.grade_number("grade_label")))


def route_placements(src: dict[str, DataFrame]) -> DataFrame:
    """Placements routed; those whose grade label does not parse are rejects (the extract keeps them without a grade)."""
    return routed(placements(src), {"grade label does not parse": F.col("grade_label").isNotNull() & F.col("grade_level").isNull()})


def student_extract(src: dict[str, DataFrame], cfg: SyncConfig) -> DataFrame:
    """Q02: student stage rows from the SIS: placements first, then what is known of the student."""
    people = src["students"].join(src["custom_fields"].select("student_id", "email_suspend", "override_email"), "student_id")
    if cfg.excluded_students:
        people = people.filter(~F.col("student_id").isin(list(cfg.excluded_students)))
    houses = src["houses"].select("student_id", "session_id", "house_name")
    found = placements(src).join(people, "student_id").join(houses, ["student_id", "session_id"], "left")
    enrolled = dates.active_on(cfg.as_of, "entry_date", "leave_date")
    nothing, allowed = F.lit(None).cast("string"), F.lit(1)
    columns = {
        "external_uid": "student_id", "schoolid": "site_id", "student_number": "local_student_id", "given_name": "first_name",
        "family_name": "last_name", "middle_name": "middle_name", "dob": "birth_date", "gender": codes.normalise_gender("gender"),
        "grade_level": "grade_level", "home_room": nothing, "area": "house_name", "entrydate": "entry_date", "exitdate": "leave_date",
        "external_userstatus": codes.flag(enrolled, 1, 0), "suspend_account": codes.flag(F.col("email_suspend"), 1, 0),
        "email_override": "override_email", "student_web_id": "email", "parent_web_id": nothing, "student_allowwebaccess": allowed,
        "parent_allowwebaccess": allowed,
    }
    return found.select(*[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()])


# ------------------------------------------------------------ X1 (Q05/Q06)
def custom_field_pivot(eav: DataFrame, table_name: str, fields: Sequence[str]) -> DataFrame:
    """Entity-attribute-value rows → one column per field.

    The latest value (highest ``seq``) wins when a field repeats.  The field
    list is explicit, so the pivot needs no extra job to find the values.
    """
    rows = eav.filter(F.col("table_name") == table_name)
    return (rows.groupBy("row_id").pivot("field", list(fields))
            .agg(F.max_by("value", "seq")))


@dataclass(frozen=True)
class Attribute:
    """A row of the rule table for custom fields: the stored field, the column it becomes, and the column's type."""

    field: str
    column: str
    kind: str = "string"


def typed_attributes(eav: DataFrame, table_name: str, rules: Sequence[Attribute]) -> DataFrame:
    """X1 by a rule table: one row per ``row_id`` with a typed column per rule and ``unparsed``, the fields (field, value) whose
    latest value is no text of the rule's type (their columns are null)."""
    wide = custom_field_pivot(eav, table_name, sorted({r.field for r in rules}))
    value = lambda r: F.col(f"`{r.field}`")
    faults = [F.when(value(r).isNotNull() & value(r).try_cast(r.kind).isNull(),
                     F.struct(F.lit(r.field).alias("field"), value(r).alias("value"))) for r in rules if r.kind != "string"]
    none = F.array().cast("array<struct<field:string,value:string>>")
    unparsed = F.filter(F.array(*faults), lambda x: x.isNotNull()) if faults else none
    return wide.select("row_id", *[value(r).try_cast(r.kind).alias(r.column) for r in rules], unparsed.alias("unparsed"))


def unparsed_attributes(typed: DataFrame) -> DataFrame:
    """(row_id, field, value) of the values that did not parse."""
    return typed.select("row_id", F.inline("unparsed"))


def older_staff_extract(teachers: DataFrame, attributes: DataFrame) -> DataFrame:
    """Q05: staff of the older SIS.  ``attributes`` (:func:`typed_attributes`) has state_id, gender, no_email, email, email_address;
    teachers count at their home school, with a staff type and both names."""
    placed = teachers.filter(F.col("staffstatus").isNotNull() & (F.col("schoolid") == F.col("homeschoolid"))
                             & F.col("first_name").isNotNull() & F.col("last_name").isNotNull())
    j = placed.join(attributes, placed["id"] == attributes["row_id"], "left")
    certified = F.col("state_id").isNotNull()
    return j.select(
        F.col("users_dcid").alias("external_uid"), "id", "schoolid", "teachernumber", codes.flag(certified, 1, 0).alias("certificated"),
        F.col("first_name").alias("given_name"), F.col("last_name").alias("family_name"), "middle_name", "gender",
        codes.flag(F.col("status") == 1, 0, 2).alias("external_userstatus"), F.col("staffstatus").alias("staff_type"),
        codes.flag(F.col("no_email") == 1, 1, 0).alias("suspend_account"), codes.flag(F.col("email") == 1, 1, 0).alias("has_email"),
        "email_address", codes.flag(certified, 1, 2).alias("staff_conference"))


def older_student_extract(students: DataFrame, attributes: DataFrame) -> DataFrame:
    """Q06: students of the older SIS.  ``attributes`` has area, suspended, email_override.  Gender is compared in upper case
    (P3); the order by id is left to whoever writes the rows (O2)."""
    j = students.join(attributes, students["id"] == attributes["row_id"], "left")
    return j.select(
        F.col("id").alias("external_uid"), "schoolid", "student_number", F.col("first_name").alias("given_name"),
        F.col("last_name").alias("family_name"), "middle_name", "dob", codes.normalise_gender(F.upper("gender")).alias("gender"),
        "grade_level", "home_room", "area", F.to_date("entrydate").alias("entrydate"), F.to_date("exitdate").alias("exitdate"),
        codes.flag(F.col("enroll_status") == 0, 0, 2).alias("external_userstatus"),
        codes.flag(F.col("suspended") == 1, 1, 0).alias("suspend_account"), "email_override", "student_web_id",
        F.col("web_id").alias("parent_web_id"), "student_allowwebaccess", F.col("allowwebaccess").alias("parent_allowwebaccess"))


# --------------------------------------------------------------------- Q18
def section_groups(src: dict[str, DataFrame], cfg: SyncConfig) -> DataFrame:
    """Q18: one desired group per section with derived address, name and
    description.

    Every affiliation joins on the section, so the joined rows of a section
    are the cross product of four per-section lists: primary teachers,
    terms of the year at an included site, courses, time blocks.  Hence
    W1 (``COUNT(*) OVER (PARTITION BY section)``) is the product of the four
    list sizes, and W2 (``dense_rank() … = 1`` over surname, course, time
    block; ties kept) keeps exactly the rows built from the first teacher
    surname, first course name and first time-block name of each list.  Each
    list is aggregated per section with map-side partial aggregation, so a hot
    section is combined by many tasks, and only the rank-1 rows are joined: the
    fan-out join is never materialised.  All of it is dealt by the section alone,
    so the joins and the last ``distinct`` need no shuffle between them.
    """
    ses = src["sessions"].filter(F.col("academic_year") == cfg.academic_year)
    sch = src["sites"].filter(F.col("exclude_from_state_reporting") == F.lit(False))
    gl = src["grade_levels"].filter(F.col("short_name").isin(list(SECTION_GRADES)))
    # Terms of the year at included sites with a section grade (small dimension chain).
    term_dim = (src["terms"].alias("tr")
                .join(ses.alias("ses"), F.col("ses.session_id") == F.col("tr.session_id"))
                .join(sch.alias("sch"), F.col("sch.site_id") == F.col("ses.site_id"))
                .join(gl.alias("gl"), F.col("gl.grade_level_id") == F.col("sch.start_grade_level_id"))
                .join(src["site_labels"].alias("sm"), F.col("sm.site_id") == F.col("sch.site_id"))
                .select(F.col("tr.term_id").alias("t_term"), F.col("tr.term_name"), F.col("sch.site_id"),
                        F.col("sch.site_name"), F.col("gl.short_name").alias("grade"),
                        F.col("sm.short_name").alias("site_short")))
    # One year's terms of the sites: the section terms are cut to them where they are read, not dealt by term.
    terms = (src["section_term"].join(F.broadcast(term_dim), F.col("term_id") == F.col("t_term"))
             .select("section_id", "term_name", "site_id", "site_name", "grade", "site_short"))
    teachers = (src["section_teacher"].filter(F.col("primary_teacher") == F.lit(True))
                .join(src["users"].select(F.col("user_id").alias("u_id"), "last_name", "first_name"),
                      F.col("user_id") == F.col("u_id"))
                .select("section_id", "user_id", "last_name", "first_name"))
    courses = (src["section_course"]
               .join(src["courses"].select(F.col("course_id").alias("c_id"), "school_course_id",
                                           F.col("short_name").alias("course_name")),
                     F.col("course_id") == F.col("c_id"))
               .select("section_id", "school_course_id", "course_name"))
    blocks = (src["section_timeblock"]
              .join(src["timeblocks"].select(F.col("timeblock_id").alias("b_id"), "timeblock_name"),
                    F.col("timeblock_id") == F.col("b_id"))
              .select("section_id", "timeblock_name"))

    def first_key(c: str) -> Column:
        return F.struct(F.col(c).isNull().alias("n"), F.col(c).alias("v"))  # NULLS LAST under min()

    # Each list once per section: its size and first key (partial aggregates), and its rows with that key.  No key is below
    # the first one, so "not above it" says "equal" without becoming a join key, by which the rows would be dealt anew.
    ranked = terms.join(terms.groupBy("section_id").agg(F.count(F.lit(1)).alias("n_t")), "section_id")
    for name, rows, key in (("u", teachers, "last_name"), ("c", courses, "course_name"), ("b", blocks, "timeblock_name")):
        stats = rows.groupBy("section_id").agg(F.count(F.lit(1)).alias(f"n_{name}"), F.min(first_key(key)).alias("first"))
        ranked = ranked.join(rows.join(stats, "section_id").filter(first_key(key) <= F.col("first")).drop("first"), "section_id")
    year = F.col("n_t") * F.col("n_u") * F.col("n_c") * F.col("n_b") > 1
    # Rows that differ only in terms which the names leave out are one row before the names are put together.
    ranked = ranked.select(
        "section_id", "site_id", "site_name", "grade", "site_short", "last_name", "first_name", "user_id", "school_course_id",
        "course_name", "timeblock_name", year.alias("whole_year"),
        F.when(~year, F.substring("term_name", 1, 2)).alias("term2")).distinct()

    period = text.period_name("timeblock_name")
    secondary = F.col("grade").isin(list(SECONDARY_GRADES))
    elementary = F.col("grade").isin(list(ELEMENTARY_GRADES))
    whole_year, term2 = F.col("whole_year"), F.col("term2")
    surname = text.clean_surname("last_name")
    first_i = text.initial("first_name")
    address = F.concat(
        F.lower(F.concat(F.lit("Z-"), surname, F.lit("-"), first_i,
                         F.when(secondary, F.concat(F.lit("-P"), period)).otherwise(F.lit("")),
                         F.lit("-"),
                         F.when(whole_year, F.lit("Y-")).otherwise(F.concat(term2, F.lit("-"))),
                         F.col("site_short"), F.lit("-" + cfg.year_tag))),
        F.lit("@" + cfg.group_domain))
    name = F.concat(F.lit("Z-"), surname, F.lit(" "), first_i,
                    F.when(secondary, F.concat(F.lit(" P"), period)).otherwise(F.lit("")),
                    F.lit(" "),
                    F.when(whole_year, F.lit("Y ")).otherwise(F.concat(term2, F.lit(" "))),
                    F.col("site_short"), F.lit(" " + cfg.year_label))
    description = F.concat(
        F.col("site_name"), F.lit(" "), F.col("last_name"), F.lit(" "), first_i, F.lit(" "),
        F.when(elementary, F.col("course_name")).otherwise(
            F.concat(F.when(whole_year, F.lit("Y")).otherwise(term2), F.lit(" Period "), period)))
    return ranked.select(
        F.col("section_id"),
        F.col("site_id").alias("school_id"),
        address.alias("group_email"),
        name.alias("group_name"),
        description.alias("group_description"),
        F.col("user_id").alias("group_owner"),
        F.col("school_course_id").alias("course_number"),
        F.col("course_name"),
        F.lit(1).alias("term_id"),
    ).distinct()


# --------------------------------------------------------------- Q19 / Q20
def current_terms(src: dict[str, DataFrame], cfg: SyncConfig) -> DataFrame:
    return (src["terms"].filter(dates.active_on(cfg.as_of, "start_date", "end_date")).alias("tr")
            .join(src["sessions"].alias("ses"), F.col("ses.session_id") == F.col("tr.session_id"))
            .select("tr.term_id", "tr.end_date", "ses.site_id"))


def student_schedule(src: dict[str, DataFrame], cfg: SyncConfig) -> DataFrame:
    """Q19: schedule rows of sections running in a term that contains as_of;
    an open leave date takes the term end (P9)."""
    terms = current_terms(src, cfg).alias("t")
    sta = src["section_term"].alias("sta").join(terms, F.col("t.term_id") == F.col("sta.term_id"))
    return (src["section_student"].alias("ssa")
            .join(sta, F.col("sta.section_id") == F.col("ssa.section_id"))
            .select(F.col("ssa.ssa_id").alias("ps_id"),
                    F.col("ssa.student_id").alias("studentid"),
                    F.col("ssa.section_id").alias("sectionid"),
                    F.col("t.site_id").alias("schoolid"),
                    F.col("ssa.entry_date").alias("dateenrolled"),
                    dates.open_end("ssa.leave_date", "t.end_date").alias("dateleft"),
                    F.col("sta.term_id").alias("termid")))


def schedule_by_term_range(section_student: DataFrame, section_term: DataFrame,
                           lo: int, hi: int, term_code: str = "sta.term_id") -> DataFrame:
    """Q20: older schedule extract — every roster row whose term code lies in
    [lo, hi] by absolute value (P15).  ``term_code`` is the SQL expression of the code over
    the section terms (``sta``)."""
    code = F.expr(term_code)
    sta = section_term.alias("sta").filter(F.abs(code).between(lo, hi))
    return (section_student.alias("ssa")
            .join(sta, F.col("sta.section_id") == F.col("ssa.section_id"))
            .select(F.col("ssa.ssa_id").alias("ps_id"), F.col("ssa.student_id").alias("studentid"),
                    F.col("ssa.section_id").alias("sectionid"), code.alias("termid"),
                    F.col("ssa.entry_date").alias("dateenrolled"), F.col("ssa.leave_date").alias("dateleft")))
