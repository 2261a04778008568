"""Domain micro-fixtures for the quirks the survey asks us to decide on."""

import datetime as dt
import re
from itertools import product

from pyspark.sql import functions as F

from conftest import rows
from rollcall.config import SyncConfig
from rollcall.plans import accounts as acc
from rollcall.plans import extract, groups as grp
from rollcall.plans.jobs import collapse_new_groups

CFG = SyncConfig(as_of=dt.date(2001, 3, 1), academic_year=2001, group_domain="g.org")
GRADES = [(i, {0: "PRE", 1: "TK", 2: "K", 15: "UG"}.get(i, str(i - 2))) for i in range(16)]
TB = {0: "Period 3 (A)", 1: "Period 1", 2: "6/7/8 Advisory", 3: "Period 2"}


def _section_fixture(spark):
    d = dict(
        sites=[(1, "North", 8, False), (2, "South", 2, False), (3, "West", 2, True), (4, "East", 8, False)],
        site_labels=[(1, "N"), (2, "S"), (3, "W"), (4, None)],
        grade_levels=GRADES,
        sessions=[(10, 1, 2001), (20, 2, 2001), (30, 3, 2001), (11, 1, 2000), (40, 4, 2001)],
        terms=[(100, 10, "S1 2001"), (101, 10, "S2 2001"), (200, 20, "S1 2001"), (300, 30, "S1 2001"),
               (110, 11, "S1 2000"), (400, 40, "S2 2001")],
        users=[(1, "Peña-López", "Ana"), (2, "Smith", "Ben"), (3, "Smith", "Bo"), (4, "Adams", "Cy")],
        section_teacher=[(1000, 2, True), (1000, 3, True), (1000, 4, False), (1001, 1, True), (1001, 4, False),
                         (1002, 4, True), (1003, 1, True), (1004, 2, True)],
        section_term=[(1000, 100), (1000, 101), (1000, 110), (1001, 100), (1002, 200), (1003, 300), (1004, 400)],
        section_course=[(1000, 1), (1001, 1), (1001, 2), (1002, 2), (1003, 1), (1004, 2)],
        courses=[(1, "M101", "Math"), (2, "A201", "Art")],
        section_timeblock=[(1000, 0), (1001, 1), (1002, 2), (1003, 3), (1004, 1)],
        timeblocks=list(TB.items()),
    )
    schemas = dict(
        sites="site_id int, site_name string, start_grade_level_id int, exclude_from_state_reporting boolean",
        site_labels="site_id int, short_name string", grade_levels="grade_level_id int, short_name string",
        sessions="session_id int, site_id int, academic_year int", terms="term_id int, session_id int, term_name string",
        users="user_id int, last_name string, first_name string",
        section_teacher="section_id int, user_id int, primary_teacher boolean",
        section_term="section_id int, term_id int", section_course="section_id int, course_id int",
        courses="course_id int, school_course_id string, short_name string",
        section_timeblock="section_id int, timeblock_id int", timeblocks="timeblock_id int, timeblock_name string")
    return d, {k: spark.createDataFrame(v, schemas[k]) for k, v in d.items()}


def _brute_q18(d, cfg):
    """The reference statement evaluated literally: fan-out join, COUNT(*)
    OVER section, dense_rank over (surname, course, block), rank 1, DISTINCT."""
    sites = {s[0]: s for s in d["sites"]}
    labels = dict(d["site_labels"])
    grades = dict(d["grade_levels"])
    sessions = {s[0]: s for s in d["sessions"]}
    terms = {t[0]: t for t in d["terms"]}
    users = {u[0]: u for u in d["users"]}
    courses = {c[0]: c for c in d["courses"]}
    tbs = dict(d["timeblocks"])
    joined = []
    for (sec, uid, prim), (sec2, term), (sec3, cid), (sec4, tbid) in product(
            d["section_teacher"], d["section_term"], d["section_course"], d["section_timeblock"]):
        if not (sec == sec2 == sec3 == sec4) or not prim:
            continue
        t = terms[term]
        ses = sessions[t[1]]
        site = sites[ses[1]]
        grade = grades.get(site[2])
        if ses[2] != cfg.academic_year or site[3] or grade not in {"TK", "K"} | {str(i) for i in range(1, 13)}:
            continue
        joined.append(dict(sec=sec, site=site, grade=grade, label=labels[site[0]], term=t[2], user=users[uid],
                           course=courses[cid], tb=tbs[tbid]))
    out = set()
    for sec in {j["sec"] for j in joined}:
        rs = [j for j in joined if j["sec"] == sec]
        first = min((j["user"][1], j["course"][2], j["tb"]) for j in rs)
        for j in rs:
            if (j["user"][1], j["course"][2], j["tb"]) != first:
                continue
            period = re.sub(r"\(.+?\)\s*|^period|6/7/8| ", "", j["tb"].lower())
            sur = re.sub(r"[^\w]+", "", j["user"][1])
            y = len(rs) > 1
            sec_grade = j["grade"] in {str(i) for i in range(6, 13)}
            elem = j["grade"] in {"TK", "K", "1", "2", "3", "4", "5"}
            term2 = j["term"][:2]
            if j["label"] is None:
                email = name = None
            else:
                email = ("z-" + sur + "-" + j["user"][2][0] + ("-p" + period if sec_grade else "") + "-"
                         + ("y-" if y else term2 + "-") + j["label"] + "-" + cfg.year_tag).lower() + "@g.org"
                name = ("Z-" + sur + " " + j["user"][2][0] + (" P" + period if sec_grade else "") + " "
                        + ("Y " if y else term2 + " ") + j["label"] + " " + cfg.year_label)
            desc = (j["site"][1] + " " + j["user"][1] + " " + j["user"][2][0] + " "
                    + (j["course"][2] if elem else ("Y" if y else term2) + " Period " + period))
            out.add((sec, j["site"][0], email, name, desc, j["user"][0], j["course"][1], j["course"][2], 1))
    return sorted(out, key=str)


def test_section_groups_match_literal_evaluation(spark):
    d, src = _section_fixture(spark)
    got = extract.section_groups(src, CFG)
    want = _brute_q18(d, CFG)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    # Two primary teachers with the same surname → two groups for one section.
    assert sum(1 for w in want if w[0] == 1000) == 2
    # Unlabelled site → no address (reject at emit time, R14 step).
    assert any(w[0] == 1004 and w[2] is None for w in want)


def test_section_group_plan_has_no_window_or_cartesian(spark, capsys):
    _, src = _section_fixture(spark)
    extract.section_groups(src, CFG).explain()
    plan = capsys.readouterr().out
    assert "Window" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_section_groups_are_dealt_by_the_section_alone(spark, capsys):
    """No shuffle by term, by first key or by the finished names (the last distinct lies where the joins left the rows)."""
    _, src = _section_fixture(spark)
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        extract.section_groups(src, CFG).explain()
        dealt = re.findall(r"hashpartitioning\((.*?), \d+\)", capsys.readouterr().out)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert any(d.startswith("section_id") for d in dealt)
    assert not [d for d in dealt if re.search("term_id|t_term|first|group_|struct", d)]


def test_section_groups_with_names_missing(spark):
    """A missing first name sorts last; alone it is the first, and its ties stay."""
    d, src = _section_fixture(spark)
    d["users"] = [(1, None, "Ana"), (2, "Smith", "Ben"), (3, None, "Bo"), (4, None, "Cy")]
    src["users"] = spark.createDataFrame(d["users"], src["users"].schema)
    src["section_teacher"] = spark.createDataFrame([(1000, 1, True), (1000, 2, True), (1001, 1, True), (1001, 3, True), (1001, 3, True)],
                                                   src["section_teacher"].schema)
    got = extract.section_groups(src, CFG).collect()
    assert sorted((r["section_id"], r["group_owner"]) for r in got) == [(1000, 2), (1001, 1), (1001, 3)]


def test_duplicate_addresses_collapse_and_unlabelled_rejected(spark):
    _, src = _section_fixture(spark)
    secs = extract.section_groups(src, CFG)
    empty = spark.createDataFrame([], "google_groupid string, group_email string, group_type string,"
                                      " unique_attribute string, department_id int")
    new = grp.section_groups_missing(secs, empty)
    dup = new.unionByName(new.withColumn("unique_attribute", F.lit("9999")))
    req, rej = collapse_new_groups(dup)
    assert req.count() == new.filter("group_email IS NOT NULL").select("group_email").distinct().count()
    per_email = {r.group_email: r["count"] for r in dup.filter("group_email IS NOT NULL")
                 .groupBy("group_email").count().collect()}
    assert {r.group_email: r.n_sections for r in req.collect()} == per_email
    assert rej.count() == dup.filter("group_email IS NULL").count() > 0


def test_latest_enrolment_keeps_ties_and_ignores_zero_length(spark):
    e = spark.createDataFrame([
        (1, 1, True, dt.date(2001, 1, 1), dt.date(2001, 6, 1)),
        (2, 1, True, dt.date(2001, 1, 1), dt.date(2001, 5, 1)),      # tie on latest entry
        (3, 1, True, dt.date(2001, 2, 1), dt.date(2001, 2, 1)),      # entry = leave: never counts
        (4, 2, False, dt.date(2001, 3, 1), dt.date(2001, 4, 1)),     # latest is not primary → dropped
        (5, 2, True, dt.date(2001, 1, 1), dt.date(2001, 4, 1))],
        "enrol_id int, student_id int, is_primary boolean, entry_date date, leave_date date")
    assert rows(extract.latest_enrolments(e), "enrol_id") == [(1,), (2,)]


def test_missing_account_counts_null_email_as_missing(spark):
    # R2: an account row without an address still needs an account.
    staff = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 0, 0)],
                                  "external_uid bigint, external_userstatus int, suspend_account int")
    accounts = spark.createDataFrame([(1, "staff", "a@x"), (2, "staff", None)],
                                     "external_uid bigint, user_type string, primary_email string")
    assert rows(acc.new_staff(staff, accounts), "external_uid") == [(2,)]
    assert rows(acc.new_staff(staff, accounts, legacy=True), "external_uid") == [(3,)]


def test_cohort_type_filter(spark):
    dpt = spark.createDataFrame([(6, 6, 1, 1)], "unit int, unique_identifier int, sitecode bigint, siteid int")
    sites = spark.createDataFrame([(1, "AB", "Alpha", 0, 8)],
                                  "siteid int, abbreviation string, description string, auto_exclude int,"
                                  " upper_unit int")
    other = spark.createDataFrame([("x", "x@g", "SchoolConference", "2024", 1)],
                                  "google_groupid string, group_email string, group_type string,"
                                  " unique_attribute string, department_id int")
    cfg = SyncConfig(as_of=dt.date(2001, 1, 1), academic_year=2001, group_domain="g.org")
    assert grp.cohort_groups_missing(dpt, sites, other, cfg).count() == 1           # R6 fixed
    assert grp.cohort_groups_missing(dpt, sites, other, cfg, type_filter=False).count() == 0
    assert grp.cohort_groups_missing(dpt, sites, other, cfg).first().group_email == "yab-classof-2024-students@g.org"


def test_members_need_directory_ids_and_stale_rule(spark):
    cfg = SyncConfig(as_of=dt.date(2001, 3, 1), academic_year=2001)
    sched = spark.createDataFrame([
        (1, 7, 50, dt.date(2001, 1, 1), dt.date(2001, 6, 1)),
        (2, 8, 50, dt.date(2001, 1, 1), dt.date(2001, 6, 1)),
        (3, 9, 50, dt.date(2000, 1, 1), dt.date(2000, 6, 1))],
        "ps_id int, studentid bigint, sectionid bigint, dateenrolled date, dateleft date")
    groups = spark.createDataFrame([("g50", "s50@g", "StudentSection", "50", 1)],
                                   "google_groupid string, group_email string, group_type string,"
                                   " unique_attribute string, department_id int")
    accounts = spark.createDataFrame([(7, "student", "u7", "a7@x", "A"), (8, "student", None, "a8@x", "B"),
                                      (9, "student", "u9", "a9@x", "C")],
                                     "external_uid bigint, user_type string, google_id string,"
                                     " primary_email string, given_name string")
    members = spark.createDataFrame([("g50", "u9", "MEMBER"), ("g50", "u7", "MEMBER")],
                                    "google_groupid string, google_userid string, role string")
    # Student 8 has no directory id → reject, not a member row with NULL.
    assert grp.section_members_missing(sched, groups, accounts, members.limit(0), cfg).select("google_id") \
        .collect() == [("u7",)]
    assert rows(grp.member_rejects(sched, groups, accounts, cfg), "external_uid") == [(8,)]
    # Stale only when no active schedule row maps the student to the group.
    assert rows(grp.stale_members(sched, groups, accounts, members, cfg), "google_userid") == [("u9",)]
