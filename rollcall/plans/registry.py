"""Named queries over the driver tables: name → (spark, sf_dir) → DataFrame.

Each entry builds the testbed views for ``sf_dir`` and runs one library plan
on them.  ``rollcall.oracle_sql`` holds the matching DuckDB statements.
"""

from __future__ import annotations

from dataclasses import replace
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.config import COHORT_GROUP, SCHOOL_GROUP
from rollcall.functions import dates
from rollcall.operators import apply as ap
from rollcall.operators import documents, ledger, nested, paging, responses
from rollcall.operators.batches import batch_summary
from rollcall.operators.ranking import last_wins
from rollcall.operators.usernames import allocate_usernames
from rollcall.plans import accounts as acc
from rollcall.plans import extract, extras, jobs
from rollcall.plans import groups as grp
from rollcall.schemas import GROUP_RECORD, MEMBER_RECORD, USER_FIELD_TO_COLUMN, USER_PAGE, USER_RESOURCE
from rollcall.sinks.export import device_table
from rollcall.sources import readers
from rollcall.testbed import Testbed

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: Callable[[Testbed], DataFrame]) -> Callable[[Testbed], DataFrame]:
        REGISTRY[name] = lambda spark, sf_dir: fn(Testbed(spark, sf_dir))
        return fn
    return deco


# ----------------------------------------------------------------- extract
@query("staff_extract")
def _staff_extract(tb: Testbed) -> DataFrame:
    return extract.staff_extract(tb.sis_users)


@query("student_latest_enrolment")
def _student_extract(tb: Testbed) -> DataFrame:
    return extract.student_extract(tb.student_sources(), tb.cfg)


@query("section_groups")
def _section_groups(tb: Testbed) -> DataFrame:
    return extract.section_groups(tb.section_sources(), tb.cfg)


@query("student_schedule")
def _student_schedule(tb: Testbed) -> DataFrame:
    return extract.student_schedule(dict(terms=tb.terms, sessions=tb.sessions, section_term=tb.section_term,
                                         section_student=tb.section_student), tb.cfg)


# ------------------------------------------------------------------ groups


@query("section_groups_missing")
def _q21(tb: Testbed) -> DataFrame:
    return grp.section_groups_missing(tb.sections, tb.groups)


@query("section_owners_missing")
def _q22(tb: Testbed) -> DataFrame:
    return grp.section_owners_missing(tb.sections, tb.groups, tb.accounts, tb.group_member)


@query("section_members_missing")
def _q23(tb: Testbed) -> DataFrame:
    return grp.section_members_missing(tb.schedule, tb.groups, tb.accounts, tb.group_member, tb.cfg)


@query("section_groups_renamed")
def _q24(tb: Testbed) -> DataFrame:
    return grp.section_groups_renamed(tb.sections, tb.groups)


@query("stale_owners")
def _q25(tb: Testbed) -> DataFrame:
    return grp.stale_owners(tb.sections, tb.groups, tb.accounts, tb.group_member)


@query("stale_members")
def _q26(tb: Testbed) -> DataFrame:
    return grp.stale_members(tb.schedule, tb.groups, tb.accounts, tb.group_member, tb.cfg)


@query("school_members_missing")
def _q27(tb: Testbed) -> DataFrame:
    return grp.school_members_missing(tb.staff_stage, tb.groups, tb.accounts, tb.group_member)


@query("cohort_groups_missing")
def _q28(tb: Testbed) -> DataFrame:
    return grp.cohort_groups_missing(tb.departments, tb.store_sites, tb.groups, tb.cfg)


@query("stale_cohort_members")
def _q29(tb: Testbed) -> DataFrame:
    return grp.stale_cohort_members(tb.students_stage, tb.groups, tb.accounts, tb.group_member, tb.cfg)


@query("cohort_members_missing")
def _q30(tb: Testbed) -> DataFrame:
    return grp.cohort_members_missing(tb.students_stage, tb.groups, tb.accounts, tb.group_member, tb.cfg)


@query("course_groups_missing")
def _q31(tb: Testbed) -> DataFrame:
    return grp.course_groups_missing(tb.sections, tb.groups, tb.cfg)


@query("course_members_missing")
def _q32(tb: Testbed) -> DataFrame:
    return grp.course_members_missing(tb.schedule, tb.groups, tb.accounts, tb.group_member, tb.cfg)


@query("group_members_of")
def _q36(tb: Testbed) -> DataFrame:
    view = grp.member_view(tb.group_member, tb.groups, tb.accounts)
    wanted = tb.groups.filter(F.col("group_type") == SCHOOL_GROUP)
    return grp.group_members_of(view, wanted)


@query("groups_by_type")
def _q38(tb: Testbed) -> DataFrame:
    return grp.groups_by_type(tb.groups, COHORT_GROUP)


@query("all_groups")
def _q39(tb: Testbed) -> DataFrame:
    return grp.all_groups(tb.groups)


# ---------------------------------------------------------------- accounts
@query("new_accounts")
def _q03(tb: Testbed) -> DataFrame:
    return acc.new_accounts(tb.students_stage, tb.staff_stage, tb.accounts, tb.cfg)


@query("new_staff_only")
def _q04(tb: Testbed) -> DataFrame:
    return acc.new_staff(tb.staff_stage, tb.accounts)


@query("new_accounts_legacy")
def _q13(tb: Testbed) -> DataFrame:
    return acc.new_accounts(tb.students_stage, tb.staff_stage, tb.accounts, tb.cfg, legacy=True)


@query("desired_staff")
def _q08(tb: Testbed) -> DataFrame:
    return acc.desired_staff(tb.staff_stage, tb.accounts, tb.cfg)


@query("desired_students")
def _q09(tb: Testbed) -> DataFrame:
    return acc.desired_students(tb.students_stage, tb.accounts, tb.orgunit, tb.cfg)


@query("account_state")
def _q17(tb: Testbed) -> DataFrame:
    return acc.account_state(tb.accounts, tb.orgunit)


@query("account_lookup")
def _q15(tb: Testbed) -> DataFrame:
    return acc.account_lookup(tb.students_stage, tb.staff_stage, tb.accounts)


@query("account_patch")
def _c3(tb: Testbed) -> DataFrame:
    desired = (acc.desired_staff(tb.staff_stage, tb.accounts, tb.cfg)
               .unionByName(acc.desired_students(tb.students_stage, tb.accounts, tb.orgunit, tb.cfg)))
    return acc.account_patch(desired, tb.accounts)


# -------------------------------------------------------------------- jobs


@query("section_groups_outbox")
def _c6(tb: Testbed) -> DataFrame:
    return jobs.section_group_sync(tb.sections, tb.schedule, tb.groups, tb.accounts, tb.group_member, tb.cfg)


@query("outbox_batches")
def _k12(tb: Testbed) -> DataFrame:
    return batch_summary(_c6(tb))


# ------------------------------------------------------ nested and sources


def _resources(tb: Testbed) -> DataFrame:
    users = readers.flatten_pages(tb.user_pages, "users", USER_PAGE)
    return nested.flatten_user_resources(users.select(F.struct("*").alias("u")), USER_FIELD_TO_COLUMN)


@query("resource_flatten")
def _c4(tb: Testbed) -> DataFrame:
    return _resources(tb)


@query("apply_upsert")
def _k3(tb: Testbed) -> DataFrame:
    r = _resources(tb).filter(F.col("google_id").isNotNull()).select(
        "google_id", "primary_email", "given_name", "family_name", "suspended", "ou_path", "change_password",
        "global_addressbook", "user_type", "external_uid")
    return ap.upsert(tb.accounts, r, ["google_id"])


@query("apply_update")
def _k4(tb: Testbed) -> DataFrame:
    desired = acc.desired_accounts(tb.staff_stage, tb.students_stage, tb.accounts, tb.orgunit, tb.cfg)
    diff = acc.account_patch(desired, tb.accounts)
    per_id = diff.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("field", "new_value"))).alias("m"))
    types = dict(tb.accounts.dtypes)
    changes = per_id.select("id", *[F.col("m")[f].cast(types[f]).alias(f) for f in acc.ACCOUNT_FIELDS],
                            F.map_keys("m").alias("supplied"))
    return ap.update(tb.accounts, changes, ["id"], supplied_col="supplied")


@query("apply_delete")
def _k7(tb: Testbed) -> DataFrame:
    doomed = grp.stale_members(tb.schedule, tb.groups, tb.accounts, tb.group_member, tb.cfg)
    return ap.delete(tb.group_member, doomed, ["google_groupid", "google_userid"])


@query("partition_replace")
def _k8(tb: Testbed) -> DataFrame:
    fresh = (grp.section_members_desired(tb.schedule, tb.groups, tb.accounts, tb.cfg)
             .select("google_groupid", F.col("google_id").alias("google_userid"), "role",
                     F.lit("USER").alias("type")))
    return ap.replace_partitions(tb.group_member, fresh, ["google_groupid"])


@query("load_by_position")
def _k1(tb: Testbed) -> DataFrame:
    return acc.staff_stage(extract.staff_extract(tb.sis_users))


@query("load_by_name")
def _k2(tb: Testbed) -> DataFrame:
    return ap.load_by_name(tb.schedule, ["studentid", "sectionid", "termid", "schoolid", "dateenrolled",
                                         "dateleft", "ps_id"])


@query("uid_linking")
def _c5(tb: Testbed) -> DataFrame:
    lookup = readers.read_uid_lookup(tb.spark, tb.uid_lookup_path())
    res = _resources(tb).select("google_id", "primary_email")
    linked = res.join(lookup, F.col("primary_email") == F.col("email"))
    fresh = linked.join(tb.accounts.select(F.col("primary_email").alias("a_email")),
                        F.col("primary_email") == F.col("a_email"), "left_anti")
    return fresh.select("google_id", "primary_email", F.col("uid").alias("new_external_uid"), "user_type",
                        nested.external_ids_payload(F.lit("custom"), F.col("uid"),
                                                    F.col("user_type")).alias("payload"))


@query("external_id_patch")
def _c11(tb: Testbed) -> DataFrame:
    rows = readers.read_external_ids(tb.spark, tb.external_ids_path())
    return rows.select("user_key", nested.external_ids_payload(F.lit("custom"), "id_value", "id_type").alias("payload"))


def _devices(tb: Testbed) -> DataFrame:
    return readers.device_listing(tb.device_pages)


@query("device_export")
def _k11(tb: Testbed) -> DataFrame:
    return device_table(_devices(tb))


@query("device_patch")
def _c9(tb: Testbed) -> DataFrame:
    ids = readers.device_listing(tb.device_pages, ["serialNumber", "deviceId"])
    return jobs.device_patches(tb.device_updates(), ids).drop("sink", "reasons")


@query("response_apply")
def _j15(tb: Testbed) -> DataFrame:
    return responses.route_group_responses(tb.group_requests, tb.group_responses, tb.groups)


@query("record_validation")
def _n10(tb: Testbed) -> DataFrame:
    _, bad = nested.split_valid(tb.groups, GROUP_RECORD)
    return bad.select("google_groupid", F.array_join("violations", ", ").alias("violations"))


@query("schema_projection")
def _n5(tb: Testbed) -> DataFrame:
    props = tb.groups.select(F.col("group_name").alias("name"), F.col("group_email").alias("email"),
                             F.col("google_groupid").alias("id"), "description", "etag")
    return nested.schema_projection(props.withColumn("google_groupid", F.col("id")), GROUP_RECORD, "api",
                                    keep=["google_groupid"])


@query("map_invert")
def _n9(tb: Testbed) -> DataFrame:
    c = tb.raw("customer").select("c_custkey", F.create_map(
        F.lit("segment"), F.col("c_mktsegment"), F.lit("name"), F.col("c_name"),
        F.lit("nation"), F.col("c_nationkey").cast("string")).alias("m"))
    inv = c.select("c_custkey", nested.invert_map("m").alias("inv"))
    return inv.select("c_custkey", F.explode("inv").alias("value", "key"))


@query("last_wins_lookup")
def _a4(tb: Testbed) -> DataFrame:
    ev = tb.raw("events").select("user_id", "event_id", "event_type", "value")
    last = last_wins(ev, ["user_id"], "event_id")
    acct = tb.accounts.filter(F.col("user_type") == "student").select("external_uid", "primary_email")
    return last.join(acct, F.col("user_id") == F.col("external_uid")).select(
        "user_id", "event_id", "event_type", "value", "primary_email")


@query("domain_user_type")
def _j12(tb: Testbed) -> DataFrame:
    from rollcall.functions import codes, text
    p = tb.raw("pages").select("page_id", F.regexp_extract("url", r"^[a-z]+://([^/?#]+)", 1).alias("host"))
    addr = F.when(F.col("page_id") % 4 == 0, F.concat(F.lit("user"), F.col("page_id").cast("string"))) \
        .otherwise(F.concat(F.lit("user"), F.col("page_id").cast("string"), F.lit("@"), F.col("host")))
    p = p.withColumn("address", text.with_default_domain(addr, tb.cfg.staff_domain))
    dom = text.domain_part("address")
    suffix = F.regexp_extract(dom, r"([^.]+\.[^.]+)$", 1)
    return p.select("page_id", "address", dom.alias("domain"),
                    codes.map_lookup({"example.com": "staff", "example.org": "student"}, suffix).alias("user_type"))


@query("custom_field_pivot")
def _x1(tb: Testbed) -> DataFrame:
    cf = extract.custom_field_pivot(tb.custom_field_values, "staff", ["click", "error", "purchase", "signup", "view"])
    high = lambda c: F.coalesce((F.col(c).try_cast("double") >= 50).cast("int"), F.lit(0))
    has = F.col("signup").isNotNull()
    return tb.sis_users.join(cf, F.col("user_id") == F.col("row_id"), "left").select(
        F.col("user_id").alias("external_uid"), F.col("local_user_id").alias("staffid"), has.cast("int").alias("certificated"),
        F.col("first_name").alias("given_name"), F.col("last_name").alias("family_name"), F.col("view").alias("gender_field"),
        high("error").alias("suspend_account"), high("purchase").alias("has_email"), F.col("click").alias("email_address"),
        F.when(has, 1).otherwise(2).alias("staff_conference"))


@query("schedule_term_range")
def _q20(tb: Testbed) -> DataFrame:
    return extract.schedule_by_term_range(tb.section_student, tb.section_term, 20011, 20012, "sta.term_id % 100000")


@query("email_writeback")
def _q33(tb: Testbed) -> DataFrame:
    return extras.email_writeback(tb.students_stage, tb.accounts)


@query("portal_missing")
def _q34(tb: Testbed) -> DataFrame:
    return extras.portal_missing(dict(enrol=tb.enrol, grade_levels=tb.grade_levels, sites=tb.sis_sites,
                                      students=tb.sis_students, sessions=tb.sessions, portal=tb.portal_students),
                                 tb.cfg)


@query("portal_export")
def _q35(tb: Testbed) -> DataFrame:
    return extras.portal_export(tb.accounts, tb.students_stage)


@query("account_listing")
def _q37(tb: Testbed) -> DataFrame:
    return extras.account_listing(tb.accounts, "student")


@query("account_sample")
def _o3(tb: Testbed) -> DataFrame:
    return extras.account_sample(tb.accounts, 50, seed=7, user_type="student")


@query("ou_path")
def _q40(tb: Testbed) -> DataFrame:
    people = tb.students_stage.select("external_uid", "schoolid", "grade_level")
    return extras.ou_paths(people, tb.orgunit, "schoolid", "grade_level", "student")


@query("numbered_units")
def _s7(tb: Testbed) -> DataFrame:
    schools = tb.staff_stage.select(F.col("schoolid")).distinct()
    return readers.numbered_names(schools, F.concat(F.lit("cart-s"), F.col("schoolid")), 2, 27).select(
        "schoolid", "n", "name")


# ------------------------------------------------------------- usernames
def _part_existing(tb: Testbed) -> DataFrame:
    from rollcall.functions.text import sanitize_username
    return tb.raw("part").where("p_partkey % 7 = 0").select(
        F.expr("CASE WHEN p_size % 2 = 0 THEN 'example.org' ELSE 'students.example.org' END").alias("domain"),
        F.concat(sanitize_username("p_name"),
                 F.expr("CASE WHEN p_partkey % 21 = 0 THEN '' ELSE CAST(p_partkey % 50 AS STRING) END")).alias("name"))


def _part_candidates(tb: Testbed) -> DataFrame:
    return tb.raw("part").where("p_partkey % 7 <> 0").selectExpr(
        "p_partkey",
        "CASE WHEN p_size % 2 = 0 THEN 'example.org' ELSE 'students.example.org' END AS domain",
        "split_part(p_name, ' ', 1) AS given_name",
        "split_part(p_name, ' ', 2) AS family_name",
        "CASE WHEN p_partkey % 3 = 0 THEN p_type END AS middle_name",
        "CASE WHEN p_partkey % 41 = 0 THEN concat('Over.', split_part(p_name, ' ', 2), '@old.example.org') END"
        " AS override")


@query("username_allocate")
def _c2(tb: Testbed) -> DataFrame:
    out = allocate_usernames(_part_candidates(tb), _part_existing(tb), ["p_partkey"])
    return out.select("p_partkey", "domain", "username", "reject_reason")


@query("provision_outbox")
def _c1(tb: Testbed) -> DataFrame:
    from rollcall.plans import provisioning
    return provisioning.provision(tb.students_stage, tb.staff_stage, tb.accounts, tb.orgunit, tb.cfg)


@query("school_cohort_outbox")
def _c7(tb: Testbed) -> DataFrame:
    return jobs.school_and_cohort_sync(tb.departments, tb.store_sites, tb.students_stage, tb.staff_stage,
                                       tb.groups, tb.accounts, tb.group_member, tb.cfg)


@query("orgunit_as_text")
def _n11(tb: Testbed) -> DataFrame:
    return nested.as_text(tb.orgunit)


@query("pending_section_members")
def _e2_pending(tb: Testbed) -> DataFrame:
    return grp.pending_section_members(tb.schedule, tb.sections, tb.groups, tb.accounts, tb.cfg)


@query("groups_after_responses")
def _e2_apply(tb: Testbed) -> DataFrame:
    routed = responses.route_group_responses(tb.group_requests, tb.group_responses, tb.groups)
    store = tb.groups.select("google_groupid", "group_email", "group_name", "description", "etag",
                             "department_id", "group_type", "unique_attribute")
    return ap.upsert(store, responses.applied_groups(routed), ["google_groupid"])


# ------------------------------------------------------ requests and answers
def _member_states(tb: Testbed) -> DataFrame:
    return ledger.states(tb.member_requests, tb.member_ledger, max_attempts=3)


@query("member_request_states")
def _x2(tb: Testbed) -> DataFrame:
    return _member_states(tb).drop("body", "seq")


@query("members_after_responses")
def _x2_apply(tb: Testbed) -> DataFrame:
    return ledger.members_after(tb.group_member, _member_states(tb))


@query("members_refused")
def _x2_refused(tb: Testbed) -> DataFrame:
    return ledger.refused(_member_states(tb))


@query("retry_queue")
def _x2_retry(tb: Testbed) -> DataFrame:
    return ledger.retry_queue(_member_states(tb), tb.cfg.batch_size)


@query("delete_outbox")
def _k12_deletes(tb: Testbed) -> DataFrame:
    return jobs.group_deletes(tb.sections, tb.schedule, tb.students_stage, tb.groups, tb.accounts, tb.group_member, tb.cfg)


@query("ordered_outbox")
def _k12_ordered(tb: Testbed) -> DataFrame:
    return jobs.full_group_sync(tb.sections, tb.schedule, tb.students_stage, tb.groups, tb.accounts, tb.group_member, tb.cfg)


# ------------------------------------------------------ documents and pages
_PERSON_KEYS = {"id": "directory_id", "family": "family_name", "given": "given_name", "city": "home_city", "zip": "home_zip",
                "suspended": "suspended"}


@query("nested_patch")
def _n8_patch(tb: Testbed) -> DataFrame:
    keys = ["c_custkey"]
    desired = documents.first_of(tb.desired_documents, keys, ["place"])
    return documents.patches(documents.walk(desired, keys, "doc"), documents.walk(tb.stored_documents, keys, "doc"), keys)


@query("flatten_by_key")
def _n1_keys(tb: Testbed) -> DataFrame:
    return documents.by_key(documents.walk(tb.stored_documents, ["c_custkey"], "doc"), ["c_custkey"], _PERSON_KEYS)


@query("unknown_keys")
def _n1_unknown(tb: Testbed) -> DataFrame:
    return documents.unknown_keys(documents.walk(tb.stored_documents, ["c_custkey"], "doc"), _PERSON_KEYS)


@query("page_chain")
def _s2_chain(tb: Testbed) -> DataFrame:
    return paging.page_chain(tb.listing_pages)


@query("complete_listings")
def _s2_complete(tb: Testbed) -> DataFrame:
    return paging.complete_listings(paging.page_chain(tb.listing_pages))


@query("json_array_source")
def _s3(tb: Testbed) -> DataFrame:
    users = readers.read_json_array(tb.spark, tb.user_array_path(), USER_RESOURCE)
    return users.select(F.col("id").alias("google_id"), F.col("primaryEmail").alias("primary_email"), F.col("name.familyName").alias("family_name"),
                        F.size("externalIds").alias("n_ids"))


# ------------------------------------------------------ rules and rejects
@query("record_violations")
def _n10_rows(tb: Testbed) -> DataFrame:
    _, groups = nested.split_valid(tb.landed_groups, GROUP_RECORD)
    _, members = nested.split_valid(tb.landed_members, MEMBER_RECORD)
    member_id = F.concat_ws("|", "google_groupid", F.coalesce("google_userid", F.lit("")))
    row = lambda df, kind, key: df.select(F.lit(kind).alias("kind"), key.alias("record_id"), F.array_join("violations", ", ").alias("violations"))
    return row(groups, "group", F.col("google_groupid")).unionByName(row(members, "member", member_id))


@query("violation_counts")
def _n10_counts(tb: Testbed) -> DataFrame:
    groups = nested.violation_counts(tb.landed_groups, GROUP_RECORD).withColumn("kind", F.lit("group"))
    return groups.unionByName(nested.violation_counts(tb.landed_members, MEMBER_RECORD).withColumn("kind", F.lit("member")))


def _reasons(df: DataFrame) -> DataFrame:
    return df.withColumn("reasons", F.array_join("reasons", ", "))


@query("routed_placements")
def _p4(tb: Testbed) -> DataFrame:
    return _reasons(extract.route_placements(tb.student_sources()))


@query("routed_new_groups")
def _c6_groups(tb: Testbed) -> DataFrame:
    return _reasons(jobs.route_new_groups(grp.section_groups_missing(tb.sections, tb.groups)))


@query("routed_members")
def _r7(tb: Testbed) -> DataFrame:
    return _reasons(jobs.route_members(tb.schedule, tb.groups, tb.accounts, tb.cfg))


@query("routed_devices")
def _c9_routed(tb: Testbed) -> DataFrame:
    ids = readers.device_listing(tb.device_pages, ["serialNumber", "deviceId"])
    return _reasons(jobs.device_patches(tb.device_updates(), ids))


# ------------------------------------------------------ write-back and older extracts
def _writeback(tb: Testbed) -> DataFrame:
    return jobs.writeback(tb.students_stage, tb.accounts, tb.sis_students, tb.sis_students_now)


@query("sis_students_after_writeback")
def _c8_after(tb: Testbed) -> DataFrame:
    return ap.snapshot_of(_writeback(tb), tb.sis_students.columns)


@query("writeback_conflicts")
def _c8_conflicts(tb: Testbed) -> DataFrame:
    return ap.conflicts_of(_writeback(tb), ["student_id"])


def _staff_attributes(tb: Testbed) -> DataFrame:
    A = extract.Attribute
    return extract.typed_attributes(tb.older_field_values, "teachers", [
        A("signup", "state_id"), A("view", "gender"), A("error", "no_email", "int"), A("purchase", "email", "int"), A("click", "email_address")])


def _student_attributes(tb: Testbed) -> DataFrame:
    A = extract.Attribute
    return extract.typed_attributes(tb.older_field_values, "students", [A("view", "area"), A("error", "suspended", "int"), A("click", "email_override")])


@query("older_staff_extract")
def _q05(tb: Testbed) -> DataFrame:
    return extract.older_staff_extract(tb.older_teachers, _staff_attributes(tb))


@query("older_student_extract")
def _q06(tb: Testbed) -> DataFrame:
    return extract.older_student_extract(tb.older_students, _student_attributes(tb))


@query("unparsed_attributes")
def _x1_unparsed(tb: Testbed) -> DataFrame:
    row = lambda df, name: extract.unparsed_attributes(df).withColumn("table_name", F.lit(name))
    return row(_staff_attributes(tb), "teachers").unionByName(row(_student_attributes(tb), "students"))


# ------------------------------------------------------ lookups and small operators
@query("uid_by_email")
def _q16(tb: Testbed) -> DataFrame:
    lookup = readers.read_uid_lookup(tb.spark, tb.uid_lookup_path()).select(F.col("email").alias("primary_email"), F.col("uid").alias("new_external_uid"))
    return acc.uid_by_email(_resources(tb).select("google_id", "primary_email"), lookup)


@query("account_by_email")
def _q07(tb: Testbed) -> DataFrame:
    return acc.account_by_email(tb.accounts, _resources(tb).select("primary_email"))


@query("account_query")
def _p16(tb: Testbed) -> DataFrame:
    return extras.account_query(tb.accounts, "google_id", _resources(tb).filter("suspended").select("google_id"), user_type="student")


@query("desired_staff_legacy")
def _p14_legacy(tb: Testbed) -> DataFrame:
    return acc.desired_staff(tb.staff_stage, tb.accounts, replace(tb.cfg, legacy_suspend_rule=True))


@query("date_texts")
def _f10_f16(tb: Testbed) -> DataFrame:
    return tb.raw("orders").select("o_orderkey", dates.mmddyy("o_orderdate").alias("mmddyy"), dates.iso_render("o_orderdate").alias("iso"))


@query("update_or_insert")
def _k5(tb: Testbed) -> DataFrame:
    changes = tb.group_requests.select(F.col("email").alias("group_email"), "name", "request_id")
    return ap.update_or_insert(tb.groups, changes, ["group_email"])


@query("insert_rows")
def _k6(tb: Testbed) -> DataFrame:
    new = grp.school_members_missing(tb.staff_stage, tb.groups, tb.accounts, tb.group_member)
    return ap.insert(tb.group_member, new.select("google_groupid", "google_userid", "role"))


@query("partition_upsert")
def _k8_upsert(tb: Testbed) -> DataFrame:
    fresh = (grp.section_members_desired(tb.schedule, tb.groups, tb.accounts, tb.cfg)
             .select("google_groupid", F.col("google_id").alias("google_userid"), "role", F.lit("USER").alias("type")))
    return ap.replace_partitions(tb.group_member, fresh, ["google_groupid"], ["google_groupid", "google_userid"], overwrite=False)


@query("store_projection")
def _n5_store(tb: Testbed) -> DataFrame:
    props = tb.group_requests.select("name", "email", F.col("request_id").alias("id"), "description", "department_id", "group_type", "unique_attribute")
    return nested.schema_projection(props, GROUP_RECORD, "store")
