"""Composite jobs (C6–C8, C10, C13): staged DataFrame plans that end in an
outbox of requests plus reject rows.  Nothing here loops over rows; each
stage is one plan, and a stage barrier (group creation before membership)
is a write of the outbox plus a later response-apply run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.config import SyncConfig
from rollcall.operators import apply as ap
from rollcall.operators.batches import ChangeSet, ordered_outbox, outbox
from rollcall.operators.documents import first_of
from rollcall.operators.nested import sparse_patch
from rollcall.operators.routing import ACCEPTED, REJECTED, SINK, accepted, rejected, routed
from rollcall.operators.runs import Run
from rollcall.plans import accounts as acc
from rollcall.plans import extract, extras, provisioning
from rollcall.plans import groups as grp
from rollcall.sinks.export import write_delimited


def route_new_groups(new_groups: DataFrame) -> DataFrame:
    """New groups routed: an unlabelled site has no address and no name to create a group under."""
    return routed(new_groups, {"group without address": F.col("group_email").isNull(), "group without name": F.col("group_name").isNull()})


def collapse_new_groups(new_groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One create request per address (the reference relied on a 409
    conflict for the second section with the same address).  The request
    carries the smallest section id with its name and description and the
    number of sections sharing the address.  Rows without an address or a
    name go to rejects.

    Returns (requests, rejects).
    """
    rows = route_new_groups(new_groups)
    rejects = rejected(rows).select("unique_attribute", F.array_join("reasons", ", ").alias("reason"))
    return requests_of(accepted(rows)), rejects


def requests_of(new_groups: DataFrame) -> DataFrame:
    """One create request per address of accepted new groups."""
    rep = F.min(F.struct("unique_attribute", "group_name", "group_description", "department_id"))
    return (new_groups.groupBy("group_email")
            .agg(rep.alias("r"), F.count(F.lit(1)).alias("n_sections"))
            .select("group_email", F.col("r.unique_attribute").alias("unique_attribute"),
                    F.col("r.group_name").alias("group_name"),
                    F.col("r.group_description").alias("group_description"),
                    F.col("r.department_id").alias("department_id"), "n_sections"))


def route_members(schedule: DataFrame, groups: DataFrame, accounts: DataFrame, cfg: SyncConfig) -> DataFrame:
    """Every (section group, student) that the schedule asks for, routed: without an account, or with one that has no directory
    id, a student cannot be a member."""
    rows = grp.scheduled_in_groups(schedule, groups, accounts, cfg)
    return routed(rows, {"no account": F.col("account_uid").isNull(),
                         "account without directory id": F.col("account_uid").isNotNull() & F.col("google_id").isNull()}).drop("account_uid")


def device_patches(updates: DataFrame, ids: DataFrame) -> DataFrame:
    """The patch of each row of a bulk update (blank fields are not supplied), routed: a serial number without a device
    cannot be patched, a row without a field need not be.  ``ids`` has serialNumber and deviceId."""
    known = ids.select(F.col("serialNumber").alias("d_serial"), "deviceId")
    j = updates.join(known, F.col("serialNumber") == F.col("d_serial"), "left").drop("d_serial")
    patch = sparse_patch({c: F.col(c) for c in ("annotatedUser", "annotatedAssetId", "annotatedLocation", "orgUnitPath", "notes")})
    return routed(j.select("serialNumber", "deviceId", patch.alias("patch")),
                  {"unknown serial number": F.col("deviceId").isNull(), "nothing to change": F.col("patch").isNull()})


def section_group_requests(sections: DataFrame, groups: DataFrame) -> DataFrame:
    """The insert-group requests of the section outbox by request id, with the fields that only the store keeps;
    ``responses.route_group_responses`` takes them with the landed responses."""
    new_groups, _ = collapse_new_groups(grp.section_groups_missing(sections, groups))
    return new_groups.select(F.concat(F.lit("insert_group:"), F.col("group_email")).alias("request_id"),
                             F.col("group_email").alias("email"), F.col("group_name").alias("name"),
                             F.col("group_description").alias("description"), "unique_attribute", "department_id",
                             F.lit(grp.SECTION_GROUP).alias("group_type"))


def member_payload() -> F.Column:
    return F.struct(F.col("google_groupid").alias("groupKey"), F.col("google_id").alias("memberKey"),
                    F.col("role").alias("role"))


def section_group_sync(sections: DataFrame, schedule: DataFrame, groups: DataFrame, accounts: DataFrame,
                       members: DataFrame, cfg: SyncConfig) -> DataFrame:
    """New section groups, missing owners and missing members as one
    batched outbox (the member stages act on groups that already exist)."""
    new_groups, _ = collapse_new_groups(grp.section_groups_missing(sections, groups))
    owners = grp.section_owners_missing(sections, groups, accounts, members)
    pupils = grp.section_members_missing(schedule, groups, accounts, members, cfg)
    group_payload = F.struct(F.col("group_email").alias("email"), F.col("group_name").alias("name"),
                             F.col("group_description").alias("description"))
    return outbox([
        ChangeSet("insert_group", new_groups, ["group_email"], group_payload),
        ChangeSet("insert_member", owners.select("google_groupid", "google_id", "role"),
                  ["google_groupid", "google_id"], member_payload()),
        ChangeSet("insert_member", pupils.select("google_groupid", "google_id", "role"),
                  ["google_groupid", "google_id"], member_payload()),
    ], cfg.batch_size)


def school_and_cohort_sync(departments: DataFrame, sites: DataFrame, students: DataFrame, staff: DataFrame,
                           groups: DataFrame, accounts: DataFrame, members: DataFrame,
                           cfg: SyncConfig) -> DataFrame:
    """Staff-group members (Q27), new graduation-year groups (Q28) and
    their missing members (Q30) as one outbox."""
    new_groups = grp.cohort_groups_missing(departments, sites, groups, cfg)
    school = grp.school_members_missing(staff, groups, accounts, members).withColumnRenamed(
        "google_userid", "google_id")
    cohort = grp.cohort_members_missing(students, groups, accounts, members, cfg)
    group_payload = F.struct(F.col("group_email").alias("email"), F.col("group_name").alias("name"),
                             F.col("group_description").alias("description"))
    return outbox([
        ChangeSet("insert_group", new_groups, ["group_email"], group_payload),
        ChangeSet("insert_member", school.select("google_groupid", "google_id", "role"),
                  ["google_groupid", "google_id"], member_payload()),
        ChangeSet("insert_member", cohort.select("google_groupid", "google_id", "role"),
                  ["google_groupid", "google_id"], member_payload()),
    ], cfg.batch_size)


def _deletes(sections: DataFrame, schedule: DataFrame, students: DataFrame, groups: DataFrame, accounts: DataFrame,
             members: DataFrame, cfg: SyncConfig) -> list[ChangeSet]:
    doomed = grp.course_groups_stale(sections, groups, cfg).select("google_groupid")
    payload = F.struct(F.col("google_groupid").alias("groupKey"), F.col("google_userid").alias("memberKey"))
    stale = [grp.stale_owners(sections, groups, accounts, members), grp.stale_members(schedule, groups, accounts, members, cfg),
             grp.stale_cohort_members(students, groups, accounts, members, cfg), members.join(doomed, "google_groupid", "left_semi")]
    return [*[ChangeSet("delete_member", s.select("google_groupid", "google_userid"), ["google_groupid", "google_userid"], payload)
              for s in stale],
            ChangeSet("delete_group", doomed, ["google_groupid"], F.struct(F.col("google_groupid").alias("groupKey")))]


def group_deletes(sections: DataFrame, schedule: DataFrame, students: DataFrame, groups: DataFrame, accounts: DataFrame,
                  members: DataFrame, cfg: SyncConfig) -> DataFrame:
    """The delete requests of stale owners (Q25), members (Q26), cohort members (Q29) and course groups: a group goes after
    all of its members."""
    return ordered_outbox(_deletes(sections, schedule, students, groups, accounts, members, cfg), cfg.batch_size)


def full_group_sync(sections: DataFrame, schedule: DataFrame, students: DataFrame, groups: DataFrame, accounts: DataFrame,
                    members: DataFrame, cfg: SyncConfig) -> DataFrame:
    """All group requests of a night in order: new section groups, owners and members (those of new groups under the group's
    address, which the directory takes for its id), stale members, stale groups."""
    wanted = grp.section_groups_missing(sections, groups)
    new_groups, _ = collapse_new_groups(wanted)
    address = wanted.filter(F.col("group_name").isNotNull() & F.col("group_email").isNotNull()).select("unique_attribute", "group_email").distinct()
    waiting = (grp.pending_section_members(schedule, sections, groups, accounts, cfg).join(address, "unique_attribute")
               .select(F.col("group_email").alias("google_groupid"), "google_id", "role"))
    owners = grp.section_owners_missing(sections, groups, accounts, members)
    pupils = grp.section_members_missing(schedule, groups, accounts, members, cfg)
    group_payload = F.struct(F.col("group_email").alias("email"), F.col("group_name").alias("name"),
                             F.col("group_description").alias("description"))
    inserts = [ChangeSet("insert_member", rows.select("google_groupid", "google_id", "role"), ["google_groupid", "google_id"],
                         member_payload()) for rows in (owners, pupils, waiting)]
    return ordered_outbox([ChangeSet("insert_group", new_groups, ["group_email"], group_payload), *inserts,
                           *_deletes(sections, schedule, students, groups, accounts, members, cfg)], cfg.batch_size)


def writeback(students: DataFrame, accounts: DataFrame, as_read: DataFrame, now: DataFrame) -> DataFrame:
    """The e-mail write-back (Q33) applied to the SIS students where a row still is as it was read.

    ``as_read`` and ``now`` are the SIS students when the night began and when it writes.  See ``apply.snapshot_of`` and
    ``apply.conflicts_of`` for the next table and the refused changes.  Of a student's tied stage rows the least address counts.
    """
    wanted = first_of(extras.email_writeback(students, accounts), ["external_uid"], ["primary_email"])
    read = as_read.withColumn("read_version", ap.row_version(as_read.columns)).select("student_id", "read_version")
    changes = (wanted.select(F.col("external_uid").alias("student_id"), F.col("primary_email").alias("email"))
               .join(read, "student_id"))
    return ap.compare_and_set(now, changes, ["student_id"])


def sis_writeback(students: DataFrame, accounts: DataFrame, src: dict[str, DataFrame], cfg: SyncConfig,
                  run: Run) -> None:
    """The e-mail write-back set (Q33) and the portal-account TSV (Q34, K9 with TAB; one file per task, written again
    from its stage when a run resumes)."""
    run.stage("email_writeback", lambda: extras.email_writeback(students, accounts))
    portal = run.stage("portal_missing", lambda: extras.portal_missing(src, cfg))
    write_delimited(portal, f"{run.root}/portal_accounts_tsv", sep="\t", header=True, mode="overwrite")


def nightly_run(tb, out_base: str, run_id: str) -> dict[str, int]:
    """Snapshot the store (K13) → extracts (Q01/Q02/Q18/Q19) → new accounts (C1) → account patches (C3) → group syncs
    (C6/C7) and deletes → SIS write-back and export (C8).

    Every stage is committed under ``out_base/run_id=…`` (:mod:`rollcall.operators.runs`), and what follows reads the committed
    rows, so no plan runs twice and a night that ended midway goes on at its first uncommitted stage when it is called
    again.  Jobs with rejects write one table, partitioned by sink.  Returns the rows of each stage (K14).
    """
    cfg, spark = tb.cfg, tb.spark
    run = Run(spark, out_base, run_id)
    account, groups, members = (run.stage(f"snapshot_{name}", lambda name=name: getattr(tb, name))
                                for name in ("account", "groups", "group_member"))  # K13 snapshot before sync
    accounts = acc.normalise_accounts(account)
    staff = run.stage("staff_stage", lambda: tb.staff_stage)
    students = run.stage("students_stage", lambda: tb.students_stage)
    sections = run.stage("sections_stage", lambda: tb.sections)
    schedule = run.stage("schedule_stage", lambda: tb.schedule)
    run.stage("placements", lambda: extract.route_placements(tb.student_sources()), [SINK])

    def provision() -> DataFrame:
        rows = provisioning.provision(students, staff, accounts, tb.orgunit, cfg)
        return rows.withColumn(SINK, F.when(F.col("reject_reason").isNull(), ACCEPTED).otherwise(REJECTED))

    run.stage("provision_outbox", provision, [SINK])
    run.stage("account_patch", lambda: acc.account_patch(acc.desired_accounts(staff, students, accounts, tb.orgunit, cfg), accounts))
    run.stage("group_requests", lambda: route_new_groups(grp.section_groups_missing(sections, groups)), [SINK])
    run.stage("member_candidates", lambda: route_members(schedule, groups, accounts, cfg), [SINK])
    run.stage("section_outbox", lambda: section_group_sync(sections, schedule, groups, accounts, members, cfg))
    run.stage("school_cohort_outbox", lambda: school_and_cohort_sync(tb.departments, tb.store_sites, students, staff, groups, accounts,
                                                                     members, cfg))
    run.stage("delete_outbox", lambda: group_deletes(sections, schedule, students, groups, accounts, members, cfg))
    src = dict(enrol=tb.enrol, grade_levels=tb.grade_levels, sites=tb.sis_sites, students=tb.sis_students,
               sessions=tb.sessions, portal=tb.portal_students)
    sis_writeback(students, accounts, src, cfg, run)
    return run.commit()
