import os

from rollcall.plans.jobs import nightly_run
from rollcall.testbed import Testbed

SF = "/root/testdata/sf0.001"


def test_nightly_run_writes_every_output_with_audit(spark, tmpdir_path):
    tb = Testbed(spark, SF)
    audit = nightly_run(tb, tmpdir_path, "r1")
    base = os.path.join(tmpdir_path, "run_id=r1")
    for name in ("snapshot_account", "staff_stage", "provision_outbox", "section_outbox", "school_cohort_outbox",
                 "account_patch", "email_writeback", "portal_accounts_tsv", "_audit"):
        assert os.path.isdir(os.path.join(base, name)), name
    written = spark.read.parquet(os.path.join(base, "section_outbox")).count()
    assert audit["section_outbox"] == written
    assert spark.read.parquet(os.path.join(base, "_audit")).count() == len(audit)
    # snapshot → restore is the identity
    restored = spark.read.parquet(os.path.join(base, "snapshot_account"))
    assert restored.exceptAll(tb.account).count() == 0 and tb.account.exceptAll(restored).count() == 0


def test_nightly_run_on_catalog_tables(spark, tmpdir_path):
    """The same job on user-provided tables: the testbed's written views act as
    the catalog; stage tables are derived, nothing else is."""
    import pytest
    from rollcall.plans.tables import CatalogTables
    from rollcall.testbed import MATERIALIZED

    tb = Testbed(spark, SF)
    tb.ingest()
    views = os.path.join(tb._files_dir(), "views")
    sources = {n: os.path.join(views, n) for n in MATERIALIZED
               if n not in ("staff_stage", "students_stage", "sections", "schedule")}
    extra = {}
    for n in ("sis_sites", "site_labels", "grade_levels", "sis_students", "student_cf", "student_house",
              "portal_students", "sis_users", "section_course", "courses", "section_timeblock", "timeblocks",
              "store_sites"):
        p = os.path.join(tmpdir_path, "src", n)
        getattr(tb, n).write.parquet(p)
        extra[n] = p
    cat = CatalogTables(spark, {**sources, **extra}, tb.cfg)
    a = nightly_run(cat, os.path.join(tmpdir_path, "out"), "c1")
    b = nightly_run(Testbed(spark, SF), os.path.join(tmpdir_path, "out"), "t1")
    assert a == b
    with pytest.raises(AttributeError):
        CatalogTables(spark, {}, tb.cfg).sis_users


def test_cli_help():
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    r = subprocess.run([sys.executable, "-m", "rollcall", "--help"], cwd=root, capture_output=True, text=True,
                       timeout=120)
    assert r.returncode == 0 and "--tables" in r.stdout


def test_a_night_that_ended_midway_goes_on(spark, tmpdir_path, monkeypatch):
    """The stages before the break are read back, not computed again, and rows in are rows out and rejects."""
    from rollcall.operators.runs import committed_runs, restore
    from rollcall.plans import jobs

    tb = Testbed(spark, SF)
    with monkeypatch.context() as m:
        m.setattr(jobs, "section_group_sync", lambda *a: 1 / 0)
        try:
            nightly_run(tb, tmpdir_path, "r1")
            raise AssertionError("the night did not end")
        except ZeroDivisionError:
            pass
    assert committed_runs(spark, tmpdir_path) == []
    before = {n: os.listdir(os.path.join(tmpdir_path, "run_id=r1", n)) for n in ("students_stage", "provision_outbox", "member_candidates")}
    for name in ("section_groups", "student_extract"):
        monkeypatch.setattr("rollcall.plans.extract." + name, lambda *a: 1 / 0)
    audit = nightly_run(tb, tmpdir_path, "r1")
    assert before == {n: os.listdir(os.path.join(tmpdir_path, "run_id=r1", n)) for n in before}
    assert committed_runs(spark, tmpdir_path) == ["r1"]
    for stage in ("provision_outbox", "group_requests", "member_candidates", "placements"):
        found = restore(spark, tmpdir_path, "r1", stage)
        by_sink = {r["sink"]: r["count"] for r in found.groupBy("sink").count().collect()}
        assert sum(by_sink.values()) == audit[stage] and set(by_sink) <= {"accepted", "rejected"}


def test_compare_and_set_leaves_changed_rows_alone(spark):
    from rollcall.operators import apply as ap

    frame = lambda data: spark.createDataFrame(data, "k long, a string, b int")
    read = frame([(1, "x", 1), (2, None, 2), (3, "z", 3), (4, "w", 4)])
    now = frame([(1, "x", 1), (2, "", 2), (3, "z", 3), (5, "n", 5)])  # 2 changed from null to blank, 4 went, 5 is new
    from pyspark.sql import functions as F

    changes = read.filter("k <> 3").select("k", F.lit("new").alias("a"), ap.row_version(read.columns).alias("read_version"))
    found = ap.compare_and_set(now, changes, ["k"])
    after = sorted(map(tuple, ap.snapshot_of(found, now.columns).collect()))
    assert after == [(1, "new", 1), (2, "", 2), (3, "z", 3), (5, "n", 5)]
    assert sorted(map(tuple, ap.conflicts_of(found, ["k"]).collect())) == [(2, "new", "conflict"), (4, "new", "gone")]
