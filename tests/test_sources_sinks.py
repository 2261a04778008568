import json
import os

from pyspark.sql import functions as F

from conftest import rows
from rollcall.operators.batches import ChangeSet, batch_summary, outbox
from rollcall.schemas import DEVICE_UPDATE_CSV, USER_PAGE, USER_RESOURCE
from rollcall.sinks import export
from rollcall.sources import readers


def test_delimited_round_trip_tab(spark, tmpdir_path):
    df = spark.createDataFrame([(1, 'a "quoted", value'), (2, None)], "id int, txt string")
    path = os.path.join(tmpdir_path, "tsv")
    export.write_delimited(df, path, sep="\t", single_file=True)
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == 1
    back = spark.read.schema("id int, txt string").option("header", True).option("sep", "\t") \
        .option("escape", '"').csv(path)
    assert rows(back) == rows(df)


def test_uid_lookup_last_row_wins(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "uids.csv")
    with open(path, "w") as f:
        f.write("student,,,a@x.org,1\nstaff,,,b@x.org,2\nstudent,,,a@x.org,3\n")
    assert rows(readers.read_uid_lookup(spark, path), "email", "uid", "user_type") == \
        [("a@x.org", "3", "student"), ("b@x.org", "2", "staff")]


def test_json_array_pages_and_devices(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "users.json")
    with open(path, "w") as f:
        json.dump([{"id": "g1", "primaryEmail": "a@x.org"}, {"id": "g2"}], f)
    assert rows(readers.read_json_array(spark, path, USER_RESOURCE), "id") == [("g1",), ("g2",)]
    pages = spark.createDataFrame([('{"users": [{"id": "u1"}, {"id": "u2"}]}',), ('{"nextPageToken": "x"}',)],
                                  "page string")
    assert rows(readers.flatten_pages(pages, "users", USER_PAGE), "id") == [("u1",), ("u2",)]
    dev = spark.createDataFrame([('{"chromeosdevices": [{"serialNumber": "S1", "status": "ACTIVE",'
                                  ' "lastSync": "2001-01-02T03:04:05.000Z"}]}',)], "page string")
    table = export.device_table(readers.device_listing(dev))
    assert len(table.columns) == 12 and table.first()["lastSync"] is not None


def test_csv_with_header_and_external_ids(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "upd.csv")
    with open(p, "w") as f:
        f.write("serialNumber,annotatedUser,annotatedAssetId,annotatedLocation,orgUnitPath,notes\nS1,u,,,,n\n")
    assert readers.read_csv_with_header(spark, p, DEVICE_UPDATE_CSV).first()["notes"] == "n"
    q = os.path.join(tmpdir_path, "ids.csv")
    with open(q, "w") as f:
        f.write("x,a@b.org,organization,42\n")
    assert rows(readers.read_external_ids(spark, q)) == [("a@b.org", "organization", "42")]


def test_numbered_names(spark):
    df = spark.createDataFrame([("S1",)], "p string")
    out = readers.numbered_names(df, F.col("p"), 2, 27)
    names = [r.name for r in out.orderBy("n").collect()]
    assert names[0] == "S1-02" and names[-1] == "S1-27" and len(names) == 26


def test_audit_counts_during_write(spark, tmpdir_path):
    df = spark.range(123)
    obs_df, obs = export.audited(df, "audit")
    export.write_json(obs_df, os.path.join(tmpdir_path, "j"))
    assert obs.get["rows"] == 123


def test_outbox_batches_full_and_cover_every_row(spark):
    a = spark.range(0, 95).select(F.col("id").cast("string").alias("k"))
    b = spark.range(0, 7).select(F.col("id").cast("string").alias("k"))
    box = outbox([ChangeSet("insert_member", a, ["k"], F.struct("k")),
                  ChangeSet("delete_member", b, ["k"], F.struct("k"))], batch_size=20)
    got = {(r.action, r.batch_no): r.n_requests for r in batch_summary(box).collect()}
    assert got == {("insert_member", 0): 20, ("insert_member", 1): 20, ("insert_member", 2): 20,
                   ("insert_member", 3): 20, ("insert_member", 4): 15, ("delete_member", 0): 7}
    assert box.select("request_id").distinct().count() == 102


def test_timeblocks_need_no_python_rows(spark):
    from rollcall.testbed import TIMEBLOCK_NAMES, Testbed

    blocks = Testbed(spark, "/root/testdata/sf0.001").timeblocks
    assert "ExistingRDD" not in blocks._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in blocks.orderBy("timeblock_id").collect()] == list(enumerate(TIMEBLOCK_NAMES))
