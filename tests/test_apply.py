
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from conftest import rows
from rollcall.operators import apply
from rollcall.operators.reconcile import changed, missing, patch_documents

T = "id int, a string, b string, c int"


def test_upsert_updates_only_supplied_columns(spark):
    t = spark.createDataFrame([(1, "a1", "b1", 10), (2, "a2", "b2", 20)], T)
    ch = spark.createDataFrame([(1, "A1"), (3, "A3")], "id int, a string")
    out = apply.upsert(t, ch, ["id"])
    assert rows(out) == [(1, "A1", "b1", 10), (2, "a2", "b2", 20), (3, "A3", None, None)]


def test_upsert_tells_supplied_null_from_absent(spark):
    t = spark.createDataFrame([(1, "a1", "b1", 10)], T)
    ch = spark.createDataFrame([(1, None, None, ["a"])], "id int, a string, b string, sup array<string>")
    out = apply.upsert(t, ch, ["id"], supplied_col="sup")
    assert rows(out) == [(1, None, "b1", 10)]


def test_upsert_of_rows_for_new_keys_only(spark):
    t = spark.createDataFrame([(1, None, "b1", 10), (1, "a1", "b1", 11), (2, "a2", "b2", 20), (None, "a0", None, 0)], T)
    ch = spark.createDataFrame([(1, "A1", True), (2, "A2", False), (3, "A3", True), (4, "A4", None), (None, "A0", True)], "id int, a string, new boolean")
    out = apply.upsert(t, ch, ["id"], new_only_col="new")
    assert rows(out, "id", "a", "c") == [(1, "a1", 11), (1, None, 10), (2, "A2", 20), (3, "A3", None), (4, "A4", None), (None, "A0", None), (None, "a0", 0)]


def test_update_ignores_unknown_keys_and_delete(spark):
    t = spark.createDataFrame([(1, "a1", "b1", 10), (2, "a2", "b2", 20)], T)
    ch = spark.createDataFrame([(2, 99), (5, 50)], "id int, c int")
    assert rows(apply.update(t, ch, ["id"]), "id", "c") == [(1, 10), (2, 99)]
    gone = spark.createDataFrame([(1,)], "id int")
    assert rows(apply.delete(t, gone, ["id"]), "id") == [(2,)]


def test_update_or_insert_logs_action(spark):
    t = spark.createDataFrame([(1, "a1", "b1", 10)], T)
    ch = spark.createDataFrame([(1, "x"), (2, "y")], "id int, a string")
    assert rows(apply.update_or_insert(t, ch, ["id"]), "id", "_action") == [(1, "update"), (2, "insert_unmanaged")]


def test_replace_partitions(spark):
    t = spark.createDataFrame([("g1", "u1"), ("g1", "u2"), ("g2", "u3")], "g string, u string")
    fresh = spark.createDataFrame([("g1", "u9")], "g string, u string")
    assert rows(apply.replace_partitions(t, fresh, ["g"])) == [("g1", "u9"), ("g2", "u3")]
    kept = apply.replace_partitions(t, fresh, ["g"], row_keys=["g", "u"], overwrite=False)
    assert rows(kept) == [("g1", "u1"), ("g1", "u2"), ("g1", "u9"), ("g2", "u3")]


def test_load_by_position_casts_and_checks_width(spark):
    src = spark.createDataFrame([("7", "x", "1")], "p string, q string, r string")
    target = StructType([StructField("id", IntegerType()), StructField("name", StringType()),
                         StructField("flag", IntegerType())])
    assert apply.load_by_position(src, target).collect()[0].asDict() == {"id": 7, "name": "x", "flag": 1}
    with pytest.raises(ValueError):
        apply.load_by_position(src.drop("r"), target)


def test_snapshot_round_trip(spark, tmpdir_path):
    t = spark.createDataFrame([(1, "a1", "b1", 10)], T)
    apply.write_snapshot(t, tmpdir_path, "r1", "accounts")
    back = apply.read_snapshot(spark, tmpdir_path, "r1", "accounts")
    assert rows(back) == rows(t)


def test_missing_is_a_left_anti_join(spark, capsys):
    d = spark.createDataFrame([(1,), (2,)], "k int")
    c = spark.createDataFrame([(2, "x"), (3, None)], "k2 int, t string")
    out = missing(d, c, [("k", "k2")], F.col("t") == "x")
    assert rows(out) == [(1,)]
    out.explain()
    assert "LeftAnti" in capsys.readouterr().out


def test_diff_then_apply_is_idempotent(spark):
    stored = spark.createDataFrame([(1, "a1", "b1", 10), (2, "a2", None, 20)], T)
    desired = spark.createDataFrame([(1, "a1", "B1", 10), (2, "a2", "b2", None)], T)
    diff = changed(desired, stored, ["id"], ["a", "b", "c"])
    assert rows(diff) == [(1, "b", "b1", "B1"), (2, "b", None, "b2"), (2, "c", "20", None)]
    docs = {r.id: r.patch for r in patch_documents(diff, ["id"]).collect()}
    assert docs[2] == '{"b":"b2","c":null}'
    per = (diff.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("field", "new_value"))).alias("m"))
           .select("id", F.col("m")["a"].alias("a"), F.col("m")["b"].alias("b"),
                   F.col("m")["c"].cast("int").alias("c"), F.map_keys("m").alias("sup")))
    applied = apply.update(stored, per, ["id"], supplied_col="sup")
    assert changed(desired, applied, ["id"], ["a", "b", "c"]).count() == 0


def test_insert_and_semi_and_stale(spark):
    from rollcall.operators.reconcile import existing, stale
    from rollcall.plans.accounts import account_by_email
    t = spark.createDataFrame([(1, "a1", "b1", 10)], T)
    more = spark.createDataFrame([(2, "a2")], "id int, a string")
    assert rows(apply.insert(t, more)) == [(1, "a1", "b1", 10), (2, "a2", None, None)]
    cur = spark.createDataFrame([(1, "x"), (5, "y")], "k int, t string")
    want = spark.createDataFrame([(1,), (2,)], "k2 int")
    assert rows(existing(want, cur, [("k2", "k")])) == [(1,)]
    assert rows(stale(cur, want, [("k", "k2")]), "k") == [(5,)]
    acc = spark.createDataFrame([(1, "a@x"), (2, "b@x")], "id int, primary_email string")
    emails = spark.createDataFrame([("b@x",), ("b@x",), ("z@x",)], "primary_email string")
    assert rows(account_by_email(acc, emails), "id") == [(2,)]


def test_text_keys_join_by_their_hash_first(spark):
    """Text keys are sorted by a hash; null keys, repeated rows and keys of other types keep their meaning."""
    t = spark.createDataFrame([("g1", "a", 1), ("g1", "a", 1), ("g1", None, 2), (None, "a", 3), ("g2", "b", 4)], "g string, u string, n int")
    gone = spark.createDataFrame([("g1", "a"), ("g1", None), (None, "a"), ("g1", "a")], "g string, u string")
    left = apply.delete(t, gone, ["g", "u"])
    assert sorted(r.n for r in left.collect()) == [2, 3, 4]
    assert "xxhash64" in left._jdf.queryExecution().optimizedPlan().toString()
    numbers = spark.createDataFrame([(1,), (4,)], "n long")
    assert sorted(r.n for r in apply.delete(t, numbers, ["n"]).collect()) == [2, 3]
    texts = spark.createDataFrame([("7",), ("8",)], "k string")
    assert [r.k for r in apply.delete(texts, spark.createDataFrame([(7,)], "k long"), ["k"]).collect()] == ["8"]
    new = apply.upsert(t.filter("n > 1"), spark.createDataFrame([("g2", "b", 9), (None, "a", 8)], "g string, u string, n int"), ["g", "u"])
    assert sorted((r.g or "", r.u or "", r.n) for r in new.collect()) == [("", "a", 3), ("", "a", 8), ("g1", "", 2), ("g2", "b", 9)]
