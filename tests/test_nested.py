import json

from pyspark.sql import functions as F

from conftest import rows
from rollcall.operators import nested
from rollcall.schemas import GROUP_RECORD, MEMBER_RECORD


def test_first_external_id_handles_empty_and_null(spark):
    df = spark.createDataFrame(
        [([("custom", "other", "x"), ("organization", "staff", "7")],), ([],), (None,)],
        "ids array<struct<type: string, customType: string, value: string>>")
    got = [r[0] for r in df.select(nested.first_external_id("ids")["value"]).collect()]
    assert got == ["7", None, None]


def test_payload_omits_nulls_and_nests(spark):
    df = spark.createDataFrame([("a@b", None, "Ann")], "e string, g string, f string")
    body = df.select(nested.payload({"primaryEmail": F.col("e"), "name.givenName": F.col("g"),
                                     "name.familyName": F.col("f")})).first()[0]
    assert json.loads(body) == {"primaryEmail": "a@b", "name": {"familyName": "Ann"}}


def test_sparse_patch_drops_blank_and_empty(spark):
    df = spark.createDataFrame([("x", ""), ("", None)], "a string, b string")
    assert [r[0] for r in df.select(nested.sparse_patch({"a": F.col("a"), "b": F.col("b")})).collect()] \
        == ['{"a":"x"}', None]


def test_invert_map_last_wins(spark):
    df = spark.createDataFrame([({"k1": "v", "k2": "w"},)], "m map<string,string>")
    inv = df.select(nested.invert_map("m")).first()[0]
    assert inv == {"v": "k1", "w": "k2"}
    dup = spark.sql("SELECT map_from_arrays(array('a', 'b', 'c'), array('x', 'x', 'y')) AS m")
    assert dup.select(nested.invert_map("m")).first()[0] == {"x": "b", "y": "c"}


def test_violations_from_metadata(spark):
    df = spark.createDataFrame([("OWNER", "USER", "u1"), ("BOSS", None, None)], "role string, type string,"
                               " google_userid string")
    ok, bad = nested.split_valid(df, MEMBER_RECORD)
    assert ok.count() == 1
    assert bad.select("violations").first()[0] == ["role: not in enum", "id: required"]


def test_schema_projection_views(spark):
    df = spark.createDataFrame([("n", "e@x", "g1", None, 0)], "name string, email string, id string,"
                               " description string, department_id int")
    store = nested.schema_projection(df, GROUP_RECORD, "store")
    assert "group_email" in store.columns and "department_id" in store.columns
    api = nested.schema_projection(df, GROUP_RECORD, "api").first()[0]
    assert json.loads(api) == {"name": "n", "email": "e@x", "id": "g1"}


def test_external_ids_payload_and_merge(spark):
    df = spark.createDataFrame([("organization", "12")], "t string, v string")
    assert df.select(nested.external_ids_payload("t", "v")).first()[0] == \
        '{"externalIds":[{"type":"organization","value":"12"}]}'
    a = spark.createDataFrame([(1, "req", "r2")], "id int, x string, y string").alias("a")
    b = spark.createDataFrame([(1, None, "resp")], "id int, x string, y string").alias("b")
    m = a.join(b, "id").select(*nested.merge_later_wins("a", "b", ["x", "y"]))
    assert rows(m) == [("req", "resp")]


def test_as_text(spark):
    df = spark.createDataFrame([(True, None, 3)], "a boolean, b string, c int")
    assert nested.as_text(df).first().asDict() == {"a": "true", "b": None, "c": "3"}
