import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from rollcall.operators import ranking


def _skewed(spark, n=3000, seed=1):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        g = "hot" if i % 3 == 0 else f"g{rnd.randint(0, 50)}"   # one key holds a third of the rows
        data.append((g, i, rnd.randint(0, 5), rnd.choice([None, "a", "b"])))
    return spark.createDataFrame(data, "g string, id int, v int, s string")


def test_sequence_within_matches_row_number(spark):
    df = _skewed(spark)
    got = ranking.sequence_within(df, ["g"], ["id"], out="seq", num_partitions=7)
    want = df.withColumn("seq", F.row_number().over(Window.partitionBy("g").orderBy("id")))
    assert rows(got, "g", "id", "seq") == rows(want, "g", "id", "seq")


def test_sequence_without_groups(spark):
    df = _skewed(spark, 500)
    got = ranking.sequence_within(df, [], ["id"], out="seq", num_partitions=5)
    assert sorted(r.seq for r in got.collect()) == list(range(1, 501))


def test_cumulative_within_matches_window_sum(spark):
    df = _skewed(spark)
    got = ranking.cumulative_within(df, ["g"], ["id"], F.col("v"), out="c", num_partitions=6)
    w = Window.partitionBy("g").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("c", F.sum("v").over(w))
    assert rows(got, "g", "id", "c") == rows(want, "g", "id", "c")


def test_first_with_ties_equals_dense_rank_nulls_last(spark):
    df = _skewed(spark)
    got = ranking.first_with_ties(df, ["g"], ["s", "v"])
    w = Window.partitionBy("g").orderBy(F.col("s").asc_nulls_last(), F.col("v").asc_nulls_last())
    want = df.withColumn("r", F.dense_rank().over(w)).filter("r = 1").drop("r")
    assert rows(got) == rows(want)


def test_annotate_groups_counts(spark):
    df = _skewed(spark)
    got = ranking.annotate_groups(df, ["g"], n=F.count(F.lit(1)))
    want = df.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("g")))
    assert rows(got, "id", "n") == rows(want, "id", "n")


def test_latest_per_key_keeps_ties(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 3, "c"), (2, 1, "d")], "k int, d int, x string")
    assert rows(ranking.latest_per_key(df, ["k"], "d"), "x") == [("a",), ("b",), ("d",)]


def test_last_wins(spark):
    df = spark.createDataFrame([("a", 1, "old"), ("a", 2, "new"), ("b", 1, "only")], "k string, o int, v string")
    assert rows(ranking.last_wins(df, ["k"], "o"), "k", "v") == [("a", "new"), ("b", "only")]


def test_hashed_sample_is_deterministic_subset(spark):
    df = _skewed(spark, 400)
    a = [r.id for r in ranking.hashed_sample(df, 25, 7, ["id"]).collect()]
    b = [r.id for r in ranking.hashed_sample(df.repartition(9), 25, 7, ["id"]).collect()]
    assert a == b and len(set(a)) == 25


def test_numbering_with_null_group_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), (None, 4), ("a", 5)], "g string, id int")
    got = ranking.sequence_within(df, ["g"], ["id"], out="seq", num_partitions=3)
    assert rows(got, "g", "id", "seq") == [("a", 3, 1), ("a", 5, 2), (None, 1, 1), (None, 2, 2), (None, 4, 3)]
    c = ranking.cumulative_within(df, ["g"], ["id"], F.col("id"), out="c", num_partitions=3)
    assert rows(c, "id", "c") == [(1, 1), (2, 3), (3, 3), (4, 7), (5, 8)]
    assert rows(ranking.latest_per_key(df, ["g"], "id"), "id") == [(4,), (5,)]


def test_materialize_reads_files(spark):
    """The rows come back from Parquet; types that Parquet lacks from a checkpoint."""
    from rollcall.operators.ranking import materialize

    rows_ = spark.createDataFrame([(1, ["a", None]), (None, None)], "k long, v array<string>")
    kept = materialize(rows_)
    assert len(kept.inputFiles()) > 0 and kept.exceptAll(rows_).isEmpty() and kept.count() == 2
    assert materialize(rows_.withColumn("n", F.lit(None))).columns == ["k", "v", "n"]
