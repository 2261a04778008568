"""Whitening and hard negatives against plain versions of themselves."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.llm import hard_negatives, whitening
from rollcall.llm.common import table

SF = "/root/testdata/sf0.001"
KIND = "vec_id long, embedding array<float>, label int, key string, v string, id int"


@pytest.fixture(scope="module")
def vectors(spark):
    """Real rows with nulls, non-finite entries, a repeated row, equal vectors and columns whose names the operators use."""
    real = table(spark, SF, "embeddings").withColumn("key", F.lit("k")).withColumn("v", F.lit(None).cast("string")).withColumn("id", F.lit(1))
    some = [list(r.embedding) for r in real.orderBy("vec_id").limit(3).collect()]
    odd = [(9000, None, 1, None, None, None), (9001, [None] + some[0][1:], 1, None, None, None), (9002, [math.nan] + some[0][1:], 1, None, None, None),
           (9003, [math.inf] + some[0][1:], 2, None, None, None), (9004, some[0], None, None, None, None), (9100, some[1], 3, None, None, None),
           (9100, some[1], 3, None, None, None), (9101, some[1], 3, None, None, None), (9102, some[1], 4, None, None, None),
           (None, some[2], 3, None, None, None), (9200, [0.0] * 64, 5, None, None, None), (9201, [-x for x in some[0]], 5, None, None, None)]
    return real.unionByName(spark.createDataFrame(odd, KIND)).cache()


def good(vector):
    return vector is not None and all(c is not None and math.isfinite(c) for c in vector)


def negatives_by_hand(rows):
    own = []
    for r in rows:
        if good(r.embedding) and r.label is not None:
            label = (r.label + 1) % 10 if r.vec_id is not None and r.vec_id % 7 == 0 else r.label
            own.append((r.vec_id, label, tuple(math.floor(256 * c) for c in r.embedding)))
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for anchor, label, q in {r for r in own if r[0] is not None and r[0] % 100 == 0}:
        scored = [(sum(a * b for a, b in zip(q, o)), i, kind) for i, kind, o in own]
        positives = sorted([s for s in scored if s[2] == label and s[1] != anchor], key=order)[:5]
        for p, positive, _ in positives:
            window = sorted([s for s in scored if s[2] != label and 30 * p <= 100 * s[0] <= 90 * p], key=order)[:10]
            out += [(anchor, positive, rank, i, p, s) for rank, (s, i, _) in enumerate(window, 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [hard_negatives.BLOCK, 2])
def test_hard_negatives(vectors, block):
    got = hard_negatives.report(vectors.repartition(5), block=block)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = negatives_by_hand(vectors.collect())
    assert len(want) > 100 and sorted(map(tuple, got.collect()), key=str) == want


def test_hard_negatives_ties_and_few(spark):
    """Equal scores go by id; a label of one row has no positives; negative and zero scores open no window or one point."""
    rows = [(100, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [0.0, 1.0], 0), (3, [-1.0, 0.0], 0), (200, [0.0, 5.0], 8), (205, [2.0, 2.0], 2),
            *[(i, [0.5, 0.0], 1) for i in range(30, 45)], (50, [0.9, 0.0], 1), (51, [0.91, 0.0], 1), (52, [0.3, 0.0], 1), (53, [0.29, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert sorted(map(tuple, hard_negatives.report(df).collect())) == sorted(negatives_by_hand(df.collect()))
    few = spark.createDataFrame(rows[:1], df.schema)
    assert hard_negatives.report(few).collect() == [] and hard_negatives.report(df.limit(0)).collect() == []


def test_products_are_exact():
    big = np.array([[2**40, 3], [-(2**40) + 1, 5]])
    assert hard_negatives.products(big, np.array([[2**20 + 1, 1]])).tolist() == [[2**60 + 2**40 + 3], [(1 - 2**40) * (2**20 + 1) + 5]]
    with pytest.raises(OverflowError):
        hard_negatives.products(big, big)


def by_hand(vectors):
    rows = [r for r in vectors.collect() if good(r.embedding)]
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in r.embedding] for r in rows], object)
    total, n = x.sum(axis=0), len(rows)
    centred = (n * x - total).astype(float) / n
    return rows, x, total, n, centred, centred.T @ centred / n


def test_whitening(vectors):
    rows, x, total, n, centred, v = by_hand(vectors)
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1], axes[:, ::-1]
    got = whitening.report(vectors.repartition(7)).collect()
    assert len(got) == 32 * n and {r.n for r in got} == {n} and {r.component for r in got} == set(range(1, 33))
    assert len({r.identity_error for r in got}) == 1 and 0 <= got[0].identity_error < 1e-10
    deviation = ((n * x - total) ** 2).sum(axis=1)
    sign = {}
    want = {}
    for r, d, c in zip(rows, deviation, centred):
        want.setdefault(r.vec_id, []).append((d, c @ axes[:, :32] / np.sqrt(values[:32])))
    for r in sorted(got, key=lambda r: str(r.vec_id)):
        d, white = want[r.vec_id][0]  # rows of equal id have equal vectors here
        c = r.component - 1
        assert r.deviation == d and abs(r.explained * v.trace() / values[c] - 1) < 1e-9
        sign.setdefault(c, 1 if abs(r.whitened - white[c]) < abs(r.whitened + white[c]) else -1)
        assert abs(sign[c] * r.whitened - white[c]) < 1e-8


def test_whitening_does_not_depend_on_partitions(vectors):
    rows = whitening.kept(vectors, "vec_id", "embedding")
    one, other = whitening.fit(rows.coalesce(1)), whitening.fit(rows.repartition(9))
    assert one.total == other.total and np.array_equal(one.values, other.values) and np.array_equal(one.vectors, other.vectors)


def test_whitening_odd_tables(spark):
    kind = "vec_id long, embedding array<double>"
    frame = lambda rows: spark.createDataFrame(rows, kind)
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)]):
        assert whitening.report(frame(rows)).collect() == []
    mixed = frame([(1, [1.0, 2.0]), (2, [1.0, 5.0]), (3, [1.0]), (4, []), (5, [7.0, 2.0])])
    got = whitening.report(mixed).collect()  # other lengths are dropped
    assert {r.vec_id for r in got} == {1, 2, 5} and {r.component for r in got} == {1, 2} and got[0].identity_error < 1e-9
    line = whitening.report(frame([(i, [float(i), 2.0 * i, 3.0]) for i in range(9)])).collect()
    assert {r.component for r in line} == {1} and abs(line[0].explained - 1) < 1e-9
    huge = frame([(1, [1e15]), (2, [-1e15])])
    assert [r.deviation for r in whitening.report(huge).collect()] == [None, None]


@pytest.mark.parametrize("size", [1, 2, 7, 40])
def test_inertia_counts(size):
    rng = np.random.default_rng(size)
    for _ in range(20):
        a = rng.integers(-3, 4, (size, size)).astype(float)
        a += a.T
        values = np.linalg.eigvalsh(a)
        for shift in rng.uniform(values[0] - 1, values[-1] + 1, 5):
            assert whitening.below(a, shift) == (values < shift).sum()


def test_feast_finds_clusters():
    values = np.array([5.0] * 12 + [4.999999] * 3 + [1.0] * 20 + [0.0] * 8)
    turn = np.linalg.qr(np.random.default_rng(1).standard_normal((43, 43)))[0]
    v = turn * values @ turn.T
    v = (v + v.T) / 2
    cut = whitening.intervals(v, 32)
    assert sum(n for _, _, n in cut) == 35
    found = np.concatenate([whitening.feast(v, *i)[0] for i in cut])
    assert np.abs(np.sort(found) - np.sort(values)[8:]).max() < 1e-12
