"""The similarity join against all pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rollcall.llm import jaccard_join as J
from rollcall.llm.common import table

SF = "/root/testdata/sf0.001"


def shingles(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) > 3 else {tuple(w)} if w else set()


def by_hand(rows, percent=85):
    """(doc_id, n_shingles, component_id) of (doc_id, text), by all pairs."""
    sets = [shingles(t) for _, t in rows]
    comp = list(range(len(rows)))

    def top(i):
        while comp[i] != i:
            i = comp[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    met = {(a, b) for h in holders.values() for k, a in enumerate(h) for b in h[k + 1:]}
    for a, b in met:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            comp[top(a)] = top(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return sorted(((d, len(s), least.get(top(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


@pytest.fixture(scope="module")
def rows(spark):
    """Real texts, copies, chains of near copies around the threshold, shared passages, odd texts and repeated rows."""
    out = [(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(4000)}"
    base = [word() for _ in range(120)]
    for i in range(60):  # near copies of one text, many just above or below the threshold of each other
        copy = list(base)
        for _ in range(rng.randrange(5)):
            copy[rng.randrange(len(copy))] = word()
        out.append((10_000 - i, " ".join(copy)))
    chain = [word() for _ in range(80)]
    for i in range(30):  # each links with the next only
        chain = chain[2:] + [word(), word()]
        out.append((20_000 + i, "  ".join(chain).upper()))
    notice = " ".join(word() for _ in range(25))
    for i in range(60):  # a passage that many share
        out.append((30_000 + i, notice + " " + " ".join(word() for _ in range(rng.randrange(0, 60)))))
    long = " ".join(f"Ünï{i % 7001} x{i % 13}" for i in range(40_000))
    out += [(40_000, long), (40_001, long + " one more word here"), (40_002, ""), (40_003, ""), (40_004, None), (None, None), (None, base and " ".join(base)),
            (40_005, " \t\r\n"), (40_006, "one two"), (40_007, "ONE  two\n"), (40_008, "one two three"), (40_008, "one two three"), (40_009, "a b c d"),
            (40_010, "one two é"), (40_011, "one two É"), (40_012, "one two three four five six")]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").select(
        "*", F.lit("x").alias("id"), F.lit(None).cast("string").alias("comp"), F.lit(1).alias("n"), F.lit(2).alias("node")).repartition(6).cache()


@pytest.mark.parametrize("options", [{}, {"leaf": 3, "pivot_rounds": 0, "groups": 16, "sketch": 64}, {"percent": 60, "leaf": 5, "pivot_rounds": 1}])
def test_join(docs, rows, options):
    got = J.report(docs, **options)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    want = by_hand(rows, options.get("percent", 85))
    assert len({c for _, _, c in want}) < len(want) - 60
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_empty(docs):
    assert J.report(docs.limit(0)).collect() == []
    assert [tuple(r) for r in J.report(docs.where("text IS NULL AND doc_id IS NULL")).collect()] == [(None, 0, None)]


def test_bounds_hold():
    """A first shingle is shared and the summed minima reach the threshold wherever two sets link."""
    rng = np.random.default_rng(3)
    order = J.rarity(np.zeros(64, np.int64))
    linked = 0
    for _ in range(300):
        pool = rng.choice(1 << 40, 80, replace=False).astype(np.uint64)
        a = pool[: rng.integers(1, 60)]
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.95], pool[60:60 + rng.integers(0, 6)]]))
        both = len(np.intersect1d(a, b))
        if 100 * both < 85 * (len(a) + len(b) - both):
            continue
        linked += 1
        first = []
        for s in (a, b):
            ranked = np.sort((order[(s % np.uint64(64)).astype(int)] << np.uint64(40)) | (s >> np.uint64(14)))
            first.append(set(ranked[: int(J.first_length(np.array([len(s)]), 85)[0])].tolist()))
        assert first[0] & first[1]
        counts = [np.bincount((s % np.uint64(16)).astype(int), minlength=16) for s in (a, b)]
        assert J.reaches(int(np.minimum(*counts).sum()), len(a), len(b), 85)
    assert linked > 50


def test_leaves_span_tasks(spark):
    """One tree over many tasks: every pair that may link is found, and leaves of one component are passed over."""
    rng = np.random.default_rng(1)
    data = [(7 if i % 3 else 8, i, i % 4 if i < 40 else 5, int(n), np.full(4, n // 4, "<u2").tobytes(), [7 if i % 3 else 8])
            for i, n in enumerate(rng.integers(20, 40, 200) * 4)]
    df = spark.createDataFrame(data, "tree long, id long, comp long, n long, counts binary, trees array<long>")
    packed = J.leaves(df.repartition(5), 6, 85).cache()
    assert sorted(i for r in packed.collect() for i in r.ids) == list(range(200)) and all(len(r.ids) <= 6 for r in packed.collect())
    near = J.leaf_pairs(packed, 85)
    uniform = {r.leaf for r in packed.collect() if r.comp_lo == r.comp_hi == 5}
    assert uniform and not any(r.x in uniform and r.y in uniform for r in near.collect())
    want = {(a[1], b[1]) for a in data for b in data if a[1] < b[1] and a[0] == b[0] and a[2] != b[2] and 185 * min(a[3], b[3]) >= 85 * (a[3] + b[3])}
    assert sorted(tuple(r) for r in J.point_pairs(packed, near, 85).collect()) == sorted(want)


def test_a_pair_is_near_once(spark):
    """Points that share several trees meet in the first of them, in small trees and in trees of several leaves."""
    point = np.full(4, 5, "<u2").tobytes()
    members = {1: range(0, 30), 2: range(20, 26), 3: range(5, 60), 4: (3, 70), 5: (3, 70, 71)}
    trees = {}
    for tree, ids in members.items():
        for i in ids:
            trees.setdefault(i, []).append(tree)
    data = [(tree, i, i, 20, point, trees[i]) for tree, ids in members.items() for i in ids]
    df = spark.createDataFrame(data, "tree long, id long, comp long, n long, counts binary, trees array<long>")
    packed = J.leaves(df.repartition(3), 8, 85).cache()
    got = sorted(tuple(r) for r in J.point_pairs(packed, J.leaf_pairs(packed, 85), 85).collect())
    assert got == sorted({(a, b) for ids in members.values() for a in ids for b in ids if a < b})


def test_counts_beyond_sixteen_bits_bound_nothing():
    x = np.array([[J._MANY, 3], [J._MANY, 3]], np.uint16)
    y = np.array([[J._MANY, 2], [9, 2]], np.uint16)
    assert J.summed_minima(x, y).tolist() == [1 << 40, 11]


def test_shingle_sets():
    for text in ("", "a", "a b c", "a b c d", "a b c d a b c d", "A\tb\nC d e"):
        raw = text.encode()
        assert len(J.shingle_sets(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))) == len(shingles(text))
    column = pa.array(["x y z w v", None, "x y z w v"])
    (_, rows, tagged), = J._sets(column, 4)
    assert rows == 3 and len(tagged) == 4 and ((tagged[:2] << np.uint64(10)) == (tagged[2:] << np.uint64(10))).all()
