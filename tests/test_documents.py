"""Schema-less documents: walks, flattening by key, patches; pages; rules."""

import json
import random

import pytest

from conftest import rows
from rollcall.operators import documents, nested, paging
from rollcall.operators.runs import Run, committed_runs, restore
from rollcall.operators.routing import accepted, reason_counts, rejected, routed
from rollcall.schemas import GROUP_RECORD
from pyspark.sql import functions as F


def made(rnd, depth=0):
    out = {}
    for name in rnd.sample(["a", "b", 'c"d', "é", "e.f"], rnd.randint(0, 4)):
        kind = rnd.random()
        if kind < 0.4 and depth < 3:
            out[name] = made(rnd, depth + 1)
        else:
            out[name] = rnd.choice([1, 2.5, "x", 'y"\\', True, None, [], [1, {"z": 2}], ""])
    return out


def patch_by_hand(stored, desired):
    out = {}
    for name in stored.keys() | desired.keys():
        if name not in desired:
            out[name] = None
        elif isinstance(stored.get(name), dict) and isinstance(desired[name], dict) and (stored[name] or not desired[name]):
            inner = patch_by_hand(stored[name], desired[name])
            if inner:
                out[name] = inner
        elif name not in stored or stored[name] != desired[name] or type(stored[name]) is not type(desired[name]):
            out[name] = desired[name]
    return out


def test_patches_equal_a_plain_recursive_difference(spark):
    rnd = random.Random(7)
    pairs = [(i, made(rnd), made(rnd)) for i in range(150)] + [(900, {"a": {"b": 1}}, {"a": 5}), (901, {"a": 5}, {"a": {"b": 1}}),
                                                               (902, {"a": {"b": 1}}, {"a": {}}), (903, {"a": {"b": {"c": 1}}}, {}), (904, {"a": {}}, {"a": {"b": 1}})]
    same = [(i, d, json.loads(json.dumps(d))) for i, d, _ in pairs[:10]]
    pairs += [(1000 + i, s, d) for i, s, d in same]
    frame = lambda data: spark.createDataFrame(data, "k long, doc string")
    stored = documents.walk(frame([(k, json.dumps(s, indent=1)) for k, s, _ in pairs] + [(5000, '{"only":1}')]), ["k"], "doc")
    desired = documents.walk(frame([(k, json.dumps(dict(reversed(d.items())))) for k, _, d in pairs] + [(5001, '{"only":1}'), (5000, "no json")]), ["k"], "doc")
    got = {r.k: json.loads(r.patch) for r in documents.patches(desired, stored, ["k"]).collect()}
    want = {}
    for k, s, d in pairs:
        if s and d and (patch := patch_by_hand(s, d)):  # a document without values has no rows to compare
            want[k] = patch
    assert len(want) > 80 and got == want


def test_walk_and_keys(spark):
    df = spark.createDataFrame([(1, '{"id":"x","a":{"b":{"name":"deep"},"name":"flat"},"n":1.5,"t":true,"z":null,"l":[1]}'), (2, "oops"), (3, None), (4, "[1]"), (5, "{}")],
                               "k long, doc string")
    values = documents.walk(df, ["k"], "doc").cache()
    assert {tuple(r.path) for r in values.collect()} == {("id",), ("a",), ("a", "b"), ("a", "b", "name"), ("a", "name"), ("n",), ("t",), ("z",), ("l",)}
    flat = documents.by_key(values, ["k"], {"id": "i", "name": "name", "z": "z", "t": "t", "none": "none"}).collect()
    assert [tuple(r) for r in flat] == [(1, "x", "flat", None, "true", None)]
    assert rows(documents.unknown_keys(values, {"id": "i", "name": "n"})) == [("l", 1), ("n", 1), ("t", 1), ("z", 1)]
    assert [r.k for r in documents.unparsable(df, "doc").collect()] == [2]


def test_first_of_takes_whole_rows(spark):
    df = spark.createDataFrame([(1, "b", "x"), (1, "a", "y"), (2, None, "z"), (2, "a", "w")], "k long, o string, v string")
    assert rows(documents.first_of(df, ["k"], ["o"])) == [(1, "a", "y"), (2, None, "z")]


def walked(pages, first=""):
    """The chain one page after the other."""
    landed = {}
    for token, nxt in pages:
        landed.setdefault(token, []).append(nxt)
    token, seen, out = first, {}, {}
    while token is not None and token not in seen:
        seen[token] = len(seen)
        token = min((n for n in landed.get(token, []) if n is not None), default=None)
    for token in landed.keys() | seen.keys():
        nxt = min((n for n in landed.get(token, []) if n is not None), default=None)
        if token not in landed:
            status = "missing"
        elif token not in seen:
            status = "orphan"
        elif nxt in seen and seen[nxt] <= seen[token]:
            status = "cycle"
        else:
            status = "repeated" if len(landed[token]) > 1 else "chained"
        out[token] = (seen.get(token), len(landed.get(token, [])), status)
    return out


def test_page_chain(spark):
    rnd = random.Random(2)
    listings = {0: [("", "p1"), ("p1", "p2"), ("p2", None)], 1: [("", None)], 2: [("p1", None)], 3: [("", "p1"), ("p1", "p1")], 4: [("", ""), ("x", "")]}
    for n in range(5, 40):
        size = rnd.randint(1, 40)
        pages = [(("p%d" % i) if i else "", "p%d" % (i + 1) if i < size else None) for i in range(size + 1)]
        for _ in range(rnd.randint(0, 3)):
            i = rnd.randrange(len(pages))
            pages[i:i + 1] = rnd.choice([[], [pages[i]] * 2, [(pages[i][0], "p%d" % rnd.randint(1, size))], [pages[i], (pages[i][0], None)]])
            if not pages:
                pages = [("", None)]
        listings[n] = pages
    data = [(n, t, x) for n, pages in listings.items() for t, x in pages]
    chain = paging.page_chain(spark.createDataFrame(data, "listing long, token string, next_token string")).cache()
    got = {}
    for r in chain.collect():
        got.setdefault(r.listing, {})[r.token] = (r.position, r.n_landed, r.status)
    assert got == {n: walked(pages) for n, pages in listings.items()}
    whole = {r.listing: r.complete for r in paging.complete_listings(chain).collect()}
    assert whole[0] and whole[1] and not whole[2] and not whole[3] and not whole[4]
    empty = spark.createDataFrame([], "listing long, token string, next_token string")
    assert paging.page_chain(empty).collect() == []


def test_rule_table(spark):
    df = spark.createDataFrame([("g1", None, "e", "7", "t"), ("g2", "n", None, "seven", "t"), (None, "n", "e", None, "t")],
                               "google_groupid string, group_name string, group_email string, department_id string, group_type string") \
        .withColumns({c: F.lit(None).cast("string") for c in ("description", "etag", "unique_attribute")})
    _, bad = nested.split_valid(df, GROUP_RECORD)
    assert sorted((r.google_groupid or "", r.violations) for r in bad.collect()) == [
        ("", ["id: required"]), ("g1", ["name: required"]), ("g2", ["email: required", "department_id: no int"])]
    counts = {(r.field, r.rule): r.n_rows for r in nested.violation_counts(df, GROUP_RECORD).collect()}
    assert counts == {("name", "required"): 1, ("email", "required"): 1, ("id", "required"): 1, ("department_id", "no int"): 1}


def test_routing_keeps_every_row(spark):
    df = spark.range(100).withColumn("v", F.when(F.col("id") % 3 > 0, F.col("id")))
    out = routed(df, {"none": F.col("v").isNull(), "big": F.col("v") > 90})
    assert accepted(out).count() + rejected(out).count() == 100
    assert rows(reason_counts(out)) == [("big", 6), ("none", 34)]


def test_a_broken_run_resumes(spark, tmpdir_path):
    built = []

    def stage(name, value, fail=False):
        def build():
            built.append(name)
            if fail:
                raise RuntimeError("the night ends here")
            return spark.createDataFrame([(value, "accepted"), (value + 1, "rejected")], "v int, sink string")
        return build

    run = Run(spark, tmpdir_path, "n1")
    assert rows(run.stage("one", stage("one", 1), ["sink"])) == [(1, "accepted"), (2, "rejected")]
    run.stage("two", stage("two", 5))
    spark.createDataFrame([(99, "left")], "v int, sink string").write.parquet(f"{tmpdir_path}/run_id=n1/three")  # what a broken attempt left
    with pytest.raises(RuntimeError):
        run.stage("three", stage("three", 7, fail=True))
    assert committed_runs(spark, tmpdir_path) == []
    with pytest.raises(LookupError):
        restore(spark, tmpdir_path, "n1", "one")

    again = Run(spark, tmpdir_path, "n1")
    assert rows(again.stage("one", stage("one", 1), ["sink"])) == [(1, "accepted"), (2, "rejected")]
    again.stage("two", stage("two", 5))
    assert rows(again.stage("three", stage("three", 7))) == [(7, "accepted"), (8, "rejected")]
    assert built == ["one", "two", "three", "three"] and again.commit() == {"one": 2, "two": 2, "three": 2}
    assert committed_runs(spark, tmpdir_path) == ["n1"] and rows(restore(spark, tmpdir_path, "n1", "three")) == [(7, "accepted"), (8, "rejected")]
    audit = {r.output: (r.rows, r.rejects) for r in spark.read.parquet(f"{tmpdir_path}/run_id=n1/_audit").collect()}
    assert audit == {"one": (2, 1), "two": (2, 0), "three": (2, 0)}


def test_walk_spreads_the_documents(spark):
    """Documents of one partition are opened by several tasks, null keys and texts that repeat included."""
    docs = spark.range(200).selectExpr("IF(id % 2 = 0, NULL, id) AS k", "concat('{\"a\":', id, '}') AS doc").coalesce(1)
    values = documents.walk(docs, ["k"], "doc")
    assert values.count() == 200
    assert values.select(F.input_file_name()).distinct().count() > 1
