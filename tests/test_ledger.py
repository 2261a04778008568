"""The ledger of attempts and the ordered outbox."""

import glob
import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from conftest import rows
from rollcall.operators import ledger, ranking
from rollcall.operators.batches import ChangeSet, ordered_outbox
from rollcall.plans import jobs
from rollcall.session import ensure_checkpoint_dir
from rollcall.testbed import Testbed

SF = "/root/testdata/sf0.001"
BODY = "struct<id:string,role:string,type:string,etag:string>"


def answers(spark, data):
    return spark.createDataFrame(data, f"request_id string, attempt int, status int, body {BODY}")


@pytest.fixture(scope="module")
def requests(spark):
    data = [("i:g1|a", "insert_member", 1, "g1", "a", "MEMBER"), ("i:g1|b", "insert_member", 2, "g1", "b", "MEMBER"),
            ("i:g1|c", "insert_member", 3, "g1", "c", "OWNER"), ("d:g1|d", "delete_member", 4, "g1", "d", None),
            ("d:g1|e", "delete_member", 5, "g1", "e", None), ("d:g1|f", "delete_member", 6, "g1", "f", None),
            ("d:g1|a", "delete_member", 7, "g1", "a", None), ("i:g2|a", "insert_member", 8, "g2", "a", "MEMBER"),
            ("i:g2|b", "insert_member", 9, "g2", "b", "MEMBER")]
    return spark.createDataFrame(data, "request_id string, action string, seq long, google_groupid string, google_userid string, role string")


LANDED = [("i:g1|a", 1, 200, ("a", "MANAGER", None, "m1")), ("i:g1|b", 1, 503, None), ("i:g1|b", 2, 409, None), ("i:g1|b", 3, 500, None),
          ("i:g1|c", 1, 403, None), ("d:g1|d", 1, 204, None), ("d:g1|e", 1, 429, None), ("d:g1|e", 2, 503, None), ("d:g1|f", 1, 404, None),
          ("d:g1|a", 1, 204, None), ("i:g2|a", 1, 503, None), ("i:nobody|x", 1, 200, None)]


def test_states(spark, requests):
    book = ledger.record(answers(spark, []), answers(spark, LANDED + LANDED[:3]))
    got = {r.request_id: (r.outcome, r.attempts, r.last_status) for r in ledger.states(requests, book, max_attempts=2).collect()}
    assert got == {"i:g1|a": ("done", 1, 200), "i:g1|b": ("exists", 3, 409), "i:g1|c": ("rejected", 1, 403), "d:g1|d": ("done", 1, 204),
                   "d:g1|e": ("failed", 2, 503), "d:g1|f": ("absent", 1, 404), "d:g1|a": ("done", 1, 204), "i:g2|a": ("retry", 1, 503),
                   "i:g2|b": ("pending", 0, None)}


def test_recording_again_changes_nothing(spark, requests):
    landed = answers(spark, LANDED)
    once = ledger.record(answers(spark, []), landed)
    twice = ledger.record(once, landed.unionByName(landed))
    late = ledger.record(twice, answers(spark, [("i:g1|a", 1, 500, None)]))  # another answer under an attempt that is known
    assert rows(once) == rows(twice) == rows(late)
    store = spark.createDataFrame([("g1", "a", "MEMBER", "USER", None), ("g1", "b", "OWNER", "USER", "old"), ("g1", "d", "MEMBER", "USER", None),
                                   ("g1", "f", "MEMBER", "USER", None), ("g9", "z", "OWNER", "USER", None)],
                                  "google_groupid string, google_userid string, role string, type string, etag string")
    found = ledger.states(requests, once)
    after = ledger.members_after(store, found)
    assert rows(after) == rows(ledger.members_after(after, found))
    # a: inserted, then deleted; b exists and keeps its row; d and f went
    assert {(r.google_groupid, r.google_userid, r.role) for r in after.collect()} == {("g1", "b", "OWNER"), ("g9", "z", "OWNER")}


def test_exists_without_a_stored_row_is_stored_as_requested(spark, requests):
    store = spark.createDataFrame([], "google_groupid string, google_userid string, role string, type string")
    found = ledger.states(requests, ledger.record(answers(spark, []), answers(spark, LANDED)))
    assert rows(ledger.members_after(store, found)) == [("g1", "b", "MEMBER", "USER")]


def test_retry_queue_and_refused(spark, requests):
    found = ledger.states(requests, ledger.record(answers(spark, []), answers(spark, LANDED)))
    due = {r.request_id: (r.attempt, r.batch_no) for r in ledger.retry_queue(found, 1).collect()}
    assert due == {"d:g1|e": (3, 0), "i:g2|a": (2, 0), "i:g2|b": (1, 1)}
    assert rows(ledger.refused(found)) == [("i:g1|c", "insert_member", 1, "rejected: status 403")]


def test_group_deletes_take_their_members(spark):
    requests = spark.createDataFrame([("d:g1", "delete_group", 1, "g1"), ("d:g2", "delete_group", 2, "g2"), ("i:g2", "insert_group", 3, "g2")],
                                     "request_id string, action string, seq long, google_groupid string")
    found = ledger.states(requests, ledger.record(answers(spark, []), answers(spark, [(r, 1, 200, None) for r in ("d:g1", "d:g2", "i:g2")])))
    groups = spark.createDataFrame([("g1",), ("g2",), ("g3",)], "google_groupid string")
    members = spark.createDataFrame([("g1", "a"), ("g2", "a"), ("g3", "a")], "google_groupid string, google_userid string")
    left, kept = ledger.groups_after_deletes(groups, members, found)
    assert rows(left) == [("g2",), ("g3",)] and rows(kept) == [("g2", "a"), ("g3", "a")]


def test_every_request_follows_what_it_needs(spark):
    tb = Testbed(spark, SF)
    box = jobs.full_group_sync(tb.sections, tb.schedule, tb.students_stage, tb.groups, tb.accounts, tb.group_member, tb.cfg).collect()
    batch = {r.request_id: r.batch_no for r in box}
    assert len(batch) == len(box) and {r.action for r in box} == {"insert_group", "insert_member", "delete_member", "delete_group"}
    created = {json.loads(r.payload)["email"]: r.batch_no for r in box if r.action == "insert_group"}
    dropped = {json.loads(r.payload)["groupKey"]: r.batch_no for r in box if r.action == "delete_group"}
    needs = [0, 0]
    for r in box:
        group = json.loads(r.payload).get("groupKey")
        if r.action == "insert_member" and group in created:
            needs[0] += 1
            assert created[group] < r.batch_no
        if r.action == "delete_member" and group in dropped:
            needs[1] += 1
            assert r.batch_no < dropped[group]
        assert r.after_batch is None or r.after_batch < r.batch_no
    assert all(needs)
    per = {}
    for r in box:
        per.setdefault(r.batch_no, []).append(r.action)
    assert sorted(per) == list(range(len(per))) and all(len(set(a)) == 1 and len(a) <= tb.cfg.batch_size for a in per.values())


def test_requests_asked_twice_are_sent_once(spark):
    df = spark.createDataFrame([("g", "a"), ("g", "b")], "google_groupid string, google_userid string")
    keys, body = ["google_groupid", "google_userid"], F.struct("google_groupid", "google_userid")
    box = ordered_outbox([ChangeSet("delete_member", df, keys, body), ChangeSet("delete_member", df.limit(1), keys, body)], 1)
    assert rows(box.select("batch_no", "seq", "after_batch")) == [(0, 1, None), (1, 2, None)]
    with pytest.raises(ValueError):
        ordered_outbox([ChangeSet("rename_group", df, keys, body)])


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_least_answer_of_an_attempt(spark):
    """Of several answers under one attempt the least counts, a missing status before any, a missing body before any."""
    body = ("a", None, None, "m1")
    landed = answers(spark, [("i:g1|a", 1, 200, body), ("i:g1|a", 1, None, body), ("i:g1|a", 1, None, None),
                             ("i:g1|b", 1, 503, None), ("i:g1|b", 1, 200, body), ("i:g1|b", 1, 200, ("a", None, None, "m0"))])
    got = {r.request_id: (r.status, r.body and r.body.etag) for r in ledger.record(answers(spark, []), landed).collect()}
    assert got == {"i:g1|a": (None, None), "i:g1|b": (200, "m0")}


def test_repeated_requests_share_their_attempts(spark, requests):
    """A request id that stands twice, once per action, is folded over the outcomes under both."""
    twice = requests.filter("request_id = 'i:g1|b'").withColumn("action", F.lit("delete_member")).unionByName(requests)
    found = ledger.states(twice, ledger.record(answers(spark, []), answers(spark, LANDED)), max_attempts=2)
    assert [(r.action, r.outcome, r.attempts) for r in found.filter("request_id = 'i:g1|b'").orderBy("action").collect()] == [
        ("delete_member", "exists", 3), ("insert_member", "exists", 3)]


def test_bodies_move_only_where_they_are_asked_for(spark, requests):
    found = ledger.states(requests, ledger.record(answers(spark, []), answers(spark, LANDED)))
    assert "max_by" not in plan_of(ledger.refused(found)) and "min_by" not in plan_of(found.drop("body", "seq"))
    assert "max_by" in plan_of(found)


def test_members_after_folds_once(spark, requests):
    found = ledger.states(requests, ledger.record(answers(spark, []), answers(spark, LANDED)))
    store = spark.createDataFrame([("g1", "a", "MEMBER", "USER", None)],
                                  "google_groupid string, google_userid string, role string, type string, etag string")
    assert "max_by" not in plan_of(ledger.members_after(store, found))


def test_outbox_numbers_without_another_shuffle(spark):
    rows_ = spark.range(1000).selectExpr("concat('g', id) AS google_groupid")
    box = ordered_outbox([ChangeSet("delete_group", rows_, ["google_groupid"], F.struct("google_groupid"))], 20)
    plan = plan_of(box)
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 3
    got = box.orderBy("seq").collect()
    assert [r.seq for r in got] == list(range(1, 1001)) and {r.batch_no for r in got} == set(range(50))


def test_requests_and_answers_move_once(spark, requests):
    found = ledger.states(requests, ledger.record(answers(spark, []).limit(0), answers(spark, LANDED)))
    assert plan_of(found).count("Exchange hashpartitioning") == 2


def test_members_after_reads_the_store_once(spark, requests):
    found = ledger.states(requests, ledger.record(answers(spark, []), answers(spark, LANDED)))
    store = spark.createDataFrame([("g1", "a", "MEMBER", "USER"), ("g1", "a", "OWNER", "USER"), ("g1", "b", "OWNER", None), (None, "b", "OWNER", None)],
                                  "google_groupid string, google_userid string, role string, type string")
    after = ledger.members_after(store, found)
    assert plan_of(after).count("Scan ExistingRDD") == 1
    assert rows(after) == [("g1", "b", "OWNER", None), (None, "b", "OWNER", None)]


def test_slices_give_the_same_members(spark, requests, tmpdir_path, monkeypatch):
    """Inputs beyond a slice are worked off slice by slice, each of which shuffles its own rows alone."""
    requests.write.parquet(f"{tmpdir_path}/requests")
    answers(spark, LANDED).write.parquet(f"{tmpdir_path}/landed")
    landed = spark.read.parquet(f"{tmpdir_path}/landed")
    found = ledger.states(spark.read.parquet(f"{tmpdir_path}/requests"), ledger.record(landed.limit(0), landed))
    store = spark.createDataFrame([("g1", "b", "OWNER", "USER", "old"), ("g1", "d", "MEMBER", "USER", None), ("g9", "z", "OWNER", "USER", None)],
                                  "google_groupid string, google_userid string, role string, type string, etag string")
    whole = rows(ledger.members_after(store, found))
    sizes = sum(os.path.getsize(f) for d in ("requests", "landed") for f in glob.glob(f"{tmpdir_path}/{d}/*.parquet"))
    monkeypatch.setattr(ranking, "SLICE_BYTES", -(-sizes // 3))
    assert ranking.slices_of(found) == 3
    kept = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(kept))
    assert rows(ledger.members_after(store, found)) == whole == [("g1", "b", "OWNER", "USER", "old"), ("g9", "z", "OWNER", "USER", None)]
    assert len(set(os.listdir(kept)) - before) == 1  # the settled requests went, their last ones per member are there
    plan = plan_of(found.filter(F.pmod(F.xxhash64("request_id"), F.lit(3)) == 1))
    below = [part for part in plan.split("Exchange hashpartitioning")[1:]]
    assert len(below) == 2 and all("Filter" in part and "pmod(xxhash64(request_id" in part for part in below)


def test_shuffles_go_with_the_write(spark):
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    shuffled = lambda: {f for f in disk.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f and f.endswith(".data")}
    before = shuffled()
    kept = ranking.materialize(spark.range(1000).repartition(4, "id"))
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before and kept.count() == 1000


def test_states_follow_the_rules_request_by_request(spark):
    """Any mix of answers and repeated, unnamed and unknown requests, against the rules in plain Python."""
    rng = random.Random(5)
    asked = [(rng.choice([None, *"abcdefghij"]), rng.choice(["insert_member", "delete_member", "delete_group", None]), n) for n in range(30)]
    tried = [(i, n, rng.choice([None, 200, 204, 403, 404, 409, 410, 429, 503]), rng.choice([None, ("u", rng.choice([None, "OWNER"]), None, f"e{rng.randrange(3)}")]))
             for i in "abcdefghxy" for n in rng.sample(range(1, 9), rng.randrange(1, 5))]

    def outcome(action, status):
        insert = action is not None and action.startswith("insert")
        return ("pending" if status is None else "done" if 200 <= status < 300 else "exists" if insert and status == 409 else
                "absent" if action is not None and not insert and status in (404, 410) else "retry" if status in (408, 429) or status >= 500 else "rejected")

    least = lambda v: (v is not None, () if v is None else tuple((x is not None, x or "") for x in v) if isinstance(v, tuple) else v)
    want = []
    for i, action, seq in asked:
        of = [(outcome(a, s) in ledger.SETTLED, n, outcome(a, s), s, body) for j, n, s, body in tried for k, a, _ in asked if i == j == k]
        best = max(of, key=lambda o: (*o[:3], least(o[3]), least(o[4])), default=None)
        n = max((o[1] for o in of), default=0)
        said = "pending" if best is None else "failed" if best[2] == "retry" and n >= 5 else best[2]
        want.append((i, action, seq, said, n, best and best[3], best and best[4]))
    got = ledger.states(spark.createDataFrame(asked, "request_id string, action string, seq long"), answers(spark, tried)).collect()
    key = lambda r: r[2]
    assert sorted(((*r[:6], r.body and tuple(r.body)) for r in got), key=key) == sorted(want, key=key)
