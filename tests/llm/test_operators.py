"""The operators against plain versions of themselves, on small tables with every odd case."""

import hashlib
import itertools
import random
import re
import unicodedata
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.llm import (chat_format, decontaminate, mixing, near_dedup, pii, quality_rules, secret_scan, token_files,
                          token_lengths, toxicity)
from rollcall.llm.common import table

DOCS = "doc_id long, text string, lang string, source string, n_chars long, doc string, node string"
SF = "/root/testdata/sf0.001"


def words(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


@pytest.fixture(scope="module")
def docs(spark):
    """Real rows, with nulls, blanks, copies, one very long text and columns whose names the operators use themselves."""
    real = table(spark, SF, "documents").withColumn("doc", F.lit("x")).withColumn("node", F.lit(None).cast("string"))
    first = real.orderBy("doc_id").limit(1).first()
    long = " ".join(f"word{i % 997} Ünï{i}" for i in range(30_000))
    odd = [(None, None, None, None, None, None, None), (9001, "", "en", "src0", 0, None, None), (9002, None, "en", "src0", 0, None, None),
           (9003, "  \n\t ", "en", None, 5, None, None), (9004, "one two", "en", None, 7, None, None), (9004, "one two", "en", None, 7, None, None),
           (9005, first.text, "en", "src1", 1, "y", None), (9006, long, "en", "src1", len(long), None, None),
           (9007, first.text, "en", "src1", 1, "y", None), (9007, first.text, "en", "src1", 1, "y", None)]
    return real.unionByName(spark.createDataFrame(odd, DOCS)).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return docs.collect()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def test_decontaminate(spark, docs, rows, empty):
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    some = [r.text for r in rows if r.text and len(words(r.text)) > 40][:3]
    items += [(None, " ".join(words(some[0])[3:20])), (7001, some[1]), (7001, some[2]), (7002, None), (7003, "..."), (7004, "the that"), (7005, "THE"),
              (7006, some[1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[i:i + 13]), set()).update(set() if item is None else {str(item)})
    want = []
    for r in rows:
        w = words(r.text)
        hit, ids = set(), set()
        for m in {len(x) for x in windows}:
            for i in range(len(w) - m + 1):
                if (found := windows.get(tuple(w[i:i + m]))) is not None:
                    hit.update(range(i, i + m))
                    ids |= found
        want.append((r.doc_id, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(),
                     bool(hit) and 20 * len(hit) >= len(w)))
    key = lambda t: tuple((x is None, x) for x in t)
    for block in (200_000, 50):
        got = [tuple(r) for r in decontaminate.report(docs, bench, block_windows=block).collect()]
        assert sorted(got, key=key) == sorted(want, key=key)
    kept = decontaminate.clean(docs, bench)
    assert kept.columns == docs.columns and kept.count() == sum(not w[5] for w in want)
    assert decontaminate.report(empty, bench).count() == 0
    assert decontaminate.report(docs, bench.limit(0)).where("n_hit > 0 or contaminated").count() == 0


def test_decontaminate_blocks_are_bounded_within_an_item():
    items = [(1, " ".join(f"w{i}" for i in range(112))), (2, "w5 w6"), (3, " ".join(f"w{i}" for i in range(20)))]
    blocks = list(decontaminate.window_blocks(items, 13, 30))
    assert [len(b) for b in blocks] == [30, 30, 30, 19]
    merged = {}
    for block in blocks:
        for window, ids in block.items():
            merged.setdefault(window, set()).update(ids)
    assert merged == next(decontaminate.window_blocks(items, 13, 1_000))


def test_secret_base_spans(docs, rows, empty):
    either = lambda s: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in s)
    names = "|".join(either(s) for s in ("password", "passwd", "secret", "token")) + "|" + either("api") + "_?" + either("key")
    assign = re.compile(rf"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    extra = ["token=token:abcdefgh", "API_KEY = 'abc' secret: \"é\" passwd=ABCDEF.", "😀 AKIA" + "Z9" * 9 + " AKIAshort AKIAAKIA" + "Q" * 15,
             "00" * 12 + "g" + "ab" * 11 + " " + "cd" * 20, "x = 'Zk3Qp9vT7bLw2Rj8XyN4'", "statementoffinancialposition2024", "api_kEy:aaaaaaſ"]
    spark = docs.sparkSession
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(9100 + i, t) for i, t in enumerate(extra)], "doc_id long, text string"))
    found = {}
    for r in secret_scan.report(more).collect():
        found.setdefault(r.doc_id, []).append(r)
    for r in more.collect():
        t = r.text or ""
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 6]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        text = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))
        for got in found[r.doc_id]:
            assert got.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
            assert [got.n_assign, got.n_access, got.n_hex] == [sum(s[1] == k for s in spans) for k in range(3)]
            assert [s for s in got.spans.split(",") if s and not s.startswith("markov")] == [s for s in text.split(",") if s]
    assert "markov:5:25" in found[9104][0].spans  # a random key
    assert "markov" not in found[9105][0].spans  # words with a year
    assert secret_scan.report(empty).count() == 0


def test_secret_model(docs):
    spark = docs.sparkSession
    table_ = secret_scan.train(secret_scan.samples(docs.select("doc_id", "text")))
    rnd = random.Random(5)
    keys = ["".join(rnd.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(28)) for _ in range(200)]
    ordinary = ["thereafter_and_then_over2024", "configuration-manager-output1", "innerclassnames_forthe_report3"]
    rows = spark.createDataFrame([(k, 1) for k in keys] + [(k, 0) for k in ordinary], "t string, label int")
    got = rows.select("label", (secret_scan.score(F.col("t"), table_) >= secret_scan.THRESHOLD).alias("hit")).collect()
    assert sum(r.hit for r in got if r.label) >= 190 and not any(r.hit for r in got if not r.label)


def test_secret_runs_of_letters_and_beside_base_spans(docs):
    """The whole scan, gates included."""
    table_ = secret_scan.train(secret_scan.samples(docs.select("doc_id", "text")))
    rnd = random.Random(7)
    letters = ["".join(rnd.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") for _ in range(28)) for _ in range(100)]
    key = "wJalrXUtnFEMIbK7MDENGbPxRfiCYqTzLpKcHvQs"
    beside = {"AKIA" + "Z9" * 8 + "/" + key: "access:0:20,markov:20:61", "id=" + "0a" * 12 + "/" + key: "hex:3:27,markov:27:68",
              key + "/" + "0a" * 12 + "/" + key: "markov:0:41,hex:41:65,markov:65:106", "0a" * 12 + "/short1": "hex:0:24",
              "Donaudampfschifffahrtsgesellschaftskapitaen": "", "-" * 30: ""}
    rows_ = docs.sparkSession.createDataFrame([(t,) for t in [*letters, *beside]], "text string")
    got = {r.text: r.spans for r in secret_scan.scan(rows_, table_).select("doc.text", secret_scan.joined("spans").alias("spans")).collect()}
    assert {t: got[t] for t in beside} == beside
    assert sum(got[t] == "markov:0:28" for t in letters) >= 95, sum(got[t] == "markov:0:28" for t in letters)


def test_pii(docs, rows, empty):
    found = {}
    for r in pii.report(docs).collect():
        found.setdefault(r.doc_id, []).append(r)
    for r in rows:
        base = brute.pii_base(r.text)
        text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base)
        for got in found[r.doc_id]:
            assert got.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
            assert [got.n_email, got.n_ip, got.n_card, got.n_phone] == [sum(s[0] == k for s in base) for k in range(4)]
    assert pii.report(empty).count() == 0
    rnd = random.Random(3)
    bits = ["1", "23", "255", ".", ".", "@", "a", "b-", "+", "+4", " ", "-", "(", ")", "é", "4111 1111 1111 1111", "x@y.z", "0", "%", "256"]
    for _ in range(20_000):
        t = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 14)))
        assert [s for s in pii.spans(t) if s[0] < 4] == brute.pii_base(t), t


def test_pii_method_spans(spark):
    t = "See https://a.example.org/x?q=1. Account no: AB-123456, IBAN GB82 WEST 1234 5698 7654 32 and mailto:me@x.org; iban DE00 1234 5678 9012"
    kinds = [(pii.KINDS[k], t[a:b]) for k, a, b in pii.spans(t) if k >= 4]
    assert kinds == [("url", "https://a.example.org/x?q=1"), ("url", "mailto:me@x.org"), ("account", "AB-123456"), ("account", "GB82 WEST 1234 5698 7654 32")]
    one = spark.createDataFrame([(1, t, "k"), (2, None, "k")], "doc_id long, text string, spans string")
    out = pii.masked(one, ("email", "account")).orderBy("doc_id").collect()
    assert "AB-123456" not in out[0].text and "[account]" in out[0].text and out[1].text is None and out[0].spans == "k"
    assert [s.kind for s in pii.scan(one).where("doc.doc_id = 1").first().spans][-1] == "account"


def test_quality_counts(docs, rows, empty):
    more = ["a b c a b c a b c d", "x x x x x x", "a b c\n\na b c\n \nq…\nend...", "#*$%&|<> é\x0bü\x0cz"]
    spark = docs.sparkSession
    all_docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(9200 + i, t) for i, t in enumerate(more)], "doc_id long, text string"))
    found = {}
    for r in quality_rules.report(all_docs).collect():
        found.setdefault(r.doc_id, []).append(r)
    for r in all_docs.collect():
        t = r.text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        twice = {g for g in grams if grams.count(g) > 1} if len(grams) < 3000 else {g for g, n in __import__("collections").Counter(grams).items() if n > 1}
        covered = {i + k for i, g in enumerate(grams) if g in twice for k in range(3)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
        for got in found[r.doc_id]:
            assert (got.n_words, got.word_chars, got.n_symbols, got.n_dup_lines, got.n_repeat_words) == want, r.doc_id
            assert got.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and not (got.base_failed and got.kept)
    kept = quality_rules.accepted(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in quality_rules.report(docs).collect())
    assert quality_rules.report(empty).count() == 0


def test_near_dedup(docs, rows, empty):
    """Classes equal the components of all pairs, with edited copies of one text about the threshold."""
    spark = docs.sparkSession
    rnd = random.Random(2)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(300)]
    near = []
    for i in range(40):
        w = list(base)
        for _ in range(rnd.randrange(12)):
            w[rnd.randrange(300)] = f"n{rnd.randrange(10**6)}"
        near.append((9300 + i, " ".join(w)))
    table_ = docs.select("doc_id", "text").unionByName(spark.createDataFrame(near, "doc_id long, text string"))
    all_rows = table_.collect()
    sets = []
    for r in all_rows:
        w = words(r.text)
        sets.append(frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    head = list(range(len(all_rows)))

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    for i, j in itertools.combinations(range(len(all_rows)), 2):
        same = (all_rows[i].text or "") == (all_rows[j].text or "")
        if same or sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
            head[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i, r in enumerate(all_rows):
        groups.setdefault(find(i), []).append(r.doc_id)
    want = sorted((d if d is not None else -1, min([x for x in g if x is not None], default=None) or 0, len(g)) for g in groups.values() for d in g)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.class_id or 0, r.n_class) for r in near_dedup.report(table_).collect())
    assert got == want
    kept = near_dedup.deduplicate(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in near_dedup.deduplicate(table_).select("doc_id").collect()]
    assert len(ids) == len(groups) and sorted(i for i in ids if i is not None) == sorted(
        x for x in (min([d for d in g if d is not None], default=None) for g in groups.values()) if x is not None)
    assert near_dedup.report(empty).count() == 0 and near_dedup.deduplicate(empty).count() == 0


def test_near_dedup_repeated_unshared_passages(spark):
    """Pairs of plain Jaccard 0.89 of which one text repeats a passage (a footer, a menu) that the other lacks."""
    rnd = random.Random(6)
    made = []
    for i in range(40):
        shared = [f"s{i}x{rnd.randrange(10**6)}" for _ in range(104)]
        footer = [f"f{i}x{k}" for k in range(8)] * (30 if i % 2 else 300)
        made += [(2 * i, " ".join(shared)), (2 * i + 1, " ".join(shared + footer))]
    got = near_dedup.report(spark.createDataFrame(made, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.class_id, r.n_class) for r in got) == [(d, d // 2 * 2, 2) for d in range(80)]


def test_prob_min_hash_estimates_probability_jaccard():
    rng = np.random.default_rng(1)
    keys = rng.integers(1, 2**53, 400).astype(np.uint64)
    a = {k: w for k, w in zip(keys[:300], rng.integers(1, 6, 300))}
    b = {k: w for k, w in zip(keys[100:], rng.integers(1, 6, 300))}
    exact = 0.0
    for k in set(a) & set(b):
        exact += 1 / sum(max(a.get(j, 0) / a[k], b.get(j, 0) / b[k]) for j in set(a) | set(b))
    ks = [np.array(list(x), np.uint64) for x in (a, b)]
    ws = [np.array(list(x.values()), float) for x in (a, b)]
    row = np.concatenate([np.zeros(300, np.int64), np.ones(300, np.int64)])
    kept = near_dedup.prob_min_hash(row, np.concatenate(ks), np.concatenate(ws), 2, 4096)
    assert abs((kept[0] == kept[1]).mean() - exact) < 0.03


@pytest.mark.parametrize("n", [1, 2, 3, 100, 5000])
def test_huffman_round_trip(n):
    rng = np.random.default_rng(n)
    counts = (rng.pareto(0.5, n) * 10 + 1).astype(np.int64)
    lengths = token_files.code_lengths(counts, 14)
    assert lengths.max() <= 14 and (n == 1 or abs(sum(2.0 ** -lengths) - 1) < 1e-9)
    code, ids = token_files.Code(lengths, 14), rng.integers(0, n, 10_007)
    bits, checkpoints = code.encode(ids)
    assert (code.decode(bits, checkpoints, len(ids)) == ids).all()


def test_huffman_is_optimal_when_not_limited():
    import heapq

    counts = np.array([50, 3, 3, 1, 8, 13, 21, 5])
    heap, total = list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        pair = heapq.heappop(heap) + heapq.heappop(heap)
        total += pair
        heapq.heappush(heap, pair)
    assert (token_files.code_lengths(counts, 12) * counts).sum() == total


def test_token_files(docs, rows, empty):
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    odd = ["<|endoftext|> a<|startoftext|>b", "Tab\there\r\nand\x0bthere x", "İstanbul ΣΑΣ é ́x", "a" * 5000]
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(9400 + i, t) for i, t in enumerate(odd)], "doc_id long, text string"))
    tokenizer = Tokenizer.from_file(token_files.default_tokenizer())
    want = []
    for r in more.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1]
        want.append((r.doc_id, len(ids), token_files.crc32(ids)))
    got = [tuple(r) for r in token_files.report(more, block_tokens=5000).orderBy("start").collect()]
    at = 0
    for doc_id, start, n, _ in got:
        assert start == at
        at += n
    ids = [r[0] for r in got]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))
    key = lambda t: tuple((x is None, x) for x in t)
    assert sorted(((d, n, c) for d, _, n, c in got), key=key) == sorted(want, key=key)
    assert token_files.report(empty).count() == 0


def test_toxicity(spark, docs, empty):
    rnd = random.Random(4)
    syllables = ["an", "the", "or", "ent", "ing", "sh", "ou", "ble", "ti", "re"]
    word = lambda: "".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4)))
    bad = ["vileword", "nastything", "cruelslur", "awfulname"]
    made, labels = [], []
    for i in range(400):
        w = [word() for _ in range(rnd.randint(20, 200))]
        toxic = i % 2
        if toxic:
            for _ in range(3):
                x = rnd.choice(bad)
                if zlib.crc32(str(i).encode()) % 5 == 0:  # misspelt where held out
                    k = rnd.randrange(2, len(x) - 1)
                    x = x[:k] + x[k + 1:]
                w.insert(rnd.randrange(len(w)), x)
        made.append((i, " ".join(w)))
        labels.append((i, 1, toxic))
    made += [(None, None), (5000, ""), (5000, "")]
    d = spark.createDataFrame(made, "doc_id long, text string").withColumn("score", F.lit("x"))
    lab = spark.createDataFrame(labels + [(None, 0, None), (1, None, None)], "doc_id long, quality int, toxic int")
    got = toxicity.report(d, lab).collect()
    assert len(got) == len(made) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.doc_id is not None and r.doc_id < 400 and r.held_out]
    assert len(held) > 50 and sum(r.predicted == r.doc_id % 2 for r in held) >= 0.9 * len(held)
    assert toxicity.report(empty, lab).count() == 0
    assert {r.score for r in toxicity.report(d, lab.limit(0)).collect()} == {0.5}


def test_mixing(docs, rows, empty):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    totals = {}
    for r in rows:
        totals[r.source] = totals.get(r.source, 0) + size(r.text)
    weight = {s: i % 3 + 1 for i, s in enumerate(sorted(totals, key=lambda s: (s is None, s or "")))}
    capped = set()
    while True:
        left = sum(totals.values()) - sum(3 * totals[s] for s in capped)
        share = left / sum(w for s, w in weight.items() if s not in capped)
        target = {s: 3.0 * totals[s] if s in capped else share * w for s, w in weight.items()}
        over = {s for s in target if target[s] > 3 * totals[s] + 1e-9}
        if not over:
            break
        capped |= over
    got = mixing.report(docs).collect()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    taken = {}
    for r in got:
        d = by_id[r.doc_id][0]
        assert (r.size, r.source_size) == (size(d.text), totals[d.source]) and r.target == pytest.approx(target[d.source])
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[d.source] = taken.get(d.source, 0) + r.taken
    biggest = {s: max(size(r.text) for r in rows if r.source == s) for s in totals}
    assert all(abs(taken[s] - target[s]) <= biggest[s] + 1e-6 for s in totals)
    again = mixing.report(docs.repartition(7)).collect()
    key = lambda t: tuple((x is None, x) for x in t)
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, again), key=key)
    mix = mixing.mixed(docs)
    assert mix.columns == docs.columns
    assert sum(size(r.text) for r in mix.collect()) == sum(r.taken for r in got)
    assert mixing.report(empty).count() == 0 and mixing.mixed(empty).count() == 0


def test_pivot_keeps_words_and_expectation():
    rng = np.random.default_rng(0)
    ends = []
    for draw in rng.random(20_000):
        a, b = mixing.pivot(0.3, 100, 0.6, 70, draw)
        assert a * 100 + b * 70 == pytest.approx(72) and min(abs(a), abs(1 - a), abs(b), abs(1 - b)) < 1e-9
        ends.append((a, b))
    assert np.allclose(np.mean(ends, axis=0), [0.3, 0.6], atol=0.01)


def test_token_lengths(docs, rows, empty):
    encode = token_lengths.encoding(token_lengths.default_ranks()).encode_ordinary
    lengths = {}
    for r in rows:
        lengths.setdefault(r.source, []).append(len(encode(r.text or "")))
    got = token_lengths.report(docs).collect()
    assert len(got) == sum(len(set(x)) for x in lengths.values())
    for r in got:
        own = lengths[r.source]
        assert r.n_docs == own.count(r.length) and r.n_longer == sum(x > r.length for x in own)
        assert r.truncated_total == sum(min(x, r.length) for x in own) and r.lost == sum(own) - r.truncated_total
    sums = token_lengths.with_sums(token_lengths.histogram(docs, ["source"]), ["source"])
    for r in token_lengths.at_limits(sums, ["source"], [0, 64, 10**7]).collect():
        own = lengths[r.source]
        assert (r.truncated_total, r.n_longer) == (sum(min(x, r.limit) for x in own), sum(x > r.limit for x in own))
    for r in token_lengths.quantiles(sums, ["source"], [0.5, 1.0]).collect():
        own = sorted(lengths[r.source])
        assert r.length == own[max(0, -(-int(r.share * 100) * len(own) // 100) - 1)]
    assert token_lengths.report(empty).count() == 0


def test_chat_repair_is_cheapest():
    table_ = chat_format.steps()
    rnd = random.Random(1)
    for _ in range(300):
        roles = [rnd.choice([-1, 1, 2, 3]) for _ in range(rnd.randint(1, 6))]
        best = min(sum(table_[r].get((s, t), (chat_format.FAR,))[0] for r, s, t in zip(roles, (0,) + p, p))
                   for p in itertools.product((1, 2, 3), repeat=len(roles)))
        assert sum(x[3] for x in chat_format.repair(roles, table_)) == best


def test_chat_format(spark):
    """Odd conversations, one of them over many partitions, against the one-task repair."""
    rnd = random.Random(8)
    turns = [(1, i, rnd.choice(["user", "assistant", "system", "User ", "tool", None]), f"t{i}") for i in range(700)]
    turns += [(2, 0, "assistant", "hi"), (2, 1, "user", None), (3, None, "human", "a"), (3, 1, "bot", "b"), (3, 1, "bot", "b"), (None, 0, "user", "n"),
              (4, 0, "system", "s"), (4, 1, "system", "s2"), (4, 2, "user", "x" * 100_000)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("row", F.lit(1)).withColumn("position", F.lit(2))
    table_ = chat_format.steps()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        got = chat_format.report(df).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(got) == len(turns)
    for conv in (1, 2, 3, 4, None):
        own = sorted((r for r in got if r.conv_id == conv), key=lambda r: r.position)
        assert [r.position for r in own] == list(range(len(own)))
        want = chat_format.repair([chat_format.role_number(r.role_in) for r in own], table_)
        assert sum(r.cost for r in own) == sum(w[3] for w in want)
        text = "".join(r.rendered for r in own)
        seen = re.findall(r"<\|im_start\|>(\w+)\n", text)
        state = 0
        for role in seen:  # the rendered roles are a legal path
            assert chat_format.ROLES.index(role) in chat_format.LEGAL[state]
            state = chat_format.ROLES.index(role)
        assert text.count("<|im_start|>") == text.count("<|im_end|>")
        for r in own:
            source = next(t[3] for t in turns if t[0] == conv and t[1] == r.turn and (t[2] == r.role_in))
            assert (source or "") in r.rendered
    assert chat_format.report(df.limit(0)).count() == 0


def test_remembered_chunks_equal_whole_texts():
    from rollcall.llm.token_files import Encoder, default_tokenizer

    texts = ["a.,b  c!!", "İi İİ ab cd", "J̌. x", "<|endoftext|>. hi.", "don't. it's, 12.5, x.́ y", ".. ,", "", "½. x².",
             "Σ. ΑΣ, é. é.", "!?x?!", "one two. three, two one!"] * 3
    whole = Encoder(default_tokenizer(), by_chunk=False).encode(texts)
    for keep in (1, 5, 1_000):
        chunked = Encoder(default_tokenizer(), keep=keep)
        assert [chunked.encode([t])[0] for t in texts] == whole


def test_stops_behind_letters_that_fall_apart():
    """Letters that NFC or lower case turns into a letter and a mark, which joins the stop behind it."""
    from rollcall.llm.token_files import Encoder, default_tokenizer

    letters = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isalnum()
               and not re.fullmatch(r"\w+", unicodedata.normalize("NFC", chr(c)).lower())]
    assert {"\u0130", "\u0958", "\u09df", "\u0a33", "\ufb1d"} <= set(letters)
    texts = ["HAKKAR\u0130, \u09b9\u09df, HAKKAR\u0130"] + [f"{c}, a{c}.: {c}" for c in letters]
    whole = Encoder(default_tokenizer(), by_chunk=False).encode(texts)
    chunked = Encoder(default_tokenizer())
    assert [chunked.encode([t])[0] for t in texts] == whole


def test_a_slice_of_texts_takes_little_memory():
    """What a worker holds to encode one slice of texts, however long its table is."""
    import tracemalloc

    import pyarrow as pa

    from rollcall.llm import token_files

    enc = token_files.encoder(token_files.default_tokenizer())
    text = "the cat sat on a mat, so it is. " * (token_files.TEXT_BYTES // 32 // 64)
    tracemalloc.start()
    enc.encode_column(pa.array([text] * 64), 1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20


def test_a_stop_behind_a_plain_word_is_told_by_its_bytes(monkeypatch):
    """One stop behind an ASCII letter or digit needs no look at the word in Python."""
    from rollcall.llm import token_files

    texts = ["The cat, a dog; 12% of x9. Yes! No? a#b# c$ (d, é, e", "", ". ,", "end."]
    whole = token_files.Encoder(token_files.default_tokenizer(), by_chunk=False).encode(texts)
    looked = []
    monkeypatch.setattr(token_files, "ends_apart", lambda word, plain=token_files.ends_apart: looked.append(word) or plain(word))
    assert token_files.Encoder(token_files.default_tokenizer()).encode(texts) == whole
    assert set(looked) <= {"é", ""}
