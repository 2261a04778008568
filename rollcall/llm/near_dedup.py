"""Operator 4: near duplicates by ProbMinHash, banding and exact verification.

Method.  A text is the set of its five-word shingles (a text of fewer words, but not none, is one shingle).
ProbMinHash1a draws for each shingle a Poisson process of arrivals with rate equal to its weight; each arrival picks
one of ``registers`` registers, which keeps its earliest arrival's shingle.  A shingle stops as soon as its next
arrival is later than every register of its text, so most shingles draw once.  Two texts agree in a register with
the probability Jaccard of their weighted sets.  Bands of ``rows`` registers make the buckets; pairs
that meet in a bucket are verified by the exact Jaccard of their shingle sets, which defines a link.

Two signatures make candidates.  In one a shingle weighs 1 + ln(its count in the text), so texts that repeat the same
passages meet; in the other every shingle weighs 1, so that the register agreement is the verified Jaccard itself and a
passage that only one of two texts repeats hides no link.  The sketch that rules pairs out is of the second kind.

No pairs within a group.  The nodes are distinct texts (identical texts collapse by their md5 first).  In each of
``pivot_rounds`` rounds every bucket that still holds two or more components compares one pivot with its members
outside the pivot's component, and verified links merge components, so n near copies cost about n comparisons for
each round.  Then all pairs left across components of a bucket are compared.  So two texts that share a bucket end in
one component or have been compared: no link is lost to the pivots.  A pair is compared by its shingles
unless its set sizes alone rule the similarity out, or its registers disagree far too often (two bits of each
of 256 registers; a pair is passed over only where the estimate lies ``sigmas`` = 3 standard deviations below
the similarity: a chance of 2e-3 for a pair at the threshold, 2e-4 at 0.82).  A pair that shares several
buckets is compared in one.  With 25 bands of 5 registers a pair at 0.8 shares a bucket with probability 1 - 5e-5, at
0.9 practically always.

Scale: a signature row is about 220 bytes; text is shuffled only for texts that share a bucket with another text.
Hot buckets are reduced by partial aggregates (pivot, least and greatest component) and joined back, where
adaptive execution may split the hot side.  Components come from large-star/small-star steps over links, never
on the driver.  Intermediates are tables in the shared folder.

Defined results: identical texts share a class whatever they hold, and a null text counts as empty; texts without a
word are otherwise alone.  The class id is the least doc_id of the class (null if it has none).  Repeated rows
are members like any other, and :func:`deduplicate` keeps exactly one row of a class (the least doc_id, null last).
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import LOWER, U64, map_arrow, mix, slices, span_hashes, stored, uniform, utf8, word_spans

SHINGLE, REGISTERS, BANDS, ROWS, SIMILARITY, WEIGHTED_BANDS = 5, 256, 25, 5, 0.8, 10
_PER_LONG = 32  # registers in a long of a sketch, two bits each
_KEY_BITS = U64(54)
_COEFFICIENTS = mix(np.arange(1, 65, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)


def shingles(buf: np.ndarray, offsets: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of at most 1,023 rows: row numbers, 54-bit keys and counts, ordered by row and key."""
    starts, ends, first = word_spans(buf, offsets)
    hashes = span_hashes(LOWER[buf], starts, ends)
    n_words = np.diff(first)
    n_shingles = np.where(n_words >= width, n_words - width + 1, np.minimum(n_words, 1))
    row = np.repeat(np.arange(len(n_words)), n_shingles)
    at = np.arange(len(row)) - np.repeat(np.cumsum(n_shingles) - n_shingles, n_shingles) + first[:-1][row]
    end = first[1:][row]
    padded = np.concatenate([hashes, np.zeros(width, U64)])
    key = np.zeros(len(row), U64)
    for k in range(width):
        key += np.where(at + k < end, padded[at + k] * _COEFFICIENTS[k], U64(0))
    tagged = np.sort((row.astype(U64) << _KEY_BITS) | (mix(key) >> U64(10)))
    new = np.ones(len(tagged), bool)
    new[1:] = tagged[1:] != tagged[:-1]
    where = np.flatnonzero(new)
    counts = np.diff(np.append(where, len(tagged)))
    tagged = tagged[where]
    return (tagged >> _KEY_BITS).astype(np.int64), tagged & U64((1 << 54) - 1), counts


def prob_min_hash(rows: np.ndarray, keys: np.ndarray, weights: np.ndarray, n_rows: int, registers: int) -> np.ndarray:
    """The shingle kept by each register: an array (n_rows, registers); a row without shingles holds zeros."""
    earliest = np.full(n_rows * registers, np.inf)
    kept = np.zeros(n_rows * registers, U64)
    base, arrival, turn = mix(keys + U64(0x632BE59BD9B4E019)), np.zeros(len(keys)), 0
    rate, ids = weights.astype(np.float64), mix(keys ^ U64(0x8CB92BA72F3D8DD7)) | U64(1)
    while len(rows):
        turn += 1
        draw = mix(base + U64((turn * 0x9E3779B97F4A7C15) & (2**64 - 1)))
        arrival = arrival - np.log(uniform(draw)) / rate
        register = rows * registers + (mix(draw ^ U64(0xD6E8FEB86659FD93)) % U64(registers)).astype(np.int64)
        np.minimum.at(earliest, register, arrival)
        won = earliest[register] == arrival
        kept[register[won]] = ids[won]
        alive = np.unique(rows) if turn > 8 else np.arange(n_rows)
        latest = np.zeros(n_rows)
        latest[alive] = earliest.reshape(n_rows, registers)[alive].max(axis=1)
        on = arrival < latest[rows]
        rows, base, ids, rate, arrival = rows[on], base[on], ids[on], rate[on], arrival[on]
    return kept.reshape(n_rows, registers)


def band_keys(kept: np.ndarray, bands: int, rows: int, first: int = 1) -> np.ndarray:
    """Bucket keys of bands numbered from ``first`` on."""
    key = np.broadcast_to(np.arange(first, first + bands, dtype=U64) * U64(0xA0761D6478BD642F), (len(kept), bands)).copy()
    for k in range(rows):
        key = mix(key ^ kept[:, k:bands * rows:rows])
    return key.view(np.int64)


def sketch(kept: np.ndarray) -> np.ndarray:
    """Two bits of each register, packed into longs: an array (n, registers / 32)."""
    n, registers = kept.shape
    bits = np.zeros((n, -(-registers // _PER_LONG) * _PER_LONG), U64)
    bits[:, :registers] = kept >> U64(20) & U64(3)
    return np.bitwise_or.reduce(bits.reshape(n, -1, _PER_LONG) << (U64(2) * np.arange(_PER_LONG, dtype=U64)), axis=2).view(np.int64)


def may_reach(similarity: float, registers: int, a: str, b: str, sigmas: float = 3.0) -> Column:
    """False where the sizes or the sketches (columns s0, s1, ...) of rows ``a`` and ``b`` rule the similarity out."""
    differ = []
    for i in range(-(-registers // _PER_LONG)):
        x = F.col(f"{a}.s{i}").bitwiseXOR(F.col(f"{b}.s{i}"))
        differ.append(F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555))))
    share = 3 / 4 * (1 - similarity)
    most = int(registers * share + sigmas * (registers * share * (1 - share)) ** 0.5)
    n, m = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    return (n >= similarity * m) & (m >= similarity * n) & (sum(differ[1:], differ[0]) <= most)


def node_of(text: Column) -> Column:
    """Identity of a text: its md5 (a null counts as empty)."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def signatures(docs: DataFrame, registers: int = REGISTERS, bands: int = BANDS, rows: int = ROWS, width: int = SHINGLE,
               weighted_bands: int = WEIGHTED_BANDS) -> DataFrame:
    """One row per distinct text: node, n_shingles, the sketch of the registers of plain weights and the bucket keys of both kinds
    of weights (none for a text without words)."""
    per_row = -(-registers // _PER_LONG)

    def sign(batches):
        for batch in batches:
            buf, offsets = utf8(batch.column(1))
            sizes, keys, lengths, sketches = [], [], [], [np.zeros((0, per_row), np.int64)]
            for a, b in slices(offsets):
                row, key, count = shingles(buf[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], width)
                kept = prob_min_hash(row, key, np.ones(len(key)), b - a, registers)
                heavy = prob_min_hash(row, key, 1 + np.log(count), b - a, weighted_bands * rows) if weighted_bands else kept[:, :0]
                size = np.bincount(row, minlength=b - a)
                sizes.append(size)
                sketches.append(sketch(kept))
                both = np.concatenate([band_keys(kept, bands, rows), band_keys(heavy, weighted_bands, rows, bands + 1)], axis=1)
                keys.append(both[size > 0].ravel())
                lengths.append(np.where(size > 0, bands + weighted_bands, 0))
            cut = np.concatenate([[0], np.cumsum(np.concatenate(lengths))]) if lengths else np.zeros(1)
            values = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            size = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
            bits = np.concatenate(sketches)
            lists = [pa.ListArray.from_arrays(pa.array(o, pa.int32()), pa.array(v, pa.int64()))
                     for o, v in ((np.arange(len(bits) + 1) * per_row, bits.ravel()), (cut, values))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), *lists],
                                             ["node", "n_shingles", "sketch", "buckets"])

    texts = docs.select(node_of(F.col("text")).alias("node"), F.col("text").cast("string").alias("text"))
    return map_arrow(texts, sign, "node binary, n_shingles long, sketch array<long>, buckets array<long>").dropDuplicates(["node"])


def jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], width: int = SHINGLE) -> np.ndarray:
    """Jaccard of the shingle sets of paired rows of two text columns (bytes and offsets)."""
    out, (buf_a, off_a), (buf_b, off_b) = [], a, b
    for i, j in slices(off_a + off_b):
        sides = []
        for buf, off in ((buf_a, off_a), (buf_b, off_b)):
            sides.append(shingles(buf[off[i]:off[j]], off[i:j + 1] - off[i], width)[:2])
        (row_a, key_a), (row_b, key_b) = sides
        both = np.sort(np.concatenate([(row_a.astype(U64) << _KEY_BITS) | key_a, (row_b.astype(U64) << _KEY_BITS) | key_b]))
        same = (both[1:][both[1:] == both[:-1]] >> _KEY_BITS).astype(np.int64)
        n = j - i
        common = np.bincount(same, minlength=n)
        union = np.bincount(row_a, minlength=n) + np.bincount(row_b, minlength=n) - common
        out.append(np.where(union > 0, common / np.maximum(union, 1), 0.0))
    return np.concatenate(out) if out else np.zeros(0)


def verified(pairs: DataFrame, texts: DataFrame, similarity: float, width: int = SHINGLE) -> DataFrame:
    """The pairs (a, b) of nodes whose texts reach the similarity."""
    def check(batches):
        for batch in batches:
            good = pa.array(jaccard(utf8(batch.column(2)), utf8(batch.column(3)), width) >= similarity)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(good), batch.column(1).filter(good)], ["a", "b"])

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return map_arrow(both, check, "a binary, b binary")


def _single(edges: DataFrame) -> bool:
    """True if no node ``a`` has two edges; edges that also lead to no other ``a`` are stars."""
    return edges.groupBy("a").count().where("count > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``links`` (a, b): comp is the least node that it is connected to."""
    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    while not edges.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty() or not _single(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = stored(large, "large")
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(least.withColumnRenamed("m", "b"))
        edges = stored(small.distinct(), "small")
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    return stars.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())


def classes(docs: DataFrame, similarity: float = SIMILARITY, registers: int = REGISTERS, bands: int = BANDS,
            rows: int = ROWS, width: int = SHINGLE, pivot_rounds: int = 2, weighted_bands: int = WEIGHTED_BANDS) -> DataFrame:
    """(node, comp) for the texts that share a bucket with another text; the others are alone."""
    nodes = stored(signatures(docs, registers, bands, rows, width, weighted_bands), "signatures")
    spread = nodes.select(F.explode("buckets").alias("bucket"), "node")
    shared = spread.groupBy("bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi")
    members = stored(spread.join(shared.select("bucket"), "bucket"), "members")
    texts = docs.select(node_of(F.col("text")).alias("node"), F.col("text").cast("string").alias("text"))
    texts = stored(texts.join(members.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"]), "texts")

    longs = -(-registers // _PER_LONG)
    facts = stored(nodes.join(members.select("node").distinct(), "node", "left_semi").select(
        "node", "n_shingles", "buckets", *[F.col("sketch")[i].alias(f"s{i}") for i in range(longs)]), "facts")
    label = stored(facts.select("node", F.col("node").alias("comp")), "label")
    near = lambda x, y: may_reach(similarity, registers, x, y)
    first_met = F.array_min(F.array_intersect("x.buckets", "y.buckets")) == F.col("x.bucket")
    ordered = (F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
    tested: list[DataFrame] = []
    for turn in range(pivot_rounds + 1):
        now = members.join(label.join(facts, "node"), "node")
        split = now.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min_by(
            F.struct("node", "comp", "n_shingles", *[f"s{i}" for i in range(longs)]), F.xxhash64("node", F.lit(turn))).alias("x")).where("lo <> hi")
        if turn < pivot_rounds:
            pairs = now.alias("y").join(split.select("bucket", "x"), "bucket").where((F.col("x.comp") != F.col("y.comp")) & near("x", "y"))
        else:
            rest = stored(now.join(split.select("bucket"), "bucket"), "rest")
            pairs = rest.alias("x").join(rest.alias("y"), (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.comp") < F.col("y.comp")) & near("x", "y") & first_met)
        pairs = pairs.select(*ordered).distinct()
        if tested:
            pairs = pairs.join(reduce(DataFrame.unionByName, tested), ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        tested.append(pairs)
        links = verified(pairs, texts, similarity, width)
        for side in ("a", "b"):  # a link of two texts is one of their components
            links = links.join(label.select(F.col("node").alias(side), F.col("comp").alias(f"{side}_comp")), side)
        joined = components(links.select(F.col("a_comp").alias("a"), F.col("b_comp").alias("b")))
        label = stored(label.join(joined.select(F.col("node").alias("comp"), F.col("comp").alias("to")), "comp", "left").select(
            "node", F.coalesce("to", "comp").alias("comp")), "label")
    return label


def labelled(docs: DataFrame, **options) -> DataFrame:
    """``docs`` in struct ``doc`` with ``node`` and ``comp``, the identity of the row's class."""
    found = classes(docs, **options)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), node_of(docs["text"]).alias("node"))
    return rows.join(found, "node", "left").withColumn("comp", F.coalesce("comp", "node"))


def report(docs: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, class_id (the least doc_id of its class) and n_class, the documents in the class."""
    rows = stored(labelled(docs.select("doc_id", "text"), **options).select("doc.doc_id", "comp"), "labelled")
    # written, so that the join lies between plain exchanges and adaptive execution may split the rows of a large class
    heads = stored(rows.groupBy("comp").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("n_class")), "heads")
    return rows.join(heads, "comp").select("doc_id", "class_id", "n_class")


def deduplicate(docs: DataFrame, **options) -> DataFrame:
    """One row of each class (the least doc_id, then the least text identity), with the columns of ``docs``."""
    rows = labelled(docs, **options)
    order = F.struct(F.col("doc.doc_id").isNull().alias("none"), F.col("doc.doc_id").alias("id"), F.col("node").alias("node"))
    first = rows.groupBy("comp").agg(F.min(order).alias("keep"), F.count("*").alias("n"))
    keep = first.select("keep.id", "keep.node").withColumnRenamed("node", "keep_node")
    same = rows["node"] == keep["keep_node"]
    kept = rows.join(keep, same & rows["doc"]["doc_id"].eqNullSafe(keep["id"]), "left_semi")
    times = kept.groupBy("node").agg(F.count("*").alias("times")).where("times > 1").select("node")
    repeated = kept.join(times, "node", "left_semi").dropDuplicates(["node"])
    return kept.join(times, "node", "left_anti").select("doc.*").unionByName(repeated.select("doc.*"))
