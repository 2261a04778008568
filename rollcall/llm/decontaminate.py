"""Operator 2: benchmark decontamination by Wu-Manber multi-pattern search over words.

The symbols are lower-cased words, the patterns are windows of 13 consecutive words of the benchmark items (an
item of fewer words, but not none, is one window).  For each pattern length m a matcher holds

* a shift table from a block (the last two words read) to the number of words that can safely be skipped,
* for blocks with shift 0, a bucket of the patterns that end in this block,

and every candidate of a bucket is compared word by word.  Text without benchmark passages is crossed in steps
of up to m - 1 words.

Scale: documents are never shuffled; each task scans its own rows against broadcast matchers.  The benchmark is
the stated query set: it is streamed in blocks of at most ``block_windows`` distinct windows, which bounds the
broadcast and the memory of a task, and documents pass once per block (one block for up to 200,000 windows;
between blocks the found hits are written to the shared folder).

Defined results: a null or empty text has no words, so it is never hit.  A window that several items share
counts for each; an item id given on several rows counts once; a row without an id marks words as hit but
is no counted item.  Rows are judged one by one, so repeated rows repeat their result.  Without documents or
without a benchmark the result is empty or clean.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from typing import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import WORDS_ONLY, map_arrow, stored

WINDOW = 13


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(WORDS_ONLY).split() if text else []


class WuManber:
    """Patterns of one length m, each a tuple of words with the ids of its items."""

    def __init__(self, m: int, patterns: dict[tuple, set]):
        self.m, self.block = m, min(2, m)
        self.shift: dict = {}
        self.buckets: dict = defaultdict(lambda: defaultdict(dict))  # by the last block, then the first word
        for words, items in patterns.items():
            for end in range(self.block, m + 1):
                key = words[end - self.block:end]
                self.shift[key] = min(self.shift.get(key, m), m - end)
            self.buckets[words[m - self.block:]][words[0]][words] = sorted(items)
        self.buckets = {block: dict(heads) for block, heads in self.buckets.items()}

    def search(self, words: list[bytes], mask: bytearray, items: set) -> None:
        """Mark the words inside any occurrence and add the items found."""
        m, n, b, shift, buckets = self.m, len(words), self.block, self.shift, self.buckets
        default, at, get = m - b + 1, m, self.shift.get
        pairs = list(zip(words, words[1:])) if b == 2 else [(w,) for w in words]
        while at <= n:  # at: the end of the window
            key = pairs[at - b]
            step = get(key, default)
            if step:
                at += step
                continue
            patterns = buckets[key].get(words[at - m])
            if patterns is not None and (ids := patterns.get(tuple(words[at - m:at]))) is not None:
                mask[at - m:at] = b"\1" * m
                items.update(ids)
            at += 1


def matchers(windows: dict[tuple, set]) -> list[WuManber]:
    by_length: dict[int, dict] = defaultdict(dict)
    for words, items in windows.items():
        by_length[len(words)][words] = items
    return [WuManber(m, p) for m, p in sorted(by_length.items())]


def window_blocks(items: Iterable, width: int, block_windows: int) -> Iterator[dict[tuple, set]]:
    """Windows with their item ids, in blocks of at most ``block_windows``, whatever an item holds."""
    block: dict[tuple, set] = {}
    for item_id, text in items:
        words = words_of(text)
        ids = set() if item_id is None else {str(item_id)}
        for i in range(max(1, len(words) - width + 1) if words else 0):
            block.setdefault(tuple(words[i:i + width]), set()).update(ids)
            if len(block) >= block_windows:
                yield block
                block = {}
    if block:
        yield block


HITS = "n_words long, n_hit long, n_items long, items array<string>, mask binary"


def find(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW, block_windows: int = 200_000) -> DataFrame:
    """Each row of ``docs`` in struct ``doc`` with n_words, n_hit, n_items and the sorted item ids.

    ``docs`` needs a column ``text``; ``benchmark`` needs ``item_id`` and ``text``.
    """
    spark = docs.sparkSession
    state = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), F.lit(0).cast("long").alias("n_words"),
                        F.lit(0).cast("long").alias("n_hit"), F.lit(0).cast("long").alias("n_items"),
                        F.array().cast("array<string>").alias("items"), F.lit(None).cast("binary").alias("mask"))
    rows = benchmark.select("item_id", "text").toLocalIterator(prefetchPartitions=False)
    blocks = window_blocks(rows, width, block_windows)
    block = next(blocks, {})
    while True:
        state = _search(state, spark.sparkContext.broadcast(matchers(block)))
        block = next(blocks, None)
        if block is None:
            return state.drop("mask")
        state = stored(state, "hits")


def _search(state: DataFrame, shared) -> DataFrame:
    def search(batches):
        found = shared.value
        for batch in batches:
            doc = batch.column("doc")
            texts = doc.field("text") if not doc.null_count else doc.flatten()[doc.type.get_field_index("text")]
            out: list[list] = [[], [], [], [], []]
            for text, items, mask in zip(texts, batch.column("items"), batch.column("mask")):
                words = words_of(text.as_py())
                seen = bytearray(mask.as_py() or bytes(len(words)))
                ids = set(items.as_py() or ())
                for m in found:
                    m.search(words, seen, ids)
                hit = seen.count(1)
                for column, value in zip(out, (len(words), hit, len(ids), sorted(ids), bytes(seen) if hit else None)):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.binary())
            yield pa.RecordBatch.from_arrays([doc, *[pa.array(v, k) for v, k in zip(out, kinds)]],
                                             ["doc", "n_words", "n_hit", "n_items", "items", "mask"])

    return map_arrow(state, search, state.schema)


def contaminated(n_hit="n_hit", n_words="n_words"):
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


def report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items_sha256 and the verdict."""
    slim = docs.select("doc_id", "text")
    found = find(slim, benchmark, **options)
    return found.select("doc.doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
                        contaminated().alias("contaminated"))


def digest(items: Iterable[str]) -> str:
    """The items_sha256 of a document, for checks."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows that are not contaminated, with the columns of ``docs``."""
    return find(docs, benchmark, **options).where(~contaminated()).select("doc.*")


ORACLE_SQL = r"""
WITH doc_words AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS m, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS words
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM item_words WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT m FROM windows),
grams AS (
  SELECT r, m, i, array_to_string(w[i:i + m - 1], ' ') AS words
  FROM (SELECT r, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i FROM doc_words JOIN lengths ON len(w) >= m)),
found AS (SELECT g.r, g.i, g.m, x.item_id FROM grams g JOIN windows x ON g.m = x.m AND g.words = x.words),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + m - 1)) AS p FROM found) GROUP BY r),
ids AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM found WHERE item_id IS NOT NULL) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(ids.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids.items, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM doc_words d LEFT JOIN hit h ON d.r = h.r LEFT JOIN ids ON d.r = ids.r
"""
