"""Operator 8: toxicity by subword-bag embeddings under a linear softmax.

The features of a text are its words and their character n-grams (3 to 5 bytes of "<word>", lower-cased), hashed
into buckets.  A text is the mean of its features' vectors; a linear softmax over that mean gives the label.
Vectors and softmax are trained jointly in numpy by Adagrad, so a misspelling that was never seen shares most of its
n-grams, and so its vectors, with the word that was.

A long text is many passages, and a mean over thousands of words would drown the few that matter.  So the mean is
taken over passages of ``passage`` words (the whole text is covered), and the text's score is that of its most
toxic passage; in training the passage that scores highest stands for its text.

Scale: the model is fitted on a documented, bounded sample of labelled rows (``per_class`` rows of each label, the
first by hash; of documents that repeat their doc_id at most twice as many rows, the first by doc_id and text) on the driver; its two classes collapse to one number per bucket, which is broadcast (``buckets`` floats).
Scoring reads every text once, without a shuffle.

Defined results: a null or empty text has no features and gets the score of the bias alone.  Rows with a null doc_id
count as held out.  A doc_id with both labels teaches both.  Without labelled rows of both labels every score is 0.5.  Repeated rows repeat their scores.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import LOWER, SLICE_BYTES, U64, _BYTE_CODES, _powers, map_arrow, mix, slices, utf8, word_spans

GRAMS, BUCKETS, DIM, PASSAGE, PER_CLASS, EPOCHS, SEED = (3, 4, 5), 1 << 18, 8, 4, 1000, 8, 7


def features(buf: np.ndarray, offsets: np.ndarray, passage: int = PASSAGE, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature buckets and their passage numbers, in no order, and the row of each passage."""
    starts, ends, first = word_spans(buf, offsets)
    n_words = np.diff(first)
    n_passages = -(-n_words // passage)
    row_of = np.repeat(np.arange(len(n_words)), n_passages)
    word_row = np.repeat(np.arange(len(n_words)), n_words)
    of_word = (np.cumsum(n_passages) - n_passages)[word_row] + (np.arange(len(starts)) - first[:-1][word_row]) // passage
    # the words again, each between < and >
    size = ends - starts
    last = np.cumsum(size + 2)
    begin = last - size - 2
    n = int(last[-1]) if len(last) else 0
    marked = np.full(n, 0x3C, np.uint8)
    marked[last - 1] = 0x3E
    inner = np.ones(n, bool)
    inner[begin] = inner[last - 1] = False
    inside = np.zeros(len(buf) + 1, np.int8)
    np.add.at(inside, starts, 1)
    np.add.at(inside, ends, -1)
    marked[inner] = LOWER[buf[np.cumsum(inside[:-1]).astype(bool)]]
    up, down = _powers(n + 1)
    total = np.zeros(n + 1, U64)
    np.cumsum(_BYTE_CODES[marked] * up[:-1], out=total[1:])
    word = np.repeat(np.arange(len(size)), size + 2)
    end = last[word]
    at = np.arange(n)
    found, where = [mix((total[last] - total[begin]) * down[begin])], [of_word]
    for k in GRAMS:
        here = at[at + k <= end]
        found.append(mix((total[here + k] - total[here]) * down[here] + U64(k)))
        where.append(of_word[word[here]])
    return (np.concatenate(found) % U64(buckets)).astype(np.int64), np.concatenate(where), row_of


@dataclass
class Model:
    """One number per bucket, and the bias: the log odds of a passage are their mean plus the bias."""

    weights: np.ndarray
    bias: float
    passage: int = PASSAGE

    def passages(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bucket, where, row = features(buf, offsets, self.passage, len(self.weights))
        n = len(row)
        mean = np.bincount(where, self.weights[bucket], n) / np.maximum(np.bincount(where, minlength=n), 1)
        return mean + self.bias, row

    def scores(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        odds = np.full(len(offsets) - 1, -np.inf)
        each, row = self.passages(buf, offsets)
        np.maximum.at(odds, row, each)
        odds[np.isinf(odds)] = self.bias
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def train(texts: list[str | None], labels: np.ndarray, buckets: int = BUCKETS, dim: int = DIM, epochs: int = EPOCHS,
          passage: int = PASSAGE, rate: float = 0.3, batch: int = 64, hard: int = 3, seed: int = SEED) -> Model:
    """Fit vectors and softmax jointly.  A toxic text is taught by its passage that scores highest so far, another
    by its ``hard`` highest, since all of its passages are clean."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (buckets, dim)).astype(np.float32)
    soft, bias = np.zeros((dim, 2), np.float32), np.zeros(2, np.float32)
    seen_v, seen_s, seen_b = np.full(buckets, 1e-6, np.float32), np.full((dim, 2), 1e-6, np.float32), np.full(2, 1e-6, np.float32)
    buf, offsets = utf8(pa.array(texts, pa.string()))
    bags: list[list[tuple[np.ndarray, np.ndarray]]] = []  # per text, per passage: buckets and their shares
    for a, b in slices(offsets, SLICE_BYTES // 2):
        bucket, where, row = features(buf[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], passage, buckets)
        key, count = np.unique(where * buckets + bucket, return_counts=True)
        where, bucket = key // buckets, key % buckets
        cut = np.searchsorted(where, np.arange(len(row) + 1))
        own: list[list] = [[] for _ in range(b - a)]
        for p, r in enumerate(row):
            c = count[cut[p]:cut[p + 1]]
            own[r].append((bucket[cut[p]:cut[p + 1]].astype(np.int32), (c / c.sum()).astype(np.float32)))
        bags += own
    balance = len(labels) / (2 * np.maximum(np.bincount(labels, minlength=2), 1))  # both labels weigh the same
    known = [i for i, bag in enumerate(bags) if bag]
    for epoch in range(epochs):
        flat = vectors @ (soft[:, 1] - soft[:, 0])
        taught: list[tuple[int, np.ndarray, np.ndarray]] = []  # label, buckets, shares
        for i in known:
            if epoch == 0:  # to begin with, a text is taught by all of its passages at once
                taught.append((labels[i], np.concatenate([k for k, _ in bags[i]]), np.concatenate([s for _, s in bags[i]]) / len(bags[i])))
                continue
            odds = np.array([flat[k] @ s for k, s in bags[i]])
            most = 1 if labels[i] else hard
            taught += [(labels[i], *bags[i][j]) for j in np.argsort(-odds, kind="stable")[:most]]
        for part in np.array_split(rng.permutation(len(taught)), max(1, len(taught) // batch)):
            chosen = {i: taught[i][1:] for i in part}
            truth = np.array([taught[i][0] for i in part])
            keys = np.concatenate([chosen[i][0] for i in part])
            share = np.concatenate([chosen[i][1] for i in part])
            which = np.repeat(np.arange(len(part)), [len(chosen[i][0]) for i in part])
            at = np.searchsorted(which, np.arange(len(part)))
            hidden = np.add.reduceat(vectors[keys] * share[:, None], at, axis=0)
            logits = hidden @ soft + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(part)), truth] -= 1
            p *= balance[truth][:, None]
            grad_s, grad_b, grad_h = hidden.T @ p, p.sum(axis=0), p @ soft.T
            used, back = np.unique(keys, return_inverse=True)
            grad_v = np.stack([np.bincount(back, grad_h[which, d] * share, len(used)) for d in range(dim)], axis=1).astype(np.float32)
            seen_v[used] += (grad_v**2).mean(axis=1)
            seen_s += grad_s**2
            seen_b += grad_b**2
            vectors[used] -= rate * grad_v / np.sqrt(seen_v[used])[:, None]
            soft -= rate * grad_s / np.sqrt(seen_s)
            bias -= rate * grad_b / np.sqrt(seen_b)
            if not soft.any():
                soft += rng.normal(0, 0.1, soft.shape).astype(np.float32)
    return Model(vectors @ (soft[:, 1] - soft[:, 0]), float(bias[1] - bias[0]), passage)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, seed: int = SEED, **options) -> Model:
    """Train on at most ``per_class`` labelled rows of each label that are not held out, the first by hash."""
    known = labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).select("doc_id", "toxic")
    order = F.xxhash64("doc_id", F.lit(seed))
    texts, values = [], []
    for value in (0, 1):
        picked = known.where(F.col("toxic") == value).orderBy(order, "doc_id").limit(per_class)
        rows = docs.select("doc_id", "text").join(picked, "doc_id").orderBy("doc_id", "text").limit(2 * per_class).select("text").collect()
        texts += [r[0] for r in rows]
        values += [value] * len(rows)
    if len(set(values)) < 2:
        return Model(np.zeros(options.get("buckets", BUCKETS), np.float32), 0.0)
    return train(texts, np.array(values), seed=seed, **options)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` in struct ``doc`` with ``score``, by the text alone."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.bias, model.passage))

    def run(batches):
        fitted = Model(*shared.value)
        for batch in batches:
            buf, offsets = utf8(batch.column(1))
            parts = [fitted.scores(buf[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]) for a, b in slices(offsets, SLICE_BYTES // 2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(parts) if parts else np.zeros(0))], ["doc", "score"])

    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), docs["text"].cast("string").alias("text"))
    return map_arrow(rows, run, rows.drop("text").schema.add("score", "double"))


def report(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, held_out, score and predicted."""
    model = fit(docs, labels, **options)
    slim = docs.select("doc_id", "text")
    rows = score(slim.select(F.struct("doc_id").alias("id"), "text"), model)
    return rows.select("doc.id.doc_id", held_out(F.col("doc.id.doc_id")).alias("held_out"), "score",
                       (F.col("score") >= 0.5).cast("int").alias("predicted"))
