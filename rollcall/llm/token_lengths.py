"""Operator 10: token counts as an exact length histogram.

Every whole text is encoded once and only its length is kept.  Documents are counted by (group, length) with a
partial count in each task, so a hot source or length is a number before it is shuffled.  Suffix sums over the
histogram then answer, for every length taken as a context limit, how many documents are longer, how many tokens a
truncation keeps and loses, and which quantile the length is.  Nothing is approximated and nothing grows with the
documents but the counts: a group has at most as many rows as distinct lengths.

Defined results: a null or empty text has length 0; a null group is a group of its own; repeated rows count each.
An empty table has an empty histogram.
"""

from __future__ import annotations

import base64

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import map_arrow

_ENCODINGS: dict[str, object] = {}


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def encoding(path: str):
    """The byte-pair encoding of a rank file, one per worker process."""
    if path not in _ENCODINGS:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _ENCODINGS[path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path]


def with_length(docs: DataFrame, by: list[str], ranks: str | None = None) -> DataFrame:
    """The columns ``by`` and ``length``, the ids of each whole text."""
    path = ranks or default_ranks()

    def run(batches):
        for batch in batches:
            encode = encoding(path).encode_ordinary
            lengths = [len(encode(t.as_py() or "")) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(lengths, pa.int64())], [*by, "length"])

    rows = docs.select(*[docs[c] for c in by], docs["text"].cast("string").alias("__text"))
    schema = rows.drop("__text").schema.add("length", "long")
    return map_arrow(rows, run, schema)


def histogram(docs: DataFrame, by: list[str], ranks: str | None = None) -> DataFrame:
    """(*by, length, n_docs)."""
    return with_length(docs, by, ranks).groupBy(*by, "length").agg(F.count("*").alias("n_docs"))


def with_sums(hist: DataFrame, by: list[str]) -> DataFrame:
    """For each length as a limit: n_longer, tokens_upto, truncated_total and lost beside the totals of the group."""
    up = Window.partitionBy(*by).orderBy("length").rowsBetween(Window.unboundedPreceding, 0)
    beyond = Window.partitionBy(*by).orderBy("length").rowsBetween(1, Window.unboundedFollowing)
    tokens = F.col("length") * F.col("n_docs")
    zero = F.lit(0).cast("long")
    return hist.select(
        *by, "length", "n_docs",
        F.sum("n_docs").over(up).alias("docs_upto"),
        F.coalesce(F.sum("n_docs").over(beyond), zero).alias("n_longer"),
        F.sum(tokens).over(up).alias("tokens_upto"),
        F.coalesce(F.sum(tokens).over(beyond), zero).alias("tokens_beyond"),
    ).withColumn("truncated_total", F.col("tokens_upto") + F.col("length") * F.col("n_longer")).withColumn(
        "lost", F.col("tokens_beyond") - F.col("length") * F.col("n_longer"))


def at_limits(sums: DataFrame, by: list[str], limits: list[int]) -> DataFrame:
    """(*by, limit, docs_upto, n_longer, truncated_total, lost) for given context limits, seen lengths or not."""
    total = sums.groupBy(*by).agg(F.sum("n_docs").alias("docs"), F.sum(F.col("length") * F.col("n_docs")).alias("tokens"), *[
        F.max(F.when(F.col("length") <= x, F.struct("length", "docs_upto", "tokens_upto"))).alias(f"at_{i}") for i, x in enumerate(limits)])
    each = F.explode(F.array(*[F.struct(F.lit(x).cast("long").alias("limit"), F.col(f"at_{i}").alias("at")) for i, x in enumerate(limits)]))
    rows = total.select(*by, "docs", "tokens", each.alias("x"))
    upto, kept = F.coalesce("x.at.docs_upto", F.lit(0)), F.coalesce("x.at.tokens_upto", F.lit(0))
    truncated = kept + F.col("x.limit") * (F.col("docs") - upto)
    return rows.select(*by, F.col("x.limit").alias("limit"), upto.cast("long").alias("docs_upto"), (F.col("docs") - upto).cast("long").alias("n_longer"),
                       truncated.cast("long").alias("truncated_total"), (F.col("tokens") - truncated).cast("long").alias("lost"))


def quantiles(sums: DataFrame, by: list[str], shares: list[float]) -> DataFrame:
    """(*by, share, length): the least length that at least that share of the documents does not exceed."""
    docs = F.col("docs_upto") + F.col("n_longer")
    rows = sums.groupBy(*by).agg(*[F.min(F.when(F.col("docs_upto") >= F.lit(q) * docs, F.col("length"))).alias(f"q{i}") for i, q in enumerate(shares)])
    each = F.explode(F.array(*[F.struct(F.lit(float(q)).alias("share"), F.col(f"q{i}").alias("length")) for i, q in enumerate(shares)]))
    return rows.select(*by, each.alias("x")).select(*by, "x.share", "x.length")


def report(docs: DataFrame, by: tuple[str, ...] = ("source",), ranks: str | None = None) -> DataFrame:
    """The histogram of every group with its sums."""
    return with_sums(histogram(docs, list(by), ranks), list(by))
