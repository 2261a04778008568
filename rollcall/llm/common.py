"""Helpers shared by the operators: tables, scratch storage, UTF-8 access to Arrow text, hashing in numpy."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from rollcall.session import ensure_checkpoint_dir

#: Text bytes that the numpy operators handle at once (a longer text is handled alone, whole).
SLICE_BYTES = 1 << 20
SLICE_ROWS = 1023

U64 = np.uint64

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package's code to the executors, once per application (as --py-files would)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="rollcall-code-"), "rollcall_code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def map_arrow(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` with this package importable on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` to a fresh folder below ``spark.checkpoint.dir``; the table read back, and the folder.

    Cuts the lineage: what follows reads files that every executor can reach, so a lost executor
    costs only its running tasks.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame, name: str) -> DataFrame:
    """:func:`staged` for a table that stays."""
    return staged(df, name)[0]


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that :func:`staged` wrote, once nothing reads it any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the n + 1 offsets of its rows; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offs[0]:offs[-1]], offs - offs[0]


def slices(offsets: np.ndarray, most_bytes: int = SLICE_BYTES, most_rows: int = SLICE_ROWS) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most so many bytes (or one row) and rows."""
    n, at = len(offsets) - 1, 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + most_bytes, "right")) - 1
        end = min(max(end, at + 1), at + most_rows, n)
        yield at, end
        at = end


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """Hashes to floats in (0, 1)."""
    return ((x >> U64(12)).astype(np.float64) + 0.5) * 2.0**-52


#: Bytes of a word: digits, lower-case letters and all of a multi-byte character; A-Z count as their lower case.
WORD = np.zeros(256, bool)
WORD[0x30:0x3A] = WORD[0x41:0x5B] = WORD[0x61:0x7B] = WORD[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
#: For bytes.translate: lower-cases A-Z and blanks what is no part of a word.
WORDS_ONLY = bytes(int(LOWER[b]) if WORD[b] else 32 for b in range(256))

_ODD = U64(0x9E3779B97F4A7C15)
_BYTE_CODES = mix((np.arange(256, dtype=U64) + U64(1)) * _ODD)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """p^i and p^-i modulo 2^64 for i < n."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, SLICE_BYTES + 1)
        base = 0xD1342543DE82EF95
        for name, b in (("up", base), ("down", pow(base, -1, 1 << 64))):
            steps = np.full(size, b, U64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range, the same wherever the bytes stand."""
    up, down = _powers(len(codes) + 1)
    total = np.zeros(len(codes) + 1, U64)
    np.cumsum(_BYTE_CODES[codes] * up[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U64) * _ODD)


def word_spans(buf: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a run of rows, and the n + 1 word offsets of the rows."""
    inside = np.zeros(len(buf) + 2, bool)
    inside[1:-1] = is_word[buf]
    here = inside[1:-1]
    edge = np.zeros(len(buf) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(here & (~inside[:-2] | edge[:-1]))
    ends = np.flatnonzero(here & (~inside[2:] | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)
