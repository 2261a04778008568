"""Operator 7: token ids in canonical, length-limited Huffman code.

Format.  A file set is a table of blocks in ascending doc_id order plus a table of code lengths.  The code is
canonical: an id's code follows from the lengths alone (shorter codes first, equal lengths by id), so the lengths are
the whole header.  Lengths come from the global counts of all ids by the package-merge method and are at
most ``limit_bits``, so one table of 2^limit entries decodes any code in one step.  A block holds whole documents
(about ``block_tokens`` ids), its bits, and a checkpoint every 64 ids: the bit offset where that id's code starts.
Blocks decode independently, and within a block all checkpoints decode side by side, in 64 table steps.

Encoding ids: a batch of texts is split at blanks by Arrow and each distinct chunk is encoded once by the tokenizers
library; the ids of the texts are gathered from those of the chunks
(a tokenizer whose splits never cross a blank nor keep a letter and a stop behind it together, as here;
``by_chunk=False`` encodes whole texts).  A letter that NFC or lower case turns into a letter and a mark keeps
its stops, as the mark joins them.

Scale: texts are tokenized where they are read and never shuffled; ids travel once, in two bytes each where the
vocabulary allows, sorted by range of (doc_id, hash, row number), so equal doc_ids spread too.  The table of ids is
deleted once the blocks are written.  Counts are summed per task before the shuffle; only the
table of counts (at most one row per vocabulary entry) and one row per partition reach the driver.

Defined results: a null or empty text is the end id alone.  Null doc_ids come first; rows of equal doc_id are
ordered by their ids, and repeated rows stay.  An empty table makes an empty file set.
"""

from __future__ import annotations

import json
import os
import unicodedata
import uuid
import zlib
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate, chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.common import discard, map_arrow, slices, staged, utf8
from rollcall.session import ensure_checkpoint_dir

END_ID, STRIDE, BLOCK_TOKENS, PARTS_KEPT = 1, 64, 1 << 18, 100_000
#: Text bytes that are split and looked up at once (a longer text alone, whole).
TEXT_BYTES = 4 << 20
#: ASCII signs that make no token with letters or digits and stand in no special token.
STOPS = ".,;:!?#$%&*"
#: ASCII letters and digits by byte.
ALNUM = np.array([b < 128 and chr(b).isalnum() for b in range(256)])


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# ---------------------------------------------------------------- text to ids

def ends_apart(word: str) -> bool:
    """True if the word's last character stays a letter or digit at its end after NFC and lower-casing."""
    return _stays(word[-1:])


@lru_cache(1 << 16)
def _stays(last: str) -> bool:
    return last.isalnum() and (last.isascii() or unicodedata.normalize("NFC", last).lower()[-1].isalnum())


#: The printable character that stands for each byte in a byte-level vocabulary: printable bytes for themselves,
#: the others by the characters from U+0100 on, in order.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_SIGNS = {b: chr(b) for b in _SHOWN} | {b: chr(0x100 + k) for k, b in enumerate(x for x in range(256) if x not in _SHOWN)}


def as_bytes(word: str) -> str | None:
    """A word of letters in lower case and byte signs; None where that takes more than letter by letter (beyond the Latin
    blocks, or a letter that falls apart in lower case)."""
    if word.isascii():
        return word.lower()
    low = word.lower()
    return low.encode().decode("latin-1").translate(_BYTE_SIGNS) if max(word) < "\u0250" and low.isalpha() else None


def lean(path: str):
    """The tokenizer of a file for words in byte signs, split at blanks alone; None unless its steps before the model are
    NFC, blanks, lower case, a split that keeps runs of letters whole, and byte signs."""
    from tokenizers import Tokenizer, normalizers, pre_tokenizers

    with open(path, encoding="utf-8") as f:
        config = json.load(f)
    steps = [n.get("type") for n in (config.get("normalizer") or {}).get("normalizers", [])]
    before = (config.get("pre_tokenizer") or {}).get("pretokenizers", [])
    known = steps == ["NFC", "Replace", "Lowercase"] and [b.get("type") for b in before] == ["Split", "ByteLevel"]
    if not (known and "[\\p{L}]+" in str(before[0]["pattern"].get("Regex")).split("|") and not before[1].get("use_regex") and not before[1].get("add_prefix_space")):
        return None
    tokenizer = Tokenizer.from_file(path)
    tokenizer.normalizer = normalizers.Sequence([])
    tokenizer.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    return tokenizer


class Encoder:
    """Ids of texts by a file of the tokenizers library.

    A column of texts is split at blanks, and each distinct chunk of it is looked at once: a word and the stops behind it
    are parts of their own where :func:`ends_apart` allows, words of ASCII letters count in lower case.  ``recent`` and
    ``older`` remember parts: when ``recent`` holds ``keep`` it takes the place of ``older``, and a part found there moves
    back, so frequent parts stay and memory is bounded by twice ``keep``.
    """

    def __init__(self, path: str, by_chunk: bool = True, keep: int = PARTS_KEPT):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.by_chunk, self.keep = Tokenizer.from_file(path), by_chunk, keep
        self.lean = lean(path)
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters, where :func:`as_bytes` allows by the model alone."""
        if self.lean is None:
            return self._cut(self.tokenizer, words, words)
        plain = [w.lower() if w.isascii() else as_bytes(w) for w in words]
        if None not in plain:
            return self._cut(self.lean, plain, words)
        out: list = [None] * len(words)
        for tokenizer, which in ((self.lean, [k for k, p in enumerate(plain) if p is not None]),
                                 (self.tokenizer, [k for k, p in enumerate(plain) if p is None])):
            some = [words[k] for k in which]
            for k, ids in zip(which, self._cut(tokenizer, [plain[k] for k in which] if tokenizer is self.lean else some, some)):
                out[k] = ids
        return out

    def _cut(self, tokenizer, words: list[str], as_written: list[str]) -> list[bytes]:
        """Ids of words of letters: one text of all of them, cut behind the ids that end a word.

        A word of letters makes at least one such id, so as many of them as words means one each; else (a letter
        that falls apart in lower case, a vocabulary without word ends) the words are encoded one by one.
        """
        ids = np.array(tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = 4 * (np.flatnonzero(self.ends_word[ids]) + 1)
        if len(ends) != len(words) or (len(ends) and ends[-1] != 4 * len(ids)):
            return self._library(as_written)
        raw = ids.tobytes()
        return [raw[a:b] for a, b in pairwise([0, *ends.tolist()])]

    def _library(self, texts: list[str]) -> list[bytes]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        raw = np.fromiter(chain.from_iterable(ids), "<u4").tobytes()
        ends = list(accumulate((4 * len(i) for i in ids), initial=0))
        return [raw[a:b] for a, b in pairwise(ends)]

    def _parts(self, parts: list[str], letters: np.ndarray) -> list[bytes]:
        """The ids of distinct parts, remembered or new; ``letters`` says which are words of letters."""
        ids = list(map(self.recent.get, parts))
        missing = [k for k, i in enumerate(ids) if i is None]
        if len(self.recent) + len(missing) > self.keep:
            self.older, self.recent = self.recent, {}
        if self.older:
            for k, i in zip(missing, map(self.older.get, [parts[k] for k in missing])):
                ids[k] = i
        new = np.array([k for k in missing if ids[k] is None], np.int64)
        for which, encode in ((new[letters[new]], self._words), (new[~letters[new]], self._library)):
            for a in range(0, len(which), 20_000):
                some = which[a:a + 20_000].tolist()
                for k, i in zip(some, encode([parts[k] for k in some])):
                    ids[k] = i
        for k in missing[:max(0, self.keep - len(self.recent))]:
            self.recent[parts[k]] = ids[k]
        return ids

    def encode_column(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one behind another (each with ``end_id``, if given), and the n + 1 offsets of the texts."""
        texts = pc.fill_null(texts, "")
        if not self.by_chunk:
            raw = self._library(texts.to_pylist())
            if end_id is not None:
                raw = [r + np.array([end_id], "<u4").tobytes() for r in raw]
            return np.frombuffer(b"".join(raw), "<u4"), np.cumsum([0, *[len(r) // 4 for r in raw]])
        for blank in "\n\t\r":
            texts = pc.replace_substring(texts, blank, " ")
        lists = pc.split_pattern(texts, " ")
        last = np.diff(lists.offsets.to_numpy().astype(np.int64)).cumsum()  # the chunks up to each text's end
        coded = lists.flatten().dictionary_encode()
        del texts, lists
        flat, size = self._chunks(coded.dictionary)
        code = coded.indices.to_numpy()
        if end_id is not None:
            flat, size = np.append(flat, np.uint32(end_id)), np.append(size, 1)
            code = np.insert(code, last, len(size) - 1)
            last = last + np.arange(1, len(last) + 1)
        return _gathered(flat, size, code), np.concatenate([[0], np.cumsum(size[code], dtype=np.int64)])[np.concatenate([[0], last])]

    def _chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct chunks one behind another, and how many each has."""
        words = pc.utf8_rtrim(chunks, characters=STOPS)
        buf, cut = utf8(chunks)
        n = pc.binary_length(words).to_numpy()
        stopped = np.flatnonzero(n < np.diff(cut))
        apart, stop, stops = np.zeros(len(chunks), bool), np.zeros(len(chunks), np.int64), {"": 0}  # part 0 is empty
        # most have one stop behind an ASCII letter or digit: they are told by two bytes, the others looked at one by one
        behind = cut[stopped] + n[stopped]
        plain = (n[stopped] > 0) & (behind + 1 == cut[stopped + 1]) & ALNUM[buf[behind - 1]]
        signs, of = np.unique(buf[behind[plain]], return_inverse=True)
        apart[stopped[plain]] = True
        stop[stopped[plain]] = np.array([stops.setdefault(chr(b), len(stops)) for b in signs], np.int64)[of]
        stopped = stopped[~plain]
        for k, chunk, word in zip(stopped.tolist(), _strings(chunks.take(stopped)), _strings(words.take(stopped))):
            if ends_apart(word):
                apart[k] = True
                stop[k] = stops.setdefault(chunk[len(word):], len(stops))
        words = pc.if_else(pa.array(apart), words, chunks)
        words = pc.if_else(pc.and_(pc.string_is_ascii(words), pc.utf8_is_alpha(words)), pc.ascii_lower(words), words).dictionary_encode()
        letters = np.concatenate([np.zeros(len(stops), bool), pc.utf8_is_alpha(words.dictionary).to_numpy(zero_copy_only=False)])
        raw = self._parts([*stops, *_strings(words.dictionary)], letters)
        size = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
        parts = np.stack([words.indices.to_numpy().astype(np.int64) + len(stops), stop], axis=1)
        return _gathered(np.frombuffer(b"".join(raw), "<u4"), size, parts.ravel()), size[parts].sum(axis=1)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        ids, offsets = self.encode_column(pa.array(texts, pa.string()))
        raw = ids.astype("<u4").tobytes()
        return [raw[4 * a:4 * b] for a, b in pairwise(offsets.tolist())]

    @property
    def width(self) -> str:
        """The least type that holds every id of the vocabulary, as a numpy name."""
        return "<u2" if len(self.ends_word) <= 1 << 16 else "<u4"


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def _gathered(flat: np.ndarray, size: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The items of ``which`` one behind another, from all items one behind another and their sizes."""
    kind = np.int32 if max(len(flat), int(size[which].sum())) < 1 << 31 else np.int64
    n = size[which].astype(kind)
    first = (np.cumsum(size) - size).astype(kind)[which]
    first[1:] -= np.cumsum(n, dtype=kind)[:-1]
    return flat[np.repeat(first, n) + np.arange(int(n.sum()), dtype=kind)]


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, by_chunk: bool = True) -> Encoder:
    """One encoder per worker process."""
    if (path, by_chunk) not in _ENCODERS:
        _ENCODERS[path, by_chunk] = Encoder(path, by_chunk)
    return _ENCODERS[path, by_chunk]


def width(path: str, end_id: int) -> str:
    """The type in which ids are kept on the way to the files: two bytes where the vocabulary and the end id allow."""
    return encoder(path).width if end_id < 1 << 16 else "<u4"


# ---------------------------------------------------------------- the code

def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits for positive counts (package-merge); zero counts get 0."""
    lengths = np.zeros(len(counts), np.int64)
    used = np.flatnonzero(counts)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError("more ids than codes of this length")
    coins = np.sort(counts[used].astype(np.int64), kind="stable")
    by_count = used[np.argsort(counts[used], kind="stable")]
    levels, row = [], np.zeros(0, np.int64)
    for _ in range(limit):  # row: values of the packages of the level below
        values = np.concatenate([coins, row])
        order = np.argsort(values, kind="stable")
        levels.append(order < len(coins))
        merged = values[order]
        row = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
    take, n = 2 * len(coins) - 2, np.zeros(len(coins), np.int64)
    for is_coin in reversed(levels):
        here = int(np.count_nonzero(is_coin[:take]))
        n[:here] += 1
        take = 2 * (take - here)
    lengths[by_count] = n
    return lengths


@dataclass
class Code:
    """Codes by id, and the decoding table: by the next ``limit`` bits, the id and the length of its code."""

    lengths: np.ndarray
    limit: int

    def __post_init__(self):
        order = np.lexsort((np.arange(len(self.lengths)), self.lengths))
        order = order[self.lengths[order] > 0]
        steps = 1 << (self.limit - self.lengths[order])
        first = np.cumsum(steps) - steps
        self.codes = np.zeros(len(self.lengths), np.uint64)
        self.codes[order] = (first >> (self.limit - self.lengths[order])).astype(np.uint64)
        self.symbol = np.zeros(1 << self.limit, np.uint32)
        self.symbol[: int(steps.sum())] = np.repeat(order, steps).astype(np.uint32)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bits of the ids, and the bit offsets of every 64th."""
        n = self.lengths[ids]
        ends = np.cumsum(n)
        starts = ends - n
        total = int(ends[-1]) if len(ids) else 0
        words = np.zeros(total // 64 + 2, np.uint64)
        at, room = starts >> 6, 64 - (starts & 63) - n  # bits left of the word behind the code
        code = self.codes[ids]
        fits = room >= 0
        high = np.where(fits, code << np.maximum(room, 0).astype(np.uint64), code >> np.maximum(-room, 0).astype(np.uint64))
        if len(ids):
            first = np.flatnonzero(np.diff(at, prepend=-1))
            words[at[first]] = np.bitwise_or.reduceat(high, first)
            over = np.flatnonzero(~fits)
            words[at[over] + 1] |= code[over] << (64 + room[over]).astype(np.uint64)
        return words.astype(">u8").tobytes()[: (total + 7) // 8], starts[::STRIDE]

    def decode(self, bits: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        """All checkpoints side by side, one table step at a time."""
        data = np.frombuffer(bits + bytes(8), np.uint8).astype(np.uint64)
        window = np.zeros(len(data) - 7, np.uint64)  # the 32 bits from each byte on
        for k in range(4):
            window |= data[k:len(data) - 7 + k] << np.uint64(8 * (3 - k))
        out = np.zeros((STRIDE, len(checkpoints)), np.uint32)
        at, mask = checkpoints.astype(np.int64), np.uint64((1 << self.limit) - 1)
        last = 8 * len(bits)
        for step in range(STRIDE):
            at = np.minimum(at, last)
            look = (window[at >> 3] >> (32 - self.limit - (at & 7)).astype(np.uint64)) & mask
            out[step] = self.symbol[look.astype(np.int64)]
            at = at + self.lengths[out[step]]
        return out.T.ravel()[:n]


# ---------------------------------------------------------------- files

@dataclass
class TokenFiles:
    """Where a file set lies, and its code."""

    blocks: DataFrame
    code: Code
    path: str


def tokenized(docs: DataFrame, tokenizer: str, by_chunk: bool = True, end_id: int = END_ID, kind: str = "<u4") -> DataFrame:
    """(doc_id, ids): the ids with the end id as little-endian numbers of type ``kind``."""
    def run(batches):
        for batch in batches:
            enc = encoder(tokenizer, by_chunk)
            texts = batch.column(1)
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
            for a, b in slices(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), TEXT_BYTES, 1 << 20):
                ids, offsets = enc.encode_column(texts.slice(a, b - a), end_id)
                data = pa.py_buffer(ids.astype(kind).tobytes())
                cut = pa.py_buffer((offsets * np.dtype(kind).itemsize).astype(np.int32).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.Array.from_buffers(pa.binary(), b - a, [None, cut, data])], ["doc_id", "ids"])

    return map_arrow(docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")), run, "doc_id long, ids binary")


def id_counts(tokens: DataFrame, kind: str = "<u4") -> DataFrame:
    """(id, n) over all ids."""
    def count(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            ids = _numbers(batch.column(0), kind)
            here = np.bincount(ids)
            if len(here) > len(total):
                here[: len(total)] += total
                total = here
            else:
                total[: len(here)] += here
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["id", "n"])

    return map_arrow(tokens.select("ids"), count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def _numbers(column: pa.Array, kind: str) -> np.ndarray:
    """The numbers of all rows of a binary column."""
    _, offsets, data = column.buffers()
    cut = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[cut[0]:cut[-1]].view(kind) if data is not None and len(column) else np.zeros(0, kind)


BLOCK = ("part int, block int, first long, n_tokens long, doc_ids array<long>, lengths array<int>, "
         "checkpoints array<long>, bits binary")


def write(docs: DataFrame, tokenizer: str | None = None, by_chunk: bool = True, end_id: int = END_ID,
          block_tokens: int = BLOCK_TOKENS, path: str | None = None) -> TokenFiles:
    """Tokenize, count, encode and write all documents."""
    spark = docs.sparkSession
    tokenizer = tokenizer or default_tokenizer()
    kind = width(tokenizer, end_id)
    size = np.dtype(kind).itemsize
    tokens, folder = staged(tokenized(docs, tokenizer, by_chunk, end_id, kind), "tokens")
    counts = id_counts(tokens, kind).toPandas()  # at most one row per vocabulary entry
    dense = np.zeros(int(counts["id"].max()) + 1 if len(counts) else 1, np.int64)
    dense[counts["id"].to_numpy()] = counts["n"].to_numpy()
    limit = max(12, int(np.count_nonzero(dense)).bit_length() + 2)
    lengths = code_lengths(dense, limit)
    shared = spark.sparkContext.broadcast(lengths.astype(np.uint8).tobytes())

    def blocks(batches):
        from pyspark import TaskContext

        code = Code(np.frombuffer(shared.value, np.uint8).astype(np.int64), limit)
        part, block, first = TaskContext.get().partitionId(), 0, 0
        doc_ids, rows, held = [], [], 0

        def record():
            ids = np.frombuffer(b"".join(rows), kind)
            bits, checkpoints = code.encode(ids)
            return pa.RecordBatch.from_arrays(
                [pa.array([x], k) for x, k in ((part, pa.int32()), (block, pa.int32()), (first, pa.int64()), (len(ids), pa.int64()),
                                               (doc_ids, pa.list_(pa.int64())), ([len(r) // size for r in rows], pa.list_(pa.int32())),
                                               (checkpoints, pa.list_(pa.int64())), (bits, pa.binary()))],
                ["part", "block", "first", "n_tokens", "doc_ids", "lengths", "checkpoints", "bits"])

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                doc_ids.append(doc_id)
                rows.append(ids.as_py())
                held += len(rows[-1]) // size
                if held >= block_tokens:
                    yield record()
                    block, first, doc_ids, rows, held = block + 1, first + held, [], [], 0
        if rows:
            yield record()

    order = [F.col("doc_id").asc_nulls_first(), "spot", "row"]
    tokens = tokens.withColumn("spot", F.xxhash64("ids")).withColumn("row", F.monotonically_increasing_id())
    dealt = tokens.repartitionByRange(*order).sortWithinPartitions(*order)
    path = path or f"{ensure_checkpoint_dir(spark)}/llm-token-files-{uuid.uuid4().hex}"
    map_arrow(dealt.select("doc_id", "ids"), blocks, BLOCK).write.parquet(f"{path}/blocks")
    header = spark.createDataFrame([(limit, lengths.astype(np.uint8).tobytes())], "limit_bits int, lengths binary")
    header.coalesce(1).write.parquet(f"{path}/code")
    discard(spark, folder)
    return open_files(spark, path)


def open_files(spark: SparkSession, path: str) -> TokenFiles:
    """A file set that was written before."""
    limit, lengths = spark.read.schema("limit_bits int, lengths binary").parquet(f"{path}/code").first()
    return TokenFiles(spark.read.schema(BLOCK).parquet(f"{path}/blocks"), Code(np.frombuffer(bytes(lengths), np.uint8).astype(np.int64), limit), path)


def _decoded(files: TokenFiles, finish, names: list[str], schema: str) -> DataFrame:
    """Decode every block; ``finish`` turns a block's ids and the ends of its documents into the last column."""
    spark = files.blocks.sparkSession
    # the ids before each partition of the file set: one row per partition
    parts = files.blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    before, total = {}, 0
    for part, n in parts:
        before[part], total = total, total + n
    shared = spark.sparkContext.broadcast((files.code.lengths.astype(np.uint8).tobytes(), files.code.limit, before))

    def decode(batches):
        lengths, limit, starts = shared.value
        code = Code(np.frombuffer(lengths, np.uint8).astype(np.int64), limit)
        for batch in batches:
            for k in range(batch.num_rows):
                one = {name: batch.column(i)[k] for i, name in enumerate(batch.schema.names)}
                ids = code.decode(one["bits"].as_py(), one["checkpoints"].values.to_numpy(), one["n_tokens"].as_py())
                n = one["lengths"].values.to_numpy().astype(np.int64)
                ends = np.cumsum(n)
                first = starts[one["part"].as_py()] + one["first"].as_py()
                yield pa.RecordBatch.from_arrays([one["doc_ids"].values, pa.array(first + ends - n, pa.int64()), pa.array(n, pa.int64()),
                                                  finish(ids.astype("<u4"), ends)], names)

    return map_arrow(files.blocks, decode, schema)


def read(files: TokenFiles) -> DataFrame:
    """Decode every block: per document doc_id, start, n_tokens and ids (32-bit little-endian bytes)."""
    def whole(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        cut = np.concatenate([[0], 4 * ends]).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(cut.tobytes()), pa.py_buffer(ids.tobytes())])

    return _decoded(files, whole, ["doc_id", "start", "n_tokens", "ids"], "doc_id long, start long, n_tokens long, ids binary")


def digests(files: TokenFiles) -> DataFrame:
    """Decode every block: per document doc_id, start, n_tokens and ids_crc32, the checksum of its ids as :func:`read` gives them."""
    def check(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        raw = memoryview(ids.tobytes())
        return pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in pairwise([0, *ends.tolist()])], pa.int64())

    return _decoded(files, check, ["doc_id", "start", "n_tokens", "ids_crc32"], "doc_id long, start long, n_tokens long, ids_crc32 long")


def report(docs: DataFrame, **options) -> DataFrame:
    """Write the ids of all documents and read them back: doc_id, start, n_tokens and ids_crc32 per document."""
    return digests(write(docs.select("doc_id", "text"), **options))


def crc32(ids: list[int]) -> int:
    """The ids_crc32 of a document, for checks."""
    return zlib.crc32(np.array(ids, "<u4").tobytes())
