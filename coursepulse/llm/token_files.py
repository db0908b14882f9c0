"""Token ids in binary files with Elias-Fano encoded document boundaries.

A file (shard) holds consecutive documents in ascending id order: the ids of all of them one after another in
the narrowest unsigned integer that the vocabulary allows, where each document ends in that array, and
the documents' own ids. Both sequences are monotone and stored as Elias-Fano codes: of ``n`` values below
``u`` the ``l = floor(log2(u / n))`` lower bits are packed side by side, the upper bits are the places of ones in a bit
vector (value ``i`` sets bit ``upper + i``), which takes ``2 + log2(u / n)`` bits a value. A count of the ones before every block of
512 bits (6 % more) makes ``select`` a binary search and one block, so any document is found without decoding the others.

Layout, little-endian (header ``HEADER``): magic, part, number in the part, documents, documents whose id is null, ids,
ids of the part's earlier shards, smallest document id, bytes an id and the three section lengths; then the boundaries, the document ids
and the ids. Bytes after the sections are ignored (Spark's text writer, which commits files only of
tasks that succeed, ends each with a line end).

Writing: Spark range-partitions the documents by id (rows of one id are dealt by their text and place, so an id that very many
rows share is many partitions), sorts each partition, and a task encodes its documents in turn and sends off a shard
when it has ``shard_ids`` ids. Reading: the headers give the number of ids of every part (one row a part comes to the driver,
and missing shards are an error), then each shard is decoded in the task that reads it.

Defined results: a null or empty text is the end id alone; a null document id sorts first; rows that repeat an id all come, in the
order of a hash of their texts; an empty table gives no document; other columns are ignored; a document longer than ``shard_ids`` has a
shard of its own. Document ids are integers.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursepulse.llm.words import offsets_and_bytes, sliced, text_array

END_ID = 2
SHARD_IDS = 8_000_000
TEXT_SLICE = 4 << 20
BLOCK = 512
MAGIC = b"EFTOKEN1"
HEADER = struct.Struct("<8sIIQQQQqIIQQQ")


class TokenFileError(ValueError):
    """A file that does not follow the format, or a set of files that is not whole."""


# --- Elias-Fano ---------------------------------------------------------------------------------------

def _pack(values: np.ndarray, bits: int) -> bytes:
    """``bits`` lower bits of every value side by side."""
    if not bits:
        return b""
    raw = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)
    return np.packbits(np.unpackbits(raw, axis=1, bitorder="little")[:, :bits].ravel(), bitorder="little").tobytes()


class EliasFano:
    """A monotone sequence of unsigned integers read from its code."""

    _HEAD = struct.Struct("<QIQ")  # values, lower bits, bytes of the upper bits

    @classmethod
    def encode(cls, values: np.ndarray, universe: int) -> bytes:
        """Code of non-decreasing ``values`` (uint64) below ``universe``."""
        values = np.asarray(values, np.uint64)
        n = len(values)
        low = max(0, (int(universe) // n).bit_length() - 1) if n else 0
        upper = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
        bits = np.zeros(-(-((int(upper[-1]) if n else 0) + 1) // BLOCK) * BLOCK, np.uint8)
        bits[upper] = 1
        before = np.concatenate([[0], np.cumsum(bits.reshape(-1, BLOCK).sum(axis=1, dtype=np.int64))[:-1]]).astype("<u4")
        packed = np.packbits(bits, bitorder="little").tobytes()
        return cls._HEAD.pack(n, low, len(packed)) + before.tobytes() + packed + _pack(values, low)

    def __init__(self, code: memoryview | bytes):
        self.n, self.low, size = self._HEAD.unpack_from(code)
        at, blocks = self._HEAD.size, size * 8 // BLOCK
        self.before = np.frombuffer(code, "<u4", blocks, at).astype(np.int64)
        at += 4 * blocks
        self.upper = np.frombuffer(code, np.uint8, size, at).reshape(-1, BLOCK // 8)
        self.lower = np.frombuffer(code, np.uint8, -(-self.n * self.low // 8), at + size)

    def __len__(self) -> int:
        return self.n

    def _lower(self, i: np.ndarray) -> np.ndarray:
        """Lower bits of the values ``i``: the nine bytes from the first bit on hold them."""
        if not self.low:
            return np.zeros(len(i), np.uint64)
        start = i * self.low
        padded = np.concatenate([self.lower, np.zeros(9, np.uint8)])
        window = padded[(start >> 3)[:, None] + np.arange(9)]
        head = np.ascontiguousarray(window[:, :8]).view("<u8").ravel()
        shift = (start & 7).astype(np.uint64)
        tail = np.where(shift > 0, window[:, 8].astype(np.uint64) << (np.uint64(64) - np.maximum(shift, 1)), np.uint64(0))
        return ((head >> shift) | tail) & np.uint64((1 << self.low) - 1)

    def select(self, i: np.ndarray) -> np.ndarray:
        """The values with the numbers ``i`` (from 0), as uint64."""
        i = np.asarray(i, np.int64)
        if len(i) and not (0 <= i.min() and i.max() < self.n):
            raise IndexError("no such value")
        out = np.empty(len(i), np.uint64)
        for at in range(0, len(i), 4096):
            some = i[at:at + 4096]
            block = np.searchsorted(self.before, some, side="right") - 1
            ones = np.unpackbits(self.upper[block], axis=1, bitorder="little")
            place = (np.cumsum(ones, axis=1, dtype=np.int16) > (some - self.before[block])[:, None]).argmax(axis=1)
            upper = (block * BLOCK + place - some).astype(np.uint64)
            out[at:at + 4096] = (upper << np.uint64(self.low)) | self._lower(some)
        return out


# --- shards -------------------------------------------------------------------------------------------

def encode_shard(part: int, number: int, before: int, doc_ids: list, ends: np.ndarray, ids: np.ndarray, width: int) -> bytes:
    """One file's bytes; ``doc_ids`` ascend, nulls first; ``ends`` are the documents' ends in ``ids``."""
    nulls = sum(d is None for d in doc_ids)
    known = doc_ids[nulls:]
    low = known[0] if known else 0
    names = np.array([d - low for d in known], np.uint64)
    sections = [EliasFano.encode(ends.astype(np.uint64), len(ids) + 1),
                EliasFano.encode(names, int(names[-1]) + 1 if known else 1), ids.astype(f"<u{width}").tobytes()]
    head = HEADER.pack(MAGIC, part, number, len(doc_ids), nulls, len(ids), before, low, width, 0, *map(len, sections))
    return b"".join([head, *sections])


class Shard:
    """Random access to one file's documents."""

    def __init__(self, data: bytes | memoryview):
        data = memoryview(data)
        if len(data) < HEADER.size or bytes(data[:8]) != MAGIC:
            raise TokenFileError("not a token file")
        (_, self.part, self.number, self.n_docs, self.nulls, self.n_ids, self.before, self.low, self.width, _,
         a, b, c) = HEADER.unpack_from(data)
        at = HEADER.size
        if len(data) < at + a + b + c or c != self.n_ids * self.width:
            raise TokenFileError("a token file is cut short")
        self.ends, self.names = EliasFano(data[at:at + a]), EliasFano(data[at + a:at + a + b])
        self.ids = np.frombuffer(data, f"<u{self.width}", self.n_ids, at + a + b)

    def starts(self, i: np.ndarray) -> np.ndarray:
        """Where the documents ``i`` start in this file's ids."""
        i = np.asarray(i, np.int64)
        out = self.ends.select(np.maximum(i - 1, 0)).astype(np.int64)
        out[i == 0] = 0
        return out

    def tokens(self, i: int) -> np.ndarray:
        """The ids of document ``i`` of this file."""
        start, = self.starts(np.array([i]))
        end, = self.ends.select(np.array([i])).astype(np.int64)
        return self.ids[start:end]

    def doc_ids(self) -> list:
        names = self.names.select(np.arange(len(self.names)))
        return [None] * self.nulls + [self.low + int(v) for v in names]


# --- token ids ------------------------------------------------------------------------------------------

def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: The white space of the tokenizer's splitting pattern (Unicode White_Space).
_SPACE = r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


class Encoder:
    """Token ids of texts by the library, each distinct word encoded once.

    No token crosses from a character before a space into that space, and a run of white space
    is cut the same way from its own start on, so a text may be cut before a space unless white space stands on both
    sides of the cut (or the text ends after it). Texts with such a place and those that contain an added
    token go to the library whole. Words without white space at their ends go to it ``JOINED`` at a time, as one text of words
    with a space before each: a token that starts with a space starts a word. The ids of up to ``KNOWN`` words are kept for the next slices.
    """

    JOINED = 100
    AT_ONCE = 20_000
    KNOWN = 1_000_000

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.width = 2 if max(vocab.values()) < 1 << 16 else 4
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        space = self.tokenizer.pre_tokenizer.pre_tokenize_str(" ")[0][0]  # the character that stands for a space
        self.leads = np.zeros(max(vocab.values()) + 1, bool)
        self.leads[[i for t, i in vocab.items() if t.startswith(space)]] = True
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.string())
        self.pool, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = [e.ids for e in got]
        ends = np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)])
        return np.fromiter((x for part in ids for x in part), np.uint32, int(ends[-1])), ends

    def encode(self, a: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, offsets)`` of a string array: ids of all rows one after another."""
        whole = np.asarray(pc.match_substring_regex(a, _SPACE + r" (" + _SPACE + r"|\z)"))
        for t in self.added:
            whole = whole | np.asarray(pc.match_substring(a, t))
        if not whole.any():
            return self._by_words(a)
        ids, offs = self._by_words(a.filter(pa.array(~whole)))
        return _interleaved(~whole, ids, offs, *self._library(a.filter(pa.array(whole)).to_pylist()))

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of ``" " + word`` for distinct words."""
        odd = np.asarray(pc.match_substring_regex(words, r"^(" + _SPACE + r"|\z)|" + _SPACE + r"\z"))
        joined = pc.binary_join_element_wise("", words.filter(pa.array(~odd)), " ")
        parts = []
        for at in range(0, len(joined), self.AT_ONCE):
            some = pa.concat_arrays([joined.slice(at, self.AT_ONCE)])
            offs, raw = offsets_and_bytes(some)
            cuts = np.append(offs[:-1:self.JOINED], offs[-1]).astype(np.int32)
            texts = pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.tobytes()), pa.py_buffer(raw.tobytes()))
            parts.append(self._library(texts.to_pylist())[0])
        ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        offs = np.append(np.flatnonzero(self.leads[ids]), len(ids))
        if len(offs) != len(joined) + 1:
            raise ValueError("the tokenizer does not keep words apart")
        if not odd.any():
            return ids, offs
        return _interleaved(~odd, ids, offs, *self._library([" " + w for w in words.filter(pa.array(odd)).to_pylist()]))

    def _known_words(self, words: pa.Array) -> np.ndarray:
        """Places of the words in the pool of known words, which learns the new ones."""
        at = pc.index_in(words, value_set=self.known)
        if at.null_count:
            if len(self.known) + at.null_count > self.KNOWN:
                self._forget()
                at = pa.nulls(len(words), pa.int32())
            new = words.filter(pc.is_null(at))
            ids, offs = self._words(new)
            at = np.array(pc.fill_null(at, -1))
            at[at < 0] = len(self.known) + np.arange(len(new))
            self.ends = np.concatenate([self.ends, offs[1:] + self.ends[-1]])
            self.pool, self.known = np.concatenate([self.pool, ids]), pa.concat_arrays([self.known, new])
        return np.asarray(at)

    def _by_words(self, a: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        lists = pc.split_pattern(a, " ")
        offs = np.asarray(lists.offsets).astype(np.int64)
        offs = offs - offs[0]
        flat = lists.flatten()
        first = offs[:-1]  # every text has a word, if only an empty one
        d = flat.dictionary_encode()
        at = self._known_words(d.dictionary)[np.asarray(d.indices)]
        heads, head_ends = self._library(flat.take(pa.array(first)).to_pylist())  # no space before these
        count = np.diff(self.ends)[at]
        begin = self.ends[at]
        count[first], begin[first] = np.diff(head_ends), head_ends[:-1] + len(self.pool)
        upto = np.concatenate([[0], np.cumsum(count)])
        where = np.repeat((begin - upto[:-1]).astype(np.int32), count) + np.arange(upto[-1], dtype=np.int32)
        return np.concatenate([self.pool, heads])[where], upto[offs]


def _interleaved(which: np.ndarray, ids: np.ndarray, offs: np.ndarray, others: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two ragged arrays in the order that ``which`` (rows of the first) gives."""
    size = np.zeros(len(which), np.int64)
    size[which], size[~which] = np.diff(offs), np.diff(ends)
    out = np.empty(int(size.sum()), np.uint32)
    from_first = np.repeat(which, size)
    out[from_first], out[~from_first] = ids, others
    return out, np.concatenate([[0], np.cumsum(size)])


_ENCODERS: dict[str, Encoder] = {}  # one per Python worker and path


def _encoder(path: str) -> Encoder:
    return _ENCODERS.get(path) or _ENCODERS.setdefault(path, Encoder(path))


def _head(data: bytes) -> tuple[int, int, int, int]:
    """``(part, number in the part, ids, ids of the part up to its end)`` of a file's header."""
    if len(data) < HEADER.size or data[:8] != MAGIC:
        raise TokenFileError("not a token file")
    _, part, number, _, _, n_ids, before, *_ = HEADER.unpack(data)
    return part, number, n_ids, before + n_ids


# --- writing and reading ----------------------------------------------------------------------------------

def write_tokens(docs: DataFrame, path: str, tokenizer_path: str | None = None, end_id: int = END_ID, shard_ids: int = SHARD_IDS,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the documents' ids, each with ``end_id`` behind, as files below ``path`` in ascending order of the document ids."""
    name = tokenizer_path or default_tokenizer()
    src = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).withColumn(
        "tie", F.xxhash64("text")).withColumn("place", F.monotonically_increasing_id())
    keys = ["doc_id", "tie", "place"]
    ordered = src.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")

    def run(batches) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(name)
        part, number, before = TaskContext.get().partitionId(), 0, 0
        names: list = []
        ids: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        held = 0

        def shard() -> pa.RecordBatch:
            data = encode_shard(part, number, before, names, np.cumsum(np.concatenate(sizes)), np.concatenate(ids), encoder.width)
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["data"])

        for b in sliced(batches, 1, min(TEXT_SLICE, 4 * shard_ids)):
            raw, offs = encoder.encode(text_array(b.column(1)))
            ids.append(np.insert(raw, offs[1:], end_id))
            sizes.append(np.diff(offs) + 1)
            names += b.column(0).to_pylist()
            held += len(ids[-1])
            if held >= shard_ids:
                yield shard()
                number, before = number + 1, before + held
                names, ids, sizes, held = [], [], [], 0
        if names:
            yield shard()

    files = ordered.mapInArrow(run, "data binary").select(F.col("data").cast("string").alias("value"))
    files.write.option("maxRecordsPerFile", 1).text(path)


def part_offsets(spark: SparkSession, path: str) -> dict[int, int]:
    """Number of ids before each part, from the headers alone (one row a part)."""
    heads = spark.read.format("binaryFile").load(path).select(F.expr(f"substring(content, 1, {HEADER.size})").alias("head"))

    def run(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [_head(h) for h in b.column(0).to_pylist() if len(h) > 1]  # a task without documents leaves an empty file
            cols = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["part", "number", "n", "upto"])

    parts = heads.mapInArrow(run, "part long, number long, n long, upto long").groupBy("part").agg(
        F.max("number").alias("last"), F.count(F.lit(1)).alias("shards"), F.sum("n").alias("n"), F.max("upto").alias("upto")).collect()
    parts = sorted(parts, key=lambda r: r["part"])
    if any(r["shards"] != r["last"] + 1 or r["n"] != r["upto"] for r in parts):
        raise TokenFileError("token files are missing or repeated")
    sums = list(accumulate((r["n"] for r in parts), initial=0))
    return {r["part"]: s for r, s in zip(parts, sums)}


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (and ``ids``: little-endian unsigned 32-bit) of every document of the files."""
    offsets = part_offsets(spark, path)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                data = memoryview(content.as_buffer())
                if len(data) <= 1:
                    continue
                shard = Shard(data)
                i = np.arange(shard.n_docs)
                start, names = shard.starts(i), shard.doc_ids()
                size = np.diff(start, append=shard.n_ids)
                wide = shard.ids.astype("<u4")
                crc = [zlib.crc32(wide[s:s + k]) for s, k in zip(start.tolist(), size.tolist())]
                base = offsets[shard.part] + shard.before
                columns = [pa.array(names, pa.int64()), pa.array(start + base), pa.array(size), pa.array(crc, pa.int64())]
                if with_ids:
                    columns.append(pa.array([wide[s:s + k].tobytes() for s, k in zip(start.tolist(), size.tolist())], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:len(columns)])

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else ""))
