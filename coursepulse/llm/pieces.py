"""SentencePiece BPE encoding with seeded merge-dropout, and lossless decoding.

The pieces and scores come from a public model file. A word's agenda holds its adjacent pieces whose
concatenation is a piece; the best-scored, leftmost candidate is merged. With dropout every candidate
(its two pieces at their place in the word) is skipped when a hash keyed by seed, document id, word
number and the word's symbols says so, which gives other, merge-type segmentations of the same text:
each occurrence of a word has its own, the same on any machine and in any partitioning. Each distinct
word of a slice is merged once without dropout; an occurrence none of whose merges is skipped has that
result (skipped candidates that lose to a better one change nothing), all others are merged one by one.

Spaces become the word mark and a mark precedes the text; a word mark that a text itself contains
and every character that is no piece become byte pieces, so any text decodes to itself. With a
dropout of 0 the ids are those of the library for texts without such marks.

Defined results: null and empty texts have no ids and decode to the empty text; ids of documents may
repeat or be null; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coursepulse.llm.agenda import PairTable, merge_all
from coursepulse.llm.words import offsets_and_bytes, rows_of, sliced, text_array

DROPOUT = 0.1
SEED = 20_240_301
MARK = "▁"
TEXT_SLICE = 4 << 20
AT_ONCE = 1 << 20  # symbols or hashes in one array step: bounds the memory of a task

_C1, _C2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


_K = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)  # odd


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _C1
    x = (x ^ (x >> np.uint64(33))) * _C2
    return x ^ (x >> np.uint64(33))


def keyed(seed: int, *parts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the parts under the seed."""
    h = np.uint64(seed)
    for p in parts:
        h = _mixed((h + np.asarray(p).astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    return h


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _split_runs(text: str) -> tuple[list[str], list[int]]:
    """The words of a text and the number of marks before each; spaces at the end are an empty word."""
    words, marks, run = [], [], 1
    parts = text.split(" ") if text else []
    for part in parts:
        if part:
            words.append(part)
            marks.append(run)
            run = 1
        else:
            run += 1
    if run > 1 and parts:
        words.append("")
        marks.append(run - 1)
    return words, marks


class PieceModel:
    """Pieces, merges and byte pieces of a SentencePiece BPE model."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        byte = [sp.is_byte(i) for i in range(n)]
        plain = {t: i for i, t in enumerate(names) if not (byte[i] or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
        order = sorted(plain.values(), key=lambda i: (-sp.get_score(i), i))
        rank = {i: r for r, i in enumerate(order)}
        self.table = PairTable((plain[t[:k]], plain[t[k:]], rank[i], i)
                               for t, i in plain.items() for k in range(1, len(t)) if t[:k] in plain and t[k:] in plain)
        self.chars = {ord(t): i for t, i in plain.items() if len(t) == 1}
        self.mark = self.chars.pop(ord(MARK))
        self.of_byte = np.zeros(256, np.int64)
        for i in range(n):
            if byte[i]:
                self.of_byte[int(names[i][1:-1], 16)] = i
        spelled = [bytes([int(t[1:-1], 16)]) if byte[i] else t.replace(MARK, " ").encode() if t in plain else b""
                   for i, t in enumerate(names)]
        self.spelled_ends = np.concatenate([[0], np.cumsum([len(x) for x in spelled])])
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        # symbols by code point; below 0 for what is no piece
        self.small = np.array([self.chars.get(c, -1 - c) for c in range(0x3000)], np.int64)

    def symbols(self, points: np.ndarray) -> np.ndarray:
        out = -1 - points.astype(np.int64)
        low = points < len(self.small)
        out[low] = self.small[points[low]]
        high = np.flatnonzero(~low)
        if len(high):
            seen, at = np.unique(points[high], return_inverse=True)
            out[high] = np.array([self.chars.get(int(c), -1 - int(c)) for c in seen], np.int64)[at]
        return out

    def with_bytes(self, ids: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols below 0 spelled in byte pieces."""
        odd = np.flatnonzero(ids < 0)
        if not len(odd):
            return ids, offs
        seen, at = np.unique(ids[odd], return_inverse=True)
        spelled = [self.of_byte[np.frombuffer(chr(-1 - int(c)).encode(), np.uint8)] for c in seen]
        size = np.ones(len(ids), np.int64)
        size[odd] = np.array([len(x) for x in spelled])[at]
        ends = np.concatenate([[0], np.cumsum(size)])
        out = np.empty(int(ends[-1]), np.int64)
        out[ends[:-1]] = ids
        for k, x in enumerate(spelled):
            first = ends[odd[at == k]]
            for j, b in enumerate(x):
                out[first + j] = b
        return out, ends[offs]

    def spread(self, words: pa.Array, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(symbols, ends)`` of words that follow ``marks`` word marks."""
        offs, raw = offsets_and_bytes(words)
        points = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32)
        chars = np.asarray(pc.utf8_length(words)).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(chars + marks)])
        sym = np.full(int(ends[-1]), self.mark, np.int64)
        sym[np.repeat(ends[:-1] + marks - (np.cumsum(chars) - chars), chars) + np.arange(chars.sum())] = self.symbols(points)
        return sym, ends

    def encode_words(self, sym: np.ndarray, ends: np.ndarray, back: np.ndarray, names: np.ndarray, numbers: np.ndarray,
                     dropout: float, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(ids, ends, back)``: the encoded words, and the one of each occurrence.

        ``sym, ends`` are the distinct words and ``back`` the word of each occurrence, which is known
        by its document's name and its number there.
        """
        merged: list = []
        ids, upto = self.with_bytes(*merge_all(sym, ends, self.table, None, merged))
        if dropout <= 0 or not merged:
            return ids, upto, back
        row = rows_of(ends)
        place = (np.arange(len(sym)) - ends[row]).astype(np.uint64)
        part = np.concatenate([[np.uint64(0)], np.cumsum(_mixed(sym.view(np.uint64) * _K[0] + place * _K[1]))])
        spelling = (part[ends[1:]] - part[ends[:-1]]).view(np.int64)
        name = keyed(seed, names, numbers, spelling[back])
        limit = np.uint64(min(int(dropout * 2.0 ** 64), 2 ** 64 - 1))

        def candidate(left, right, within):
            return within * _K[2] + ((left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)) * _K[3]

        left, right, at = (np.concatenate(x) for x in zip(*merged))
        order = np.argsort(row[at], kind="stable")
        made = candidate(left, right, place[at])[order]
        n_made = np.bincount(row[at], minlength=len(ends) - 1)
        first = np.cumsum(n_made) - n_made
        skipped = np.zeros(len(back), bool)
        for some in self._portions(np.arange(len(back)), n_made[back]):
            n = n_made[back[some]]
            of = np.repeat(np.arange(len(some)), n)
            which = np.repeat(first[back[some]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            skipped[some[of[_mixed(name[some][of] + made[which]) < limit]]] = True
        pools, sizes, own = [ids], [np.diff(upto)], np.flatnonzero(skipped)
        for some in self._portions(own, np.diff(ends)[back[own]]):
            n = np.diff(ends)[back[some]]
            new_ends = np.concatenate([[0], np.cumsum(n)])
            of = np.repeat(np.arange(len(some)), n)
            source = np.repeat(ends[back[some]] - new_ends[:-1], n) + np.arange(n.sum())
            known, within = name[some], place[source]

            def skip(left, right, at, known=known, of=of, within=within):
                return _mixed(known[of[at]] + candidate(left, right, within[at])) < limit

            got, new_ends = self.with_bytes(*merge_all(sym[source], new_ends, self.table, skip))
            pools.append(got)
            sizes.append(np.diff(new_ends))
        back = back.copy()
        back[own] = len(ends) - 1 + np.arange(len(own))
        return np.concatenate(pools), np.concatenate([[0], np.cumsum(np.concatenate(sizes))]), back

    @staticmethod
    def _portions(items: np.ndarray, sizes: np.ndarray):
        """Consecutive ``items`` that hold about ``AT_ONCE`` together (one at least)."""
        if len(items):
            group = (np.cumsum(sizes) - sizes) // AT_ONCE
            yield from np.split(items, np.flatnonzero(np.diff(group)) + 1)

    def encode(self, a: pa.Array, names: np.ndarray, dropout: float = 0.0, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, offsets)`` of a string array; ``names`` are the documents' numbers."""
        odd = (np.asarray(pc.match_substring(a, "  ")) | np.asarray(pc.starts_with(a, " "))
               | np.asarray(pc.ends_with(a, " ")) | np.asarray(pc.equal(a, "")))
        lists = pc.split_pattern(pc.if_else(pa.array(odd), "", a), " ")
        offs = np.asarray(lists.offsets).astype(np.int64)
        offs, flat = offs - offs[0], lists.flatten()
        d = flat.dictionary_encode()
        code, words, marks = np.asarray(d.indices).astype(np.int64), d.dictionary, np.ones(len(flat), np.int64)
        if odd.any():  # runs of spaces are marks of the word that follows: split these rows one by one
            index = {w: i for i, w in enumerate(words.to_pylist())}
            counts, codes, marked = np.diff(offs), [], []
            for i, text in enumerate(a.to_pylist()):
                if odd[i]:
                    own, run = _split_runs(text)
                    codes.append(np.array([index.setdefault(w, len(index)) for w in own], np.int64))
                    marked.append(np.array(run, np.int64))
                    counts[i] = len(own)
                else:
                    codes.append(code[offs[i]:offs[i + 1]])
                    marked.append(marks[offs[i]:offs[i + 1]])
            code, marks = np.concatenate(codes), np.concatenate(marked)
            offs = np.concatenate([[0], np.cumsum(counts)])
            words = pa.array(list(index), pa.string())
        row = rows_of(offs)
        number = np.arange(len(code)) - offs[row]
        most = int(marks.max(initial=0)) + 1
        each, back = np.unique(code * most + marks, return_inverse=True)
        sym, ends = self.spread(text_array(words.take(pa.array(each // most))), each % most)
        pool, ends, back = self.encode_words(sym, ends, back, names[row], number, dropout, seed)
        n = np.diff(ends)[back]
        upto = np.concatenate([[0], np.cumsum(n)])
        where = np.repeat(ends[back] - upto[:-1], n) + np.arange(upto[-1])
        return pool[where], upto[offs]

    def decode(self, ids: np.ndarray, offs: np.ndarray) -> pa.Array:
        """The texts, without the mark before each."""
        size = np.diff(self.spelled_ends)[ids]
        upto = np.concatenate([[0], np.cumsum(size)])
        raw = self.spelled[np.repeat(self.spelled_ends[ids] - upto[:-1], size) + np.arange(upto[-1])]
        ends = upto[offs]
        first = ends[:-1][np.diff(ends) > 0]
        keep = np.ones(len(raw), bool)
        keep[first] = False
        ends = np.concatenate([[0], np.cumsum(keep)])[ends]
        return pa.Array.from_buffers(pa.large_string(), len(offs) - 1, [None, pa.py_buffer(ends.astype(np.int64).tobytes()),
                                                                        pa.py_buffer(raw[keep].tobytes())]).cast(pa.string())


_MODELS: dict[str, PieceModel] = {}  # one per Python worker and path


def _model(path: str) -> PieceModel:
    return _MODELS.get(path) or _MODELS.setdefault(path, PieceModel(path))


def encode(docs: DataFrame, model_path: str | None = None, dropout: float = DROPOUT, seed: int = SEED,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_sha256, n_pieces, ids`` (little-endian unsigned 32-bit; the digest is of the text)."""
    path = model_path or default_model()
    text = F.coalesce(docs[text_col], F.lit(""))
    src = docs.select(docs[id_col].alias("doc_id"), text.alias("text"), F.xxhash64(docs[id_col]).alias("name"),
                      F.sha2(text, 256).alias("text_sha256"))

    def run(batches):
        model = _model(path)
        for b in sliced(batches, 1, TEXT_SLICE):
            ids, offs = model.encode(text_array(b.column(1)), np.asarray(b.column(2)), dropout, seed)
            col = pa.Array.from_buffers(pa.large_binary(), len(offs) - 1, [
                None, pa.py_buffer((offs * 4).tobytes()), pa.py_buffer(ids.astype("<u4").tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(3), pa.array(np.diff(offs)), col],
                                             names=["doc_id", "text_sha256", "n_pieces", "ids"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, text_sha256 string, n_pieces long, ids binary")


def decode(encoded: DataFrame, model_path: str | None = None, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids; all its columns pass through."""
    path = model_path or default_model()
    at = encoded.columns.index(ids_col)

    def run(batches):
        model = _model(path)
        for b in sliced(batches, at, TEXT_SLICE):
            offs, raw = offsets_and_bytes(pc.fill_null(b.column(at), b""))
            ids = np.frombuffer(raw.tobytes(), "<u4").astype(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, model.decode(ids, offs // 4)], names=[*b.schema.names, out])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField(out, T.StringType())]))
