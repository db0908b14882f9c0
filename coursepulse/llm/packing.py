"""Best-fit packing of tokenised documents into sequences of a fixed capacity by bin completion.

A document becomes its token ids and one end id; only documents longer than the capacity are cut,
into pieces of the capacity and a last shorter one. Sequences are bins. Pieces of one length are
interchangeable, so the problem is fully stated by the histogram of lengths, which has at most
``capacity`` rows however large the corpus: Spark counts it, bin completion solves it, and Spark
deals the patterns out to the pieces by their rank within their length.

Bin completion (branch and bound): take the largest remaining piece, enumerate the undominated
fillings of its bin one by one, apply a filling as often as the counts allow or fewer times, go on with the rest. Branches
whose bins and lower bound of the rest do not beat the best known solution are cut; the best-fit-decreasing solution is
the first incumbent, and the search ends at the lower bound, when all is enumerated, or after ``STEPS`` steps, the one limit (the
incumbent is then returned; it is valid and complete, perhaps not minimal). ``Completion`` tells the gap to the bound and
whether the packing is proven minimal.

Defined results: a null or empty text is the end id alone; rows that repeat an id are packed one by
one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from coursepulse.llm.agenda import LONG, PairTable, merge_all
from coursepulse.llm.scratch import written
from coursepulse.llm.words import offsets_and_bytes, sliced, text_array

CAPACITY = 4096
END_ID = 1
TEXT_SLICE = 3 << 20
STEPS = 200_000  # of the search on the driver, some seconds at most
CLASS_ROWS = 100_000  # pieces of one length numbered in one group

Pattern = tuple[tuple[int, int], ...]  # (length, how many), in the order of their places


# --- tokens ---------------------------------------------------------------------------------

#: Words that normalisation leaves alone but for lower-casing letters one to one; an apostrophe can
#: start a part of its own, so words with one are left to the library.
_PLAIN = r"^[!-&(-~À-ÖØ-öø-ÿ]+$"
_LETTER, _DIGIT, _OTHER = 1, 2, 3
_KIND = np.full(256, _OTHER, np.int8)
_KIND[ord("a"):ord("z") + 1] = _LETTER
_KIND[0x80:] = _LETTER
_KIND[ord("0"):ord("9") + 1] = _DIGIT


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class WordTokenizer:
    """Token ids of texts from the ids of their words between spaces and line ends.

    The tokenizer drops white space and no token crosses it, so the ids of a text are those of its
    words in turn; each distinct word of a slice is encoded once. Plain words (letters, digits and
    marks of Latin-1) are merged all at once by the vocabulary's own merge list; the library encodes
    all others. A part (letters, one digit, other marks) ends with a symbol that carries the
    word-end mark, over which no merge reaches, so a word's parts need no separate treatment.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.table = PairTable((vocab[a], vocab[b], i, vocab[a + b]) for i, (a, b) in enumerate(pairs))
        marks = _byte_symbols()
        self.inner = np.array([vocab[c] for c in marks], np.int64)
        self.final = np.array([vocab[c + "</w>"] for c in marks], np.int64)

    def _plain(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        offs, raw = offsets_and_bytes(text_array(pc.utf8_lower(words)))
        kind = _KIND[raw]
        end = np.ones(len(raw), bool)
        end[:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        end[offs[1:] - 1] = True
        symbols = np.where(end, self.final[raw], self.inner[raw])
        parts = np.concatenate([[0], np.flatnonzero(end) + 1])
        ids, part_offs = merge_all(symbols, parts, self.table)
        return ids, part_offs[np.searchsorted(parts, offs)]

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, ends)`` of distinct words; ``ends`` has one entry more than there are words."""
        plain = np.asarray(pc.match_substring_regex(words, _PLAIN)) & ~np.asarray(pc.match_substring(words, "<|"))
        plain &= np.asarray(pc.binary_length(words)) <= LONG  # the library merges long words in n log n
        ids, offs = self._plain(words.filter(pa.array(plain)))
        if plain.all():
            return ids, offs
        others = self.tokenizer.encode_batch_fast(words.filter(pa.array(~plain)).to_pylist(), add_special_tokens=False)
        count = np.zeros(len(words), np.int64)
        count[plain] = np.diff(offs)
        count[~plain] = [len(e.ids) for e in others]
        ends = np.concatenate([[0], np.cumsum(count)])
        from_plain = np.repeat(plain, count)
        out = np.empty(int(ends[-1]), np.int64)
        out[from_plain] = ids
        out[~from_plain] = [x for e in others for x in e.ids]
        return out, ends

    def encode(self, a: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, offsets)`` of a string array: uint32 ids of all rows one after another."""
        lists = pc.split_pattern(pc.replace_substring(a, "\n", " "), " ")
        offs = np.asarray(lists.offsets).astype(np.int64)
        offs = offs - offs[0]
        d = lists.flatten().dictionary_encode()
        pool, ends = self._words(d.dictionary)
        word = np.asarray(d.indices)
        n = np.diff(ends)[word]
        upto = np.concatenate([[0], np.cumsum(n)])
        where = np.repeat((ends[word] - upto[:-1]).astype(np.int32), n) + np.arange(upto[-1], dtype=np.int32)
        return pool.astype(np.uint32)[where], upto[offs]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


_TOKENIZERS: dict[str, WordTokenizer] = {}  # one per Python worker and path


def _tokenizer(path: str) -> WordTokenizer:
    return _TOKENIZERS.get(path) or _TOKENIZERS.setdefault(path, WordTokenizer(path))


def tokenise(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces: ``doc_id, piece, start, length, ids`` (ids: little-endian unsigned 32-bit)."""
    path = tokenizer_path or default_tokenizer()
    src = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))

    def run(batches) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(path)
        for b in sliced(batches, 1, TEXT_SLICE):
            raw, offs = tok.encode(text_array(b.column(1)))
            n = len(offs) - 1
            ids = np.insert(raw, offs[1:], end_id).astype("<u4")
            offs = offs + np.arange(n + 1)
            size = np.diff(offs)
            count = -(-size // capacity)
            row = np.repeat(np.arange(n), count)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            start = piece * capacity
            length = np.minimum(size[row] - start, capacity)
            ends = np.concatenate([[0], np.cumsum(length)]) * 4
            col = pa.Array.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(ends.astype(np.int64).tobytes()),
                                                                      pa.py_buffer(ids.tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), col], names=["doc_id", "piece", "start", "length", "ids"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids binary")


# --- bin completion on the histogram of lengths ------------------------------------------------

def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing, for all pieces of a length at once: ``[(pattern, bins)]``."""
    room: list[list] = [[] for _ in range(capacity + 1)]  # open bins by free room: [pattern, bins]
    used = np.zeros(capacity + 1, bool)
    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            at = np.flatnonzero(used[size:])
            if not len(at):
                each = capacity // size
                for k, bins in ((each, left // each), (left % each, 1)):
                    if k and bins:
                        free = capacity - k * size
                        room[free].append((((size, k),), bins))
                        used[free] = True
                break
            free = int(at[0]) + size
            pattern, bins = room[free].pop()
            used[free] = bool(room[free])
            each = min(free // size, left)
            fits = min(bins, left // each)
            if bins > fits:
                room[free].append((pattern, bins - fits))
                used[free] = True
            now = free - each * size
            room[now].append(((*pattern, (size, each)), fits))
            used[now] = True
            left -= each * fits
    return [x for group in room for x in group]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """The larger of the volume bound and Martello and Toth's L2 bound."""
    n = np.zeros(capacity + 2, np.int64)
    n[np.fromiter(counts, np.int64, len(counts))] = np.fromiter(counts.values(), np.int64, len(counts))
    number, volume = np.cumsum(n), np.cumsum(n * np.arange(capacity + 2))
    half = capacity // 2
    k = np.arange(1, half + 1)
    big = number[-1] - number[capacity - k]
    mid = number[capacity - k] - number[half]
    small = volume[half] - volume[k - 1]
    rest = small - (mid * capacity - (volume[capacity - k] - volume[half]))
    return max(-(-int(volume[-1]) // capacity), int((big + mid + np.maximum(0, -(-rest // capacity))).max(initial=0)))


class Budget:
    """Steps of the search that are left; one for each piece put into a filling, each filling and each branch."""

    def __init__(self, steps: int):
        self.left = steps

    def spend(self, steps: int = 1) -> bool:
        self.left -= steps
        return self.left >= 0


def fillings(counts: dict[int, int], largest: int, capacity: int, budget: Budget) -> Iterator[Pattern]:
    """Every undominated filling around one ``largest`` piece, found one by one, least waste first.

    The other pieces of the bin are a choice among ``counts`` (without that piece). A choice is dominated where a
    piece that is left out could take the place of some of its pieces, being as large or larger, and still fit: the
    bin would hold no less, and what it gave up fits wherever the left-out piece went. Fillings come in passes of
    waste 0, 1, 2 to 3, 4 to 7 and so on; it ends early only when the budget does.
    """
    room = capacity - largest
    avail = sorted(((s, k - (s == largest)) for s, k in counts.items() if s <= room and k > (s == largest)), reverse=True)
    sizes = [s for s, _ in avail]
    most = [0] * (len(avail) + 1)  # volume of the pieces from a place on
    for i in range(len(avail) - 1, -1, -1):
        most[i] = most[i + 1] + sizes[i] * avail[i][1]

    def dominated(used: dict[int, int], free: int) -> bool:
        sums = 1
        for size, k in used.items():
            for _ in range(k):
                sums |= sums << size
        for size, k in avail:
            have = used.get(size, 0)
            if have == k:
                continue
            if size <= free:
                return True
            # a choice of the filling's pieces with a sum from size - free to size; the piece itself is no gain
            low = size - free
            span = free if have else free + 1
            if (sums >> low) & ((1 << span) - 1):
                return True
        return False

    def extend(i: int, free: int, used: dict[int, int], low: int, high: int) -> Iterator[Pattern]:
        at = i
        while at < len(sizes) and sizes[at] > free:
            at += 1
        for j in range(at, len(sizes)):
            if free - most[j] > high:  # all that is left would not fill enough
                break
            size, k = avail[j]
            for c in range(min(k, free // size), 0, -1):
                if not budget.spend():
                    return
                used[size] = c
                yield from extend(j + 1, free - c * size, used, low, high)
                del used[size]
        if low <= free <= high and budget.spend(1 + len(avail)) and not dominated(used, free):
            yield _plus(tuple(used.items()), largest)

    low, high = 0, 0
    while low <= room and budget.left > 0:
        yield from extend(0, room, {}, low, high)
        low, high = high + 1, 2 * high + 1


def _plus(pattern, largest: int) -> Pattern:
    """The pattern with one more ``largest`` piece in front."""
    same = dict(pattern).get(largest, 0)
    return ((largest, same + 1), *(x for x in pattern if x[0] != largest))


class Completion(NamedTuple):
    """``patterns``: ``[(pattern, bins)]``; ``bins`` in all, at least ``bound`` of them are needed; ``proven``: no
    packing has fewer (the bound is met, or the search ended within its budget)."""

    patterns: list[tuple[Pattern, int]]
    bins: int
    bound: int
    proven: bool


def complete(counts: dict[int, int], capacity: int = CAPACITY, steps: int = STEPS) -> Completion:
    """Bin completion for pieces given as ``{length: how many}``.

    A branch is an undominated filling around the largest piece that is left, put to use as often as the counts allow
    or fewer times; it is cut where its bins and the lower bound of the rest reach the best packing known.
    """
    counts = {int(s): int(k) for s, k in counts.items() if k}
    if any(not 0 < s <= capacity for s in counts):
        raise ValueError("a piece must have a length from 1 to the capacity")
    bound = lower_bound(counts, capacity)
    best = best_fit(counts, capacity)
    best_bins = sum(k for _, k in best)
    left, chosen, bins, budget = dict(counts), [], 0, Budget(steps)

    def branches() -> Iterator[tuple[Pattern, int]]:
        now = {s: k for s, k in left.items() if k}
        for pattern in fillings(now, max(now), capacity, budget):
            for k in range(min(now[s] // c for s, c in pattern), 0, -1):
                if not budget.spend(1 + len(now) // 8):
                    return
                yield pattern, k

    stack: list[list] = [[branches(), None]] if best_bins > bound else []
    while stack and best_bins > bound:
        todo, done = stack[-1]
        if done:
            pattern, k = done
            for s, c in pattern:
                left[s] += c * k
            chosen.pop()
            bins, stack[-1][1] = bins - k, None
        branch = next(todo, None)
        if branch is None:
            stack.pop()
            continue
        pattern, k = branch
        for s, c in pattern:
            left[s] -= c * k
        chosen.append(branch)
        bins, stack[-1][1] = bins + k, branch
        if not any(left.values()):
            if bins < best_bins:
                best, best_bins = list(chosen), bins
        elif bins + lower_bound(left, capacity) < best_bins:
            stack.append([branches(), None])
    return Completion(best, best_bins, bound, best_bins == bound or budget.left >= 0)


def bin_completion(counts: dict[int, int], capacity: int = CAPACITY, steps: int = STEPS) -> tuple[list[tuple[Pattern, int]], int]:
    """``([(pattern, bins)], lower bound)`` of :func:`complete`."""
    found = complete(counts, capacity, steps)
    return found.patterns, found.bound


# --- placing ---------------------------------------------------------------------------------

def place(pieces: DataFrame, capacity: int = CAPACITY, steps: int = STEPS) -> DataFrame:
    """``pieces`` (a written table with ``length``) with ``sequence_id`` and ``offset``.

    The driver holds the histogram (at most ``capacity`` rows) and the patterns; a task finds the
    place of a piece from its rank within its length. Ranks are dealt in groups of about
    ``CLASS_ROWS``, so a length that very many pieces share is numbered in many tasks.
    """
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    patterns = complete(histogram, capacity, steps).patterns
    # runs: pieces of a length with ranks from `rank` on fill `each` places a bin from `offset` on
    taken: dict[int, int] = {}
    runs, sequence = [], 0
    for pattern, bins in patterns:
        offset = 0
        for size, each in pattern:
            rank = taken.get(size, 0)
            runs.append((size, rank, sequence, each, offset))
            taken[size] = rank + each * bins
            offset += each * size
        sequence += bins
    table = np.array(sorted(runs), np.int64).reshape(-1, 5)
    wide = 1 << 44
    key = table[:, 0] * wide + table[:, 1]

    salts = max(1, -(-max(histogram.values(), default=0) // CLASS_ROWS))
    names = pieces.columns
    salted = pieces.withColumn("__salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    rank = F.row_number().over(W.partitionBy("length", "__salt").orderBy("doc_id", "piece"))
    before = (salted.groupBy("length", "__salt").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("__before", F.sum("n").over(W.partitionBy("length").orderBy("__salt")) - F.col("n")).drop("n"))
    ranked = (salted.withColumn("__rank", rank).join(before, ["length", "__salt"])
              .select(*names, (F.col("__rank") - 1 + F.col("__before")).alias("__rank")))

    def run(batches):
        for b in batches:
            size = np.asarray(b.column(names.index("length")))
            rank = np.asarray(b.column(len(names)))
            i = np.searchsorted(key, size * wide + rank, side="right") - 1
            k = rank - table[i, 1]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[: len(names)], pa.array(table[i, 2] + k // table[i, 3]),
                 pa.array(table[i, 4] + (k % table[i, 3]) * size)], names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    return ranked.mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Where every piece goes: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Without its ids a piece is a few numbers; they are written once and numbered, the ids are not
    shuffled. ``sequences`` joins them for the token output.
    """
    pieces = tokenise(docs, tokenizer_path, capacity, end_id, id_col, text_col)
    small, _ = written(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "pieces")
    return place(small, capacity)


def sequences(docs: DataFrame, placed: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY,
              end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The packed token ids: ``sequence_id, n_tokens, ids`` (ids must be unique in ``docs``)."""
    ids = tokenise(docs, tokenizer_path, capacity, end_id, id_col, text_col).select("doc_id", "piece", "ids")
    parts = placed.join(ids, ["doc_id", "piece"]).groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", "n_tokens",
                        F.expr("aggregate(parts, cast('' as binary), (a, p) -> concat(a, p.ids))").alias("ids"))
