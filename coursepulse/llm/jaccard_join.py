"""Exact n-gram Jaccard join as a metric-space join.

A document's set holds its distinct 5-word shingles (64-bit hashes of the lower-cased words; a text
of fewer words is one shingle). The Jaccard distance ``d = 1 - J`` is a metric, and documents link
when ``d <= 0.25``. Copies share one set and are joined as one class.

Pivots and regions. Unrelated texts all lie at distance 1 from each other, so documents alone tell
nothing apart at the top level; there the pivots are one-shingle sets. A set is nearest to the pivots
of its own shingles; ties go to the rarer shingle, then to the smaller hash. Two sets within 0.25
share one of their ``n - ceil(0.75 n) + 1`` nearest pivots, and ``1 + s`` of them where each set has
``s`` more. A set is replicated to that many pivots (``s`` is a twentieth of its size), a window that loses
no link. In a pivot's cell the sets are cut into runs of sizes that can link (distances to the empty
and the full set bound sizes), and the smallest class of a run names the region that the run joins.
A set that shares fewer than ``1 + s`` of its cells with any other set links with nothing, and a set
may leave the regions that it shares fewest cells with, ``s / 2`` cells in all: two linked sets still
meet in a cell that neither has left. What is left is shuffled with whole sets.

Within a region the join recurses with documents as pivots: a pivot's distances to all members are
computed exactly, members within 0.25 link to it and form its Voronoi region, and the next pivot is
taken from the rest. Two members of different regions are compared only if the triangle inequality
allows a link: each within 0.5 of the other's pivot, and their distances to either pivot at most 0.25
apart. Members that links already connect are not compared. A region of more than ``region_rows``
members is cut: its members are compared with its pivot where they are, and blocks of those that do
not link are joined with blocks of all members, each pair of blocks in a task of its own.

Shingles that occur in many sets are counted over all documents and made the farthest pivots; which
ones they are changes the work, never the result.

Defined results: texts without words are linked with nothing and have 0 shingles; null counts as
empty; repeated rows are copies of each other; null ids have no component; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from coursepulse.llm.components import components
from coursepulse.llm.scratch import remove, written
from coursepulse.llm.words import offsets_and_bytes, sliced, split_words, text_array

WIDTH, PERCENT = 5, 75
SPARE = 20                # a set's window has one pivot for so many elements beyond the least number
TEXT_SLICE = 4 << 20
COUNTED_AT_ONCE = 3_000_000  # shingles of a task whose sets are counted together
COMMON_ROWS = 2           # sets of a task that make a shingle common
MAX_COMMON = 1_000_000    # common shingles sent to the tasks: 12 MB at most
CELL_ROWS = 1_500_000     # pivot entries handled in one task
REGION_ROWS = 3_000       # members of a region joined in one task
BROADCAST_ROWS = 500_000  # class ids sent to the tasks: 8 MB at most; beyond, a shuffle join

_RNG = np.random.default_rng(20_240_229)
_BYTE = _RNG.integers(0, 1 << 63, size=(64, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _RNG.integers(0, 1 << 63, size=WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of distinct, nonempty words: a sum of table entries by place and byte."""
    offs, raw = offsets_and_bytes(text_array(words))
    if not len(raw):
        return np.zeros(0, np.uint64)
    place = np.arange(len(raw)) - np.repeat(offs[:-1], np.diff(offs))
    part = _BYTE[place & 63, raw]
    far = place >= 64
    if far.any():
        part[far] = _mixed(part[far] + (place[far] >> 6).astype(np.uint64))
    return _mixed(np.add.reduceat(part, offs[:-1]))


def shingle_sets(a: pa.Array, width: int = WIDTH) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    ids, words, offs = split_words(pc.ascii_lower(a))
    h = word_hashes(words)[ids]
    total = np.zeros(max(0, len(h) - width + 1), np.uint64)
    for k in range(width):
        total += h[k:len(h) - width + 1 + k] * _PLACE[k] if len(total) else total
    total = _mixed(total)
    for i, j in zip(offs[:-1].tolist(), offs[1:].tolist()):
        if j - i >= width:
            s = np.sort(total[i:j - width + 1])
            keep = np.ones(len(s), bool)
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            yield s[keep]
        elif j > i:  # the whole sequence, told apart from longer ones by its length
            with np.errstate(over="ignore"):
                yield _mixed(np.array([(h[i:j] * _PLACE[:j - i]).sum(dtype=np.uint64) + np.uint64(j - i)], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def set_class(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def _key(c: bytes) -> int:
    """The class's 64-bit name in the search for candidates (the class itself decides)."""
    return int.from_bytes(c[:8], "little", signed=True)


def spare(n):
    """Pivots a set of ``n`` elements is replicated to beyond the least number."""
    return n // SPARE


def least_spare(n):
    """A lower bound of ``spare`` for the set itself and for every set that it can link with."""
    return ((PERCENT * n + 99) // 100) // SPARE


def window_size(n):
    return min(n, n - (PERCENT * n + 99) // 100 + 1 + spare(n))


# --- passes over the documents -------------------------------------------------------------------

def _classes(docs: DataFrame) -> DataFrame:
    """Rows of documents (``doc_id, class, key, n``) and, beside them, shingles that several sets of a
    task share (``shingle, sets``)."""

    def shared(sets: list[np.ndarray], kind: pa.DataType) -> pa.RecordBatch:
        shingle, times = np.unique(np.concatenate(sets), return_counts=True)
        shingle, times = shingle[times > 1], times[times > 1]
        m = len(shingle)
        return pa.RecordBatch.from_arrays(
            [pa.nulls(m, kind), pa.nulls(m, pa.binary()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()),
             pa.array(shingle.view(np.int64)), pa.array(times.astype(np.int64))], names=names)

    names = ["doc_id", "class", "key", "n", "shingle", "sets"]

    def run(batches):
        held, seen, kind = [], set(), None
        for b in sliced(batches, 1, TEXT_SLICE):
            sets, kind = list(shingle_sets(text_array(b.column(1)))), b.column(0).type
            classes = [set_class(s) for s in sets]
            n = len(sets)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(classes, pa.binary()), pa.array([c and _key(c) for c in classes], pa.int64()),
                 pa.array([len(s) for s in sets], pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], names=names)
            for c, s in zip(classes, sets):  # copies count once
                if c and c not in seen:
                    seen.add(c)
                    held.append(s)
            if sum(map(len, held)) > COUNTED_AT_ONCE:
                yield shared(held, kind)
                held, seen = [], set()
        if held:
            yield shared(held, kind)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, class binary, key long, n long, shingle long, sets long")


def _cells(docs: DataFrame, common: tuple[np.ndarray, np.ndarray], buckets: int) -> DataFrame:
    """Entries ``(pivot shingle, class, size)`` of every set's window, packed by bucket of pivots."""
    hashes, rank = common

    def run(batches):
        seen: set[bytes] = set()
        for b in sliced(batches, 1, TEXT_SLICE):
            out, keys, sizes = [], [], []
            for s in shingle_sets(text_array(b.column(1))):
                c = set_class(s)
                if c is None or c in seen:
                    continue
                seen.add(c)
                p = window_size(len(s))
                if len(hashes):
                    at = np.minimum(np.searchsorted(hashes, s), len(hashes) - 1)
                    often = hashes[at] == s
                    near = s[~often][:p]
                    if len(near) < p:
                        far = s[often]
                        near = np.concatenate([near, far[np.argsort(rank[at[often]], kind="stable")][:p - len(near)]])
                else:
                    near = s[:p]
                out.append(near)
                keys.append(_key(c))
                sizes.append(len(s))
            if not out:
                continue
            count = np.array([len(x) for x in out])
            entry = np.zeros(count.sum(), dtype=[("shingle", "<u8"), ("key", "<i8"), ("size", "<i4")])
            entry["shingle"] = np.concatenate(out)
            entry["key"] = np.repeat(np.array(keys, np.int64), count)
            entry["size"] = np.repeat(np.array(sizes, np.int32), count)
            bucket = (entry["shingle"] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            entry, ends = entry[order], np.cumsum(np.bincount(bucket, minlength=buckets))
            full = np.flatnonzero(np.diff(ends, prepend=0))
            begin = np.concatenate([[0], ends])
            yield pa.RecordBatch.from_arrays(
                [pa.array(full, pa.int32()), pa.array([entry[begin[k]:ends[k]].tobytes() for k in full], pa.binary())],
                names=["bucket", "entries"])

    return docs.mapInArrow(run, "bucket int, entries binary")


def _regions_of_bucket(table: pa.Table) -> pa.Table:
    """``(pivot, member, size, cells)``: each run of linkable sizes in a cell, named by its smallest class."""
    raw = b"".join(table.column("entries").to_pylist())
    e = np.frombuffer(raw, dtype=[("shingle", "<u8"), ("key", "<i8"), ("size", "<i4")])
    order = np.argsort(e["shingle"], kind="stable")
    shingle = e["shingle"][order]
    same = shingle[1:] == shingle[:-1]
    shared = np.zeros(len(e), bool)
    shared[1:] |= same
    shared[:-1] |= same
    e = e[order[shared]]
    e = e[np.lexsort((e["key"], e["size"], e["shingle"]))]
    e = e[np.append(True, e[1:] != e[:-1])] if len(e) else e  # the same class from several tasks
    out = np.zeros(0, dtype=[("pivot", "<i8"), ("member", "<i8"), ("size", "<i4")])
    times = np.zeros(0, np.int64)
    if len(e):
        size = e["size"].astype(np.int64)
        new = np.ones(len(e), bool)
        new[1:] = (e["shingle"][1:] != e["shingle"][:-1]) | (100 * size[:-1] < PERCENT * size[1:])
        first = np.flatnonzero(new)
        run = np.diff(np.append(first, len(e)))
        alone = np.repeat(run == 1, run)
        rows = np.zeros(len(e), out.dtype)
        rows["pivot"], rows["member"], rows["size"] = np.repeat(np.minimum.reduceat(e["key"], first), run), e["key"], e["size"]
        out, times = np.unique(rows[~alone], return_counts=True)
    return pa.table({"pivot": pa.array(out["pivot"].astype(np.int64)), "member": pa.array(out["member"].astype(np.int64)),
                     "size": pa.array(out["size"].astype(np.int64)), "cells": pa.array(times.astype(np.int64))})


def _sets(docs: DataFrame) -> DataFrame:
    """``class, key, set`` of each text that has words."""

    def run(batches):
        for b in sliced(batches, 1, TEXT_SLICE):
            sets = [s for s in shingle_sets(text_array(b.column(1))) if len(s)]
            names = [set_class(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.binary()), pa.array([_key(c) for c in names], pa.int64()),
                 pa.array([s.tobytes() for s in sets], pa.binary())], names=["class", "key", "set"])

    return docs.mapInArrow(run, "class binary, key long, set binary")


# --- the join inside a region --------------------------------------------------------------------

def linked(shared, n, m):
    """Whether sets of ``n`` and ``m`` elements with ``shared`` common ones are within the distance."""
    return 100 * shared >= PERCENT * (n + m - shared)


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)


def join_region(sets: list[np.ndarray]) -> list[int]:
    """For each set the first set that links connect it with: exact, by recursion over pivots."""
    n = np.array([len(s) for s in sets], np.int64)
    forest = _Forest(len(sets))
    if len(sets) == 2:
        if 100 * n.min() >= PERCENT * n.max() and linked(len(np.intersect1d(*sets, assume_unique=True)), n[0], n[1]):
            forest.join(0, 1)
        return [forest.root(i) for i in range(len(sets))]
    _, token, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), n)
    often = times[token] > 1  # a shingle of one set is in no intersection
    token, row = token[often], row[often]
    own = np.searchsorted(row, np.arange(len(sets) + 1))
    weight = np.bincount(row, weights=times[token], minlength=len(sets))
    mark = np.zeros(len(times), np.int64)

    def shared_with(i: int) -> np.ndarray:
        mark[:] = 0
        mark[token[own[i]:own[i + 1]]] = 1
        c = np.concatenate([[0], np.cumsum(mark[token])])
        return c[own[1:]] - c[own[:-1]]

    regions: list[tuple[int, np.ndarray, np.ndarray]] = []  # pivot, its members, its shared counts with all
    free = np.ones(len(sets), bool)
    for pivot in np.argsort(-weight, kind="stable"):
        if not free[pivot]:
            continue
        shared = shared_with(int(pivot))
        near = linked(shared, n[pivot], n)
        for j in np.flatnonzero(near):
            forest.join(int(pivot), int(j))
        members = np.flatnonzero(near & free)
        free[near] = False
        free[pivot] = False
        members = members[members != pivot]
        if len(members):
            regions.append((int(pivot), members, shared))
    # every pair with a pivot is decided; members of different regions meet in the windows
    for x in range(len(regions)):
        p, mine, to_p = regions[x]
        dp = 1 - to_p / (n + n[p] - to_p)
        for q, theirs, to_q in regions[x + 1:]:
            dq = 1 - to_q / (n + n[q] - to_q)
            r = 1 - PERCENT / 100 + 1e-9
            left = mine[dq[mine] <= dq[theirs].max() + r]
            right = theirs[dp[theirs] <= dp[mine].max() + r]
            if not len(left) or not len(right):
                continue
            for i in left:
                may = right[(np.abs(dp[right] - dp[i]) <= r) & (np.abs(dq[right] - dq[i]) <= r)]
                root = forest.root(int(i))
                may = may[[forest.root(int(j)) != root for j in may]] if len(may) else may
                if len(may):
                    shared = shared_with(int(i))[may]
                    for j in may[linked(shared, n[i], n[may])]:
                        forest.join(int(i), int(j))
    return [forest.root(i) for i in range(len(sets))]


def _by_group(batches, column: int) -> Iterator[list[pa.RecordBatch]]:
    """Slices of the rows of one group each, from batches that are sorted by the column."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        key = np.asarray(b.column(column))
        cut = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]]) if len(key) else [0]
        for i, j in zip(cut[:-1], cut[1:]):
            if held and np.asarray(held[0].column(column))[0] != key[i]:
                yield held
                held = []
            held.append(b.slice(i, j - i))
    if held:
        yield held


def _join_regions(batches):
    """``(a, b)`` links between classes from rows ``region, class, set`` sorted by region."""
    left, right = [], []
    for group in _by_group(batches, 0):
        found: dict[bytes, np.ndarray] = {}
        for b in group:
            for c, s in zip(b.column(1).to_pylist(), b.column(2)):
                found.setdefault(c, np.frombuffer(s.as_buffer(), "<u8"))
        names = list(found)
        if len(names) > 1:
            for i, root in enumerate(join_region(list(found.values()))):
                if root != i:
                    left.append(names[root])
                    right.append(names[i])
        if len(left) > 20_000:
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["a", "b"])
            left, right = [], []
    yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["a", "b"])


def _compare_with_pivot(batches):
    """Adds ``near`` to rows ``pivot, class, set, pivot_class, pivot_set``; drops the pivot's columns."""
    for b in batches:
        near = []
        for s, p in zip(b.column(2), b.column(4)):
            x, y = np.frombuffer(s.as_buffer(), "<u8"), np.frombuffer(p.as_buffer(), "<u8")
            near.append(bool(linked(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y))))
        yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(near)], names=["pivot", "class", "set", "pivot_class", "near"])


def _solve(rows: DataFrame) -> DataFrame:
    """Links from rows ``region, class, set``."""
    return rows.repartition("region").sortWithinPartitions("region").mapInArrow(_join_regions, "a binary, b binary")


def _solve_large(rows: DataFrame, sizes: DataFrame, region_rows: int) -> DataFrame:
    """Links of regions with more members than a task takes: rows ``pivot, key, class, set``."""
    first = rows.groupBy("pivot").agg(F.min("key").alias("key"))  # the namesake may have left the region
    pivots = (rows.join(first, ["pivot", "key"]).select("pivot", F.col("class").alias("pivot_class"), F.col("set").alias("pivot_set"))
              .dropDuplicates(["pivot"]))
    compared = rows.select("pivot", "class", "set").join(pivots, "pivot").select("pivot", "class", "set", "pivot_class", "pivot_set")
    compared, _ = written(compared.mapInArrow(
        _compare_with_pivot, "pivot long, class binary, set binary, pivot_class binary, near boolean"), "large-regions")
    half = max(1, region_rows // 2)
    far = compared.where("not near").groupBy("pivot").agg(F.count(F.lit(1)).alias("n_far"))
    blocks = sizes.join(far, "pivot").select("pivot", F.ceil(F.col("n") / half).cast("int").alias("all_blocks"),
                                             F.ceil(F.col("n_far") / half).cast("int").alias("far_blocks"))
    dealt = compared.join(blocks, "pivot").withColumn("h", F.xxhash64("class"))
    # task (i, j): block i of those that do not link, with block j of all
    as_far = dealt.where("not near").select("pivot", "class", "set", F.expr("pmod(h, far_blocks)").alias("i"),
                                            F.explode(F.expr("sequence(0, all_blocks - 1)")).alias("j"))
    as_any = dealt.select("pivot", "class", "set", F.explode(F.expr("sequence(0, far_blocks - 1)")).alias("i"),
                          F.expr("pmod(shiftright(h, 8), all_blocks)").alias("j"))
    tasks = as_far.select("pivot", "i", "j", "class", "set").unionAll(as_any.select("pivot", "i", "j", "class", "set"))
    inner = _solve(tasks.select(F.xxhash64("pivot", "i", "j").alias("region"), "class", "set"))
    return inner.unionAll(compared.where("near").select(F.col("pivot_class").alias("a"), F.col("class").alias("b")))


def _common(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of most sets, ``MAX_COMMON`` at most, sorted by hash, and how many sets have them."""
    table, path = written(counted.where(F.col("sets") >= COMMON_ROWS), "common-shingles")
    least, total = COMMON_ROWS, 0
    for r in table.groupBy("sets").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("sets")).collect():  # a row per count
        total += r["n"]
        if total > MAX_COMMON:
            least = r["sets"] + 1
            break
    got = table.where(F.col("sets") >= least).toArrow()
    remove(table.sparkSession, path)
    hashes, sets = (got.column(c).to_numpy().astype(np.int64) for c in ("shingle", "sets"))
    order = np.argsort(hashes.view(np.uint64))
    return hashes.view(np.uint64)[order], sets.astype(np.int32)[order]


# --- the operator --------------------------------------------------------------------------------

def join_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   region_rows: int = REGION_ROWS) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id`` (ids are integers)."""
    spark = docs.sparkSession
    src = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    table, _ = written(_classes(src), "shingle-classes")
    rows = table.where("shingle is null").select("doc_id", "class", "key", "n")
    often = _common(table.where("shingle is not null").groupBy("shingle").agg(F.sum("sets").alias("sets")))
    bound = rows.agg(F.sum(F.expr(f"n - floor(({PERCENT} * n + 99) / 100) + 1 + floor(n / {SPARE})"))).first()[0] or 0
    buckets = max(1, -(-int(bound) // CELL_ROWS))
    cells = _cells(src, often, buckets)
    met = (cells.groupBy("bucket").applyInArrow(_regions_of_bucket, "pivot long, member long, size long, cells long")
           .groupBy("pivot", "member", "size").agg(F.sum("cells").alias("cells")))
    mine = W.partitionBy("member", "size")  # a set has at most as many regions as elements
    left = F.expr(f"floor(floor(({PERCENT} * size + 99) / 100) / {SPARE})")
    in_region = (met.withColumn("total", F.sum("cells").over(mine))
                 .withColumn("upto", F.sum("cells").over(mine.orderBy("cells", "pivot")))
                 .where((F.col("total") > left) & (F.col("upto") > F.floor(left / 2)))
                 .select("pivot", F.col("member").alias("key")))
    in_region, _ = written(in_region, "jaccard-regions")

    # each class's smallest document stands for it
    classes, _ = written(rows.where("class is not null").groupBy("class", "key").agg(F.min("doc_id").alias("low")),
                         "jaccard-classes")
    sizes = in_region.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"))
    in_region = in_region.join(sizes.where("n > 1").select("pivot"), "pivot", "left_semi")
    ids, _ = written(classes.join(in_region.select("key").distinct(), "key").select(F.col("low").alias("doc_id")).distinct(),
                     "jaccard-candidates")
    few = ids.count() <= BROADCAST_ROWS
    sets = _sets(src.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi").select("doc_id", "text"))
    members = in_region.join(sets, "key")
    large, _ = written(sizes.where(F.col("n") > region_rows), "large-region-sizes")
    if large.isEmpty():
        links = _solve(members.select(F.col("pivot").alias("region"), "class", "set"))
    else:
        members, _ = written(members, "jaccard-members")
        small = members.join(large, "pivot", "left_anti")
        big = members.join(large.select("pivot"), "pivot")
        links = _solve(small.select(F.col("pivot").alias("region"), "class", "set")).unionAll(
            _solve_large(big, large, region_rows))
    links, _ = written(links, "jaccard-links")
    low = classes.select(F.col("class").alias("c"), "low")
    numbered = (links.join(low, links["a"] == low["c"]).select("b", F.col("low").alias("la"))
                .join(low, F.col("b") == low["c"]).select(F.col("la").alias("a"), F.col("low").alias("b")))
    found = components(numbered)
    by_class = classes.join(found, classes["low"] == found["vertex"], "left").select(
        "class", F.coalesce("component", "low").alias("component"))
    return (rows.join(by_class, "class", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, the one with the smallest id, with all its columns."""
    rows, _ = written(join_documents(docs, id_col, text_col).where("component_id <> doc_id").select("doc_id"), "jaccard-gone")
    gone = rows.select(F.col("doc_id").alias("gone_id"))
    return docs.join(gone, docs[id_col] == gone["gone_id"], "left_anti")
