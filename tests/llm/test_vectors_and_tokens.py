"""Centroid clustering, whitening and token files against brute force, and on their edge cases."""

import hashlib
import math
import random
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from coursepulse.llm import centroids, eigen, token_files, whitening
from coursepulse.llm.scratch import scratch_path
from coursepulse.llm.shipping import ship_package
from tests.llm.conftest import EDGE

NAN, INF = math.nan, math.inf
CLASHES = "id long, cluster int, distance string, x binary, n int, component string, embedding2 string"


@pytest.fixture(scope="module")
def vectors(spark):
    """``vectors(rows)``: a table of vectors with extra columns whose names the operators use themselves."""
    ship_package(spark)

    def make(rows, kind="float"):
        return spark.createDataFrame([(*r, 1, 1, "d", b"x", 1, "c", "e") for r in rows],
                                     f"vec_id long, embedding array<{kind}>, " + CLASHES)

    return make


def some_vectors(seed, n, d, spread=1.0):
    r = np.random.default_rng(seed)
    return [(int(i), [float(v) for v in x]) for i, x in enumerate((r.normal(size=(n, d)) * spread).astype(np.float32))]


ODD = [(900, None), (901, []), (902, [1.0, None, 0.0, 0.0]), (903, [NAN, 0.0, 0.0, 0.0]), (904, [INF, 0.0, 0.0, 0.0]), (905, [1.0] * 5)]


# --- centroid clustering

def brute_clusters(rows, k, rounds, d, seed=1):
    kept = [(i, [math.floor(64 * c) for c in v]) for i, v in rows
            if v is not None and len(v) == d and all(c is not None and math.isfinite(c) for c in v)]
    if not kept:
        return []
    name = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    cents = [list(x) for _, x in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]
    nearest = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(cents))
    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(nearest(x)[1], []).append(x)
        for n, g in groups.items():
            cents[n] = [sum(c) // len(g) for c in zip(*g)]
    got = [(i, *nearest(x)) for i, x in kept]
    inertia = {n: sum(s for _, s, m in got if m == n) for _, _, n in got}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i if i is not None else -1), n, s, inertia[n], sum(inertia.values()), sha[n]) for i, s, n in got)


def clusters_of(df):
    return sorted((-1 if r.vec_id is None else r.vec_id, *r[1:]) for r in df.collect())


@pytest.mark.parametrize("seed,k,spread", [(1, 5, 1.0), (2, 16, 0.02), (3, 1, 1.0), (4, 40, 30.0)])
def test_clusters_against_all_distances(vectors, seed, k, spread):
    rows = some_vectors(seed, 150, 4, spread)
    rows += [(i + 1000, rows[7][1]) for i in range(60)] + [(3, rows[3][1]), (None, rows[9][1])] + ODD  # copies, a repeated row, no id
    got = clusters_of(centroids.cluster(vectors(rows).repartition(5), k=k, dims=4))
    assert got == brute_clusters(rows, k, 3, 4)


def test_clusters_of_few_no_and_large_vectors(vectors):
    few = [(1, [0.5, 0.25]), (2, [0.5, 0.25]), (3, [-0.5, 8.0])]
    assert clusters_of(centroids.cluster(vectors(few), dims=2)) == brute_clusters(few, 16, 3, 2)
    large = [(i, [c * 2.0 ** 20, 1.5]) for i, c in enumerate((1.0, -3.25, 7.0, 10.0, 1.5))]  # integers beyond the 64-bit path
    assert clusters_of(centroids.cluster(vectors(large, "double"), k=2, dims=2)) == brute_clusters(large, 2, 3, 2)
    for none in ([], ODD):
        assert centroids.cluster(vectors(none), dims=4).collect() == []
    with pytest.raises(Exception, match="64-bit"):
        centroids.cluster(vectors([(1, [1e30]), (2, [0.0]), (3, [0.0])], "double"), k=1, rounds=0, dims=1).collect()


@pytest.mark.parametrize("seed", range(6))
def test_search_equals_all_distances_and_rejects_most(seed):
    r = np.random.default_rng(seed)
    cents = r.integers(-40, 40, (200, 16)) + r.integers(-60, 60, (200, 1))  # means that differ
    cents[50:60] = cents[10]  # equal centroids: the smallest number wins
    x = np.concatenate([cents[r.integers(0, 200, 500)] + r.integers(-3, 4, (500, 16)), cents[:100], r.integers(-50, 50, (200, 16))])
    number, best, computed = centroids.Centroids(cents.tolist()).nearest(x)
    every = ((x[:, None, :] - cents[None]) ** 2).sum(axis=2)
    assert (number == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
    assert computed < 0.5 * every.size
    same, far, _ = centroids.Centroids(cents.tolist()).nearest(x.astype(object))
    assert (same == number).all() and (far == best).all()


# --- eigenvectors

def rotation(r, d):
    q = np.linalg.qr(r.normal(size=(d, d)))[0].astype(np.longdouble)
    for _ in range(3):
        q = q @ (1.5 * np.eye(d) - 0.5 * q.T @ q)
    return q


@pytest.mark.parametrize("values", [list(range(1, 41)), [1 + 1e-9 * i for i in range(8)] + [2.0, 3.0, 5.0], [10.0 ** -i for i in range(12)],
                                    [1 + 1e-7 * i for i in range(4)] + [7 + 1e-10 * i for i in range(4)] + [100.0]])
def test_refined_eigenvectors_are_right_to_the_last_digits(values):
    q = rotation(np.random.default_rng(4), len(values))
    a = (q * np.array(values, np.longdouble)) @ q.T
    got, x, _ = eigen.eigenvectors((a + a.T) / 2)
    order = np.argsort(-np.array(values))
    assert np.abs(got - np.array(values, np.longdouble)[order]).max() < 1e-15 * max(values)
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-17
    assert np.abs(1 - np.abs((x * q[:, order]).sum(axis=0))).max() < 1e-15
    rough = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1]  # the float32 vectors alone are not
    assert np.abs(1 - np.abs((rough * q[:, order]).sum(axis=0))).max() > 1e-9


def test_repeated_and_zero_eigenvalues():
    q = rotation(np.random.default_rng(5), 9)
    values = np.array([3, 3, 3, 1, 1, 0, 0, 0, 8], np.longdouble)
    a = (q * values) @ q.T
    got, x, _ = eigen.eigenvectors((a + a.T) / 2)
    assert np.abs(got - np.sort(values)[::-1]).max() < 1e-17 and np.abs(a @ x - x * got).max() < 1e-17
    assert np.abs(x.T @ x - np.eye(9)).max() < 1e-17
    assert eigen.eigenvectors(np.zeros((2, 2)))[0].tolist() == [0, 0]
    assert eigen.eigenvectors(np.array([[4.0]]))[1].tolist() == [[1]]


# --- whitening

def exact_fit(rows, d):
    kept = [(i, tuple(math.floor(64 * c) + 1_000_000 for c in v)) for i, v in rows
            if v is not None and len(v) == d and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({x for _, x in kept})
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    z = [[n * a - b for a, b in zip(x, s)] for x in fit]
    v = [[Fraction(sum(r[i] * r[j] for r in z), n ** 3) for j in range(d)] for i in range(d)]
    return kept, fit, n, s, v


@pytest.mark.parametrize("seed,d,spread", [(1, 6, 1.0), (2, 20, 0.05), (3, 3, 40.0)])
def test_whitening_against_exact_fractions(vectors, seed, d, spread):
    rows = some_vectors(seed, 120, d, spread)
    rows += [(i + 1000, rows[7][1]) for i in range(300)] + [(3, rows[3][1]), (None, rows[9][1]), *ODD[:5]]
    kept, fit, n, s, v = exact_fit(rows, d)
    got = whitening.whiten(vectors(rows).repartition(4)).collect()
    k = min(16, d)
    assert len(got) == len(kept) * k and {r.n for r in got} == {n}
    values, u = np.linalg.eigh(np.array([[float(c) for c in r] for r in v]))
    values, u = values[::-1], u[:, ::-1]
    by, trace = {}, sum(v[i][i] for i in range(d))
    for r in got:
        assert abs(r.explained * float(trace) / values[r.component - 1] - 1) < 1e-9 and r.identity_error < 1e-9
        by.setdefault((r.vec_id, r.component), []).append(r)
    signs = {}
    for i, x in kept:
        deviation = sum((n * a - b) ** 2 for a, b in zip(x, s))
        y = np.array([float(Fraction(n * a - b, n)) for a, b in zip(x, s)])
        for c in range(1, k + 1):
            want = float(y @ u[:, c - 1] / np.sqrt(values[c - 1]))
            rows_here = [r for r in by[i, c] if int(r.deviation) == deviation]
            assert rows_here
            if abs(want) > 1e-3:
                signs.setdefault(c, set()).add(math.copysign(1, want * rows_here[0].whitened))
            assert abs(abs(rows_here[0].whitened) - abs(want)) < 1e-7
    assert all(len(x) == 1 for x in signs.values())  # one sign for all rows


def test_whitening_does_not_depend_on_partitions(vectors):
    rows = some_vectors(8, 200, 5)
    a, b = ({(r.vec_id, r.component): (r.deviation, r.whitened) for r in whitening.whiten(vectors(rows).repartition(p)).collect()} for p in (1, 7))
    assert a == b


def test_whitening_edges(vectors):
    one = whitening.whiten(vectors([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()  # a single distinct vector
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in sorted(one)] == [
        (i, c, 1, 0, 0.0, 0.0, 0.0) for i in (1, 2) for c in (1, 2)]
    line = whitening.whiten(vectors([(i, [float(i), 2.0 * i, 0.0]) for i in range(4)])).collect()  # one direction only
    assert {(r.component, round(r.explained, 12)) for r in line} == {(1, 1.0), (2, 0.0), (3, 0.0)}
    assert all(r.whitened == 0 for r in line if r.component > 1) and line[0].identity_error < 1e-12
    assert {r.vec_id for r in whitening.whiten(vectors([(1, [1.0, 2.0]), (2, [0.0, 1.0]), (3, [1.0])])).collect()} == {1, 2}
    for none in ([], ODD[:2]):
        assert whitening.whiten(vectors(none)).collect() == []
    wide = [(i, [float(v) * 2.0 ** 30, 1.0]) for i, v in enumerate((1, -5, 9))]  # 8 bytes an entry, sums beyond 64 bits
    kept, _, n, s, _ = exact_fit(wide, 2)
    got = {r.vec_id: int(r.deviation) for r in whitening.whiten(vectors(wide, "double")).collect()}
    assert got == {i: sum((n * a - b) ** 2 for a, b in zip(x, s)) for i, x in kept}


def test_exact_products():
    r = np.random.default_rng(0)
    for top in (3, 1 << 20, 1 << 25, 1 << 40):
        y = r.integers(-top, top, (70, 5))
        assert (whitening.exact_products(y) == y.astype(object).T @ y.astype(object)).all()


# --- token files

@pytest.mark.parametrize("n,universe", [(1, 1), (1, 1 << 64), (5, (1 << 64) - 1), (1000, 1001), (3000, 10 ** 9), (2000, 5), (700, 1 << 40)])
def test_elias_fano_selects_every_value(n, universe):
    r = random.Random(n + universe)
    values = np.array(sorted(r.randrange(universe) for _ in range(n)), np.uint64)
    code = token_files.EliasFano.encode(values, universe)
    ef = token_files.EliasFano(code)
    order = np.array(r.sample(range(n), n))
    assert (ef.select(order) == values[order]).all()
    assert len(code) * 8 <= n * (max(0, math.log2(universe / n)) + 3.5) + 900
    with pytest.raises(IndexError):
        ef.select(np.array([n]))


def test_elias_fano_of_nothing():
    assert len(token_files.EliasFano(token_files.EliasFano.encode(np.zeros(0), 1)).select(np.zeros(0))) == 0


def test_words_apart_equal_the_library():
    from tokenizers import Tokenizer

    encoder, tok = token_files.Encoder(token_files.default_tokenizer()), Tokenizer.from_file(token_files.default_tokenizer())
    r = random.Random(2)
    parts = ["a", "b", " ", "  ", "\n", " \n", "\t", "\xa0", "　", "'s", "12", "!", "é", "x y", "<|endoftext|>", "\x0b", "\x85", "\x1c", "​", "한"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 9))) for _ in range(20_000)] + ["", " ", " a", "a ", "x" * 5000]
    ids, offs = encoder.encode(pa.array(texts))
    assert all(ids[offs[i]:offs[i + 1]].tolist() == tok.encode(t, add_special_tokens=False).ids for i, t in enumerate(texts))


def brute_tokens(rows):
    from tokenizers import Tokenizer

    tok, out, at = Tokenizer.from_file(token_files.default_tokenizer()), {}, 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        out.setdefault(i, []).append((at, len(ids), zlib.crc32(ids.tobytes()), ids.tobytes()))
        at += len(ids)
    return out


@pytest.mark.parametrize("shard_ids", [50, 100_000_000])
def test_token_files_hold_every_id_in_order(spark, docs, shard_ids):
    rows = [*EDGE, (None, "no id"), (-5, "below zero"), (1 << 62, "far off")]
    path = scratch_path(spark, "tokens-test")
    token_files.write_tokens(docs(rows).repartition(3), path, shard_ids=shard_ids)
    got = token_files.read_tokens(spark, path, with_ids=True).collect()
    want = brute_tokens(rows)
    assert sorted((str(r.doc_id), r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) for r in got) == sorted(
        (str(i), *w) for i, all_of in want.items() for w in all_of)
    # one document out of a file by its number
    files = spark.read.format("binaryFile").load(path).collect()
    shard = next(s for s in (token_files.Shard(bytes(f.content)) for f in files if len(f.content) > 1) if 9 in s.doc_ids())
    ids = shard.tokens(shard.doc_ids().index(9)).astype("<u4").tobytes()
    assert ids == want[9][0][3] and shard.ids.itemsize == 2


def test_token_files_that_are_not_whole(spark, docs, empty):
    path = scratch_path(spark, "tokens-cut")
    token_files.write_tokens(docs([(i, "some words " * 9) for i in range(60)]).coalesce(1), path, shard_ids=100)
    data = [bytes(r.content) for r in spark.read.format("binaryFile").load(path).collect() if len(r.content) > 1]
    assert len(data) > 2
    with pytest.raises(token_files.TokenFileError):
        token_files.Shard(data[0][:-40])
    with pytest.raises(token_files.TokenFileError):
        token_files.Shard(b"x" * 200)
    some = [r.path for r in spark.read.format("binaryFile").load(path).select("path", "length").collect() if r.length > 1]
    with pytest.raises(token_files.TokenFileError):
        token_files.part_offsets(spark, some[1:])
    none = scratch_path(spark, "tokens-none")
    token_files.write_tokens(empty, none)
    assert token_files.read_tokens(spark, none).collect() == []


def test_many_rows_of_one_id(spark, docs):
    src = docs([(7, f"text {i % 5}") for i in range(400)] + [(8, "last")])
    path = scratch_path(spark, "tokens-hot")
    token_files.write_tokens(src, path, shard_ids=200)
    rows = token_files.read_tokens(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [7] * 400 + [8]
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))
    assert src.select(F.sum(F.lit(1))).first()[0] == len(rows)
