"""PCA whitening of integer vectors with a covariance over the distinct ones.

An entry ``c`` counts as the integer ``floor(scale * c) + shift``. The fit list is every distinct vector once: Spark groups
the vectors themselves (as bytes), so a vector that a third of all rows share moves once a task, and the
list is written to the shared folder. Two passes over it give the covariance: first the number ``n`` and the sums ``S``, then the
products of the vectors centred at the integer next to their mean. Both are integer sums, so the
covariance is an exact fraction whatever the shift, the order and the number of tasks:

    n^2 V = n sum y y' - (sum y)(sum y)'        with y = x - round(S / n)

Its eigenvectors come from float32 ones by mixed-precision refinement (``eigen.py``); the driver holds ``d x d``
numbers, not rows. A task sends ``d (d + 1) / 2`` sums. A third pass over the list measures the covariance of
the whitened vectors against the identity.

Defined results: rows whose vector is null or holds null, NaN or infinite entries are left out; ``dims`` is the
vectors' length, by default the most frequent one (the larger on ties), and vectors of another
length, which no covariance covers, are left out as well; repeated rows all get their result; an empty table gives an empty result.
A component without variance (fewer distinct vectors than entries, for one) has whitened 0 and is left out of
``identity_error``; without any variance, ``explained`` is 0. Entries beyond 64 bits are an error. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursepulse.llm.eigen import WIDE, eigenvectors
from coursepulse.llm.scratch import written

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
SLICE_ROWS = 4_096
NO_VARIANCE = 1e-15  # of the trace


# --- one slice of vectors -----------------------------------------------------------------------------

def integer_rows(column: pa.Array, dims: int, scale: int = SCALE, shift: int = SHIFT) -> tuple[np.ndarray, np.ndarray]:
    """``(rows, vectors)``: which rows remain, and their entries ``floor(scale * c) + shift`` as int64."""
    size = np.asarray(pc.fill_null(pc.list_value_length(column), -1)).astype(np.int64)
    rows = np.flatnonzero(size == dims)
    flat = column.take(pa.array(rows)).flatten().cast(pa.float64())
    values = np.asarray(pc.fill_null(flat, math.nan)).reshape(-1, dims)
    whole = np.isfinite(values).all(axis=1)
    x = np.floor(scale * values[whole])
    if x.size and np.abs(x).max() >= 2.0 ** 62:
        raise OverflowError("an entry is no 64-bit integer")
    return rows[whole], x.astype(np.int64) + shift


def _packed(x: np.ndarray) -> pa.Array:
    """One binary value a vector, equal if and only if the vectors are: 4 bytes an entry where all fit, else 8."""
    out = np.empty(len(x), object)
    small = (np.abs(x) < 1 << 31).all(axis=1)
    for kind, some in (("<i4", small), ("<i8", ~small)):
        raw = x[some].astype(kind).tobytes()
        width = x.shape[1] * int(kind[-1])
        out[some] = [raw[i:i + width] for i in range(0, len(raw), width)]
    return pa.array(out, pa.binary())


def _unpacked(column: pa.Array, dims: int) -> np.ndarray:
    size = np.asarray(pc.binary_length(column)).astype(np.int64)
    x = np.empty((len(column), dims), np.int64)
    for kind, width in (("<i4", 4 * dims), ("<i8", 8 * dims)):
        some = size == width
        x[some] = np.frombuffer(b"".join(column.filter(pa.array(some)).to_pylist()), kind).reshape(-1, dims)
    return x


def exact_products(y: np.ndarray) -> np.ndarray:
    """``y' y`` in Python integers; float64 products where their sums are exact, else integer ones."""
    top = int(np.abs(y).max(initial=0))
    if top >= 1 << 26:
        wide = y.astype(object)
        return wide.T @ wide
    rows = max(1, (1 << 53) // max(1, top * top))
    out = np.zeros((y.shape[1],) * 2, object)
    for at in range(0, len(y), rows):
        f = y[at:at + rows].astype(np.float64)
        out = out + (f.T @ f).astype(np.int64).astype(object)
    return out


def _sliced(batches, most: int = SLICE_ROWS):
    for b in batches:
        for at in range(0, b.num_rows, most):
            yield b.slice(at, most)


# --- covariance of the fit list -------------------------------------------------------------------------

def _dims(src: DataFrame) -> int:
    """The most frequent length of a vector."""
    row = (src.where("embedding IS NOT NULL").groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("n"))
           .where("d > 0").orderBy(F.desc("n"), F.desc("d")).first())
    return row["d"] if row else 0


def distinct_vectors(src: DataFrame, dims: int, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """The fit list: ``x`` (bytes) of every distinct vector of ``src`` (``embedding``: array<double>)."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for b in _sliced(batches):
            yield pa.RecordBatch.from_arrays([_packed(integer_rows(b.column(0), dims, scale, shift)[1])], names=["x"])

    return src.select("embedding").mapInArrow(run, "x binary").groupBy("x").agg(F.lit(1).alias("one")).select("x")


def _summed(parts: DataFrame, *keys: str) -> list:
    return parts.groupBy(*keys).agg(F.sum("v").alias("v")).collect()


def _decimals(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


class Fit:
    """Number, sums and covariance (numerators over ``n * n``) of a fit list, and its eigenvectors."""

    def __init__(self, n: int, sums: list[int], numerators: np.ndarray, components: int):
        self.n, self.sums, self.d = n, sums, len(sums)
        self.middle = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)  # integers next to the means
        self.rest = np.array([float(Fraction(s - n * int(m), n)) for s, m in zip(sums, self.middle)])
        square = n * n
        whole, part = numerators // square, numerators % square
        cov = whole.astype(WIDE) + np.array([[_wide(v, square) for v in r] for r in part], WIDE)
        lam, vectors, self.steps = eigenvectors(cov)
        trace = sum(Fraction(int(numerators[i, i]), square) for i in range(self.d))
        self.components = min(components, self.d)
        self.covariance, self.vectors = cov, vectors[:, : self.components]
        self.values = lam[: self.components]
        self.explained = [float(v / WIDE(float(trace))) if trace else 0.0 for v in self.values]
        self.alive = np.array([bool(trace) and float(v) > NO_VARIANCE * float(trace) for v in self.values], bool)
        scale = np.array([1 / np.sqrt(v) if a else 0 for v, a in zip(self.values, self.alive)], WIDE)
        self.turn = (self.vectors * scale).astype(np.float64)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.middle).astype(np.float64) - self.rest) @ self.turn

    def deviation(self, x: np.ndarray) -> list[int] | np.ndarray:
        """``sum (n x - S)^2`` of every row: int64 where that is certain to fit, else Python integers."""
        y = x - self.middle
        rest = [s - self.n * int(m) for s, m in zip(self.sums, self.middle)]
        top = self.n * (int(np.abs(y).max(initial=0)) + 1)
        if top < 1 << 62 and self.d * top * top < 1 << 63:
            z = self.n * y - np.array(rest, np.int64)
            return (z * z).sum(axis=1)
        z = self.n * y.astype(object) - np.array(rest, object)
        return list((z * z).sum(axis=1))


def _wide(numerator: int, denominator: int):
    """The fraction (0 <= numerator < denominator) in extended precision."""
    bits = np.finfo(WIDE).nmant + 2
    scaled = (int(numerator) << bits) // denominator
    return np.ldexp(WIDE(scaled >> 32), 32 - bits) + np.ldexp(WIDE(scaled & 0xFFFFFFFF), -bits)


def fit(distinct: DataFrame, dims: int, components: int = COMPONENTS) -> Fit | None:
    """Fit on a (written) list of distinct vectors; None where it is empty."""

    def sums(batches) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(dims, object), 0
        for b in _sliced(batches):
            x = _unpacked(b.column(0), dims)
            total, n = total + (x.astype(object).sum(axis=0) if len(x) and np.abs(x).max() >= 1 << 50 else x.sum(axis=0).astype(object)), n + len(x)
        yield pa.RecordBatch.from_arrays([pa.array(range(dims + 1), pa.int32()), _decimals([*total, n])], names=["i", "v"])

    totals = {r["i"]: int(r["v"]) for r in _summed(distinct.mapInArrow(sums, "i int, v decimal(38,0)"), "i")}
    n = totals.get(dims, 0)
    if not n:
        return None
    s = [totals[i] for i in range(dims)]
    middle = np.array([(2 * v + n) // (2 * n) for v in s], np.int64)
    upper = np.triu_indices(dims)

    def products(batches) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims), object)
        for b in _sliced(batches):
            total = total + exact_products(_unpacked(b.column(0), dims) - middle)
        yield pa.RecordBatch.from_arrays([pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)),
                                          _decimals(total[upper])], names=["i", "j", "v"])

    gram = np.zeros((dims, dims), object)
    for r in _summed(distinct.mapInArrow(products, "i int, j int, v decimal(38,0)"), "i", "j"):
        gram[r["i"], r["j"]] = gram[r["j"], r["i"]] = int(r["v"])
    rest = np.array([v - n * int(m) for v, m in zip(s, middle)], object)
    return Fit(n, s, n * gram - np.outer(rest, rest), components)


def identity_error(distinct: DataFrame, model: Fit) -> float:
    """Largest absolute entry of the whitened list's covariance minus the identity, over components with variance."""
    k, dims = model.components, model.d
    upper = np.triu_indices(k)

    def moments(batches) -> Iterator[pa.RecordBatch]:
        total, mean = np.zeros((k, k)), np.zeros(k)
        for b in _sliced(batches):
            w = model.whiten(_unpacked(b.column(0), dims))
            total, mean = total + w.T @ w, mean + w.sum(axis=0)
        i, j = [*upper[0], *range(k)], [*upper[1], *[k] * k]
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                                          pa.array([*total[upper], *mean], pa.float64())], names=["i", "j", "v"])

    got = {(r["i"], r["j"]): r["v"] / model.n for r in _summed(distinct.mapInArrow(moments, "i int, j int, v double"), "i", "j")}
    alive = np.flatnonzero(model.alive).tolist()
    return max((abs(got[i, j] - got[i, k] * got[j, k] - (i == j)) for i in alive for j in alive if i <= j), default=0.0)


# --- result -------------------------------------------------------------------------------------------

def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT, dims: int | None = None,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every remaining row.

    ``deviation`` is a decimal of up to 38 digits. The tasks get the fit (``d x components`` numbers).
    """
    src = vectors.select(vectors[id_col].alias("id"), vectors[vector_col].cast("array<double>").alias("embedding"))
    kind = src.schema["id"].dataType.simpleString()
    schema = (f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, "
              "identity_error double")
    dims = _dims(src) if dims is None else dims
    model = None
    if dims:
        distinct, _ = written(distinct_vectors(src, dims, scale, shift), "distinct-vectors")
        model = fit(distinct, dims, components)
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    error = identity_error(distinct, model)
    k, n = model.components, model.n

    def run(batches) -> Iterator[pa.RecordBatch]:
        for b in _sliced(batches):
            rows, x = integer_rows(b.column(1), dims, scale, shift)
            each = pa.array(np.repeat(np.arange(len(rows)), k))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(rows)).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                 pa.array(np.full(len(each), n)), _wide_column(model.deviation(x)).take(each), pa.array(model.whiten(x).ravel()),
                 pa.array(np.tile(model.explained, len(rows)), pa.float64()), pa.array(np.full(len(each), error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return src.mapInArrow(run, schema)


def _wide_column(values: list[int] | np.ndarray) -> pa.Array:
    """Integers as decimal(38,0)."""
    if isinstance(values, list):
        return _decimals(values)
    pairs = np.stack([values, values >> 63], axis=1).astype("<i8")
    return pa.Array.from_buffers(pa.decimal128(38, 0), len(values), [None, pa.py_buffer(pairs.tobytes())])
