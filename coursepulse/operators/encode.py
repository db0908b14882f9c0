"""Encoders: numeric (mean fill + z-score), categorical (top-n one-hot), ordinal, responses.

Fitting is one aggregate job whose small result (a mean and a std, a top-n list, a mode) comes
to the driver; transforming is a ``select`` of literal-parameterised expressions, so it stays in
whole-stage codegen on the executors. Several columns of one table are fitted in a single
aggregate (``fit_numeric`` takes a list).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursepulse.functions.columns import band_average, safe_div
from coursepulse.functions.dims import few_rows


# ---------------------------------------------------------------- numeric
@dataclass
class NumericData:
    """Mean fill and z-score with the sample standard deviation (both over non-null values)."""

    fillna: str = "mean"
    normalize: bool = True
    params: dict[str, dict[str, float | None]] = field(default_factory=dict)

    def __post_init__(self):
        if self.fillna != "mean":
            raise NotImplementedError("only fillna='mean' is defined")

    def fit(self, df: DataFrame, cols: str | Sequence[str]) -> "NumericData":
        cols = [cols] if isinstance(cols, str) else list(cols)
        aggs = []
        for c in cols:
            aggs += [F.avg(c).alias(f"{c}__mu"), F.stddev_samp(c).alias(f"{c}__sd")]
        row = df.agg(*aggs).first()
        for c in cols:
            self.params[c] = {"mu": row[f"{c}__mu"], "std": row[f"{c}__sd"]}
        return self

    def column(self, c: str, out: str | None = None) -> Column:
        p = self.params[c]
        mu = F.lit(p["mu"]).cast("double")
        x = F.coalesce(F.col(c).cast("double"), mu)
        if self.normalize:
            x = safe_div(x - mu, F.lit(p["std"]).cast("double"))
        return x.alias(out or c)

    def columns(self, c: str) -> list[Column]:
        return [self.column(c)]


def fill_zero(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Missing numeric values replaced by 0."""
    return df.na.fill(0, subset=list(cols) if cols else None)


def column_means(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Mean of each column that has a value (one aggregate for all columns)."""
    row = df.agg(*[F.avg(f"`{c}`").alias(c) for c in cols]).first()
    return {c: row[c] for c in cols if row[c] is not None}


def fill_mean(df: DataFrame, cols: Sequence[str], means: dict[str, float] | None = None) -> DataFrame:
    """Missing values replaced by the column mean, or by the given ``means`` of another split (as
    doubles; a column without a mean keeps its NULLs)."""
    means = column_means(df, cols) if means is None else means
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(means[c]).cast("double"))
                           for c in cols if c in means})


# ---------------------------------------------------------------- categorical
def top_categories(df: DataFrame, col: str, n: int | None) -> list[str]:
    """Most frequent non-null values, ties by value; the distinct list is cut on the executors."""
    q = (df.where(F.col(col).isNotNull()).groupBy(col).count()
         .orderBy(F.desc("count"), F.asc(col)))
    if n is not None:
        q = q.limit(n)
    return [r[0] for r in few_rows(q, f"values of {col}")]


def one_hot_columns(col: str, categories: Sequence[str], prefix: str | None = None) -> list[Column]:
    pre = f"{col}_" if prefix is None else prefix
    return [F.when(F.col(col) == v, F.lit(1.0)).otherwise(F.lit(0.0)).alias(f"{pre}{v}") for v in categories]


@dataclass
class CategoricalData:
    """One-hot of the ``most_common`` values; other values and NULL give an all-zero row."""

    encode: str = "one-hot"
    most_common: int = 10
    handle_unknown: str = "ignore"
    params: dict[str, list[str]] = field(default_factory=dict)

    def __post_init__(self):
        if self.encode != "one-hot":
            raise NotImplementedError("only one-hot encoding is defined")

    def fit(self, df: DataFrame, cols: str | Sequence[str]) -> "CategoricalData":
        for c in ([cols] if isinstance(cols, str) else cols):
            self.params[c] = top_categories(df, c, self.most_common)
        return self

    def columns(self, c: str) -> list[Column]:
        return one_hot_columns(c, self.params[c])


# ---------------------------------------------------------------- ordinal
@dataclass
class OrdinalData:
    """Index in a given order; NULL and unlisted values get the index of the modal listed value."""

    order: list[str]
    handle_unknown: str = "ignore"
    fillna: str = "most_common"
    params: dict[str, int] = field(default_factory=dict)

    def __post_init__(self):
        if self.fillna != "most_common":
            raise NotImplementedError("only fillna='most_common' is defined")

    def fit(self, df: DataFrame, cols: str | Sequence[str]) -> "OrdinalData":
        for c in ([cols] if isinstance(cols, str) else cols):
            top = (df.where(F.col(c).isin(self.order)).groupBy(c).count()
                   .orderBy(F.desc("count"), F.asc(c)).limit(1).collect())
            self.params[c] = self.order.index(top[0][0]) if top else 0
        return self

    def column(self, c: str) -> Column:
        pos = F.array_position(F.array(*[F.lit(v) for v in self.order]), F.col(c))
        return F.coalesce(F.nullif(pos, F.lit(0)) - 1, F.lit(self.params[c]).cast("long")).alias(c)

    def columns(self, c: str) -> list[Column]:
        return [self.column(c)]


def label_index(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Integer label encoding in alphabetical order of the distinct values (0-based).

    The distinct values are numbered in range-sorted partitions, so their number is not bounded by a
    task, and joined back (broadcast where their size allows it).
    """
    from coursepulse.functions.dims import bounded_broadcast
    from coursepulse.operators.numbering import number_rows

    labels = df.select(col).where(F.col(col).isNotNull()).distinct()
    labels = number_rows(labels, [col], out or f"{col}_label")
    return df.join(bounded_broadcast(labels, 100_000), col, "left")


def band_midpoint(col: str) -> Column:
    return band_average(F.col(col)).alias(col)


# ---------------------------------------------------------------- responses
def response_column(targets: Sequence[Sequence[str]], source: str = "final_result") -> Column:
    """Index of the target group containing the label (a later group wins), NULL otherwise."""
    mapping: dict[str, float] = {}
    for i, group in enumerate(targets):
        for label in group:
            mapping[label] = float(i)
    if not mapping:
        return F.lit(None).cast("double")
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(m, F.col(source))


def map_outcome(col: str, mapping: dict, strict: bool = True) -> Column:
    """Map a label with a fixed dict; unknown labels raise when ``strict`` (NULL otherwise)."""
    expr = None
    for k, v in mapping.items():
        lit = F.lit(v)
        expr = F.when(F.col(col) == k, lit) if expr is None else expr.when(F.col(col) == k, lit)
    if strict:
        known = F.col(col).isin(list(mapping))
        err = F.raise_error(F.concat(F.lit("unknown label: "), F.coalesce(F.col(col), F.lit("NULL"))))
        return F.when(known, expr).otherwise(err)
    return expr
