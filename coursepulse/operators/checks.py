"""Validation operators: key uniqueness, merge indicators, split completeness, share sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursepulse.functions.dims import DEFAULT_MAX_ROWS, row_bound
from coursepulse.operators.features import DuplicateIndex
from coursepulse.operators.split import IN_TEST, IN_TRAIN, with_sides
from coursepulse.schema import TRAIN_TERMS


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count (partial aggregation before the shuffle)."""
    return df.groupBy(*keys).count().where(F.col("count") > 1).withColumnRenamed("count", "n")


UNIQUE_ATTR = "_coursepulse_unique_keys"


def known_unique(df: DataFrame, keys: Sequence[str]) -> bool:
    """True when ``keys`` were already checked unique on this frame."""
    return tuple(keys) in getattr(df, UNIQUE_ATTR, set())


def mark_unique(df: DataFrame, keys: Sequence[str]) -> None:
    setattr(df, UNIQUE_ATTR, getattr(df, UNIQUE_ATTR, set()) | {tuple(keys)})


def assert_unique_keys(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise :class:`DuplicateIndex` if a key repeats (one job; stops at the first duplicate).
    The verdict is remembered on the frame, so a table is checked once."""
    if known_unique(df, keys):
        return
    if duplicate_keys(df, keys).limit(1).count() > 0:
        raise DuplicateIndex(list(keys))
    mark_unique(df, keys)


def merge_with_indicator(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left",
                         name: str = "_merge") -> DataFrame:
    """Equi-join that also says where each row came from: 'left_only', 'right_only' or 'both'."""
    lf, rf = "__in_left", "__in_right"
    l2 = left.withColumn(lf, F.lit(True))
    r2 = right.withColumn(rf, F.lit(True))
    bound = row_bound(right)
    if how == "outer" and bound is not None and bound <= DEFAULT_MAX_ROWS:
        # full outer join with a small right side: the large side is never shuffled on the key
        # (one key may hold a large share of it); right rows without a match come from an anti
        # join against the large side's distinct keys
        matched = l2.join(F.broadcast(r2), list(on), "left")
        unmatched = r2.join(left.select(*on).distinct(), list(on), "left_anti")
        j = matched.unionByName(unmatched, allowMissingColumns=True)
    else:
        j = l2.join(r2, list(on), "full_outer" if how == "outer" else how)
    ind = (F.when(F.col(lf).isNotNull() & F.col(rf).isNotNull(), "both")
           .when(F.col(lf).isNotNull(), "left_only").otherwise("right_only"))
    return j.withColumn(name, ind).drop(lf, rf)


def indicator_counts(df: DataFrame, name: str = "_merge") -> DataFrame:
    """Row count per merge indicator value."""
    return df.groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def split_completeness(tables: dict[str, DataFrame], train_terms: Sequence[str] = TRAIN_TERMS,
                       test_terms: Sequence[str] | None = None) -> DataFrame:
    """Per table: total, train and test rows, counted in one scan of the table (without
    ``test_terms`` train + test must equal total)."""
    out = None
    for name, df in tables.items():
        part = with_sides(df, tables.get("assessments"), train_terms, test_terms).agg(
            F.count(F.lit(1)).alias("n_total"), F.count_if(IN_TRAIN).alias("n_train"),
            F.count_if(IN_TEST).alias("n_test")).withColumn("table_name", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out
