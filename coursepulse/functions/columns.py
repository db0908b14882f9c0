"""Expressions shared by the operators. All stay JVM-side (no Python UDF)."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def null_safe_isin(col: Column, values: Iterable) -> Column:
    """``col IN values`` where NULL counts as not in the list (pandas ``isin``)."""
    return F.coalesce(col.isin(list(values)), F.lit(False))


def not_true(cond: Column) -> Column:
    """pandas ``not (cond)`` where a missing operand makes ``cond`` False, so the row is kept."""
    return ~F.coalesce(cond, F.lit(False))


def segment_of(date: Column, days: int = 30) -> Column:
    """Segment number ``ceil(date / days)``: -29..0 -> 0, 1..days -> 1."""
    return F.ceil(date / F.lit(float(days))).cast("long")


def day_in_segment(date: Column, days: int = 30) -> Column:
    """Day inside the segment, 1..days."""
    return date - (segment_of(date, days) - 1) * days


def safe_div(num: Column, den: Column) -> Column:
    """Division that yields NULL instead of raising on a zero divisor (ANSI mode)."""
    return F.try_divide(num, den)


def ln_or_null(x: Column) -> Column:
    """Natural log, NULL for zero (pandas would raise / give -inf)."""
    return F.ln(F.nullif(x, F.lit(0.0)))


def entropy_term(p: Column, base: float = 2.0) -> Column:
    """``-p log_base p`` with ``0 log 0 = 0``."""
    logp = F.log2(p) if base == 2.0 else F.ln(p) / F.lit(math.log(base))
    return F.when(p > 0, -p * logp).otherwise(F.lit(0.0))


def band_average(col: Column) -> Column:
    """Mean of the integers written in a band label ('35-55' -> 45.0, '55<=' -> 55.0); NULL kept."""
    nums = F.regexp_extract_all(col, F.lit(r"(\d+)"), 1)
    total = F.aggregate(nums, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return F.when(col.isNull(), F.lit(None).cast("double")).otherwise(safe_div(total, F.size(nums).cast("double")))


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double / float column (used for engine-to-engine comparison)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f"`{f.name}`"), digits).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)
