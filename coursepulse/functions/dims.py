"""Broadcast only sides whose size is bounded, with a shuffle join beyond the bound.

A dimension side (courses, sites, schedules) is broadcast when its row count is proven to be at
most ``max_rows`` and its rows, by the types of their columns, to take at most ``MAX_BYTES``: either a
bound is declared where the table is built (e.g. one row per course by construction), or a
``limit(rows + 1).count()`` check is run once and remembered on the frame. Strings and nested values
have no fixed width; their stored length is measured with the count. Above the bound the frame is
returned as is and Spark plans a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

DEFAULT_MAX_ROWS = 1_000_000
FEW_ROWS = 10_000
MAX_BYTES = 256 * 1024 * 1024

_ATTR = "_coursepulse_row_bound"


def mark_bounded(df: DataFrame, rows: int) -> DataFrame:
    """Declare that ``df`` has at most ``rows`` rows (proven by how it is built)."""
    setattr(df, _ATTR, int(rows))
    return df


def row_bound(df: DataFrame) -> int | None:
    return getattr(df, _ATTR, None)


def few_rows(df: DataFrame, what: str, limit: int = FEW_ROWS) -> list[Row]:
    """The rows of a frame that is small by its meaning (classes, categories, activities); more are an error.

    At most ``limit + 1`` rows reach the driver.
    """
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} {what}")
    return rows


def narrowed(df: DataFrame, *cols: str) -> DataFrame:
    """``df.select(cols)`` with the row bound of ``df``."""
    out, bound = df.select(*cols), row_bound(df)
    return out if bound is None else mark_bounded(out, bound)


def _fixed_width(df: DataFrame) -> int:
    return 8 * len(df.columns) + 32


def _measured(df: DataFrame, max_rows: int) -> tuple[int, int]:
    """Rows (at most ``max_rows + 1``) and bytes of those rows."""
    var = [F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0)) for f in df.schema.fields
           if f.dataType.typeName() in ("string", "binary", "array", "map", "struct")]
    width = sum(var, F.lit(_fixed_width(df)).cast("long"))
    row = df.select(width.alias("w")).limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum("w")).first()
    return row[0], row[1] or 0


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS) -> DataFrame:
    """``F.broadcast(df)`` if ``df`` has at most ``max_rows`` rows and ``MAX_BYTES``, else ``df`` unchanged."""
    bound = row_bound(df)
    if bound is None:
        bound, size = _measured(df, max_rows)
        if bound > max_rows or size > MAX_BYTES:
            return df
        mark_bounded(df, bound)
    if bound <= max_rows:
        return mark_bounded(F.broadcast(df), bound)
    return df
