"""Loading the seven cohort tables with fixed schemas (never schema inference)."""

from __future__ import annotations

import os
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coursepulse.schema import CSV_FILES, SCHEMAS, TABLES
from coursepulse.session import cut_lineage


def _names(names: Iterable[str] | None) -> list[str]:
    chosen = list(names) if names else list(TABLES)
    unknown = [n for n in chosen if n not in SCHEMAS]
    if unknown:
        raise KeyError(f"unknown tables: {unknown}")
    return chosen


def _typed(name: str, col: str, kind, bad_values: str):
    """The column as its type; a value that does not parse raises, or becomes NULL if so asked."""
    value = F.col(f"`{col}`").try_cast(kind)
    if bad_values == "null":
        return value.alias(col)
    message = F.concat(F.lit(f"{name}.{col}: not a {kind.simpleString()}: "), F.col(f"`{col}`"))
    return F.when(F.col(f"`{col}`").isNotNull() & value.isNull(), F.raise_error(message).cast(kind)).otherwise(value).alias(col)


def load_csv_tables(spark: SparkSession, path: str, names: Iterable[str] | None = None,
                    bad_values: str = "raise") -> dict[str, DataFrame]:
    """Read the public data set's CSV files into a dict of lazy tables (``names`` selects a subset).

    The column names come from the header row (files may hold a subset of the columns, in any
    order); the types come from the fixed schema, never from inference. Empty fields are NULL. A
    value that does not parse as its type raises when it is read; ``bad_values="null"`` makes it NULL.
    """
    if bad_values not in ("raise", "null"):
        raise ValueError("bad_values is 'raise' or 'null'")
    out = {}
    for name in _names(names):
        raw = spark.read.option("header", True).option("inferSchema", False).csv(os.path.join(path, CSV_FILES[name]))
        types = {f.name: f.dataType for f in SCHEMAS[name].fields}
        cols = [_typed(name, c, types[c], bad_values) for c in types if c in raw.columns]
        extra = [F.col(f"`{c}`") for c in raw.columns if c not in types]
        out[name] = raw.select(*cols, *extra)
    return out


def load_csv_with_rejects(spark: SparkSession, path: str,
                          names: Iterable[str] | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """The typed tables and one table of what was rejected (``table``, ``file``, ``column``, ``value``, ``reason``).

    A file is read once: every row is typed with the list of its faults beside it and written to the
    checkpoint folder, from where its table takes the rows without a fault and the reject table the faults. Each
    value that does not parse is a fault of its own ('not a long'); a row with more or fewer fields than the header is one
    fault, with NULL as column and the whole line as value. A table without its file raises.
    """
    out, rejected = {}, []
    for name in _names(names):
        file = os.path.join(path, CSV_FILES[name])
        header = spark.read.option("header", True).option("inferSchema", False).csv(file).schema
        line = "__line"
        raw = (spark.read.option("header", True).option("enforceSchema", False).option("columnNameOfCorruptRecord", line)
               .schema(T.StructType([*header.fields, T.StructField(line, T.StringType())])).csv(file))
        types = {f.name: f.dataType for f in SCHEMAS[name].fields}
        def of(column, value, reason):
            return F.struct(column.cast("string").alias("column"), value.alias("value"), F.lit(reason).alias("reason"))

        bad = [F.when(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(types[c]).isNull(),
                      of(F.lit(c), F.col(f"`{c}`"), f"not a {types[c].simpleString()}")) for c in types if c in header.names]
        faults = F.when(F.col(line).isNotNull(), F.array(of(F.lit(None), F.col(line), "wrong number of fields"))).otherwise(
            F.array_compact(F.array(*bad)))
        typed = raw.select(*[_typed(name, c, types[c], "null") for c in types if c in header.names],
                           *[F.col(f"`{c}`") for c in header.names if c not in types],
                           faults.alias("__faults"), F.col("_metadata.file_path").alias("__file"))
        typed = cut_lineage(typed)
        out[name] = typed.where(F.size("__faults") == 0).drop("__faults", "__file")
        rejected.append(typed.select(F.lit(name).alias("table"), F.col("__file").alias("file"),
                                     F.inline("__faults")))
    return out, reduce(DataFrame.unionByName, rejected)


def load_parquet_tables(spark: SparkSession, path: str, names: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """Read tables written by :func:`write_tables` (one folder per table), cast to the fixed schema."""
    out = {}
    for name in _names(names):
        df = spark.read.parquet(os.path.join(path, name))
        out[name] = conform(df, name)
    return out


def conform(df: DataFrame, name: str) -> DataFrame:
    """Cast to the fixed schema; columns of the schema that the frame lacks are left out."""
    have = set(df.columns)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMAS[name].fields if f.name in have])


def write_tables(tables: dict[str, DataFrame], path: str, mode: str = "overwrite") -> None:
    """Write tables as parquet; the click table is partitioned by term so term splits prune files."""
    for name, df in tables.items():
        w = df.write.mode(mode)
        if name == "student_vle":
            w = w.partitionBy("code_presentation")
        w.parquet(os.path.join(path, name))
