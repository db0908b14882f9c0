"""Sink of the merged feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_feature_table(df: DataFrame, path: str, partition_by: str = "code_presentation",
                        mode: str = "overwrite") -> None:
    """Write a feature table as parquet partitioned by term, so a later term split prunes files."""
    df.write.mode(mode).partitionBy(partition_by).parquet(path)
