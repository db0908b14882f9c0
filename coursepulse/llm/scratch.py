"""Tables written to the shared folder the cluster names in ``spark.checkpoint.dir``.

A written table cuts the lineage like ``checkpoint()`` does, but is compressed, typed and can be
pruned by column. Executors that are lost take nothing with them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from coursepulse.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet into the shared folder; returns the reread frame and its path."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that no later step reads."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
