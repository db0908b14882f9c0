"""Incremental maintenance of the daily click base from a stream of click files.

The batch operators read whole tables. When click files keep arriving, the daily base
``(student, day) -> clicks`` that every click feature starts from can be kept current with
Structured Streaming instead of being recomputed: the same ``daily_clicks`` aggregation runs on a
file stream and its running result is written in update mode (``foreachBatch`` lets a caller
merge each micro-batch into a table). Days are integer offsets, not event times, so there is no
watermark: the state holds one entry per (student, course, day), bounded by students x course days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from coursepulse.operators.clicks import daily_clicks
from coursepulse.schema import SCHEMAS


def click_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Click files (parquet, fixed schema) under ``path`` as a stream."""
    reader = spark.readStream.schema(SCHEMAS["student_vle"])
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def daily_clicks_stream(spark: SparkSession, path: str) -> DataFrame:
    """Streaming daily base: the batch operator applied to the click stream."""
    return daily_clicks(click_stream(spark, path))


def start_daily_clicks(spark: SparkSession, path: str, checkpoint: str, query_name: str = "daily_clicks",
                       sink: str | None = None, foreach_batch=None) -> StreamingQuery:
    """Start the daily-base stream (update mode) into a ``sink`` format or a ``foreach_batch`` function;
    one of them must be named. ``checkpoint`` must be a shared folder on a cluster."""
    if sink is None and foreach_batch is None:
        raise ValueError("name a sink or a foreach_batch function")
    w = (daily_clicks_stream(spark, path).writeStream.outputMode("update")
         .option("checkpointLocation", checkpoint).queryName(query_name))
    if foreach_batch is not None:
        return w.foreachBatch(foreach_batch).start()
    return w.format(sink).start()
