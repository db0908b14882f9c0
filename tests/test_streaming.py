"""The streamed daily base equals the batch daily base over the same click files."""

import os
import tempfile

from pyspark.sql import functions as F

from coursepulse.operators.clicks import daily_clicks
from coursepulse.sources.fixture import fixture_tables
from coursepulse.streaming import start_daily_clicks


def test_stream_matches_batch(spark):
    root = tempfile.mkdtemp(prefix="coursepulse-stream-")
    src = os.path.join(root, "clicks")
    clicks = fixture_tables(spark, "/root/testdata/sf0.001")["student_vle"]
    # two arrivals of click files
    clicks.where(F.col("date") < 10).write.parquet(os.path.join(src, "part1"))
    clicks.where(F.col("date") >= 10).write.parquet(os.path.join(src, "part2"))
    q = start_daily_clicks(spark, os.path.join(src, "*"), os.path.join(root, "ckpt"), query_name="daily_test",
                           sink="memory")
    try:
        q.processAllAvailable()
        got = spark.sql("SELECT * FROM daily_test")
        # update mode: the latest row of each key is its current total
        latest = got.groupBy("code_module", "code_presentation", "id_student", "date").agg(
            F.max("sum_click").alias("sum_click"))
        want = daily_clicks(clicks)
        assert latest.exceptAll(want).count() == 0 and want.exceptAll(latest).count() == 0
    finally:
        q.stop()
