"""Connected components of links by alternating large-star and small-star steps (Kiveris et al. 2014).

Only minima are aggregated, so a vertex with very many links moves as one row per task; the join
that hands a minimum back has one row per vertex on one side, and Spark can split a hot vertex on
the other. Every round is written to the shared checkpoint folder; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursepulse.llm.scratch import remove, written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return both.join(low, both["u"] == low["w"]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
    down = edges.join(low, edges["u"] == low["w"]).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return down.unionAll(low.select(F.col("w").alias("u"), F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(vertex, component)`` for the vertices of ``links`` (``a, b``: numbers); the component is the
    smallest vertex that links reach. Vertices that are their own component are left out."""
    spark = links.sparkSession
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    table, path = written(edges, "links")
    state = None
    while True:
        new, new_path = written(_small_star(_large_star(table)), "links")
        remove(spark, path)
        table, path = new, new_path
        now = tuple(table.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            return table.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
        state = now
