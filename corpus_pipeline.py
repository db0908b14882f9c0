"""Training-corpus pipeline: five stages over ``documents``, each with one operator of ``coursepulse.llm``.

A stage takes ``(spark, docs, sf_dir)`` and returns a frame; ``run`` writes it as Parquet into the
shared checkpoint folder and rereads it as the next stage's ``docs``. All stages but the last return
the columns of ``documents``; the last returns the places of the kept documents' pieces.

Defined results: null, empty and very short texts fail the quality rules; rows that repeat an id and its text
leave one row; other columns pass through whatever their names; without labels nothing counts as toxic; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from coursepulse.llm import exact_dedup, jaccard_join, packing, quality, toxicity
from coursepulse.llm.scratch import remove, written
from coursepulse.llm.shipping import ship_package


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    ship_package(spark)
    return quality.keep_documents(docs)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold; labels come from the folder's ``labels``."""
    ship_package(spark)
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    ship_package(spark)
    return exact_dedup.keep_one(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies."""
    ship_package(spark)
    return jaccard_join.keep_one(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every piece of the kept documents in the packed sequences."""
    ship_package(spark)
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("best-fit packing", best_fit_packing),
]

#: Scores of fitted trees and bin completion are not SQL; tests hold ``run`` against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the folder's ``documents``."""
    docs, path = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs, new = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if path:
            remove(spark, path)
        path = new
    return STAGES[-1][1](spark, docs, sf_dir)
