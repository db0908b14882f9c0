"""Sources and sinks: CSV files with a header row and parquet folders read back with the fixed schemas."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from coursepulse.operators.features import DuplicateIndex
from coursepulse.plans import feature_pool as fp
from coursepulse.schema import CSV_FILES, TABLES
from coursepulse.sources import conform, fixture_tables, load_csv_tables, load_parquet_tables, write_tables


def _checksum(df):
    cols = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in sorted(df.columns)]
    return df.select(F.sum(F.xxhash64(*cols) % 1000003).alias("h")).first()["h"], df.count()


@pytest.fixture(scope="module")
def raw(spark):
    return fixture_tables(spark, "/root/testdata/sf0.001")


def test_csv_roundtrip(spark, raw):
    root = tempfile.mkdtemp(prefix="coursepulse-csv-")
    for t in TABLES:
        # one CSV file per table, named as in the public data set
        out = os.path.join(root, "_" + t)
        conform(raw[t], t).coalesce(1).write.option("header", True).csv(out)
        part = [f for f in os.listdir(out) if f.endswith(".csv")][0]
        os.link(os.path.join(out, part), os.path.join(root, CSV_FILES[t]))
    back = load_csv_tables(spark, root)
    for t in TABLES:
        assert _checksum(back[t]) == _checksum(conform(raw[t], t)), t
    sub = load_csv_tables(spark, root, ["vle", "courses"])
    assert sorted(sub) == ["courses", "vle"]


def test_parquet_roundtrip(spark, raw):
    root = tempfile.mkdtemp(prefix="coursepulse-pq-")
    write_tables({t: conform(raw[t], t) for t in ("student_vle", "courses")}, root)
    back = load_parquet_tables(spark, root, ["student_vle", "courses"])
    assert _checksum(back["student_vle"]) == _checksum(conform(raw["student_vle"], "student_vle"))
    # the click table is partitioned by term: a term filter reads one folder
    plan = back["student_vle"].where(F.col("code_presentation") == "2014J")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(code_presentation" in plan


def test_extract_column_checks_keys(spark, raw):
    col = fp.extract_column(raw, "student_info", "gender")
    assert col.columns == ["code_module", "code_presentation", "id_student", "gender"]
    dup = {"student_info": raw["student_info"].unionByName(raw["student_info"].limit(1))}
    with pytest.raises(DuplicateIndex):
        fp.extract_column(dup, "student_info", "gender")
