"""Registry of the checked queries: a Spark callable and, where SQL can express it, an oracle query.

Each query reads the generated tables through ``coursepulse.sources.fixture`` (Spark side) and
the same mapping as SQL CTEs (oracle side). Doubles are rounded to 6 digits on both sides and
every computed column carries the same alias.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from coursepulse.functions.columns import round_doubles
from coursepulse.plans.mapping_sql import with_mapping

TRAIN_IN = "('2013B', '2013J', '2014B')"


@dataclass
class Entry:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    body: str | None

    @property
    def sql(self) -> str | None:
        """Oracle SQL; double outputs rounded to 6 digits (half away from zero, as Spark's round)."""
        if not self.body:
            return None
        from coursepulse.plans.output_doubles import OUTPUT_DOUBLES

        sql = with_mapping(self.body)
        doubles = OUTPUT_DOUBLES.get(self.name, [])
        if not doubles:
            return sql
        repl = ", ".join(f'round("{c}", 6) AS "{c}"' for c in doubles)
        return f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) AS q"


REGISTRY: dict[str, Entry] = {}
TUNED = ("m8_forest_grid_search", "m8_m10_forest_properties", "m10_feature_importance", "m11_forest_test_metrics", "m7_m9_first_assessment_models")


def query(name: str, sql: str | None = None, rounded: bool = True):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with its oracle SQL body."""

    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            return round_doubles(df, 6) if rounded else df

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = Entry(name, run, sql)
        return fn

    return deco


def load_all() -> dict[str, Entry]:
    # importing the modules fills the registry
    from coursepulse.plans import (  # noqa: F401
        q_clicks,
        q_core,
        q_distributions,
        q_model,
        q_regularity,
        q_stats,
    )
    # the tuned models, which run for minutes, come last
    for name in TUNED:
        REGISTRY[name] = REGISTRY.pop(name)
    return REGISTRY
