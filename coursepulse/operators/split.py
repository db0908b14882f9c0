"""Train / test split by term.

Tables with a term column split on it (a NULL term goes to the test side, as pandas ``~isin``
does); tables without one split by the ids of the assessments given in the training terms. Written partitioned by term, the split of the click
table is a partition-pruned scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursepulse.functions.columns import null_safe_isin
from coursepulse.functions.dims import bounded_broadcast, mark_bounded, row_bound
from coursepulse.schema import TEST_TERMS, TRAIN_TERMS


IN_TRAIN, IN_TEST = "__in_train", "__in_test"


def assessment_sides(assessments: DataFrame, train_terms: Sequence[str]) -> DataFrame:
    """One row per assessment id: given in a training term, given in another one."""
    mask = null_safe_isin(F.col("code_presentation"), train_terms)
    out = assessments.groupBy("id_assessment").agg(F.max(mask).alias(IN_TRAIN), F.max(~mask).alias(IN_TEST))
    bound = row_bound(assessments)
    return mark_bounded(out, bound) if bound is not None else out


def with_sides(df: DataFrame, assessments: DataFrame | None = None, train_terms: Sequence[str] = TRAIN_TERMS,
               test_terms: Sequence[str] | None = None) -> DataFrame:
    """``df`` with two flags: the row belongs to the training side, to the test side.

    Without ``test_terms`` the test side is every other row. With them, a table that has a term
    tests it against them, and a table without one is tested by the assessments of the other terms
    (rows of unknown assessments are then on neither side).
    """
    if "code_presentation" in df.columns:
        train = null_safe_isin(F.col("code_presentation"), train_terms)
        test = ~train if test_terms is None else null_safe_isin(F.col("code_presentation"), test_terms)
        return df.withColumns({IN_TRAIN: train, IN_TEST: test})
    if "id_assessment" not in df.columns:
        raise ValueError("table has neither a term nor an assessment id column")
    if assessments is None:
        raise ValueError("assessments are needed to split a table without a term column")
    x = df.join(bounded_broadcast(assessment_sides(assessments, train_terms)), "id_assessment", "left")
    train = F.coalesce(IN_TRAIN, F.lit(False))
    test = ~train if test_terms is None else F.coalesce(IN_TEST, F.lit(False))
    return x.select(*df.columns, train.alias(IN_TRAIN), test.alias(IN_TEST))


def train_test_split_df(df: DataFrame, assessments: DataFrame | None = None,
                        train_years: Sequence[str] | None = TRAIN_TERMS) -> tuple[DataFrame, DataFrame]:
    """Split one table: rows of the training terms vs. all other rows."""
    if train_years is None:
        raise ValueError("the training terms cannot be missing")
    return _sides(df, with_sides(df, assessments, train_years))


def _sides(df: DataFrame, flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    return tuple(_keep_bound(flagged.where(side).drop(IN_TRAIN, IN_TEST), df) for side in (IN_TRAIN, IN_TEST))


def _keep_bound(child: DataFrame, parent: DataFrame) -> DataFrame:
    """A row filter keeps the parent's row bound and its checked unique keys."""
    from coursepulse.operators import checks

    bound = row_bound(parent)
    for keys in getattr(parent, checks.UNIQUE_ATTR, set()):
        checks.mark_unique(child, keys)
    return mark_bounded(child, bound) if bound is not None else child


def train_test_split(raw: dict[str, DataFrame], train_years: Sequence[str] | None = TRAIN_TERMS
                     ) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Split every table of the container (tables without a term go by assessment id)."""
    train, test = {}, {}
    for name, df in raw.items():
        train[name], test[name] = train_test_split_df(df, raw.get("assessments"), train_years)
    return train, test


def legacy_split(df: DataFrame, assessments: DataFrame, train_terms: Sequence[str] = TRAIN_TERMS,
                 test_terms: Sequence[str] = TEST_TERMS) -> tuple[DataFrame, DataFrame]:
    """Split with explicit test terms; rows of other terms (or NULL) are in neither side."""
    return _sides(df, with_sides(df, assessments, train_terms, test_terms))
