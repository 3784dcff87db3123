"""Checks on data and row counts taken along the way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class QualityError(AssertionError):
    """A data check found failing rows."""


def failing_rows(df: DataFrame, rule: Column) -> DataFrame:
    """Rows that break a check: those the rule is true for."""
    return df.where(rule)


def non_positive_duration() -> Column:
    return F.col("duration_hrs") <= 0


def expect_none(df: DataFrame, rule: Column, name: str = "check") -> DataFrame:
    """Raise :class:`QualityError` if any row breaks the check; else hand ``df`` on."""
    sample = failing_rows(df, rule).take(5)
    if sample:
        raise QualityError(f"{name}: failing rows, among them {sample}")
    return df


def drop_non_positive(voyages: DataFrame) -> DataFrame:
    """The rule applied when voyages are stored: an unknown duration stays."""
    return voyages.where((F.col("duration_hrs") > 0) | F.col("duration_hrs").isNull())


def counted(df: DataFrame, name: str, **more: Column) -> tuple[DataFrame, Observation]:
    """Count rows while they pass, without a job of its own: ``observation.get["rows"]``.

    ``more`` are further aggregates to take along, of bounded size.
    """
    observation = Observation(name)
    extra = [column.alias(key) for key, column in more.items()]
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *extra), observation
