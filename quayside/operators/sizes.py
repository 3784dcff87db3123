"""Broadcast only what was measured to be small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside import config


def is_small(df: DataFrame, max_rows: int | None = None, weight: Column | None = None) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows, each counted with ``weight`` (default 1)."""
    limit = config.BROADCAST_MAX_ROWS if max_rows is None else max_rows
    total = df.agg(F.coalesce(F.sum(F.lit(1) if weight is None else weight), F.lit(0))).first()[0]
    return total <= limit


def broadcast_if_small(df: DataFrame, max_rows: int | None = None, weight: Column | None = None) -> DataFrame:
    """``df`` with a broadcast hint if it is small.

    Otherwise it is returned without one: the join then shuffles both sides, and adaptive
    execution cuts the partitions of hot keys into pieces.
    """
    return F.broadcast(df) if is_small(df, max_rows, weight) else df
