"""Dashboard queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RECENT_ROWS = 10
LAST_DAYS_ROWS = 100
RUN_HISTORY_ROWS = 10


def totals(voyages: DataFrame) -> DataFrame:
    """Number of voyages and vessels, and miles sailed."""
    return voyages.agg(
        F.count("*").alias("voyages"),
        F.count_distinct("mmsi").alias("vessels"),
        F.sum("distance_nm").alias("total_distance"),
    )


def recent(voyages: DataFrame, rows: int = RECENT_ROWS) -> DataFrame:
    """Voyages that ended last."""
    return voyages.orderBy(F.desc("arr_time"), "mmsi", "dep_time").limit(rows)


def _of_vessel(voyages: DataFrame, mmsi: int | str) -> DataFrame:
    # The page parameter is text; one that is no number matches nothing.
    return voyages.where(F.col("mmsi") == F.lit(str(mmsi)).try_cast("bigint"))


def vessel_stats(voyages: DataFrame, mmsi: int | str) -> DataFrame:
    """Trips and miles of a vessel, one row per name it used."""
    return (
        _of_vessel(voyages, mmsi)
        .groupBy("vessel_name")
        .agg(F.count("*").alias("total_trips"), F.sum("distance_nm").alias("total_nm"))
    )


def vessel_history(voyages: DataFrame, mmsi: int | str) -> DataFrame:
    """Legs of a vessel, newest first."""
    return (
        _of_vessel(voyages, mmsi)
        .select("dep_locode", "arr_locode", "dep_time", "duration_hrs")
        .orderBy(F.desc("dep_time"), "arr_locode")
    )


def last_days(
    voyages: DataFrame, days: int = 30, as_of: date | None = None, rows: int = LAST_DAYS_ROWS
) -> DataFrame:
    """Newest voyages that departed in the last ``days`` days before ``as_of`` (default today)."""
    today = F.current_date() if as_of is None else F.lit(as_of)
    return (
        voyages.where(F.col("dep_time") >= F.date_sub(today, days).cast("timestamp_ntz"))
        .orderBy(F.desc("dep_time"), "mmsi", "arr_time")
        .limit(rows)
        .select("vessel_name", "dep_locode", "arr_locode", "dep_time", "distance_nm", "route_geometry")
    )


def run_history(run_log: DataFrame, rows: int = RUN_HISTORY_ROWS) -> DataFrame:
    """Models run and seconds spent per run time and status, newest first."""
    return (
        run_log.groupBy(F.col("generated_at").alias("run_time"), "status")
        .agg(F.count("unique_id").alias("models_run"), F.sum("execution_time").alias("total_duration_sec"))
        .orderBy(F.desc("run_time"), "status")
        .limit(rows)
    )


def latency(run_log: DataFrame, pattern: str = "%stg_ais%") -> DataFrame:
    """Seconds and rows of the staging models, newest first."""
    return (
        run_log.where(F.col("unique_id").like(pattern))
        .orderBy(F.desc("generated_at"), "unique_id", "execution_time")
        .select("unique_id", "execution_time", "rows_affected")
    )


def page_query(voyages: DataFrame, sql: str, **params) -> DataFrame:
    """A page's own SQL over ``{voyages}``, with ``:name`` parameters."""
    return voyages.sparkSession.sql(sql, args=params, voyages=voyages)
