"""One run from landed files to checked voyages."""

from __future__ import annotations

import logging
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from quayside import schemas
from quayside.config import Tables
from quayside.operators.quality import expect_none, non_positive_duration
from quayside.operators.routes import RouteFinder
from quayside.plans.ingest import IngestReport, ingest_days
from quayside.plans.reference_data import ensure_countries, ensure_ports
from quayside.plans.voyages import build_voyages, run_folder
from quayside.sources.tables import ensure_table, read_table, source

log = logging.getLogger(__name__)


def run_days(
    spark: SparkSession,
    tables: Tables,
    landing: str,
    days: list[date],
    country_pages: DataFrame,
    port_pages: DataFrame,
    mode: str = "carry",
    finder: RouteFinder | None = None,
    run_id: str | None = None,
    by: str = "ports",
    on_missing: str = "great_circle",
) -> IngestReport:
    """Refresh reference data, ingest ``days``, bring the voyages up to date and check them.

    A call repeated with its ``run_id`` does not ingest again what it has ingested.
    """
    now = datetime.now(timezone.utc)
    ensure_countries(spark, tables, country_pages, now)
    ports = ensure_ports(spark, tables, port_pages, now)
    ensure_table(spark, tables.raw_pings, schemas.RAW_PINGS, partition="dt")
    kept = None if run_id is None else f"{run_folder(spark, tables.raw_pings, run_id)}/ingested"
    before = None if kept is None else read_table(spark, kept)
    if before is None:
        report = ingest_days(spark, landing, days, ports, tables.raw_pings)
        if kept is not None:
            spark.createDataFrame([(report.to_json(days),)], "report string").coalesce(1).write.mode("overwrite").parquet(kept)
    else:
        report = IngestReport.from_json(before.first()["report"], days)
    if report.done:
        build_voyages(
            spark, tables, mode=mode, days=report.done, finder=finder, run_id=run_id, by=by, on_missing=on_missing
        )
    expect_none(source(spark, tables, "voyages"), non_positive_duration(), "positive duration")
    return report
