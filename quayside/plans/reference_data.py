"""Countries and ports: when to refresh them, and what to use when a refresh brings nothing."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import config, schemas
from quayside.config import Tables
from quayside.functions.time import age_days
from quayside.sources.locodes import country_codes_of_pages, normalize_ports, raw_locode
from quayside.sources.tables import publish_version, read_version

# Major hubs used when no port list is to be had.
FALLBACK_PORTS = [
    ("NLRTM", "Rotterdam", 51.95, 4.13),
    ("SGSIN", "Singapore", 1.28, 103.85),
    ("CNSHA", "Shanghai", 31.23, 121.47),
    ("CNNGB", "Ningbo", 29.86, 121.52),
    ("KRPUS", "Busan", 35.10, 129.04),
    ("USLAX", "Los Angeles", 33.74, -118.26),
    ("USLGB", "Long Beach", 33.77, -118.19),
    ("USNYC", "New York", 40.71, -74.00),
    ("DEHAM", "Hamburg", 53.55, 9.99),
    ("BEANR", "Antwerp", 51.22, 4.40),
    ("JPTYO", "Tokyo", 35.68, 139.76),
    ("AEJEA", "Jebel Ali", 25.00, 55.06),
]


def fallback_ports(spark: SparkSession, now: datetime) -> DataFrame:
    return _stamped(spark.createDataFrame(FALLBACK_PORTS, "locode string, name string, lat double, lon double"), now)


def _stamped(df: DataFrame, now: datetime) -> DataFrame:
    return df.withColumn("updated_at", F.lit(now.replace(tzinfo=None)).cast("timestamp_ntz"))


def staleness(current: DataFrame, max_age_days: int, now: datetime) -> DataFrame:
    """One row ``(last_update, age_days, is_stale)``. No rows at all counts as stale."""
    at = F.lit(now.replace(tzinfo=None)).cast("timestamp_ntz")
    age = age_days(F.col("last_update"), at)
    return current.agg(F.max("updated_at").alias("last_update")).select(
        "last_update",
        age.alias("age_days"),
        (F.col("last_update").isNull() | (age > max_age_days)).alias("is_stale"),
    )


def is_stale(current: DataFrame | None, max_age_days: int, now: datetime) -> bool:
    return current is None or staleness(current, max_age_days, now).first()["is_stale"]


def refresh_if_stale(
    current: DataFrame | None,
    new: DataFrame,
    max_age_days: int,
    now: datetime,
    fallback: DataFrame | None = None,
    always_add_fallback: bool = False,
) -> DataFrame:
    """The table to use from now on.

    A fresh ``current`` stays. A stale one gives way to ``new``; if that is empty, existing rows
    are kept, and only without any the ``fallback`` is used. ``always_add_fallback`` also adds it
    to a refresh that worked, as the original job does.
    """
    if not is_stale(current, max_age_days, now):
        return current
    if not new.isEmpty():
        stamped = _stamped(new, now)
        return stamped.unionByName(fallback) if always_add_fallback and fallback is not None else stamped
    if current is not None and not current.isEmpty():
        return current
    return fallback if fallback is not None else _stamped(new, now)


def _store(chosen: DataFrame, current: DataFrame | None, path: str) -> DataFrame:
    return chosen if chosen is current else publish_version(chosen, path)


def ensure_countries(spark: SparkSession, tables: Tables, pages: DataFrame, now: datetime) -> DataFrame:
    """Countries table, rebuilt from stored code-list pages when older than a year.

    Pages without the heading bring no codes and leave the table as it is.
    """
    current = read_version(spark, tables.countries, schemas.COUNTRIES)
    if not is_stale(current, config.COUNTRIES_MAX_AGE_DAYS, now):
        return current
    chosen = refresh_if_stale(current, country_codes_of_pages(pages), config.COUNTRIES_MAX_AGE_DAYS, now)
    return _store(chosen, current, tables.countries)


def ensure_ports(
    spark: SparkSession, tables: Tables, pages: DataFrame, now: datetime, always_add_fallback: bool = False
) -> DataFrame:
    """Ports table, rebuilt from stored pages ``(iso, html)`` when older than half a year.

    Only pages of countries in the countries table are used, if there is one.
    """
    current = read_version(spark, tables.ports, schemas.PORTS)
    if not is_stale(current, config.PORTS_MAX_AGE_DAYS, now):
        return current
    countries = read_version(spark, tables.countries, schemas.COUNTRIES)
    if countries is not None:
        pages = pages.join(countries.select(F.col("code").alias("iso")).distinct(), "iso", "left_semi")
    chosen = refresh_if_stale(
        current,
        normalize_ports(raw_locode(pages)),
        config.PORTS_MAX_AGE_DAYS,
        now,
        fallback_ports(spark, now),
        always_add_fallback,
    )
    return _store(chosen, current, tables.ports)
