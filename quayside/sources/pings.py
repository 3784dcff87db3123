"""Daily ping files: which days, which files, and how their text becomes typed columns."""

from __future__ import annotations

import calendar
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside import schemas
from quayside.functions.time import parse_time
from quayside.sources.tables import read_table

# The columns read by name, and how a day's file is called.
PING_COLUMNS = ["mmsi", "latitude", "longitude", "base_date_time", "vessel_name", "imo"]
# A day's file may also be a folder of that name with the parts in it.
FILE_DAY = r"ais-([0-9]{4}-[0-9]{2}-[0-9]{2})\.csv"


def plan_dates(
    year: int | None = None, month: int | None = None, day: int | None = None, now: datetime | None = None
) -> list[date]:
    """Days to process: one day, a month, a year, or yesterday (UTC). Never a future day.

    A day without a month counts as the whole year, a month without a year as yesterday.
    """
    now = now or datetime.now(timezone.utc)
    yesterday = now.date() - timedelta(days=1)
    if year and month and day:
        first = last = date(year, month, day)
    elif year and month:
        first, last = date(year, month, 1), date(year, month, calendar.monthrange(year, month)[1])
    elif year:
        first, last = date(year, 1, 1), date(year, 12, 31)
    else:
        first = last = yesterday
    # Today may be asked for; a range that reaches beyond it ends yesterday.
    if last > now.date():
        last = yesterday
    return [first + timedelta(days=i) for i in range((last - first).days + 1)]


def date_range(spark: SparkSession, days: list[date]) -> DataFrame:
    """Planned days as a table ``(dt, file_name)``, to be joined with what was found."""
    if not days:
        return spark.createDataFrame([], "dt date, file_name string")
    ends = spark.createDataFrame([(days[0], days[-1])], "first date, last date")
    dt = ends.select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("dt"))
    return dt.withColumn("file_name", F.concat(F.lit("ais-"), F.date_format("dt", "yyyy-MM-dd"), F.lit(".csv")))


def landed_files(spark: SparkSession, landing: str) -> DataFrame:
    """Files of the landing folder as ``(dt, path)``, plain or compressed. Content is not read."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(landing)
    day = F.regexp_extract("path", FILE_DAY, 1).try_cast("date")
    return listing.select(day.alias("dt"), "path").where(F.col("dt").isNotNull())


def _header(spark: SparkSession, path: str) -> tuple[str, ...]:
    first = spark.read.text(path).head()
    line = first[0] if first else ""
    return tuple(name.strip().strip('"').lstrip("\ufeff") for name in line.split(","))


def typed_pings(text: DataFrame) -> DataFrame:
    """Typed columns from all-text pings. What cannot be read is null; unplaced pings are dropped."""
    lat, lon = F.col("latitude"), F.col("longitude")
    return text.select(
        F.col("mmsi").try_cast("bigint").alias("mmsi"),
        lat.try_cast("double").alias("latitude"),
        lon.try_cast("double").alias("longitude"),
        parse_time(F.col("base_date_time")).alias("dep_time"),
        "vessel_name",
        "imo",
        *[c for c in text.columns if c == "dt"],
    ).where(lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon))


class MissingColumns(ValueError):
    """A day's file lacks a column; the day cannot be read."""


def read_pings(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """Pings of the given files with the file's day as ``dt``.

    Columns are found by name in each file. Spark takes the header of one file for all it reads
    together, so files are read together only when their headers are equal (one line of each is
    looked at). A compressed file is read by one task; many files are read at once.
    """
    paths = sorted(paths)
    if not paths:
        return spark.createDataFrame([], "mmsi bigint, latitude double, longitude double, "
                                         "dep_time timestamp_ntz, vessel_name string, imo string, dt date")
    with ThreadPoolExecutor(max_workers=16) as pool:
        headers = list(pool.map(lambda p: _header(spark, p), paths))
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, header in zip(paths, headers):
        absent = [c for c in PING_COLUMNS if c not in header]
        if absent:
            raise MissingColumns(f"{path}: no column {', '.join(absent)}")
        groups.setdefault(header, []).append(path)

    parts = []
    for header, members in groups.items():
        # Name by position and keep only the first of equal names.
        schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(header))])
        lines = spark.read.schema(schema).option("header", True).csv(members)
        named = [F.col(f"c{header.index(c)}").alias(c) for c in PING_COLUMNS]
        day = F.regexp_extract("_metadata.file_path", FILE_DAY, 1).try_cast("date").alias("dt")
        parts.append(typed_pings(lines.select(*named, day)))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def append_pings(df: DataFrame, path: str, mode: str = "overwrite_days") -> None:
    """Store matched pings with ``ingested_at``, one folder per file day ``dt``.

    ``"overwrite_days"`` replaces the days present in ``df``, so that a day can be run again;
    ``"append"`` adds rows every time.
    """
    if mode not in ("overwrite_days", "append"):
        raise ValueError(f"unknown mode {mode!r}")
    stamped = df.withColumn("ingested_at", F.current_timestamp().cast("timestamp_ntz"))
    # Rows of a day together, so that each becomes few files; adaptive execution cuts big days up by size. Sorted by vessel, files can be skipped.
    laid_out = stamped.select(*schemas.RAW_PINGS.names).hint("rebalance", "dt").sortWithinPartitions("dt", "mmsi")
    writer = laid_out.write.partitionBy("dt")
    if mode == "append":
        writer.mode("append").parquet(path)
    else:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def clear_days(spark: SparkSession, path: str, days: list[date]) -> None:
    """Empty the stored days that a new run found no pings for; an overwrite does not touch them."""
    stored = read_table(spark, path, schemas.RAW_PINGS) if days else None
    if stored is None:
        return
    nothing = spark.createDataFrame([], schemas.RAW_PINGS).drop("dt")
    for (day,) in stored.where(F.col("dt").isin(days)).select("dt").distinct().toLocalIterator():
        nothing.write.mode("overwrite").parquet(f"{path}/dt={day}")
