"""Reading and writing the engine's own tables, kept as Parquet folders."""

from __future__ import annotations

from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside import schemas
from quayside.config import Tables

# Declared sources: name -> (location, schema, what it holds).
REGISTRY = {
    "countries": ("countries", schemas.COUNTRIES, "ISO country codes"),
    "ports": ("ports", schemas.PORTS, "Sea ports with a position"),
    "raw_ais_pings": ("raw_pings", schemas.RAW_PINGS, "Pings near ports, from the daily files"),
    "voyages": ("voyages", schemas.VOYAGES, "Completed voyages"),
    "open_visits": ("open_visits", schemas.OPEN_VISITS, "Unfinished visit of each vessel"),
    "routes": ("routes", schemas.ROUTES, "Sea routes by port pair"),
    "run_results": ("run_results", schemas.RUN_RESULTS, "One row per model and run"),
}


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame | None:
    """The table at ``path``, or ``None`` where nothing was written yet."""
    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def source(spark: SparkSession, tables: Tables, name: str) -> DataFrame:
    """A declared source; empty with the right schema where nothing was written yet."""
    location, schema, _ = REGISTRY[name]
    path = getattr(tables, location)
    readers = {"open_visits": carried_state, "countries": read_version, "ports": read_version}
    found = readers[name](spark, path) if name in readers else read_table(spark, path, schema)
    return spark.createDataFrame([], schema) if found is None else found


def log_state(spark: SparkSession, path: str, run_id: str, event: str, folder: str | None = None) -> None:
    """Note that a run has ``started`` or is ``done``, and the folder of open visits it left, if any."""
    log = read_table(spark, f"{path}/log", schemas.STATE_LOG)
    last = None if log is None else log.agg(F.max("seq")).first()[0]
    row = ((last or 0) + 1, run_id, event, folder)
    append_table(spark.createDataFrame([row], schemas.STATE_LOG).coalesce(1), f"{path}/log")


def carried_state(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame | None:
    """Open visits that the newest finished run left; ``None`` if they don't go with the voyages.

    That is so before the first run, after a look-back, and after a run other than ``run_id`` that was not finished.
    """
    log = read_table(spark, f"{path}/log", schemas.STATE_LOG)
    if log is None:
        return None
    events = log.where((F.col("event") != "started") | (F.col("run_id") != F.lit(run_id or "")))
    newest = events.orderBy(F.desc("seq")).first()
    if newest is None or newest["event"] != "done" or newest["folder"] is None:
        return None
    return read_table(spark, newest["folder"], schemas.OPEN_VISITS)


def ensure_table(spark: SparkSession, path: str, schema: T.StructType, partition: str | None = None) -> None:
    """Create an empty table with ``schema`` where there is none."""
    if read_table(spark, path) is not None:
        return
    nothing = spark.createDataFrame([], schema)
    if partition is not None:
        # A file beside partition folders would break their discovery: use the null partition.
        nothing, path = nothing.drop(partition), f"{path}/{partition}=__HIVE_DEFAULT_PARTITION__"
    nothing.write.mode("append").parquet(path)


def replace_table(df: DataFrame, path: str) -> None:
    """Put ``df`` in place of whatever the table held. ``df`` must not read from ``path``."""
    df.write.mode("overwrite").parquet(path)


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of the versions that were published, the newest first."""
    log = read_table(spark, f"{path}/versions", schemas.VERSIONS)
    return [] if log is None else [row["folder"] for row in log.orderBy(F.desc("seq")).limit(2).collect()]


def read_version(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The newest published version of a table, or ``None`` where nothing was published yet."""
    newest = _versions(spark, path)
    return read_table(spark, f"{path}/{newest[0]}", schema) if newest else None


def publish_version(df: DataFrame, path: str) -> DataFrame:
    """Put ``df`` in place of what the table held; ``df`` may read from the table itself.

    The rows go to a folder of their own and count only when the log of versions names it, which is written last: until then, and after a crash
    at any point, readers see the version before. That one is kept for readers that have begun, older ones are removed.
    """
    spark = df.sparkSession
    before, folder = _versions(spark, path), f"v-{uuid4().hex}"
    df.write.parquet(f"{path}/{folder}")
    seq = 0 if not before else read_table(spark, f"{path}/versions", schemas.VERSIONS).agg(F.max("seq")).first()[0]
    append_table(spark.createDataFrame([(seq + 1, folder)], schemas.VERSIONS).coalesce(1), f"{path}/versions")
    for old in before[1:]:
        remove(spark, f"{path}/{old}")
    return spark.read.schema(df.schema).parquet(f"{path}/{folder}")


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def partitions(spark: SparkSession, path: str, name: str) -> list[str]:
    """Values of the partition folders ``name=value`` of a table in order, from their names alone; the null partition is left out."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place):
        return []
    names = [entry.getPath().getName() for entry in system.listStatus(place)]
    return sorted(n[len(name) + 1 :] for n in names if n.startswith(f"{name}=") and not n.endswith("=__HIVE_DEFAULT_PARTITION__"))


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Files below a folder, without those that Spark doesn't read; none if it isn't there. Nothing is opened."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place):
        return []
    found, listing = [], system.listFiles(place, True)
    while listing.hasNext():
        file = listing.next().getPath()
        if file.getName()[0] not in "._":
            found.append(file.toString())
    return sorted(found)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the engine's own, wherever it is stored; nothing happens if there is none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
