"""Continuous ingest of the landing folder, each file once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quayside.plans.ingest import IngestReport, ingest_days
from quayside.sources.pings import FILE_DAY
from quayside.sources.tables import read_table, remove

_LISTING = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])


def new_files(spark: SparkSession, landing: str, max_files: int = 64) -> DataFrame:
    """Stream of ``(dt, path)`` of files as they land. Only names are read, not content."""
    return (
        spark.readStream.format("binaryFile")
        .schema(_LISTING)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        .load(landing)
        .select(F.regexp_extract("path", FILE_DAY, 1).try_cast("date").alias("dt"), "path")
        .where(F.col("dt").isNotNull())
    )


def stream_ingest(
    spark: SparkSession,
    landing: str,
    ports: DataFrame,
    path: str,
    checkpoint: str,
    max_files: int = 64,
    on_report: Callable[[int, IngestReport], None] | None = None,
) -> StreamingQuery:
    """Ingest what has landed since the last call, then stop.

    The stream carries file names, at most ``max_files`` at a time, so that each file is read with
    its own header. A day that is named is ingested with all its files and replaces what was
    stored of it: neither late parts nor a batch repeated after a failure can lose or double rows.
    A day that fails is tried again by every later batch until it succeeds.
    """

    def store(names: DataFrame, epoch: int) -> None:
        spark = names.sparkSession
        failed = read_table(spark, f"{checkpoint}-failed/epoch={epoch - 1}", "dt date, why string")
        named = names.select("dt") if failed is None else names.select("dt").union(failed.select("dt"))
        days = [row["dt"] for row in named.distinct().toLocalIterator()]
        report = ingest_days(spark, landing, days, ports, path)
        again = spark.createDataFrame(sorted(report.failed.items()), "dt date, why string")
        again.coalesce(1).write.mode("overwrite").parquet(f"{checkpoint}-failed/epoch={epoch}")
        remove(spark, f"{checkpoint}-failed/epoch={epoch - 2}")
        if on_report is not None:
            on_report(epoch, report)

    return (
        new_files(spark, landing, max_files)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
