"""Ports and pings derived from the test tables, which hold no vessel data.

Every ``nation`` becomes a port and every ``events`` row a ping near one of them, so that all
queries grow with the given tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.nearest import nearest_port
from quayside.plans.staging import stage


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ports(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("n_nationkey")
    return table(spark, folder, "nation").select(
        F.concat(F.lit("P"), F.lpad(key.cast("string"), 4, "0")).alias("locode"),
        F.col("n_name").alias("name"),
        (-60 + F.col("n_regionkey") * 25 + key % 5).cast("double").alias("lat"),
        (-150 + key * 12).cast("double").alias("lon"),
    )


def pings(spark: SparkSession, folder: str, harbours: DataFrame | None = None) -> DataFrame:
    shift = (
        F.when(F.col("event_type") == "click", 0)
        .when(F.col("event_type") == "view", 1)
        .when(F.col("event_type") == "error", 2)
        .when(F.col("event_type") == "signup", 3)
        .otherwise(4)
    )
    user, event = F.col("user_id"), F.col("event_id")
    at = F.concat(F.lit("P"), F.lpad(((user + shift) % 25).cast("string"), 4, "0"))
    return (
        table(spark, folder, "events")
        .withColumn("locode", at)
        .join(ports(spark, folder) if harbours is None else harbours, "locode")
        .select(
            (user + 200000000).alias("mmsi"),
            F.concat(F.when(user % 3 == 0, "IMO").otherwise(""), (user + 9000000).cast("string")).alias("imo"),
            F.concat(F.lit("VESSEL "), user.cast("string")).alias("vessel_name"),
            (F.col("lat") + (event % 21 - 10) * 6e-3).alias("latitude"),
            (F.col("lon") + (event % 13 - 6) * 8e-3).alias("longitude"),
            F.col("ts").alias("base_date_time"),
            event.alias("event_id"),
        )
    )


def raw_pings(spark: SparkSession, folder: str) -> DataFrame:
    """Pings matched to their port, in the columns of the ingested table."""
    harbours = ports(spark, folder)
    matched = nearest_port(pings(spark, folder, harbours), harbours)
    return matched.withColumnRenamed("base_date_time", "dep_time")


def staged(spark: SparkSession, folder: str) -> DataFrame:
    return stage(raw_pings(spark, folder))
