"""Keyed replace in a partitioned Parquet table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from hashlib import sha256
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import config
from quayside.operators.sizes import broadcast_if_small
from quayside.sources.tables import read_table, remove


def replace_by_key(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` with the rows of ``batch`` in place of those with an equal key. Null equals null."""
    incoming = batch.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return target.join(incoming, same, "left_anti").unionByName(batch)


def touched_rows(target: DataFrame, touched: DataFrame, partition: str) -> DataFrame:
    """Rows of ``target`` in the partitions named by ``touched``. They are literals, few as calendar days are, so no other folder is opened."""
    values = [value for (value,) in touched.select(partition).distinct().toLocalIterator()]
    named = F.col(partition).isin([v for v in values if v is not None])
    return target.where(named | F.col(partition).isNull() if None in values else named)


def _prepare(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    partition: str,
    drop: DataFrame | None,
    drop_keys: Sequence[str],
    work: str,
    sort: Sequence[str],
) -> None:
    """Write the new content of every touched partition, and the list of those partitions."""
    spark = batch.sparkSession
    touched = batch.select(partition)
    if drop is not None:
        drop.write.mode("overwrite").parquet(f"{work}/drop")
        dropped = spark.read.parquet(f"{work}/drop")
        gone = broadcast_if_small(dropped.select(*[F.col(k).alias(f"_gone_{k}") for k in drop_keys]))
        is_gone = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_gone_{k}")) for k in drop_keys])
        if partition in dropped.columns:
            touched = touched.unionByName(dropped.select(partition))
        else:
            touched = touched.unionByName(target.join(gone, is_gone, "left_semi").select(partition))
    touched.distinct().write.mode("overwrite").parquet(f"{work}/touched")
    touched = spark.read.parquet(f"{work}/touched")

    old = touched_rows(target, touched, partition).select(*target.columns)
    if drop is not None:
        old = old.join(gone, is_gone, "left_anti")
    merged = replace_by_key(old, batch.select(*target.columns), keys)
    _by_partition(merged, partition, sort).write.mode("overwrite").partitionBy(partition).parquet(f"{work}/merged")


def _by_partition(df: DataFrame, partition: str, sort: Sequence[str]) -> DataFrame:
    """Rows of a partition together, so that each becomes few files; big ones are split."""
    return df.hint("rebalance", partition).sortWithinPartitions(partition, *sort)


def _swap(spark: SparkSession, path: str, partition: str, work: str, sort: Sequence[str]) -> None:
    """Move the prepared partitions into the table. Can be repeated."""
    schema = read_table(spark, path).schema
    merged = read_table(spark, f"{work}/merged", schema)
    writer = _by_partition(merged, partition, sort).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(partition).parquet(path)
    # Partitions that lost all their rows are no part of the overwrite. They are few: calendar days.
    touched = spark.read.parquet(f"{work}/touched")
    emptied = touched.join(merged.select(partition).distinct(), partition, "left_anti")
    nothing = spark.createDataFrame([], schema).drop(partition)
    for (value,) in emptied.toLocalIterator():
        nothing.write.mode("overwrite").parquet(f"{path}/{partition}={value}")


def upsert(
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    partition: str,
    drop: DataFrame | None = None,
    drop_keys: Sequence[str] = ("mmsi",),
    run_id: str | None = None,
    sort: Sequence[str] = (),
) -> None:
    """Put ``batch`` into the table at ``path``, rewriting only partitions it touches.

    Each key must always fall into the same partition. ``drop`` is a table of distinct
    ``drop_keys`` values whose rows all leave the target first; if it also has the column ``partition``, which the keys
    must then determine, only those partitions are searched. Rows are sorted by ``sort`` inside a file.

    The new partitions are written to the shared folder before the table changes. With a
    ``run_id``, a call for this table repeated after a crash finds them and only finishes the swap; a call
    repeated after success does nothing.
    """
    spark = batch.sparkSession
    own = sha256(path.encode()).hexdigest()[:12]
    work = f"{config.shared_folder(spark)}/upsert-{own}-{run_id or uuid4().hex}"
    if read_table(spark, f"{work}/done") is not None:
        return
    if read_table(spark, f"{work}/ready") is None:
        batch.write.mode("overwrite").partitionBy(partition).parquet(f"{work}/batch")
        batch = spark.read.schema(batch.schema).parquet(f"{work}/batch")
        target = read_table(spark, path)
        if target is None:
            target = spark.createDataFrame([], batch.schema)
        _prepare(target, batch, keys, partition, drop, drop_keys, work, sort)
        spark.range(1).write.mode("overwrite").parquet(f"{work}/ready")
    if read_table(spark, path) is None:
        merged = spark.read.schema(batch.schema).parquet(f"{work}/merged")
        _by_partition(merged, partition, sort).write.mode("overwrite").partitionBy(partition).parquet(path)
    else:
        _swap(spark, path, partition, work, sort)
    spark.range(1).write.mode("overwrite").parquet(f"{work}/done")
    for name in ("ready", "batch", "drop", "touched", "merged"):
        remove(spark, f"{work}/{name}")
