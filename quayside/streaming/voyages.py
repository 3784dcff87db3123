"""Voyages from a stream of staged pings, with each vessel's unfinished visit as state.

Every micro-batch is stitched by the same sliced windows as a batch run, so a vessel that owns a
third of a micro-batch is still spread over tasks; a per-key state function would hand all its
rows to one. State, legs and pings are written per epoch into the shared folder. An epoch that is
run again after a failure overwrites its own folders with the same rows; what it reads stays until the epoch after the next.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quayside import schemas
from quayside.operators.nearest import nearest_port
from quayside.operators.sizes import broadcast_if_small
from quayside.operators.stitch import completed, link_visits, open_visits
from quayside.plans.staging import stage
from quayside.plans.voyages import carry_input, late_changes, late_restarts, since_restart
from quayside.sources.tables import read_table, remove

#: So many blocks of pings of one level become one.
MERGED = 8


def match_stream(pings: DataFrame, ports: DataFrame) -> DataFrame:
    """Staged pings of a stream of typed pings. Keeps no state: the ports are a static table."""
    return stage(nearest_port(pings, ports))


@dataclass(frozen=True)
class Block:
    """Pings of the epochs ``first`` to ``last``, merged ``level`` times, with the span of each vessel's pings beside them."""

    first: int
    last: int
    level: int = 0

    @property
    def name(self) -> str:
        return f"{self.first}-{self.last}"


def history_blocks(spark: SparkSession, out: str, epoch: int) -> list[Block]:
    """The blocks that hold all pings up to an epoch; none if it isn't finished."""
    listed = read_table(spark, f"{out}/blocks/epoch={epoch}", "first int, last int, level int")
    return [] if listed is None else [Block(*row) for row in sorted(listed.collect())]


def _spans(spark: SparkSession, out: str, blocks: Sequence[Block]) -> DataFrame:
    """``mmsi, first_ping, last_ping, block``"""
    read = [spark.read.parquet(f"{out}/spans/{block.name}").withColumn("block", F.lit(block.name)) for block in blocks]
    return reduce(DataFrame.unionByName, read)


def _store_block(pings: DataFrame, out: str, block: Block) -> None:
    spark = pings.sparkSession
    laid_out = pings.select(*schemas.STAGED.names).hint("rebalance").sortWithinPartitions("mmsi", "dep_time")
    laid_out.write.mode("overwrite").parquet(f"{out}/pings/{block.name}")
    stored = spark.read.schema(schemas.STAGED).parquet(f"{out}/pings/{block.name}").where(F.col("dep_time").isNotNull())
    spans = stored.groupBy("mmsi").agg(F.min("dep_time").alias("first_ping"), F.max("dep_time").alias("last_ping"))
    spans.write.mode("overwrite").parquet(f"{out}/spans/{block.name}")


def _pings(spark: SparkSession, out: str, names: Sequence[str]) -> DataFrame:
    reader = spark.read.schema(schemas.STAGED)
    return reader.parquet(*[f"{out}/pings/{name}" for name in names]) if names else spark.createDataFrame([], schemas.STAGED)


def _late_history(spark: SparkSession, out: str, late: DataFrame, spans: DataFrame) -> DataFrame:
    """Pings of late vessels since their restart, from the blocks that hold any."""
    starts = late.select(F.col("mmsi").alias("late_mmsi"), "restart")
    needed = spans.join(starts, F.col("mmsi").eqNullSafe(F.col("late_mmsi")) & (F.col("last_ping") >= F.col("restart")))
    return since_restart(_pings(spark, out, [name for (name,) in needed.select("block").distinct().toLocalIterator()]), late)


def _compact(spark: SparkSession, out: str, blocks: list[Block]) -> list[Block]:
    """Merge blocks as soon as there are ``MERGED`` of a level, so that their number grows with the logarithm of the epochs."""
    for level in range(max(block.level for block in blocks) + 1):
        same = [block for block in blocks if block.level == level]
        if len(same) >= MERGED:
            merged = Block(same[0].first, same[-1].last, level + 1)
            _store_block(_pings(spark, out, [block.name for block in same]), out, merged)
            blocks = [block for block in blocks if block.level != level] + [merged]
    return sorted(blocks, key=lambda block: block.first)


def stitch_epoch(new: DataFrame, epoch: int, out: str) -> None:
    """Stitch one micro-batch with the state of the epoch before it.

    Completed legs are kept of every epoch, states and lists of blocks of the last two. A missing state is an error: legs would be lost. A vessel with a late ping is
    stitched again from the last visit that the ping can't have changed, and only blocks that hold pings of it since then are read.
    """
    spark = new.sparkSession
    state = read_table(spark, f"{out}/state/epoch={epoch - 1}", schemas.OPEN_VISITS)
    if state is None:
        if epoch > 0:
            raise RuntimeError(f"no state of epoch {epoch - 1} in {out}; start anew with an empty folder and checkpoint")
        state = spark.createDataFrame([], schemas.OPEN_VISITS)
    before, own = history_blocks(spark, out, epoch - 1), Block(epoch, epoch)
    for unused in set(history_blocks(spark, out, epoch - 2)) - set(before):
        remove(spark, f"{out}/pings/{unused.name}")
        remove(spark, f"{out}/spans/{unused.name}")
    _store_block(new, out, own)
    new, spans = _pings(spark, out, [own.name]), _spans(spark, out, [*before, own])

    work = f"{out}/work"
    late_changes(new, state, None).write.mode("overwrite").parquet(f"{work}/changes")
    legs = None if epoch == 0 else valid_legs(spark, out, epoch)
    late = late_restarts(spark.read.parquet(f"{work}/changes"), state, legs, "epoch", range(epoch), spans, work)
    late.write.mode("overwrite").parquet(f"{out}/late/epoch={epoch}")
    late = spark.read.parquet(f"{out}/late/epoch={epoch}")
    pings = carry_input(new, state, None if late.isEmpty() else _late_history(spark, out, late, spans), late)

    link_visits(pings).write.mode("overwrite").parquet(f"{work}/linked")
    linked = spark.read.parquet(f"{work}/linked")
    completed(linked).write.mode("overwrite").parquet(f"{out}/legs/epoch={epoch}")
    open_visits(linked, pings, state).write.mode("overwrite").parquet(f"{out}/state/epoch={epoch}")
    blocks = [(b.first, b.last, b.level) for b in _compact(spark, out, [*before, own])]
    spark.createDataFrame(blocks, "first int, last int, level int").coalesce(1).write.mode("overwrite").parquet(f"{out}/blocks/epoch={epoch}")
    remove(spark, work)
    remove(spark, f"{out}/state/epoch={epoch - 2}")
    remove(spark, f"{out}/blocks/epoch={epoch - 3}")


def stream_stitch(staged: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Stitch all pings that have arrived, epoch by epoch, then stop. Read with :func:`stream_legs`."""
    return (
        staged.writeStream.foreachBatch(lambda batch, epoch: stitch_epoch(batch, epoch, out))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def valid_legs(spark: SparkSession, out: str, until: int | None = None) -> DataFrame:
    """Legs with their ``epoch``, of epochs before ``until``. Where a vessel was stitched anew, its legs of earlier epochs count only if they depart before the restart."""
    stored = T.StructType([*schemas.LEGS.fields, T.StructField("epoch", T.IntegerType())])
    anew = T.StructType([T.StructField("mmsi", T.LongType()), T.StructField("restart", T.TimestampNTZType()), T.StructField("epoch", T.IntegerType())])
    legs, late = spark.read.schema(stored).parquet(f"{out}/legs"), spark.read.schema(anew).parquet(f"{out}/late")
    if until is not None:
        legs, late = legs.where(F.col("epoch") < until), late.where(F.col("epoch") < until)
    late = broadcast_if_small(late.select(F.col("mmsi").alias("late_mmsi"), "restart", F.col("epoch").alias("from_epoch")))
    replaced = F.col("mmsi").eqNullSafe(F.col("late_mmsi")) & (F.col("epoch") < F.col("from_epoch")) & (F.col("dep_time") >= F.col("restart"))
    return legs.join(late, replaced, "left_anti")


def stream_legs(spark: SparkSession, out: str) -> DataFrame:
    """Legs found so far."""
    if read_table(spark, f"{out}/legs") is None:
        return spark.createDataFrame([], schemas.LEGS)
    return valid_legs(spark, out).select(*schemas.LEGS.names)
