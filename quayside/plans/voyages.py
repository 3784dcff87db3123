"""The voyages table: full build, and two ways to bring it up to date.

``lookback`` reads again everything since 14 days before the newest arrival and replaces rows by
key. That cuts stays which straddle the line, so a voyage can appear twice with another departure
time, and passages longer than the look-back are lost. ``carry`` keeps each vessel's unfinished
visit instead and stitches it with new pings only; its result equals a full build.

What ``carry`` remembers lies beside the open visits: one folder of them for each run, the span of each vessel's pings in
every file day already read, and a log that names the folder that counts. Folders are switched last. Wherever the log shows
that a run was not finished, or that voyages were built another way, everything is built anew from the stored pings.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta
from functools import reduce
from hashlib import sha256
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import config, schemas
from quayside.config import Tables
from quayside.operators.quality import drop_non_positive
from quayside.operators.routes import RouteFinder, enrich_routes, find_routes, missing_pairs
from quayside.operators.sizes import broadcast_if_small
from quayside.operators.stitch import completed, link_visits, open_visits, voyage_legs
from quayside.operators.upsert import upsert
from quayside.plans.staging import stage
from quayside.sources.tables import append_table, carried_state, data_files, log_state, partitions, read_table, remove, source

PARTITION = "dep_date"
#: Partitions that a late vessel's last certain leg is looked for in first.
SEARCHED = 32


def with_partition(voyages: DataFrame) -> DataFrame:
    return voyages.withColumn(PARTITION, F.to_date("dep_time"))


# --- look-back ---------------------------------------------------------------


def cutoff(voyages: DataFrame | None, days: int = config.LOOKBACK_DAYS) -> datetime | None:
    """Newest arrival minus the look-back; ``None`` means a full load."""
    newest = None if voyages is None else voyages.agg(F.max("arr_time")).first()[0]
    return None if newest is None else newest - timedelta(days=days)


def lookback_input(staged: DataFrame, voyages: DataFrame | None, days: int = config.LOOKBACK_DAYS) -> DataFrame:
    """Staged pings since the cut-off. The filter is a literal: it reaches the scan.

    Pings that still have their file day ``dt`` are read from the days since the cut-off only, with
    a margin for files that hold pings of the days before.
    """
    since = cutoff(voyages, days)
    if since is None:
        return staged
    if "dt" in staged.columns:
        first = since.date() - timedelta(days=config.FILE_DAY_MARGIN)
        staged = staged.where(F.col("dt") >= F.lit(first))
    return staged.where(F.col("dep_time") >= F.lit(since).cast("timestamp_ntz"))


# --- carry -------------------------------------------------------------------


def carry_input(
    new: DataFrame, state: DataFrame | None, history: DataFrame | None = None, late: DataFrame | None = None
) -> DataFrame:
    """Pings to stitch: the open visits with the new pings after them.

    Vessels in ``late`` are stitched anew from ``history``, which holds all their staged pings,
    the new ones included.
    """
    columns = schemas.STAGED.names
    if state is None:
        return new.select(*columns)
    current = state.select(*columns).unionByName(new.select(*columns))
    if late is None or late.isEmpty():
        return current
    flagged = broadcast_if_small(late.select(F.col("mmsi").alias("late_mmsi")))
    same = F.col("mmsi").eqNullSafe(F.col("late_mmsi"))
    again = history.select(*columns).join(flagged, same, "left_semi")
    return current.join(flagged, same, "left_anti").unionByName(again)


def carry_batches(batches: list[DataFrame]) -> DataFrame:
    """Legs of batches in time order, each stitched with the state the one before left.

    Batch and state are written to the shared folder, so that each step starts from a table.
    """
    spark = batches[0].sparkSession
    work = f"{config.shared_folder(spark)}/carry-{uuid4().hex}"
    state, legs = None, None
    for number, new in enumerate(batches):
        pings = carry_input(new, state)
        linked = _written(link_visits(pings), f"{work}/linked-{number}")
        state = _written(open_visits(linked, pings, state), f"{work}/state-{number}")
        legs = completed(linked) if legs is None else legs.unionByName(completed(linked))
    return legs


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


# --- jobs --------------------------------------------------------------------


def update_routes(
    spark: SparkSession, tables: Tables, legs: DataFrame, finder: RouteFinder, by: str = "ports"
) -> None:
    """Add routes the table does not hold yet, and the pairs that have none, so that no pair is asked twice."""
    known = source(spark, tables, "routes")
    found = find_routes(missing_pairs(legs, known, by), finder)
    aside = f"{config.shared_folder(spark)}/routes-{uuid4().hex}"
    append_table(_written(found, aside), tables.routes)
    remove(spark, aside)


def _enriched(
    spark: SparkSession, tables: Tables, legs: DataFrame, finder: RouteFinder | None, on_missing: str, by: str
) -> DataFrame:
    if finder is not None:
        update_routes(spark, tables, legs, finder, by)
    voyages = enrich_routes(legs, read_table(spark, tables.routes, schemas.ROUTES), on_missing, by)
    return with_partition(drop_non_positive(voyages))


def run_folder(spark: SparkSession, table: str, run_id: str) -> str:
    """Where a run keeps its intermediate tables: its own for each table and run."""
    return f"{config.shared_folder(spark)}/run-{sha256(table.encode()).hexdigest()[:12]}-{run_id}"


def _bind(spark: SparkSession, work: str, description: str, files: list[str]) -> None:
    """Tie a run to its input: what was asked for, and the files it is about to read."""
    asked = f"{description}; {len(files)} files, {sha256(chr(10).join(files).encode()).hexdigest()}"
    bound = read_table(spark, f"{work}/input")
    if bound is None:
        spark.createDataFrame([(asked,)], "asked string").coalesce(1).write.parquet(f"{work}/input")
    elif bound.first()["asked"] != asked:
        raise ValueError(f"run {work} was begun with another input: {bound.first()['asked']}; now {asked}")


def _finished(spark: SparkSession, work: str) -> bool:
    return read_table(spark, f"{work}/done") is not None


def _finish(spark: SparkSession, work: str) -> None:
    spark.range(1).write.mode("overwrite").parquet(f"{work}/done")
    for name in ("before", "late", "search", "linked", "after", "spans", "legs", "gone", "added"):
        remove(spark, f"{work}/{name}")


def late_changes(new: DataFrame, state: DataFrame, replaced: DataFrame | None) -> DataFrame:
    """``mmsi, changed``: vessels whose past changes, and from when.

    A vessel is late if a new ping is not after its newest one already read, or if a file day that held pings of it is
    replaced (``replaced``: spans of what was read of those days).
    """
    first = new.groupBy("mmsi").agg(F.min("dep_time").alias("changed"))
    seen = state.groupBy(F.col("mmsi").alias("seen_mmsi")).agg(F.max("last_seen").alias("last_seen"))
    late = first.join(seen, F.col("mmsi").eqNullSafe(F.col("seen_mmsi"))).where("changed <= last_seen").select("mmsi", "changed")
    if replaced is not None:
        late = late.unionByName(first.join(replaced.select(F.col("mmsi").alias("old_mmsi")).distinct(), F.col("mmsi").eqNullSafe(F.col("old_mmsi")), "left_semi"))
        late = late.unionByName(replaced.select("mmsi", F.col("first_ping").alias("changed")))
    return late.groupBy("mmsi").agg(F.min("changed").alias("changed"))


def late_restarts(
    late: DataFrame, state: DataFrame, voyages: DataFrame | None, partition: str, values: Sequence, spans: DataFrame, work: str
) -> DataFrame:
    """``mmsi, restart``: when each vessel of ``late`` (mmsi, changed) has to be stitched anew from.

    What lies before a visit that began before the first changed ping is certain. That is the unfinished visit in ``state``, or else the departure
    of the last stored leg that ends before the change. Stored legs are searched from the newest of the partition's ``values`` backwards, in which a vessel's
    legs follow each other, twice as many partitions each time, until all vessels have one; those without start with their first ping in ``spans``.
    """
    opened = state.groupBy(F.col("mmsi").alias("open_mmsi")).agg(F.min("dep_time").alias("opened"))
    known = late.join(opened, F.col("mmsi").eqNullSafe(F.col("open_mmsi")) & (F.col("opened") < F.col("changed")), "left")
    known = _written(known.select("mmsi", "changed", F.col("opened").alias("restart")), f"{work}/search/open")
    found, pending = [known.where("restart is not null").select("mmsi", "restart")], known.where("restart is null").select("mmsi", "changed")
    newest = pending.agg(F.max("changed")).first()[0]
    if voyages is not None and newest is not None:
        size, left = SEARCHED, list(values)
        if partition == PARTITION:
            left = [value for value in left if value <= newest.date()]
        while left and not pending.isEmpty():
            searched, left = left[-size:], left[:-size]
            size *= 2
            legs = voyages.where(F.col(partition).isin(searched)).select(F.col("mmsi").alias("leg_mmsi"), "dep_time", "arr_time")
            certain = pending.join(legs, F.col("mmsi").eqNullSafe(F.col("leg_mmsi")) & (F.col("arr_time") < F.col("changed")))
            last = certain.groupBy("mmsi").agg(F.max_by("dep_time", F.struct("arr_time", "dep_time")).alias("restart"))
            found.append(_written(last, f"{work}/search/legs-{size}"))
            pending = pending.join(found[-1].select(F.col("mmsi").alias("found_mmsi")), F.col("mmsi").eqNullSafe(F.col("found_mmsi")), "left_anti")
            pending = _written(pending, f"{work}/search/pending-{size}")
    if newest is not None:
        # A new ping may itself be the first.
        first = spans.select(F.col("mmsi").alias("seen_mmsi"), "first_ping")
        begun = pending.join(first, F.col("mmsi").eqNullSafe(F.col("seen_mmsi")), "left")
        found.append(begun.groupBy("mmsi").agg(F.least(F.min("first_ping"), F.min("changed")).alias("restart")))
    return reduce(DataFrame.unionByName, found)


def since_restart(rows: DataFrame, late: DataFrame) -> DataFrame:
    """Rows of late vessels since their restart; date partitions before the earliest one are not opened."""
    earliest = late.agg(F.min("restart")).first()[0]
    if earliest is None:
        return rows.where(F.lit(False))
    if PARTITION in rows.columns:
        rows = rows.where(F.col(PARTITION) >= F.lit(earliest.date()))
    starts = broadcast_if_small(late.select(F.col("mmsi").alias("late_mmsi"), "restart"))
    return rows.join(starts, F.col("mmsi").eqNullSafe(F.col("late_mmsi")) & (F.col("dep_time") >= F.col("restart")), "left_semi")


def _history(raw: DataFrame, late: DataFrame, spans: DataFrame) -> DataFrame:
    """Stored pings of late vessels since their restart, from the file days that hold any."""
    starts = late.select(F.col("mmsi").alias("late_mmsi"), "restart")
    needed = spans.join(starts, F.col("mmsi").eqNullSafe(F.col("late_mmsi")) & (F.col("last_ping") >= F.col("restart")))
    days = [row["dt"] for row in needed.select("dt").distinct().toLocalIterator()]
    return since_restart(stage(raw.where(F.col("dt").isin(days))), late)


def _equal_legs(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    other = right.select(*[F.col(c).alias(f"_{c}") for c in schemas.LEGS.names])
    return left.join(other, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in schemas.LEGS.names]), how)


def _lookback(
    spark: SparkSession, tables: Tables, raw: DataFrame, work: str, finder: RouteFinder | None, on_missing: str, by: str, run_id: str
) -> None:
    target = read_table(spark, tables.voyages)
    legs = _written(voyage_legs(lookback_input(stage(raw, keep_day=True), target)), f"{work}/legs")
    batch = _enriched(spark, tables, legs, finder, on_missing, by)
    # The state no longer goes with the voyages: the next carry builds all anew.
    log_state(spark, tables.open_visits, run_id, "done")
    upsert(tables.voyages, batch, schemas.VOYAGE_KEY, PARTITION, run_id=run_id, sort=("mmsi",))


def _carry(
    spark: SparkSession, tables: Tables, raw: DataFrame, new_raw: DataFrame, days: Column | None, work: str,
    finder: RouteFinder | None, on_missing: str, by: str, run_id: str,
) -> None:
    state = read_table(spark, f"{work}/before", schemas.OPEN_VISITS)
    if state is None:
        current = carried_state(spark, tables.open_visits, run_id)
        if current is not None:
            state = _written(current, f"{work}/before")
    log_state(spark, tables.open_visits, run_id, "started")
    anew = state is None
    if anew:
        new_raw, days, state = raw, None, spark.createDataFrame([], schemas.OPEN_VISITS)
    seen_path = f"{tables.open_visits}/seen"
    seen = None if anew else read_table(spark, seen_path, schemas.SEEN)
    in_days = F.lit(True) if days is None else days
    spans = new_raw.where(F.col("dep_time").isNotNull()).groupBy("dt", "mmsi").agg(F.min("dep_time").alias("first_ping"), F.max("dep_time").alias("last_ping"))
    spans = _written(spans, f"{work}/spans")
    new, target = stage(new_raw), read_table(spark, tables.voyages)
    replaced = None if seen is None else seen.where(in_days)
    every = spans if seen is None else spans.unionByName(seen.where(~in_days).select(*spans.columns))
    changes = _written(late_changes(new, state, replaced), f"{work}/search/changes")
    dates = [date.fromisoformat(day) for day in partitions(spark, tables.voyages, PARTITION)]
    late = _written(late_restarts(changes, state, target, PARTITION, dates, every, work), f"{work}/late")
    if late.isEmpty():
        pings = carry_input(new, state)
    else:
        pings = carry_input(new, state, _history(raw, late, every), late)
    linked = _written(link_visits(pings), f"{work}/linked")
    after = f"{tables.open_visits}/state-{run_id}"
    _written(open_visits(linked, pings, state), after)

    legs, gone = completed(linked), None
    if target is not None:
        scope = target if anew else since_restart(target, late)
        gone = _written(_equal_legs(scope, legs, "left_anti").select(*schemas.VOYAGE_KEY, PARTITION), f"{work}/gone")
        legs = _equal_legs(legs, scope, "left_anti")
    added = _written(legs, f"{work}/added")
    batch = _enriched(spark, tables, added, finder, on_missing, by)
    upsert(tables.voyages, batch, schemas.VOYAGE_KEY, PARTITION, drop=gone, drop_keys=schemas.VOYAGE_KEY, run_id=run_id, sort=("mmsi",))
    _remember(spark, seen_path, spans, replaced, anew)
    log_state(spark, tables.open_visits, run_id, "done", after)


def _remember(spark: SparkSession, path: str, spans: DataFrame, replaced: DataFrame | None, anew: bool) -> None:
    """Put the spans of the days just read in place of what was known of them."""
    if anew:
        remove(spark, path)
    elif replaced is not None:
        emptied = replaced.select("dt").distinct().join(spans.select("dt").distinct(), "dt", "left_anti")
        for (day,) in emptied.toLocalIterator():
            remove(spark, f"{path}/dt={day}")
    writer = spans.select("mmsi", "first_ping", "last_ping", "dt").hint("rebalance", "dt").write.partitionBy("dt")
    writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def build_voyages(
    spark: SparkSession,
    tables: Tables,
    mode: str = "carry",
    since_day: str | None = None,
    finder: RouteFinder | None = None,
    on_missing: str = "great_circle",
    run_id: str | None = None,
    days: Sequence[date] | None = None,
    by: str = "ports",
) -> None:
    """Bring the voyages table up to date from the ingested pings.

    ``carry`` treats the file days ``days``, or those from ``since_day`` (``YYYY-MM-DD``) on, as new or replaced, by default
    all; vessels whose earlier pings they change are stitched again from the leg before. Without a state that goes with the voyages all is built
    anew. Only date partitions with a changed voyage are rewritten.

    Repeating a call with the same ``run_id`` after a crash finishes the interrupted run; after success
    it does nothing. A ``run_id`` goes with one input: another one is refused.
    ``by`` and ``on_missing`` say how routes are found, see :func:`enrich_routes`.
    """
    if mode not in ("carry", "lookback"):
        raise ValueError(f"unknown mode {mode!r}")
    raw = source(spark, tables, "raw_ais_pings")
    run_id = run_id or uuid4().hex
    work = run_folder(spark, tables.voyages, run_id)
    chosen = None
    if mode == "carry" and days is not None:
        chosen = F.col("dt").isin(list(days))
    elif mode == "carry" and since_day is not None:
        chosen = F.col("dt") >= F.lit(since_day).cast("date")
    new_raw = raw if chosen is None else raw.where(chosen)
    stored = partitions(spark, tables.raw_pings, "dt")
    if mode == "carry" and days is not None:
        stored = sorted(set(stored) & set(map(str, days)))
    elif mode == "carry" and since_day is not None:
        stored = [day for day in stored if day >= str(since_day)]
    files = [file for day in stored for file in data_files(spark, f"{tables.raw_pings}/dt={day}")]
    _bind(spark, work, f"{mode}, days {sorted(map(str, days)) if days is not None else since_day}", files)
    if _finished(spark, work):
        return
    if mode == "lookback":
        _lookback(spark, tables, raw, work, finder, on_missing, by, run_id)
    else:
        _carry(spark, tables, raw, new_raw, chosen, work, finder, on_missing, by, run_id)
    _finish(spark, work)
