"""Port visits and voyage legs of each vessel.

A visit is the first of a run of pings at one port; a leg joins a visit to the next one. Written
as one window per vessel this is ``lag``, a filter and ``lead``. But one vessel may own a third of
all pings (a shared or missing MMSI does), and a window partition cannot be split. So the windows
run per (vessel, time slice), where runs collapse, and only the first and last candidate of every
slice meet per vessel: at most two rows per slice, however many pings there are. Repeated
reports are merged before they are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside import config, schemas
from quayside.functions.time import time_slice

# Pings of a vessel in time order. The columns after the time make the order total.
ORDER = ("dep_time", "port_locode", "lat", "lon", "imo", "vessel_name")


def _without_repeats(pings: DataFrame) -> DataFrame:
    """Each report once, reduced before the shuffle.

    Equal reports stand next to each other in ``ORDER``, and only the first can open a visit. Without a port each
    opens one, so these are counted and put back.
    """
    counted = pings.groupBy(*pings.columns).agg(F.count("*").alias("n"))
    times = F.when(F.col("port_locode").isNull(), F.col("n").cast("int")).otherwise(F.lit(1))
    return counted.withColumn("n", F.explode(F.array_repeat(F.lit(1), times))).drop("n")


def _differs(port: Column, before: Column) -> Column:
    """Whether a ping opens a visit. A missing port opens one only after another missing port."""
    return F.coalesce(before.isNull() | (port != before), F.lit(False))


def link_visits(
    staged: DataFrame,
    slice_minutes: int = config.SLICE_MINUTES,
) -> DataFrame:
    """Every visit as ``dep_*`` with the next visit of the vessel as ``arr_*``.

    ``is_open`` marks the last visit of a vessel, which has no next one. Pings without a time are
    left out: sorted last, they could not form or change a leg. Pings without an MMSI count as one
    vessel. The result does not depend on ``slice_minutes``, which bounds the reports that one task sorts.
    """
    pings = (
        staged.where(F.col("dep_time").isNotNull())
        .select(*schemas.STAGED.names)
        .withColumn("slice", time_slice(F.col("dep_time"), slice_minutes))
    )
    pings = _without_repeats(pings)

    # Inside a slice: all visits but the first are certain.
    inside = Window.partitionBy("mmsi", "slice").orderBy(*ORDER)
    whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place = F.struct("port_locode", "lat", "lon", "dep_time")
    candidates = (
        pings.withColumns({
            "before": F.lag("port_locode").over(inside),
            "pos": F.row_number().over(inside),
            "slice_port": F.last("port_locode").over(whole),
        })
        .where((F.col("pos") == 1) | _differs(F.col("port_locode"), F.col("before")))
        .withColumn("next", F.lead(place).over(inside))
    )

    # Between slices: only edge rows share the vessel's partition (null group).
    is_edge = (F.col("pos") == 1) | F.col("next").isNull()
    across = Window.partitionBy("mmsi", "group").orderBy("slice", "pos")
    opens = (F.col("pos") > 1) | _differs(F.col("port_locode"), F.col("slice_port_before"))
    visits = (
        candidates.withColumn("group", F.when(~is_edge, F.col("slice")))
        .withColumn("slice_port_before", F.lag("slice_port").over(across))
        .withColumn("opens", opens)
        # A slice that only goes on with the visit before it, and has no other, drops out here.
        .where(F.col("opens") | F.col("next").isNotNull())
        .withColumn("entry", F.when(F.col("opens"), place).otherwise(F.col("next")))
        .withColumn("following", F.lead("entry").over(across))
        .withColumn("arr", F.when(F.col("next").isNull(), F.col("following")).otherwise(F.col("next")))
        .where("opens")
    )
    return visits.select(
        "mmsi",
        "imo",
        "vessel_name",
        F.col("port_locode").alias("dep_locode"),
        F.col("lat").alias("dep_lat"),
        F.col("lon").alias("dep_lon"),
        "dep_time",
        F.col("arr.port_locode").alias("arr_locode"),
        F.col("arr.lat").alias("arr_lat"),
        F.col("arr.lon").alias("arr_lon"),
        F.col("arr.dep_time").alias("arr_time"),
        F.col("arr").isNull().alias("is_open"),
    )


def completed(linked: DataFrame) -> DataFrame:
    """Legs among linked visits: the next port is known and reached later."""
    return linked.where(F.col("arr_locode").isNotNull() & (F.col("arr_time") > F.col("dep_time"))).select(
        *schemas.LEGS.names
    )


def port_visits(staged: DataFrame, **limits) -> DataFrame:
    """First ping of every run of pings at one port, in the staged columns."""
    return link_visits(staged, **limits).select(
        "mmsi",
        "imo",
        "vessel_name",
        F.col("dep_locode").alias("port_locode"),
        F.col("dep_lat").alias("lat"),
        F.col("dep_lon").alias("lon"),
        "dep_time",
    )


def voyage_legs(staged: DataFrame, **limits) -> DataFrame:
    """Completed port-to-port legs of every vessel."""
    return completed(link_visits(staged, **limits))


def open_visits(linked: DataFrame, staged: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """What the next run must know of each vessel (:data:`schemas.OPEN_VISITS`).

    That is the unfinished visit and the time of the newest ping. A report without a port after
    the visit is kept as well, since it decides how the next ping is read. ``before`` is the state
    ``linked`` was made with.
    """
    same = F.col("mmsi").eqNullSafe(F.col("key"))
    visit = linked.where("is_open").select(
        "mmsi", "imo", "vessel_name", F.col("dep_locode").alias("port_locode"),
        F.col("dep_lat").alias("lat"), F.col("dep_lon").alias("lon"), "dep_time",
    )
    timed = staged.where(F.col("dep_time").isNotNull())
    tail = (
        timed.where(F.col("port_locode").isNull())
        .groupBy(F.col("mmsi").alias("key"))
        .agg(F.max(F.struct(*[F.col(c) for c in ORDER])).alias("tail"))
    )
    tail = (
        tail.join(visit.select("mmsi", F.struct(*[F.col(c) for c in ORDER]).alias("head")), same)
        .where(F.col("tail") > F.col("head"))
        .select("mmsi", *[F.col("tail")[c].alias(c) for c in ORDER])
    )
    seen = timed.select("mmsi", F.col("dep_time").alias("at"))
    if before is not None:
        seen = seen.unionByName(before.select("mmsi", F.col("last_seen").alias("at")))
    seen = seen.groupBy(F.col("mmsi").alias("key")).agg(F.max("at").alias("last_seen"))
    return visit.unionByName(tail).join(seen, same).select(*schemas.OPEN_VISITS.names)
