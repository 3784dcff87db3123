"""Routes of voyage legs: lookup, fallback, distance, geometry text, duration.

Sea routes come from a table ``(route_key, geometry, length_nm)``, one row per port pair. A
provider function fills the table for pairs it does not hold yet; it runs in tasks over distinct
pairs, so a pair is computed once however many legs use it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside import config, schemas
from quayside.functions.geo import haversine_km, is_path, km_to_nm, line_string
from quayside.functions.text import route_key
from quayside.functions.time import duration_hours
from quayside.operators.sizes import broadcast_if_small

_ENDS = ("dep_lon", "dep_lat", "arr_lon", "arr_lat")
# Arguments as in _ENDS; returns ([[lon, lat], ...], length in nautical miles).
RouteFinder = Callable[[float, float, float, float], tuple[list[list[float]], float]]


def _leg_key(by: str) -> Column:
    """What a route is looked up by: the port pair, or both positions for one route per leg."""
    if by == "ports":
        return route_key(F.col("dep_locode"), F.col("arr_locode"))
    if by == "positions":
        return F.concat_ws("_", F.lit("route"), *[F.col(c).cast("string") for c in _ENDS])
    raise ValueError(f"unknown route key {by!r}")


def route_pairs(legs: DataFrame, by: str = "ports") -> DataFrame:
    """Distinct route keys of the legs with the number of legs, and one position for each end.

    The position is the lowest one seen, so that a rerun asks for the same route.
    """
    names = ["dep_locode", "arr_locode"] if by == "ports" else []
    return (
        legs.withColumn("route_key", _leg_key(by))
        .groupBy("route_key", *names)
        .agg(F.count("*").alias("legs"), *[F.min(c).alias(c) for c in _ENDS])
    )


def find_routes(pairs: DataFrame, finder: RouteFinder) -> DataFrame:
    """Routes (:data:`schemas.ROUTES`) of distinct pairs. A pair the finder fails on has one without coordinates and length.

    Pairs are dealt over a fixed number of tasks: their rows are small, but the finder's time is not.
    """
    names = list(schemas.ROUTES.names)  # workers need not find this package

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for pair in frame.itertuples(index=False):
                try:
                    path, length = finder(pair.dep_lon, pair.dep_lat, pair.arr_lon, pair.arr_lat)
                except Exception:  # any failure of the finder means "no route", never a lost leg
                    rows.append((pair.route_key, {"type": None, "coordinates": None}, None))
                    continue
                geometry = {"type": "LineString", "coordinates": [[float(x), float(y)] for x, y in path]}
                rows.append((pair.route_key, geometry, None if length is None else float(length)))
            yield pd.DataFrame(rows, columns=names)

    needed = pairs.select("route_key", *_ENDS).repartition(config.FINDER_TASKS, "route_key")
    return needed.mapInPandas(batches, schema=schemas.ROUTES)


def missing_pairs(legs: DataFrame, routes: DataFrame, by: str = "ports") -> DataFrame:
    return route_pairs(legs, by).join(routes.select("route_key"), "route_key", "left_anti")


def geometry_text(geometry: Column) -> Column:
    """GeoJSON text; a route without a geometry is written as the text ``null``."""
    return F.coalesce(F.to_json(geometry), F.lit("null"))


def enrich_routes(
    legs: DataFrame,
    routes: DataFrame | None = None,
    on_missing: str = "great_circle",
    by: str = "ports",
    broadcast_max_rows: int | None = None,
) -> DataFrame:
    """Legs with ``route_geometry``, ``distance_nm`` and ``duration_hrs``, all durations positive.

    ``routes`` is looked up by port pair or, with ``by="positions"``, by the exact ends of a leg.

    ``on_missing`` says what a leg without a route gets: ``"great_circle"`` a straight line and
    its great-circle length (also for routes of fewer than two points), ``"zero"`` no geometry and
    distance 0.
    """
    if on_missing not in ("great_circle", "zero"):
        raise ValueError(f"unknown policy {on_missing!r}")
    ends = [F.col(c) for c in ("dep_lat", "dep_lon", "arr_lat", "arr_lon")]
    straight = line_string((ends[0], ends[1]), (ends[2], ends[3]))
    straight_nm = km_to_nm(haversine_km(*ends))

    if routes is None:
        found, geometry, length = F.lit(False), F.lit(None).cast(schemas.GEOMETRY), F.lit(None).cast("double")
        joined = legs
    else:
        # Measured in path points: they, not the rows, fill the memory.
        points = F.greatest(F.size(F.coalesce(F.col("geometry.coordinates"), F.array())), F.lit(1))
        lookup = broadcast_if_small(
            # A pair that was asked for and has no route counts as missing.
            routes.where(F.col("geometry").isNull() | F.col("geometry.coordinates").isNotNull()).select(
                "route_key", "geometry", "length_nm", F.lit(True).alias("found")
            ),
            broadcast_max_rows,
            weight=points,
        )
        joined = legs.withColumn("route_key", _leg_key(by)).join(lookup, "route_key", "left")
        found = F.coalesce(F.col("found"), F.lit(False))
        geometry, length = F.col("geometry"), F.col("length_nm")

    if on_missing == "great_circle":
        found = found & is_path(geometry)
        text = F.when(found, geometry_text(geometry)).otherwise(geometry_text(straight))
        distance = F.when(found, F.coalesce(length, F.lit(0.0))).otherwise(straight_nm)
    else:
        text = F.when(found, geometry_text(geometry))
        distance = F.when(found, F.coalesce(length, F.lit(0.0))).otherwise(F.lit(0.0))

    enriched = joined.withColumns({
        "route_geometry": text,
        "distance_nm": distance,
        "duration_hrs": duration_hours(F.col("dep_time"), F.col("arr_time")),
    })
    return enriched.where(F.col("duration_hrs") > 0).select(*schemas.VOYAGES.names)


def route_length(route: Column) -> Column:
    """Length of a GeoJSON feature; 0 when it has none, null when there is no route."""
    return F.when(route.isNotNull(), F.coalesce(route["properties"]["length"], F.lit(0.0)))


def route_path(route: Column) -> Column:
    """Geometry text of a GeoJSON feature; null when there is no route."""
    return F.when(route.isNotNull(), geometry_text(route["geometry"]))

