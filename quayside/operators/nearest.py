"""Nearest port within a radius, as an equi-join on grid cells.

A distance condition alone would be a nested-loop join. The ports are instead written into every
cell of a grid that their circle can touch; a ping looks only into its own cell. With the ports
broadcast, the pings are never shuffled and the join keeps at most one row per ping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside import config
from quayside.functions.geo import haversine_km_of_radians, planar_km_of_radians, to_radians
from quayside.operators.sizes import is_small

_MARGIN = 1.1  # cells are this much wider than the radius, so that rounding cannot step over one


def _cell(degrees: Column, width: float) -> Column:
    return F.floor(degrees / F.lit(width))


def _planar_span(width: float) -> tuple[Column, Column]:
    column = _cell(F.col("lon"), width)
    return column - 1, column + 1


def _haversine_span(width: float, reach: float) -> tuple[Column, Column]:
    """First and last grid column of a true circle, which is wider in longitude near the poles."""
    columns = round(360 / width)
    ratio = F.sin(F.radians(F.lit(reach))) / F.cos(F.radians(F.col("lat")))
    over_pole = (F.abs("lat") + reach >= 90) | (ratio >= 1)
    half = F.when(over_pole, F.lit(180.0)).otherwise(F.degrees(F.asin(ratio)) * _MARGIN)
    first, last = _cell(F.col("lon") - half, width), _cell(F.col("lon") + half, width)
    # Never name a column twice when the circle goes all the way round.
    return first, F.least(last, first + columns - 1)


def nearest_port(
    pings: DataFrame,
    ports: DataFrame,
    radius_km: float = config.PORT_RADIUS_KM,
    metric: str = "planar",
    broadcast_max_rows: int | None = None,
) -> DataFrame:
    """Add ``port_locode`` and ``dist_km`` of the nearest port; drop pings farther than the radius.

    ``pings`` needs ``latitude`` and ``longitude``, ``ports`` needs ``locode``, ``lat`` and
    ``lon``. The radius itself is inside. Of ports at the same distance the lowest code wins.
    ``metric`` is ``"planar"`` (see :func:`planar_km`) or ``"haversine"``.
    """
    if metric not in ("planar", "haversine"):
        raise ValueError(f"unknown metric {metric!r}")
    reach = radius_km / (config.EARTH_RADIUS_KM * 3.141592653589793 / 180)
    width = reach * _MARGIN
    if metric == "haversine":
        width = 360 / int(360 / width)  # a whole number of columns, so that cells wrap

    first, last = _planar_span(width) if metric == "planar" else _haversine_span(width, reach)
    columns = F.lit(round(360 / width))

    def wrapped(cx: Column) -> Column:
        return cx if metric == "planar" else F.pmod(cx, columns)

    known = ports.where(F.col("lat").isNotNull() & F.col("lon").isNotNull() & ~F.isnan("lat") & ~F.isnan("lon"))
    small = is_small(known, broadcast_max_rows, weight=3 * (last - first + 1))
    if small:
        known = known.coalesce(1)  # they end up in one broadcast anyway: build it without shuffles
    # Ports sharing one position are the same candidate; only the lowest code can win.
    sites = known.groupBy("lat", "lon").agg(F.min("locode").alias("locode"))
    row = _cell(F.col("lat"), width)
    cells = (
        sites.withColumn("cy", F.explode(F.sequence(row - 1, row + 1)))
        .withColumn("cx", F.explode(F.transform(F.sequence(first, last), wrapped)))
        .groupBy("cy", "cx")
        .agg(F.collect_list(F.struct(F.radians("lat").alias("y"), F.radians("lon").alias("x"), "locode")).alias("sites"))
    )

    lat, lon = F.col("latitude"), F.col("longitude")
    y, x = to_radians(lat, lon)
    located = pings.where(lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)).withColumns({
        "cy": _cell(lat, width), "cx": wrapped(_cell(lon, width)), "y": y, "x": x,
    })
    distance = planar_km_of_radians if metric == "planar" else haversine_km_of_radians

    def candidate(site: Column) -> Column:
        km = distance(F.col("y"), F.col("x"), site["y"], site["x"])
        return F.struct(km.alias("dist_km"), site["locode"].alias("locode"))

    return (
        located.join(F.broadcast(cells) if small else cells, ["cy", "cx"])
        # One candidate is the usual case and needs no loop.
        .withColumn(
            "nearest",
            F.when(F.size("sites") == 1, candidate(F.col("sites")[0])).otherwise(
                F.array_min(F.transform("sites", candidate))
            ),
        )
        .where(F.col("nearest.dist_km") <= radius_km)
        .select(
            *pings.columns,
            F.col("nearest.locode").alias("port_locode"),
            F.col("nearest.dist_km").alias("dist_km"),
        )
    )
