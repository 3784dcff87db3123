import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.operators.nearest import nearest_port

PINGS = "id bigint, latitude double, longitude double"
PORTS = "locode string, lat double, lon double"


def brute_force(pings, ports, metric, radius=5.0):
    """Nearest port of each ping by looking at all of them."""
    lat, lon = np.radians([p[1] for p in ports]), np.radians([p[2] for p in ports])
    found = {}
    for key, y, x in pings:
        y, x = math.radians(y), math.radians(x)
        if metric == "planar":
            km = np.sqrt((lat - y) ** 2 + (lon - x) ** 2) * 6371.0
        else:
            a = np.sin((lat - y) / 2) ** 2 + np.cos(y) * np.cos(lat) * np.sin((lon - x) / 2) ** 2
            km = 2 * 6371.0 * np.arcsin(np.minimum(1, np.sqrt(a)))
        best = min(zip(np.round(km, 9), [p[0] for p in ports]))
        if best[0] <= radius:
            found[key] = best[1]
    return found


def match(spark, pings, ports, **options):
    got = nearest_port(spark.createDataFrame(pings, PINGS), spark.createDataFrame(ports, PORTS), **options)
    return {r.id: r.port_locode for r in got.collect()}


@pytest.mark.parametrize("metric", ["planar", "haversine"])
@pytest.mark.parametrize("limit", [None, 0])
def test_equals_brute_force(spark, metric, limit):
    dice = random.Random(7)
    ports = [(f"P{i:03d}", dice.uniform(-2, 2), dice.uniform(-2, 2)) for i in range(200)]
    ports += [(f"N{i:03d}", dice.uniform(84, 90), dice.uniform(-180, 180)) for i in range(60)]
    ports += [(f"D{i:03d}", dice.uniform(50, 51), 180 - dice.uniform(0, 0.2)) for i in range(20)]
    pings = [(i, dice.uniform(-2.1, 2.1), dice.uniform(-2.1, 2.1)) for i in range(1500)]
    pings += [(5000 + i, dice.uniform(83.9, 90), dice.uniform(-180, 180)) for i in range(800)]
    pings += [(8000 + i, dice.uniform(50, 51), -180 + dice.uniform(0, 0.1)) for i in range(300)]
    got = match(spark, pings, ports, metric=metric, broadcast_max_rows=limit)
    assert got == brute_force(pings, ports, metric)
    assert len(got) > 60
    if metric == "haversine":
        assert any(key >= 8000 for key in got), "circles must wrap at 180 degrees"


def test_radius_is_inside_and_ties_go_to_the_lowest_code(spark):
    step = math.degrees(5.0 / 6371.0)
    pings = [(1, step * (1 - 1e-9), 0.0), (2, step * (1 + 1e-9), 0.0), (3, 10.0, 10.0), (4, 60.0, 0.0449), (5, 0.0, 180.0)]
    ports = [("A", 0.0, 0.0), ("C", 10.0, 10.01), ("B", 10.0, 9.99), ("E", 60.0, 0.0), ("W", 0.0, -180.0),
             ("Z", 0.0, 0.0)]
    assert match(spark, pings, ports) == {1: "A", 3: "B", 4: "E"}


def test_bad_positions_match_nothing(spark):
    pings = [(1, None, 0.0), (2, 0.0, float("nan")), (3, float("inf"), 0.0), (4, 91.0, 181.0), (5, 0.0, 0.0)]
    ports = [("A", 0.0, 0.0), ("B", None, 0.0), ("C", float("nan"), 0.0)]
    assert match(spark, pings, ports) == {5: "A"}


def test_sample_frames(spark):
    pings = [(1, 40.7128, -74.0060), (2, 40.7200, -74.0100), (3, 51.5074, -0.1278)]
    ports = [("USNYC", 40.7128, -74.0060), ("GBLON", 51.5074, -0.1278), ("ZASSB", -29.8587, 31.0218)]
    assert match(spark, pings, ports) == {1: "USNYC", 2: "USNYC", 3: "GBLON"}


def test_pings_are_not_shuffled(spark):
    pings = spark.range(1000).select("id", (F.col("id") / 10.0).alias("latitude"), F.rand(1).alias("longitude"))
    ports = spark.createDataFrame([("A", 0.0, 0.0)], PORTS)
    plan = nearest_port(pings, ports)._jdf.queryExecution().executedPlan().toString()
    join = plan.index("BroadcastHashJoin")
    ping_side = plan[join:plan.index("BroadcastExchange")]
    assert "Exchange" not in ping_side and "NestedLoop" not in plan and "Cartesian" not in plan


def test_unknown_metric(spark):
    with pytest.raises(ValueError):
        match(spark, [(1, 0.0, 0.0)], [("A", 0.0, 0.0)], metric="cubic")
