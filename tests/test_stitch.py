import datetime as dt
import random

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quayside import schemas
from quayside.checks.oracles import LEG_COLUMNS, _stitched
from quayside.operators.stitch import ORDER, completed, link_visits, open_visits, port_visits, voyage_legs

START = dt.datetime(2025, 1, 1)
ARROW = pa.schema([
    ("mmsi", pa.int64()), ("imo", pa.string()), ("vessel_name", pa.string()), ("port_locode", pa.string()),
    ("lat", pa.float64()), ("lon", pa.float64()), ("dep_time", pa.timestamp("us")),
])


def random_pings(seed, vessels=60, null_ports=0.15, null_times=0.05, minutes=600, repeats=0.1):
    """Short, messy histories: repeated reports, ties, missing ports, times and MMSI."""
    dice = random.Random(seed)
    rows = []
    for vessel in range(vessels):
        mmsi = None if vessel == 0 else vessel
        for _ in range(dice.randint(1, 25)):
            port = None if dice.random() < null_ports else dice.choice("ABC")
            at = None if dice.random() < null_times else START + dt.timedelta(minutes=dice.randint(0, minutes))
            row = (mmsi, "9", f"V{vessel}", port, float(dice.randint(0, 2)), 0.0, at)
            rows += [row] * (3 if dice.random() < repeats else 1)
    dice.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, schemas.STAGED)


def values(df, columns):
    return sorted(map(str, (tuple(r) for r in df.select(*columns).collect())))


def expected(rows, relation, columns):
    con = duckdb.connect()
    con.execute("set default_null_order='nulls_first'")
    con.register("staged", pa.Table.from_pylist([dict(zip(ARROW.names, r)) for r in rows], schema=ARROW))
    sql = f"with {_stitched('staged')} select {', '.join(columns)} from {relation}"
    return sorted(map(str, con.execute(sql).fetchall()))


def test_literal_frame(spark):
    at = [dt.datetime(2025, 1, 1, 10), dt.datetime(2025, 1, 1, 11), dt.datetime(2025, 1, 2, 10), dt.datetime(2025, 1, 3, 10)]
    ports, place = ["PORTA", "PORTA", "PORTB", "PORTC"], [10.0, 10.0, 20.0, 30.0]
    rows = [(123, "999", "Vessel A", p, x, x, t) for p, x, t in zip(ports, place, at)]
    got = voyage_legs(frame(spark, rows)).orderBy("dep_time").collect()
    assert [(r.dep_locode, r.arr_locode) for r in got] == [("PORTA", "PORTB"), ("PORTB", "PORTC")]
    assert got[0].dep_time == at[0] and got[0].arr_time == at[2]


@pytest.mark.parametrize("minutes", [7, 60, 1440])
def test_legs_equal_plain_windows(spark, minutes):
    rows = random_pings(minutes)
    got = voyage_legs(frame(spark, rows), slice_minutes=minutes)
    want = expected(rows, "legs", schemas.LEGS.names)
    assert values(got, schemas.LEGS.names) == want and len(want) > 50


def test_visits_equal_plain_windows(spark):
    rows = [r for r in random_pings(5) if r[-1] is not None]
    got = port_visits(frame(spark, rows), slice_minutes=30)
    assert values(got, schemas.STAGED.names) == expected(rows, "visits", schemas.STAGED.names)


@pytest.mark.parametrize("minutes", [1, 30, 1440])
def test_repeats_and_missing_ports_change_nothing(spark, minutes):
    rows = random_pings(11, minutes=120, repeats=0.6)
    rows += [(77, "9", "V", port, 0.0, 0.0, START + dt.timedelta(minutes=m)) for m, port in enumerate(["A", None, None, None, None, "B"])]
    timed = [r for r in rows if r[-1] is not None]
    got = voyage_legs(frame(spark, rows), slice_minutes=minutes)
    assert values(got, schemas.LEGS.names) == expected(rows, "legs", schemas.LEGS.names)
    assert values(port_visits(frame(spark, timed), slice_minutes=minutes), schemas.STAGED.names) == expected(timed, "visits", schemas.STAGED.names)


def test_one_vessel_with_most_pings_is_spread(spark):
    """A third and more of the pings belong to one vessel: no task may sort them all."""
    hot = spark.range(20000).select(
        F.lit(1).cast("bigint").alias("mmsi"), F.lit("9").alias("imo"), F.lit("HOT").alias("vessel_name"),
        F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("port_locode"), F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon"),
        F.timestamp_add("SECOND", F.col("id").cast("int") * 60, F.lit(START)).cast("timestamp_ntz").alias("dep_time"),
    )
    cold = hot.withColumn("mmsi", F.lit(2).cast("bigint")).limit(100)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        linked = link_visits(hot.unionByName(cold))
        assert completed(linked).count() == 19999 + 99
        per_task = linked.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert per_task < 5000


def test_a_copy_repeated_many_times_is_reduced_before_the_shuffle(spark):
    row = (1, "9", "V", "A", 0.0, 0.0, START)
    rows = [row] * 3000 + [(1, "9", "V", "B", 0.0, 0.0, START + dt.timedelta(hours=5))]
    linked = link_visits(frame(spark, rows))
    plan = linked._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_count") > plan.rindex("Exchange hashpartitioning")
    assert [(r.dep_locode, r.arr_locode) for r in completed(linked).collect()] == [("A", "B")]


def test_plan_has_an_exchange_for_repeats_one_for_slices_and_one_for_edges(spark):
    plan = link_visits(frame(spark, random_pings(1)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3
    assert plan.count("Sort [") == 2


def test_zero_length_leg_is_dropped(spark):
    rows = [(1, "", "V", "A", 0.0, 0.0, START), (1, "", "V", "B", 0.0, 0.0, START),
            (1, "", "V", "C", 0.0, 0.0, START + dt.timedelta(hours=1))]
    got = voyage_legs(frame(spark, rows)).collect()
    assert [(r.dep_locode, r.arr_locode) for r in got] == [("B", "C")]


def test_open_visits(spark):
    hour = dt.timedelta(hours=1)
    rows = [(1, "", "V", "A", 0.0, 0.0, START), (1, "", "V", "B", 0.0, 0.0, START + hour),
            (1, "", "V", "B", 0.0, 0.0, START + 2 * hour), (1, "", "V", None, 0.0, 0.0, START + 3 * hour),
            (2, "", "W", "A", 0.0, 0.0, START)]
    staged = frame(spark, rows)
    state = open_visits(link_visits(staged), staged).orderBy("mmsi", "dep_time").collect()
    assert [(r.mmsi, r.port_locode, r.dep_time, r.last_seen) for r in state] == [
        (1, "B", START + hour, START + 3 * hour), (1, None, START + 3 * hour, START + 3 * hour), (2, "A", START, START),
    ]


def test_order_is_total_over_the_staged_columns():
    assert set(ORDER) | {"mmsi"} == set(schemas.STAGED.names)


def test_leg_columns_match_the_oracle_text():
    assert [c.strip() for c in LEG_COLUMNS.split(",")] == schemas.LEGS.names
