import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from quayside import schemas
from quayside.config import Tables
from quayside.operators import quality, routes
from quayside.operators.stitch import voyage_legs
from quayside.operators.upsert import replace_by_key, upsert
from quayside.plans import reports, voyages
from quayside.plans.staging import stage
from quayside.sources.pings import append_pings
from tests.test_stitch import frame, random_pings, values

START = dt.datetime(2025, 1, 1)
HOUR, DAY = dt.timedelta(hours=1), dt.timedelta(days=1)


def leg(mmsi=1, dep="A", arr="B", start=START, hours=10, dep_at=(0.0, 0.0), arr_at=(0.0, 10.0), name="V"):
    return (mmsi, "9", name, dep, *dep_at, start, arr, *arr_at, start + hours * HOUR)


def legs_frame(spark, rows):
    return spark.createDataFrame(rows, schemas.LEGS)


# --- routes ------------------------------------------------------------------


def test_route_from_table(spark):
    known = [("route_A_B", ("LineString", [[0.0, 0.0], [5.0, 0.0], [10.0, 0.0]]), 100.0), ("route_A_C", ("LineString", [[0.0, 0.0]]), 7.0),
             ("route_A_D", None, None)]
    rows = [leg(), leg(arr="C", start=START + DAY), leg(arr="D", start=START + 2 * DAY), leg(arr="E", start=START + 3 * DAY)]
    table = spark.createDataFrame(known, schemas.ROUTES)
    straight = 10 * 60 * 1.852 / 1.852

    got = routes.enrich_routes(legs_frame(spark, rows), table).orderBy("dep_time").collect()
    assert got[0].distance_nm == 100.0 and got[0].duration_hrs == 10.0
    assert json.loads(got[0].route_geometry)["coordinates"] == [[0, 0], [5, 0], [10, 0]]
    for r in got[1:]:
        assert r.distance_nm == pytest.approx(straight, rel=2e-3)
        assert json.loads(r.route_geometry)["coordinates"] == [[0, 0], [10, 0]]

    got = routes.enrich_routes(legs_frame(spark, rows), table, on_missing="zero").orderBy("dep_time").collect()
    assert [r.distance_nm for r in got] == [100.0, 7.0, 0.0, 0.0]
    assert [r.route_geometry and json.loads(r.route_geometry) and "path" for r in got] == ["path", "path", None, None]
    assert got[2].route_geometry == "null" and got[3].route_geometry is None


def test_routes_with_a_table_too_big_to_broadcast(spark):
    table = spark.createDataFrame([("route_A_B", ("LineString", [[0.0, 0.0], [10.0, 0.0]]), 100.0)], schemas.ROUTES)
    enriched = routes.enrich_routes(legs_frame(spark, [leg()]), table, broadcast_max_rows=0)
    assert enriched.first().distance_nm == 100.0


def test_durations_are_positive_and_the_schema_is_whole(spark):
    rows = [leg(hours=0), leg(hours=-1)]
    assert routes.enrich_routes(legs_frame(spark, rows)).count() == 0
    empty = routes.enrich_routes(legs_frame(spark, []))
    assert empty.columns == schemas.VOYAGES.names and empty.count() == 0


def test_finder_runs_once_per_pair(spark, tmp_path):
    log = tmp_path / "calls"

    def finder(dep_lon, dep_lat, arr_lon, arr_lat):
        with open(log, "a") as out:
            out.write(f"{dep_lon},{dep_lat},{arr_lon},{arr_lat}\n")
        if arr_lon > 15:
            raise RuntimeError("point on land")
        return [[dep_lon, dep_lat], [arr_lon, arr_lat]], 42.0

    rows = [leg(start=START + i * DAY) for i in range(20)] + [leg(arr="Z", arr_at=(0.0, 20.0))]
    legs = legs_frame(spark, rows)
    found = routes.find_routes(routes.route_pairs(legs), finder).collect()
    assert sorted((r.route_key, r.length_nm) for r in found) == [("route_A_B", 42.0), ("route_A_Z", None)]
    assert sorted(log.read_text().split()) == ["0.0,0.0,10.0,0.0", "0.0,0.0,20.0,0.0"]
    # A pair without a route is not asked again, and its legs fall back.
    known = spark.createDataFrame(found, schemas.ROUTES)
    assert routes.missing_pairs(legs, known).count() == 0
    zero = routes.enrich_routes(legs, known, on_missing="zero").where("arr_locode = 'Z'").first()
    assert (zero.distance_nm, zero.route_geometry) == (0.0, None)


def test_finder_needs_no_package_on_workers(spark):
    from pyspark import cloudpickle

    pairs = routes.route_pairs(legs_frame(spark, [leg()]))
    plan = routes.find_routes(pairs, lambda *_: ([[0.0, 0.0], [1.0, 1.0]], 1.0))
    assert plan.count() == 1
    names = list(schemas.ROUTES.names)
    assert b"quayside" not in cloudpickle.dumps(lambda: names)


def test_routes_by_position(spark):
    rows = [leg(), leg(start=START + DAY, arr_at=(0.0, 11.0))]
    legs = legs_frame(spark, rows)

    def finder(dep_lon, dep_lat, arr_lon, arr_lat):
        return [[dep_lon, dep_lat], [arr_lon, arr_lat]], arr_lon

    found = routes.find_routes(routes.route_pairs(legs, "positions"), finder)
    got = routes.enrich_routes(legs, found, by="positions").orderBy("dep_time").collect()
    assert [r.distance_nm for r in got] == [10.0, 11.0]


# --- quality -----------------------------------------------------------------


def test_duration_checks(spark):
    table = spark.createDataFrame([(1, 2.0), (2, 0.0), (3, -1.0), (4, None)], "mmsi bigint, duration_hrs double")
    rule = quality.non_positive_duration()
    assert {r.mmsi for r in quality.failing_rows(table, rule).collect()} == {2, 3}
    assert {r.mmsi for r in quality.drop_non_positive(table).collect()} == {1, 4}
    with pytest.raises(quality.QualityError):
        quality.expect_none(table, rule)
    quality.expect_none(table.where("mmsi = 1"), rule)


def test_counted_needs_no_job_of_its_own(spark):
    df, seen = quality.counted(spark.range(7), "rows seen")
    df.where("id > 2").write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 7


# --- keyed replace -----------------------------------------------------------


def test_replace_by_key_takes_null_as_a_value(spark):
    target = spark.createDataFrame([(None, 1, "old"), (1, 1, "old"), (2, 1, "old")], "k bigint, t int, v string")
    batch = spark.createDataFrame([(None, 1, "new"), (2, 1, "new"), (3, 1, "new")], "k bigint, t int, v string")
    got = {(r.k, r.v) for r in replace_by_key(target, batch, ["k", "t"]).collect()}
    assert got == {(None, "new"), (1, "old"), (2, "new"), (3, "new")}


ROWS = "k bigint, mmsi bigint, day date, v string"


def stored(spark, path):
    return sorted((r.k, r.mmsi, r.day, r.v) for r in spark.read.parquet(path).collect())


def test_upsert_rewrites_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    one, two, three = dt.date(2025, 1, 1), dt.date(2025, 1, 2), dt.date(2025, 1, 3)
    upsert(path, spark.createDataFrame([(1, 1, one, "a"), (2, 1, two, "a"), (3, 2, three, "a")], ROWS), ["k"], "day")
    untouched = sorted((tmp_path / "t" / "day=2025-01-01").glob("*.parquet"))
    upsert(path, spark.createDataFrame([(2, 1, two, "b"), (4, 1, two, "b")], ROWS), ["k"], "day")
    assert stored(spark, path) == [(1, 1, one, "a"), (2, 1, two, "b"), (3, 2, three, "a"), (4, 1, two, "b")]
    assert sorted((tmp_path / "t" / "day=2025-01-01").glob("*.parquet")) == untouched


def test_upsert_drops_rows_and_empties_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    one, two = dt.date(2025, 1, 1), dt.date(2025, 1, 2)
    upsert(path, spark.createDataFrame([(1, 1, one, "a"), (2, 2, two, "a"), (3, 1, two, "a")], ROWS), ["k"], "day")
    gone = spark.createDataFrame([(1,)], "mmsi bigint")
    upsert(path, spark.createDataFrame([(9, 1, two, "b")], ROWS), ["k"], "day", drop=gone)
    assert stored(spark, path) == [(2, 2, two, "a"), (9, 1, two, "b")]
    upsert(path, spark.createDataFrame([], ROWS), ["k"], "day", drop=gone)
    assert stored(spark, path) == [(2, 2, two, "a")]


def test_upsert_goes_on_after_a_crash_and_does_nothing_twice(spark, tmp_path, monkeypatch):
    from quayside.operators import upsert as module

    path, one = str(tmp_path / "t"), dt.date(2025, 1, 1)
    upsert(path, spark.createDataFrame([(1, 1, one, "a"), (2, 1, one, "a")], ROWS), ["k"], "day")
    batch = spark.createDataFrame([(2, 1, one, "b")], ROWS)

    def crash(*_):
        spark.createDataFrame([], ROWS).drop("day").write.mode("overwrite").parquet(f"{path}/day=2025-01-01")
        raise RuntimeError("lost in the middle of the swap")

    with monkeypatch.context() as patched:
        patched.setattr(module, "_swap", crash)
        with pytest.raises(RuntimeError):
            upsert(path, batch, ["k"], "day", run_id="crashed")
    upsert(path, batch, ["k"], "day", run_id="crashed")
    assert stored(spark, path) == [(1, 1, one, "a"), (2, 1, one, "b")]
    upsert(path, spark.createDataFrame([(2, 1, one, "c")], ROWS), ["k"], "day")
    upsert(path, batch, ["k"], "day", run_id="crashed")
    assert stored(spark, path) == [(1, 1, one, "a"), (2, 1, one, "c")]


# --- incremental -------------------------------------------------------------


@pytest.mark.parametrize("seed", [3])
def test_carry_equals_a_full_build(spark, seed):
    rows = random_pings(seed, null_times=0.02)
    cuts = [START + m * dt.timedelta(minutes=1) for m in (0, 150, 300, 301, 700)]
    parts = [[r for r in rows if r[-1] is None or a <= r[-1] < b] for a, b in zip(cuts, cuts[1:])]
    got = voyages.carry_batches([frame(spark, p) for p in parts])
    assert values(got, schemas.LEGS.names) == values(voyage_legs(frame(spark, rows)), schemas.LEGS.names)


def straddling():
    """A stay across the cut-off, and a passage of 20 days."""
    at = [("A", 0), ("B", 5), ("B", 12), ("B", 20), ("C", 26), ("D", 46)]
    return [(1, "9", "V", port, 0.0, 0.0, START + day * DAY) for port, day in at]


def test_lookback_doubles_a_stay_across_the_line_and_carry_does_not(spark):
    rows = straddling()
    target = voyage_legs(frame(spark, rows[:5]))
    batch = voyage_legs(voyages.lookback_input(frame(spark, rows), target))
    merged = replace_by_key(target, batch, schemas.VOYAGE_KEY)
    pairs = sorted((r.dep_locode, r.arr_locode, r.dep_time.day) for r in merged.collect())
    assert pairs == [("A", "B", 1), ("B", "C", 6), ("B", "C", 13), ("C", "D", 27)]
    carried = voyages.carry_batches([frame(spark, rows[:3]), frame(spark, rows[3:5]), frame(spark, rows[5:])])
    assert sorted((r.dep_locode, r.arr_locode, r.dep_time.day) for r in carried.collect()) == [
        ("A", "B", 1), ("B", "C", 6), ("C", "D", 27)]


def test_cutoff(spark):
    assert voyages.cutoff(None) is None and voyages.cutoff(legs_frame(spark, [])) is None
    assert voyages.cutoff(legs_frame(spark, [leg(), leg(hours=48)])) == START + 2 * DAY - 14 * DAY
    plan = voyages.lookback_input(frame(spark, straddling()), legs_frame(spark, [leg(hours=24 * 30)]))
    assert plan.count() == 3


def store_pings(spark, rows, path):
    df = spark.createDataFrame(rows, schemas.STAGED).select(
        "mmsi", "imo", "vessel_name", F.col("lat").alias("latitude"), F.col("lon").alias("longitude"), "dep_time",
        "port_locode", F.to_date("dep_time").alias("dt"))
    append_pings(df, path)


def voyage_rows(spark, tables):
    return values(spark.read.parquet(tables.voyages), schemas.LEGS.names)


def test_build_job_carry_with_late_pings(spark, tmp_path):
    tables = Tables(str(tmp_path))
    rows = [r for r in random_pings(21, vessels=30, null_ports=0, minutes=6 * 1440) if r[-1] is not None]
    late = [r for r in rows if r[-1].day == 2 and (r[0] or 0) % 3 == 1]
    first = [r for r in rows if r[-1].day <= 3 and r not in late]
    rest = [r for r in rows if r[-1].day > 3]
    store_pings(spark, first, tables.raw_pings)
    voyages.build_voyages(spark, tables, run_id="first" + str(tmp_path).replace("/", "-"))
    assert voyage_rows(spark, tables) == values(voyage_legs(frame(spark, first)), schemas.LEGS.names)

    # Pings of day 2 turn up together with the days after: their vessels are built anew.
    store_pings(spark, [r for r in rows if r[-1].day == 2], tables.raw_pings)
    store_pings(spark, rest, tables.raw_pings)
    run = "second" + str(tmp_path).replace("/", "-")
    for _ in range(2):  # repeating the call changes nothing
        voyages.build_voyages(spark, tables, since_day="2025-01-02", run_id=run)
        full = voyage_legs(stage(spark.read.parquet(tables.raw_pings)))
        assert voyage_rows(spark, tables) == values(full, schemas.LEGS.names)
    quality.expect_none(spark.read.parquet(tables.voyages), quality.non_positive_duration())


def test_build_job_lookback_and_route_table(spark, tmp_path):
    tables = Tables(str(tmp_path))
    rows = straddling()

    def finder(*_):
        return [[0.0, 0.0], [1.0, 1.0], [2.0, 2.0]], 77.0

    store_pings(spark, rows[:5], tables.raw_pings)
    voyages.build_voyages(spark, tables, mode="lookback", finder=finder)
    store_pings(spark, rows[5:], tables.raw_pings)
    voyages.build_voyages(spark, tables, mode="lookback", finder=finder)
    stored_voyages = spark.read.parquet(tables.voyages)
    assert stored_voyages.count() == 4
    assert {r.distance_nm for r in stored_voyages.collect()} == {77.0}
    assert spark.read.parquet(tables.routes).count() == 3


def days_of(rows, *days):
    return [r for r in rows if r[-1].day in days]


def history(seed=23):
    return [r for r in random_pings(seed, vessels=20, null_ports=0, minutes=6 * 1440) if r[-1] is not None]


def assert_full(spark, tables):
    assert voyage_rows(spark, tables) == values(voyage_legs(stage(spark.read.parquet(tables.raw_pings))), schemas.LEGS.names)


def test_a_run_id_goes_with_one_input(spark, tmp_path):
    tables, rows = Tables(str(tmp_path)), history()
    store_pings(spark, days_of(rows, 1, 2), tables.raw_pings)
    voyages.build_voyages(spark, tables, run_id="X")
    store_pings(spark, days_of(rows, 3, 4), tables.raw_pings)
    with pytest.raises(ValueError, match="another input"):
        voyages.build_voyages(spark, tables, run_id="X")
    voyages.build_voyages(spark, tables, since_day="2025-01-03", run_id="Y")
    assert_full(spark, tables)


def test_two_warehouses_share_run_ids(spark, tmp_path):
    rows = history()
    for name, part in (("one", days_of(rows, 1)), ("two", days_of(rows, 2))):
        tables = Tables(str(tmp_path / name))
        store_pings(spark, part, tables.raw_pings)
        voyages.build_voyages(spark, tables, run_id="same")
        assert_full(spark, tables)


def test_carry_after_lookback_builds_anew(spark, tmp_path):
    tables, rows = Tables(str(tmp_path)), history()
    store_pings(spark, days_of(rows, 1, 2, 3), tables.raw_pings)
    voyages.build_voyages(spark, tables, mode="lookback")
    store_pings(spark, days_of(rows, 4, 5), tables.raw_pings)
    voyages.build_voyages(spark, tables, days=[dt.date(2025, 1, 4), dt.date(2025, 1, 5)])
    assert_full(spark, tables)


def test_carry_after_an_unfinished_run_builds_anew(spark, tmp_path, monkeypatch):
    tables, rows = Tables(str(tmp_path)), history()
    store_pings(spark, days_of(rows, 1, 2), tables.raw_pings)
    voyages.build_voyages(spark, tables)
    store_pings(spark, days_of(rows, 3), tables.raw_pings)

    def crash(*_, **__):
        raise RuntimeError("lost")

    for name in ("upsert", "_remember"):
        with monkeypatch.context() as patched:
            patched.setattr(voyages, name, crash)
            with pytest.raises(RuntimeError):
                voyages.build_voyages(spark, tables, days=[dt.date(2025, 1, 3)], run_id=name)
    # The same run goes on, another one must not rely on what it left.
    voyages.build_voyages(spark, tables, days=[dt.date(2025, 1, 3)], run_id="_remember")
    assert_full(spark, tables)
    store_pings(spark, days_of(rows, 4), tables.raw_pings)
    voyages.build_voyages(spark, tables, days=[dt.date(2025, 1, 4)])
    assert_full(spark, tables)


def test_a_replaced_day_leaves_no_stale_voyage(spark, tmp_path):
    tables, rows = Tables(str(tmp_path)), history()
    store_pings(spark, days_of(rows, 1, 2, 3), tables.raw_pings)
    voyages.build_voyages(spark, tables)
    store_pings(spark, [r for r in days_of(rows, 2) if (r[0] or 0) % 3], tables.raw_pings)  # a third of the vessels is gone
    store_pings(spark, days_of(rows, 4), tables.raw_pings)
    voyages.build_voyages(spark, tables, days=[dt.date(2025, 1, 2), dt.date(2025, 1, 4)])
    assert_full(spark, tables)


def test_a_late_ping_rewrites_and_reads_few_days(spark, tmp_path):
    tables = Tables(str(tmp_path))
    rows = [(v, "9", "V", "AB"[day % 2], 0.0, 0.0, START + day * DAY) for v in (1, 2) for day in range(12)]
    store_pings(spark, rows, tables.raw_pings)
    voyages.build_voyages(spark, tables)
    before = {p.parent.name: p.name for p in (tmp_path / "gold" / "voyages").glob("dep_date=*/*.parquet")}
    assert len(before) == len(list((tmp_path / "gold" / "voyages").glob("dep_date=*/*.parquet"))) == 11
    late = [r for r in rows if r[-1].day == 6] + [(1, "9", "V", "C", 0.0, 0.0, START + 5 * DAY + dt.timedelta(hours=2))]
    store_pings(spark, late, tables.raw_pings)
    voyages.build_voyages(spark, tables, days=[dt.date(2025, 1, 6)])
    assert_full(spark, tables)
    after = {p.parent.name: p.name for p in (tmp_path / "gold" / "voyages").glob("dep_date=*/*.parquet")}
    assert {day for day in before if before[day] != after.get(day)} == {"dep_date=2025-01-06"}


def test_lookback_prunes_file_days(spark, tmp_path):
    store_pings(spark, straddling(), str(tmp_path))
    raw = spark.read.parquet(str(tmp_path))
    target = legs_frame(spark, [leg(hours=24 * 30)])
    plan = voyages.lookback_input(stage(raw, keep_day=True), target)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


# --- reports -----------------------------------------------------------------


def voyage_table(spark):
    rows = [
        leg(1, start=START, name="Old name"), leg(1, start=START + DAY), leg(2, start=START + 2 * DAY),
        leg(None, start=START + 40 * DAY), leg(2, dep="B", arr="A", start=START + 41 * DAY),
    ]
    return routes.enrich_routes(legs_frame(spark, rows))


def test_reports(spark):
    table = voyage_table(spark)
    total = reports.totals(table).first()
    assert (total.voyages, total.vessels) == (5, 2) and total.total_distance == pytest.approx(5 * 600, rel=2e-3)
    assert [r.dep_time for r in reports.recent(table, 2).collect()] == [START + 41 * DAY, START + 40 * DAY]
    assert {(r.vessel_name, r.total_trips) for r in reports.vessel_stats(table, "1").collect()} == {("Old name", 1), ("V", 1)}
    assert reports.vessel_stats(table, "no number").count() == 0
    assert [r.dep_locode for r in reports.vessel_history(table, 2).collect()] == ["B", "A"]
    as_of = (START + 42 * DAY).date()
    assert reports.last_days(table, 30, as_of).count() == 2
    assert reports.last_days(table, 40, as_of).count() == 3
    assert reports.last_days(table, 30).count() == 0
    page = reports.page_query(table, "select count(*) as n from {voyages} where mmsi = try_cast(:mmsi as bigint)", mmsi="1")
    assert page.first().n == 2


def test_top_rows_are_not_fully_sorted(spark):
    plan = reports.recent(voyage_table(spark))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_a_daily_run_does_not_open_old_voyages(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(voyages, "SEARCHED", 1)
    tables = Tables(str(tmp_path))
    rows = [(mmsi, "9", "V", "ABC"[h // 6 % 3], 1.0, 2.0, START + h * HOUR) for mmsi in range(1, 6) for h in range(mmsi, 144, 3)]
    late = [r for r in days_of(rows, 5) if r[0] == 3][-3:]
    store_pings(spark, [r for r in days_of(rows, 1, 2, 3, 4, 5) if r not in late], tables.raw_pings)
    voyages.build_voyages(spark, tables)
    # Files of an old day that would fail to be read.
    old = [f for f in (tmp_path / "gold" / "voyages" / "dep_date=2025-01-02").iterdir()]
    kept = {f: f.read_bytes() for f in old}
    for file in old:
        file.write_bytes(b"gone")
    store_pings(spark, days_of(rows, 5, 6), tables.raw_pings)
    voyages.build_voyages(spark, tables, days=[dt.date(2025, 1, 5), dt.date(2025, 1, 6)])
    for file, content in kept.items():
        file.write_bytes(content)
    assert_full(spark, tables)

    restarts = spark.createDataFrame([(1, dt.datetime(2025, 1, 4, 12))], "mmsi bigint, restart timestamp_ntz")
    voyages.since_restart(spark.read.parquet(tables.voyages), restarts).explain("formatted")
    assert "PartitionFilters: [isnotnull(dep_date" in capsys.readouterr().out


@pytest.mark.parametrize("changed, restart", [(50, 40), (40, 20), (25, 5), (5, 0), (3, 0)])
def test_restarts(spark, tmp_path, changed, restart):
    """A leg every ten hours from hour 5 on, and an unfinished visit since hour 40; the first ping at hour 0."""
    at = lambda hours: START + hours * HOUR
    late = spark.createDataFrame([(1, at(changed))], "mmsi bigint, changed timestamp_ntz")
    state = spark.createDataFrame([(1, None, None, "D", 0.0, 0.0, at(40), at(60))], schemas.OPEN_VISITS)
    legs = voyages.with_partition(legs_frame(spark, [leg(start=at(5), hours=15), leg(start=at(20), hours=15), leg(start=at(35), hours=5), leg(mmsi=2, start=at(1), hours=1)]))
    spans = spark.createDataFrame([(1, at(0), at(60), START.date())], schemas.SEEN)
    found = voyages.late_restarts(late, state, legs, voyages.PARTITION, [dt.date(2025, 1, 1), dt.date(2025, 1, 2)], spans, str(tmp_path))
    assert [(r.mmsi, r.restart) for r in found.collect()] == [(1, at(restart))]
