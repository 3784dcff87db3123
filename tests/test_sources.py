import datetime as dt
import gzip
import json

import pytest
import zstandard
from pyspark.sql import functions as F

from quayside import schemas
from quayside.config import Tables
from quayside.plans import reports
from quayside.plans.ingest import ingest_days
from quayside.sources import locodes, runlog
from quayside.sources.html import html_rows, nested_cells, table_after
from quayside.sources.pings import MissingColumns, append_pings, date_range, landed_files, plan_dates, read_pings
from quayside.sources.tables import append_table, ensure_table, read_table, replace_table, source
from quayside.streaming.ingest import stream_ingest

NOW = dt.datetime(2025, 3, 10, 12, tzinfo=dt.timezone.utc)
D = dt.date


@pytest.mark.parametrize("args,first,last,count", [
    (dict(year=2024), D(2024, 1, 1), D(2024, 12, 31), 366),
    (dict(year=2024, month=2), D(2024, 2, 1), D(2024, 2, 29), 29),
    (dict(year=2024, month=12), D(2024, 12, 1), D(2024, 12, 31), 31),
    (dict(year=2024, month=2, day=3), D(2024, 2, 3), D(2024, 2, 3), 1),
    (dict(year=2024, day=3), D(2024, 1, 1), D(2024, 12, 31), 366),
    (dict(month=2), D(2025, 3, 9), D(2025, 3, 9), 1),
    (dict(), D(2025, 3, 9), D(2025, 3, 9), 1),
    (dict(year=2025), D(2025, 1, 1), D(2025, 3, 9), 68),
    (dict(year=2025, month=3, day=10), D(2025, 3, 10), D(2025, 3, 10), 1),
])
def test_plan_dates(args, first, last, count):
    days = plan_dates(**args, now=NOW)
    assert (days[0], days[-1], len(days)) == (first, last, count)


def test_future_days_are_none():
    assert plan_dates(2025, 4, now=NOW) == [] and plan_dates(2025, 3, 11, now=NOW) == []


def test_date_range(spark):
    rows = date_range(spark, plan_dates(2024, 2)).orderBy("dt").collect()
    assert len(rows) == 29 and rows[-1].file_name == "ais-2024-02-29.csv"
    assert date_range(spark, []).count() == 0


HEADER = "mmsi,base_date_time,longitude,latitude,sog,vessel_name,imo"
LINES = [
    "1,2025-01-01 10:00:00,0.001,0.0,5,Ship A,IMO9",
    "bad,2025-01-01 11:00:00,0.001,0.0,5,Ship B,9",
    "3,not a date,0.001,0.0,5,Ship C,",
    "4,2025-01-01 10:00:00,0.001,x,5,Ship D,9",
    "5,2025-01-01 10:00:00,NaN,0.0,5,Ship E,9",
    "6,2025-01-01 10:00:00,,0.0,5,Ship F,9",
    '7,2025-01-01 10:00:00,40.0,40.0,5,"Ship, G",9',
]


def land(folder, day, header=HEADER, lines=LINES, packed=None):
    folder.mkdir(exist_ok=True)
    data = "\n".join([header, *lines]).encode() + b"\n"
    name = f"ais-{day}.csv"
    if packed == "zst":
        (folder / f"{name}.zst").write_bytes(zstandard.ZstdCompressor().compress(data))
    elif packed == "gz":
        (folder / f"{name}.gz").write_bytes(gzip.compress(data))
    else:
        (folder / name).write_bytes(data)


def ports(spark):
    return spark.createDataFrame([("A", "Port A", 0.0, 0.0)], "locode string, name string, lat double, lon double")


def test_files_are_read_by_column_name(spark, tmp_path):
    land(tmp_path / "in", "2025-01-01")
    other = "imo,vessel_name,latitude,longitude,mmsi,base_date_time"
    land(tmp_path / "in", "2025-01-02", other, ["IMO8,Ship H,0.0,0.002,8,2025-01-02 10:00:00"], packed="zst")
    files = {r.dt: r.path for r in landed_files(spark, str(tmp_path / "in")).collect()}
    assert sorted(files) == [D(2025, 1, 1), D(2025, 1, 2)]
    rows = {r.vessel_name: r for r in read_pings(spark, files.values()).collect()}
    assert sorted(rows) == ["Ship A", "Ship B", "Ship C", "Ship H", "Ship, G"]
    assert rows["Ship A"].mmsi == 1 and rows["Ship A"].dep_time == dt.datetime(2025, 1, 1, 10)
    assert rows["Ship B"].mmsi is None and rows["Ship C"].dep_time is None
    assert (rows["Ship H"].mmsi, rows["Ship H"].latitude, rows["Ship H"].longitude) == (8, 0.0, 0.002)
    assert rows["Ship H"].dt == D(2025, 1, 2)


def test_only_needed_columns_are_read(spark, tmp_path):
    land(tmp_path / "in", "2025-01-01")
    plan = read_pings(spark, [str(tmp_path / "in" / "ais-2025-01-01.csv")])._jdf.queryExecution().executedPlan().toString()
    assert "c4" not in plan.split("ReadSchema")[1]


def test_missing_column(spark, tmp_path):
    land(tmp_path / "in", "2025-01-01", header=HEADER.replace("imo", "imo_number"))
    with pytest.raises(MissingColumns):
        read_pings(spark, [str(tmp_path / "in" / "ais-2025-01-01.csv")])


def test_a_bad_day_does_not_stop_the_others(spark, tmp_path):
    landing = tmp_path / "in"
    for day in range(1, 6):
        lines = [line.replace("2025-01-01", f"2025-01-{day:02d}") for line in LINES]
        land(landing, f"2025-01-{day:02d}", lines=lines, packed="zst")
    broken = landing / "ais-2025-01-02.csv.zst"
    broken.write_bytes(broken.read_bytes()[:-20])
    land(landing, "2025-01-04", header="a,b,c", lines=["1,2,3"], packed="zst")
    path = str(tmp_path / "pings")
    report = ingest_days(spark, str(landing), plan_dates(2025, 1), ports(spark), path)
    assert report.done == [D(2025, 1, 1), D(2025, 1, 3), D(2025, 1, 5)]
    assert sorted(report.failed) == [D(2025, 1, 2), D(2025, 1, 4)]
    assert len(report.absent) == 26
    stored = spark.read.parquet(path)
    assert stored.count() == 9 and stored.where("ingested_at is null").count() == 0
    assert {r[0] for r in stored.select("port_locode").distinct().collect()} == {"A"}


def test_row_counts_and_running_a_day_again(spark, tmp_path):
    land(tmp_path / "in", "2025-01-01")
    day, path = [D(2025, 1, 1)], str(tmp_path / "pings")
    report = ingest_days(spark, str(tmp_path / "in"), day, ports(spark), path)
    assert (report.read, report.kept) == (4, 3)
    ingest_days(spark, str(tmp_path / "in"), day, ports(spark), path)
    assert spark.read.parquet(path).count() == 3
    ingest_days(spark, str(tmp_path / "in"), day, ports(spark), path, mode="append")
    assert spark.read.parquet(path).count() == 6


def test_a_day_that_lost_its_pings_is_emptied(spark, tmp_path):
    for day in (1, 2):
        land(tmp_path / "in", f"2025-01-0{day}")
    days, path = [D(2025, 1, 1), D(2025, 1, 2)], str(tmp_path / "pings")
    ingest_days(spark, str(tmp_path / "in"), days, ports(spark), path)
    land(tmp_path / "in", "2025-01-02", lines=LINES[-1:])
    assert ingest_days(spark, str(tmp_path / "in"), days, ports(spark), path).kept == 3
    assert {str(r.dt) for r in spark.read.parquet(path).collect()} == {"2025-01-01"}


def test_stream_takes_each_file_once(spark, tmp_path):
    landing, path = tmp_path / "in", str(tmp_path / "pings")
    reports_seen = []

    def run():
        stream_ingest(spark, str(landing), ports(spark), path, str(tmp_path / "cp"), max_files=1,
                      on_report=lambda _, r: reports_seen.append(r)).awaitTermination()

    land(landing, "2025-01-01")
    land(landing, "2025-01-02", packed="gz")
    run()
    assert sorted(d for r in reports_seen for d in r.done) == [D(2025, 1, 1), D(2025, 1, 2)]
    land(landing, "2025-01-03")
    reports_seen.clear()
    run()
    assert [r.done for r in reports_seen] == [[D(2025, 1, 3)]]
    assert spark.read.parquet(path).count() == 9


def test_stream_tries_a_failed_day_again(spark, tmp_path):
    landing, path, seen = tmp_path / "in", str(tmp_path / "pings"), []

    def run():
        stream_ingest(spark, str(landing), ports(spark), path, str(tmp_path / "cp"), on_report=lambda _, r: seen.append(r)).awaitTermination()

    land(landing, "2025-01-01", "a,b", ["1,2"])
    run()
    assert list(seen[-1].failed) == [D(2025, 1, 1)]
    land(landing, "2025-01-01")  # mended under its old name, which the stream does not give again
    land(landing, "2025-01-02")
    run()
    assert seen[-1].done == [D(2025, 1, 1), D(2025, 1, 2)] and not seen[-1].failed
    land(landing, "2025-01-03")
    run()
    assert seen[-1].done == [D(2025, 1, 3)]


def test_tables(spark, tmp_path):
    tables = Tables(str(tmp_path))
    assert read_table(spark, tables.ports) is None
    assert source(spark, tables, "ports").columns == schemas.PORTS.names
    ensure_table(spark, tables.run_results, schemas.RUN_RESULTS)
    ensure_table(spark, tables.run_results, schemas.RUN_RESULTS)
    assert read_table(spark, tables.run_results).schema == schemas.RUN_RESULTS
    ensure_table(spark, tables.raw_pings, schemas.RAW_PINGS, partition="dt")
    assert source(spark, tables, "raw_ais_pings").count() == 0
    rows = spark.createDataFrame([("A",), ("B",)], "code string")
    replace_table(rows, tables.countries)
    replace_table(rows.limit(1), tables.countries)
    append_table(rows, tables.countries)
    assert read_table(spark, tables.countries).count() == 3


TABLE = """<html><h1>x</h1><h2 class="a" id="Other">n</h2><table><tr><th>Code</th></tr><tr><td>XX</td></tr></table>
<h2 id="Current_codes">Current</h2><p>text</p>
<table class="wikitable"><tr><th>Entry</th><th>Name</th></tr>
<tr><td><a href="/wiki/NL"> NL </a></td><td>Netherlands</td></tr>
<TR><td>BE<td>Belgium</tr>
<tr><td>A1</td></tr><tr><td>nl</td></tr><tr><td>NLD</td></tr><tr></tr><tr><td>BE</td><td>again</td></tr></table>
<table><tr><td>ZZ</td></tr><tr><td>ZY</td></tr></table></html>"""


def test_html_rows(spark):
    pages = spark.createDataFrame([(1, TABLE)], "page_id bigint, html string")
    rows = html_rows(pages, html=table_after(F.col("html"), "Current_codes")).orderBy("row_no").collect()
    assert [r.cells for r in rows[:3]] == [["Entry", "Name"], ["NL", "Netherlands"], ["BE", "Belgium"]]
    assert html_rows(pages).count() == len(rows) + 4


def test_table_with_a_table_inside(spark):
    inner = "<table><tr><td>in</td></tr></table>"
    html = f"<h2 id='x'>h</h2>text<TABLE class=a><tr><td>AA{inner}</td></tr><tr><td>BB</td></tr></TABLE ><table><tr><td>no</td></tr></table>"
    pages = spark.createDataFrame([(1, html), (2, "<h2 id=x></h2><table><tr><td>open"), (3, "<h2 id=x></h2> none"), (4, None)], "page_id int, html string")
    rows = html_rows(pages, html=table_after(F.col("html"), "x")).select("page_id", F.array_join("cells", "|").alias("c")).collect()
    assert sorted((r.page_id, r.c) for r in rows if r.c) == [(1, "AAin|in"), (1, "BB"), (1, "in"), (2, "open")]


@pytest.mark.parametrize("html,rows", [
    (None, None), ("", []), ("<td>a</td>", []), ("<table><td>a</table>", []), ("<tr></tr></table></table><tr><td>a", [[], ["a"]]),
    ("<table><tr><td>a<td>b<tr><th>c</table><tr><td>d</tr>e", [["a", "b"], ["c"], ["d"]]),
    ("<tr><td>a<table><tr><td>b</table>c</td><td>d</td></tr>", [["a<table><tr><td>b</table>c", "b", "d"], ["b"]]),
    ("<tr><td>1<table><tr><td>2<TABLE><tr><td>3</table></td></table><td>4", [["1<table><tr><td>2<TABLE><tr><td>3</table></td></table>", "2<TABLE><tr><td>3</table>", "3", "4"], ["2<TABLE><tr><td>3</table>", "3"], ["3"]]),
    ("<tr><!-- <td>no --><td\nid='x'>yes</td><tdx>no</tdx></tr>", [["yes"]]),
    ("<table>" * 20000 + "<tr><td>deep", [["deep"]]),
])
def test_nested_cells(html, rows):
    assert nested_cells(html, ["td", "th"]) == rows


def test_flat_pages_read_the_same_either_way(spark):
    flat = "<table><tr><td> a </td><th>b</th></tr><TR><td>BE<td>Belgium</tr><tr></tr><tr><td>open</table>"
    pages = spark.createDataFrame([(1, flat), (2, flat + "<table></table>"), (3, None), (4, "none")], "page_id int, html string")
    rows = {}
    for row in html_rows(pages).orderBy("page_id", "row_no").collect():
        rows.setdefault(row.page_id, []).append(row.cells)
    assert rows == {1: [["a", "b"], ["BE", "Belgium"], [], ["open"]], 2: [["a", "b"], ["BE", "Belgium"], [], ["open"]]}


def test_country_codes(spark):
    pages = spark.createDataFrame([(1, TABLE)], "page_id bigint, html string")
    assert [r.code for r in locodes.country_codes_of_pages(pages).collect()] == ["A1", "BE", "NL"]
    moved = pages.withColumn("html", F.replace(F.col("html"), F.lit("Current_codes"), F.lit("Codes")))
    assert locodes.country_codes_of_pages(moved).count() == 0


def port_row(code="RTM", function="1-3-----", status="AI", place="5157N 00408E", cells=12):
    row = ["", code, "Rotterdam", "Rotterdam", "ZH", function, status, "0401", "", place, "", ""]
    return row[:cells]


@pytest.mark.parametrize("change,kept", [
    ({}, "NLRTM"), ({"code": " be ant"}, "BEANT"), ({"code": "x"}, None), ({"code": " "}, None),
    ({"function": "--3-----"}, None), ({"function": "0--1"}, "NLRTM"), ({"status": "XX"}, None), ({"status": " RLx "}, "NLRTM"),
    ({"place": ""}, None), ({"place": "5157N"}, None), ({"place": "5157N  00408E"}, None), ({"place": " 5157N 00408E "}, "NLRTM"),
    ({"place": "xx57N 00408E"}, None), ({"cells": 9}, None), ({"cells": 10}, "NLRTM"),
])
def test_port_rows(spark, change, kept):
    raw = spark.createDataFrame([("NL", port_row(**change))], "iso string, cells array<string>")
    got = locodes.normalize_ports(raw).collect()
    assert [r.locode for r in got] == ([kept] if kept else [])
    if kept:
        assert got[0].lat == pytest.approx(51.95) and got[0].lon == pytest.approx(4 + 8 / 60)


def test_port_pages(spark):
    row = "".join(f"<td>{c.replace(' ', '&nbsp;') if i == 1 else c}</td>" for i, c in enumerate(port_row("NL RTM")))
    html = "<table>" + "<tr><td>head</td></tr>" * 10 + f"<tr>{row}</tr><tr><td>short</td></tr></table>"
    pages = spark.createDataFrame([("NL", html)], "iso string, html string")
    got = locodes.normalize_ports(locodes.raw_locode(pages)).collect()
    assert [(r.locode, r.name) for r in got] == [("NLRTM", "Rotterdam")]


def test_run_results(spark, tmp_path):
    document = {
        "metadata": {"generated_at": "2025-01-01T10:00:00.5Z"},
        "results": [
            {"unique_id": "model.x.stg_ais", "status": "success", "execution_time": 1.5,
             "adapter_response": {"rows_affected": 7}, "message": "OK", "extra": 1},
            {"unique_id": "model.x.voyages", "status": "error", "execution_time": 2.0, "adapter_response": {}},
        ],
    }
    path = tmp_path / "run_results.json"
    path.write_text(json.dumps(document, indent=1))
    rows = runlog.read_run_results(spark, str(path))
    assert rows.schema == schemas.RUN_RESULTS
    got = {r.unique_id: r for r in rows.collect()}
    assert got["model.x.stg_ais"].rows_affected == 7 and got["model.x.stg_ais"].run_id is None
    assert got["model.x.voyages"].rows_affected is None and got["model.x.voyages"].message is None
    assert got["model.x.voyages"].generated_at == dt.datetime(2025, 1, 1, 10, 0, 0, 500000)
    assert runlog.read_run_results(spark, str(tmp_path / "none.json")).count() == 0

    log = str(tmp_path / "log")
    runlog.append_run_log(rows, log)
    runlog.append_run_log(rows, log)
    stored = spark.read.parquet(log)
    history = reports.run_history(stored).collect()
    assert [(r.status, r.models_run, r.total_duration_sec) for r in history] == [("error", 2, 4.0), ("success", 2, 3.0)]
    assert [r.unique_id for r in reports.latency(stored).collect()] == ["model.x.stg_ais"] * 2


def test_a_day_is_stored_in_few_files(spark, tmp_path):
    rows = [(i % 50, "9", "V", 1.0, 2.0, dt.datetime(2025, 1, 1 + i % 3), "A", None, dt.date(2025, 1, 1 + i % 3)) for i in range(3000)]
    pings = spark.createDataFrame(rows, schemas.RAW_PINGS).drop("ingested_at").repartition(16)
    append_pings(pings, str(tmp_path / "pings"))
    assert [len(list(day.glob("*.parquet"))) for day in sorted((tmp_path / "pings").glob("dt=*"))] == [1, 1, 1]
    stored = spark.read.parquet(str(tmp_path / "pings"))
    assert stored.count() == 3000
    # In a file vessels follow each other.
    one = spark.read.parquet(str(next((tmp_path / "pings" / "dt=2025-01-01").glob("*.parquet"))))
    vessels = [r.mmsi for r in one.collect()]
    assert vessels == sorted(vessels)


def test_an_error_without_a_message_is_reported(spark, tmp_path, monkeypatch):
    from quayside.plans import ingest

    def fail(*_, **__):
        raise AssertionError

    monkeypatch.setattr(ingest, "read_pings", fail)
    day = dt.date(2025, 1, 1)
    ports = spark.createDataFrame([("A", 1.0, 2.0)], "locode string, lat double, lon double")
    report = ingest.ingest_files(spark, {day: ["x"]}, ports, str(tmp_path / "pings"))
    assert report.failed == {day: "AssertionError()"} and report.done == []
