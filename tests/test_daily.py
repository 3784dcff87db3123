import datetime as dt

from quayside.config import Tables
from quayside.plans.daily import run_days
from quayside.sources.pings import plan_dates
from tests.test_sources import HEADER, TABLE, land, port_row


def test_from_files_to_voyages(spark, tmp_path):
    head = "<tr><td>head</td></tr>" * 10
    rows = [port_row("AAA", place="0000N 00000E"), port_row("BBB", place="0000N 00100E")]
    page = "<table>" + head + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows) + "</table>"
    countries = spark.createDataFrame([(TABLE,)], "html string")
    ports = spark.createDataFrame([("NL", page)], "iso string, html string")
    tables, landing = Tables(str(tmp_path / "root")), tmp_path / "in"
    at = {1: 0.0, 2: 1.0, 3: 1.0, 4: 0.0}
    for day, lon in at.items():
        line = f"7,2025-01-{day:02d} 10:00:00,{lon},0.0,5,Ship,IMO9"
        land(landing, f"2025-01-{day:02d}", HEADER, [line])

    def run(days):
        return run_days(spark, tables, str(landing), days, countries, ports)

    def voyages():
        got = spark.read.parquet(tables.voyages).orderBy("dep_time").collect()
        return [(r.imo, r.dep_locode, r.arr_locode, r.duration_hrs) for r in got]

    first, second = plan_dates(2025, 1, 1) + plan_dates(2025, 1, 2), [dt.date(2025, 1, d) for d in (2, 3, 4, 5)]
    assert run(first).done == first
    assert voyages() == [("9", "NLAAA", "NLBBB", 24.0)]
    report = run(second)  # one day of them again, one without a file
    assert report.done == second[:3] and report.absent == second[3:]
    assert voyages() == [("9", "NLAAA", "NLBBB", 24.0), ("9", "NLBBB", "NLAAA", 48.0)]
