"""Registered queries against their SQL on the smallest test tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from quayside.checks.oracles import ORACLES
from quayside.checks.queries import REGISTERED
from tools.check_oracles import rows_of

FOLDER = "/root/testdata/sf0.001"
# The rest is covered by the unit tests, and in full by tools/check_oracles.py.
CHECKED = [
    "nearest_port_pings", "nearest_port_haversine", "stg_ais", "voyage_legs", "voyage_legs_thinned", "voyage_duration",
    "voyages_great_circle", "route_lookup", "overview_totals", "recent_voyages", "incremental_lookback",
    "unece_coords", "port_filter", "country_codes", "staleness", "html_list_rows", "html_table_rows", "run_history",
    "run_results_flatten", "date_range", "time_parsing", "csv_ingest",
]


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for file in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"create view {os.path.basename(file)[:-8]} as select * from '{file}'")
    return con


def test_every_query_has_an_oracle():
    assert {query.__name__ for query in REGISTERED} == set(ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(CHECKED) <= set(entry.queries())


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_oracle(spark, con, name):
    frame = entry.queries()[name](spark, FOLDER)
    want = con.execute(entry.oracle_sql()[name]).fetchall()
    columns = [c[0] for c in con.description]
    assert sorted(frame.columns) == sorted(columns)
    assert rows_of(frame.columns, frame.collect()) == rows_of(columns, want)


def test_entry(spark):
    row = entry.entry(spark).first()
    assert row.voyages > 0 and row.vessels > 0
