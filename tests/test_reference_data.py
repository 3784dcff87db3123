import datetime as dt

import pytest

from quayside import config, schemas
from quayside.config import Tables
from quayside.plans import reference_data as ref
from tests.test_sources import TABLE, port_row

NOW = dt.datetime(2025, 3, 10, 12)


def countries(spark, *ages):
    return spark.createDataFrame([("NL", NOW - dt.timedelta(days=a)) for a in ages], schemas.COUNTRIES)


@pytest.mark.parametrize("ages,limit,stale", [
    ((365,), 365, False), ((366,), 365, True), ((180,), 180, False), ((181,), 180, True), ((400, 10), 365, False), ((), 365, True),
])
def test_staleness(spark, ages, limit, stale):
    assert ref.is_stale(countries(spark, *ages), limit, NOW) is stale


def test_no_table_is_stale():
    assert ref.is_stale(None, 365, NOW)


def port_frame(spark, codes, age=None):
    rows = [(c, c, 1.0, 2.0) for c in codes]
    df = spark.createDataFrame(rows, "locode string, name string, lat double, lon double")
    return df if age is None else ref._stamped(df, NOW - dt.timedelta(days=age))


@pytest.mark.parametrize("age,new,always,expected", [
    (10, ["N"], False, "O"),
    (181, ["N"], False, "N"),
    (181, [], False, "O"),
    (None, ["N"], False, "N"),
    (None, [], False, "fallback"),
    (181, ["N"], True, "both"),
])
def test_refresh(spark, age, new, always, expected):
    current = None if age is None else port_frame(spark, ["O"], age)
    fallback = ref.fallback_ports(spark, NOW)
    chosen = ref.refresh_if_stale(current, port_frame(spark, new), config.PORTS_MAX_AGE_DAYS, NOW, fallback, always)
    codes = sorted(r.locode for r in chosen.collect())
    hubs = sorted(p[0] for p in ref.FALLBACK_PORTS)
    assert codes == {"fallback": hubs, "both": sorted(hubs + ["N"])}.get(expected, [expected])


def test_tables_are_built_and_kept(spark, tmp_path):
    tables = Tables(str(tmp_path))
    codes = spark.createDataFrame([(1, TABLE)], "page_id bigint, html string")
    assert sorted(r.code for r in ref.ensure_countries(spark, tables, codes, NOW).collect()) == ["A1", "BE", "NL"]
    # Later, but not stale; and stale with a page that lost its heading: the table stays.
    assert ref.ensure_countries(spark, tables, codes.limit(0), NOW + dt.timedelta(days=300)).count() == 3
    assert ref.ensure_countries(spark, tables, codes.limit(0), NOW + dt.timedelta(days=400)).count() == 3

    head = "<tr><td>head</td></tr>" * 10
    page = "<table>" + head + "".join(f"<tr>{''.join(f'<td>{c}</td>' for c in port_row(code))}</tr>" for code in ("RTM", "AMS")) + "</table>"
    pages = spark.createDataFrame([("NL", page), ("QQ", page)], "iso string, html string")
    ports = ref.ensure_ports(spark, tables, pages, NOW)
    assert sorted(r.locode for r in ports.collect()) == ["NLAMS", "NLRTM"]
    assert ports.schema == schemas.PORTS
    kept = ref.ensure_ports(spark, tables, pages.limit(0), NOW + dt.timedelta(days=200))
    assert sorted(r.locode for r in kept.collect()) == ["NLAMS", "NLRTM"]


def test_hubs_when_there_is_nothing(spark, tmp_path):
    pages = spark.createDataFrame([], "iso string, html string")
    assert ref.ensure_ports(spark, Tables(str(tmp_path)), pages, NOW).count() == len(ref.FALLBACK_PORTS)


def test_a_crash_while_storing_leaves_the_old_table(spark, tmp_path, monkeypatch):
    from quayside.sources import tables as module

    path = str(tmp_path / "ports")
    module.publish_version(port_frame(spark, ["OLD"], 1), path)

    def fail(*_):
        raise RuntimeError("power cut")

    monkeypatch.setattr(module, "append_table", fail)
    with pytest.raises(RuntimeError):
        module.publish_version(port_frame(spark, ["NEW"], 0), path)
    assert [r.locode for r in module.read_version(spark, path).collect()] == ["OLD"]
    monkeypatch.undo()
    # A new version may be made from the old one, which running readers can still finish.
    old = module.read_version(spark, path)
    module.publish_version(old.unionByName(port_frame(spark, ["NEW"], 0)), path)
    assert sorted(r.locode for r in module.read_version(spark, path).collect()) == ["NEW", "OLD"]
    assert old.count() == 1
    module.publish_version(port_frame(spark, ["LAST"], 0), path)
    assert [r.locode for r in module.read_version(spark, path).collect()] == ["LAST"]
    assert len(list((tmp_path / "ports").glob("v-*"))) == 3  # the last two, and what the crash left
