import datetime as dt
import html
import json
import math

import pytest
from pyspark.sql import functions as F

from quayside.functions import geo, text, time
from quayside.operators import routes


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def lits(*values):
    return [F.lit(v) for v in values]


def test_angles_go_both_ways(spark):
    df = spark.createDataFrame([(0.0, 0.0), (90.0, 180.0), (180.0, 360.0)], "latitude double, longitude double")
    lat, lon = geo.to_radians(F.col("latitude"), F.col("longitude"))
    back = geo.to_degrees(lat, lon)
    for row in df.select("*", lat.alias("a"), lon.alias("b"), back[0].alias("c"), back[1].alias("d")).collect():
        assert row.a == math.radians(row.latitude) and row.b == math.radians(row.longitude)
        assert row.c == pytest.approx(row.latitude) and row.d == pytest.approx(row.longitude)


def test_haversine(spark):
    far = one(spark, geo.haversine_km(*lits(40.7128, -74.0060, 51.5074, -0.1278)).alias("km")).km
    assert 5500 < far < 5650
    assert one(spark, geo.haversine_km(*lits(0.0, 0.0, 0.0, 0.0)).alias("km")).km == 0.0
    antipodes = one(spark, geo.haversine_km(*lits(20.3, -77.7, -20.3, 102.3)).alias("km")).km
    assert antipodes == pytest.approx(math.pi * 6371, abs=0.1)


def test_planar_is_not_shrunk_by_latitude(spark):
    row = one(spark, geo.planar_km(*lits(60.0, 0.0, 60.0, 1.0)).alias("a"), geo.planar_km(*lits(0.0, 0.0, 0.0, 1.0)).alias("b"))
    assert row.a == row.b == pytest.approx(6371 * math.pi / 180)


@pytest.mark.parametrize("nm,speed,hours", [(100.0, 10.0, 10.0), (0.0, 10.0, None), (None, 10.0, None), (123.45, 12.5, 9.88)])
def test_expected_hours(spark, nm, speed, hours):
    assert one(spark, geo.expected_hours(F.lit(nm).cast("double"), speed).alias("h")).h == hours


def test_line_and_path(spark):
    line = geo.line_string((F.lit(29.88), F.lit(-89.96)), (F.lit(29.86), F.lit(-89.92)))
    row = one(spark, line.alias("line"), geo.is_path(line).alias("ok"), routes.geometry_text(line).alias("text"))
    assert row.line.coordinates == [[-89.96, 29.88], [-89.92, 29.86]] and row.ok
    assert json.loads(row.text) == {"type": "LineString", "coordinates": [[-89.96, 29.88], [-89.92, 29.86]]}


@pytest.mark.parametrize("n,kept", [(30, 30), (31, 16), (32, 17), (100, 51), (101, 35), (102, 35)])
def test_downsample(spark, n, kept):
    points = spark.range(1).select(F.sequence(F.lit(1), F.lit(n)).alias("p"))
    got = points.select(geo.downsample_path(F.col("p")).alias("p")).first().p
    assert len(got) == kept and got[0] == 1 and got[-1] == n


def test_route_feature(spark):
    schema = "route struct<geometry: struct<type: string, coordinates: array<array<double>>>, properties: struct<length: double>>"
    rows = [
        (((("LineString", [[0.0, 0.0], [1.0, 1.0]])), (123.45,)),),
        ((None, (None,)),),
        (None,),
    ]
    got = spark.createDataFrame(rows, schema).select(
        routes.route_length(F.col("route")).alias("nm"), routes.route_path(F.col("route")).alias("path")
    ).collect()
    assert [r.nm for r in got] == [123.45, 0.0, None]
    assert json.loads(got[0].path)["coordinates"] == [[0.0, 0.0], [1.0, 1.0]]
    assert got[1].path == "null" and got[2].path is None


@pytest.mark.parametrize("raw,clean", [
    ("IMO9123456", "9123456"), ("9123456", "9123456"), ("imo9", "imo9"), ("IMO", ""), ("IMOIMO9", "IMO9"), (None, None),
])
def test_imo(spark, raw, clean):
    assert one(spark, text.strip_imo_prefix(F.lit(raw).cast("string")).alias("x")).x == clean


@pytest.mark.parametrize("raw,degrees", [
    ("5157N", 51.95), ("00408E", 4 + 8 / 60), ("3344S", -(33 + 44 / 60)), ("05830W", -58.5), ("5157X", 51.95),
    ("5157", None), ("", None), (None, None), ("5x57N", None), ("51 7N", 51 + 7 / 60), ("515dN", None),
])
def test_unece_coord(spark, raw, degrees):
    got = one(spark, text.unece_coord(F.lit(raw).cast("string")).alias("x")).x
    assert got == (degrees if degrees is None else pytest.approx(degrees))


@pytest.mark.parametrize("raw,both", [("5157N 00408E", True), ("5157N", False), ("5157N  00408E", False), ("", False)])
def test_coordinate_pair(spark, raw, both):
    lat, lon = text.coordinate_pair(F.lit(raw))
    row = one(spark, lat.alias("lat"), lon.alias("lon"))
    assert (row.lat is not None and row.lon is not None) == both


@pytest.mark.parametrize("country,raw,code", [("NL", "RTM", "NLRTM"), ("AR", " AR  bla ", "ARBLA"), ("NL", "ab", "AB")])
def test_locode(spark, country, raw, code):
    assert one(spark, text.locode(F.lit(country), text.bare_code(F.lit(raw))).alias("x")).x == code


@pytest.mark.parametrize("code,ok", [("NL", True), ("A1", True), ("11", False), ("nl", False), ("Nl", False), ("NLD", False)])
def test_country_code(spark, code, ok):
    assert one(spark, text.is_country_code(F.lit(code)).alias("x")).x is ok


def test_route_key(spark):
    none = F.lit(None).cast("string")
    row = one(spark, text.route_key(F.lit("USCHL"), F.lit("USMXP")).alias("a"), text.route_key(none, F.lit("USMXP")).alias("b"))
    assert (row.a, row.b) == ("route_USCHL_USMXP", "route_UNK_USMXP")


@pytest.mark.parametrize("raw,plain", [
    ("a &amp; b", "a & b"), ("&Aring;rhus", "Århus"), ("&#197;&#xC5;x", "ÅÅx"), ("&nope; & &", "&nope; & &"),
    ("&nbsp;x", " x"), ("plain", "plain"), ("&#8364;", "€"),
])
def test_unescape(spark, raw, plain):
    df = spark.createDataFrame([(raw,)], "t string")
    assert df.select(text.unescape_html(F.col("t")).alias("x")).first().x == plain


def test_unescape_like_the_standard(spark):
    """With and without semicolons, against the standard library, which follows HTML 5."""
    raws = ["a&nbsp b", "&amp&lt;&gt", "&notit; &notin; &not", "x&copy2024", "&ampamp;", "&AMPx;", "&#197 &#xC5g &#65a", "&eacute,&Eacutex", "&&amp", "&unknown x", "&hellip x", "&#;&#x;", "a=1&lang=en&para=2"]
    df = spark.createDataFrame([(raw,) for raw in raws], "t string")
    got = {r.t: r.x for r in df.select("t", text.unescape_html(F.col("t")).alias("x")).collect()}
    assert got == {raw: html.unescape(raw) for raw in raws}


def test_html_text(spark):
    df = spark.createDataFrame([("&nbsp; <b>New&nbsp;York</b> <!-- x --> , <i> NY </i>",)], "t string")
    assert df.select(text.html_text(F.col("t")).alias("x")).first().x == "New York,NY"


@pytest.mark.parametrize("raw,parsed", [
    ("2025-01-01 10:00:00", dt.datetime(2025, 1, 1, 10)), ("2025-01-01T10:00:00Z", dt.datetime(2025, 1, 1, 10)),
    ("2025-01-01T10:00:00.250", dt.datetime(2025, 1, 1, 10, 0, 0, 250000)), ("bad", None), ("", None),
    ("2025-01-01T10:00:00+02:00", dt.datetime(2025, 1, 1, 8)), ("10:00:00", None), ("T10:00", None), ("2025", None), ("2025-01", None),
])
def test_parse_time(spark, raw, parsed):
    assert one(spark, time.parse_time(F.lit(raw)).alias("t")).t == parsed


def test_durations(spark):
    start = F.lit("2025-01-01 10:00:00").cast("timestamp_ntz")
    end = F.lit("2025-01-01 20:00:00.9").cast("timestamp_ntz")
    row = one(spark, time.duration_hours(start, end).alias("a"), time.time_difference_hours(start, end).alias("b"),
              time.age_days(start, F.lit("2026-01-01 09:59:59").cast("timestamp_ntz")).alias("c"))
    assert row.a == pytest.approx(10 + 0.9 / 3600) and row.b == -10.0 and row.c == 364


def test_time_slices_follow_time(spark):
    rows = [(dt.datetime(1969, 12, 31, 23, 59),), (dt.datetime(1970, 1, 1),), (dt.datetime(2024, 3, 10, 2, 30),), (dt.datetime(2024, 3, 10, 3, 1),)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    got = [r.s for r in df.select(time.time_slice(F.col("t"), 60).alias("s")).collect()]
    assert got[:2] == [-1, 0] and got[3] == got[2] + 1
