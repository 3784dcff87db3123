"""The registered queries: every operator, run over whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import config, samples, schemas
from quayside.functions import geo, text, time
from quayside.operators import quality, routes, stitch, upsert
from quayside.operators.nearest import nearest_port
from quayside.plans import reference_data, reports, voyages
from quayside.plans.ingest import ingest_days
from quayside.sources import locodes, pings as ping_files, runlog
from quayside.sources.html import html_rows
from quayside.sources.tables import read_table
from quayside.streaming.ingest import stream_ingest
from quayside.streaming.voyages import match_stream, stream_legs, stream_stitch

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the queries; the oracle texts use the same values.
VESSEL = "200000100"
AS_OF = date(2024, 1, 31)
LAST_DAYS = 7
NOW = datetime(2002, 1, 1, 12, 0, 0)
BATCH_STARTS = ["2024-01-07", "2024-01-13", "2024-01-19", "2024-01-25"]
LAST_LOAD = "2024-01-25"
LATE_DAY = "2024-01-10"


def _work(spark: SparkSession, name: str) -> str:
    return f"{config.shared_folder(spark)}/{name}-{uuid4().hex}"


def _legs(spark: SparkSession, folder: str, **limits) -> DataFrame:
    return stitch.voyage_legs(samples.staged(spark, folder), **limits)


def _voyages(spark: SparkSession, folder: str) -> DataFrame:
    return routes.enrich_routes(_legs(spark, folder))


# --- matching and stitching --------------------------------------------------


def nearest_port_pings(spark: SparkSession, folder: str) -> DataFrame:
    return samples.raw_pings(spark, folder).select(
        "mmsi", "imo", "vessel_name", "latitude", "longitude", "dep_time", "port_locode",
        F.round("dist_km", 6).alias("dist_km"),
    )


def nearest_port_haversine(spark: SparkSession, folder: str) -> DataFrame:
    matched = nearest_port(samples.pings(spark, folder), samples.ports(spark, folder), metric="haversine")
    return matched.select("event_id", "port_locode", F.round("dist_km", 6).alias("dist_km"))


def nearest_port_shuffled(spark: SparkSession, folder: str) -> DataFrame:
    """The same match with the ports too big to broadcast."""
    matched = nearest_port(samples.pings(spark, folder), samples.ports(spark, folder), broadcast_max_rows=0)
    return matched.select("event_id", "port_locode", F.round("dist_km", 6).alias("dist_km"))


def stg_ais(spark: SparkSession, folder: str) -> DataFrame:
    return samples.staged(spark, folder)


def port_visits(spark: SparkSession, folder: str) -> DataFrame:
    return stitch.port_visits(samples.staged(spark, folder))


def voyage_legs(spark: SparkSession, folder: str) -> DataFrame:
    return _legs(spark, folder)


def voyage_legs_thinned(spark: SparkSession, folder: str) -> DataFrame:
    """The same legs from slices of a day and pings that are all reported twice."""
    staged = samples.staged(spark, folder)
    return stitch.voyage_legs(staged.unionByName(staged), slice_minutes=1440)


def port_visits_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Visits when every fifth ping has lost its port and every seventh is reported three times."""
    n = F.unix_micros(F.col("dep_time").cast("timestamp")) + F.col("mmsi")
    staged = samples.staged(spark, folder).withColumn("port_locode", F.when(n % 5 != 0, F.col("port_locode")))
    again = staged.where(n % 7 == 0)
    return stitch.port_visits(staged.unionByName(again).unionByName(again))


# --- distance, duration, routes ----------------------------------------------


def voyage_duration(spark: SparkSession, folder: str) -> DataFrame:
    legs = _legs(spark, folder)
    start, end = F.col("dep_time"), F.col("arr_time")
    return legs.select(
        "mmsi", "dep_time",
        time.duration_hours(start, end).alias("duration_hrs"),
        time.time_difference_hours(start, end).alias("difference_hrs"),
    )


def voyage_distance(spark: SparkSession, folder: str) -> DataFrame:
    legs = _legs(spark, folder)
    ends = [F.col(c) for c in ("dep_lat", "dep_lon", "arr_lat", "arr_lon")]
    km = geo.haversine_km(*ends)
    return legs.select(
        "mmsi", "dep_time",
        F.round(km, 3).alias("haversine_km"),
        F.round(geo.km_to_nm(km), 3).alias("distance_nm"),
        F.round(geo.planar_km(*ends), 3).alias("planar_km"),
    )


def angle_conversion(spark: SparkSession, folder: str) -> DataFrame:
    lat_rad, lon_rad = geo.to_radians(F.col("latitude"), F.col("longitude"))
    lat_deg, lon_deg = geo.to_degrees(lat_rad, lon_rad)
    return samples.pings(spark, folder).select(
        "event_id",
        F.round(lat_rad, 12).alias("lat_rad"), F.round(lon_rad, 12).alias("lon_rad"),
        geo.round_coordinate(lat_deg).alias("lat_deg"), geo.round_coordinate(lon_deg).alias("lon_deg"),
    )


def expected_duration(spark: SparkSession, folder: str) -> DataFrame:
    legs = _legs(spark, folder)
    ends = [F.col(c) for c in ("dep_lat", "dep_lon", "arr_lat", "arr_lon")]
    return legs.select(
        "mmsi", "dep_time",
        geo.expected_hours(F.round(geo.km_to_nm(geo.haversine_km(*ends)), 3)).alias("expected_hrs"),
    )


def voyages_zero_policy(spark: SparkSession, folder: str) -> DataFrame:
    """Voyages when no route can be found: no geometry, distance 0."""
    return routes.enrich_routes(_legs(spark, folder), on_missing="zero")


def voyages_great_circle(spark: SparkSession, folder: str) -> DataFrame:
    """Voyages with the straight line as route."""
    return _voyages(spark, folder).withColumn("distance_nm", F.round("distance_nm", 3))


def route_key_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return routes.route_pairs(_legs(spark, folder)).select("route_key", "dep_locode", "arr_locode", "legs")


def _dogleg(dep_lon: float, dep_lat: float, arr_lon: float, arr_lat: float):
    """A stand-in for a sea router: along the parallel, then along the meridian, 60 nm a degree."""
    if arr_lon < dep_lon:
        raise ValueError("only eastward routes are known")
    path = [[dep_lon, dep_lat], [arr_lon, dep_lat], [arr_lon, arr_lat]]
    return path, 60.0 * (abs(arr_lon - dep_lon) + abs(arr_lat - dep_lat))


def route_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Routes found once per port pair by a finder, joined to the legs; the rest go straight."""
    legs = _legs(spark, folder)
    work = _work(spark, "routes")
    routes.find_routes(routes.route_pairs(legs), _dogleg).write.parquet(work)
    found = spark.read.schema(schemas.ROUTES).parquet(work)
    return routes.enrich_routes(legs, found).select(
        "mmsi", "dep_time", "arr_time", F.round("distance_nm", 3).alias("distance_nm"),
        F.size(F.from_json("route_geometry", schemas.GEOMETRY)["coordinates"]).alias("points"),
    )


def route_positions(spark: SparkSession, folder: str) -> DataFrame:
    """Each leg's own route, zero where there is none: some ends have no route, some a route of one point."""

    def finder(dep_lon, dep_lat, arr_lon, arr_lat):
        kind = int(abs(dep_lat)) % 3
        if kind == 0:
            raise ValueError("no route from here")
        return ([[dep_lon, dep_lat]] if kind == 1 else [[dep_lon, dep_lat], [arr_lon, dep_lat], [arr_lon, arr_lat]]), abs(arr_lon - dep_lon)

    legs, work = _legs(spark, folder), _work(spark, "routes")
    routes.find_routes(routes.route_pairs(legs, "positions"), finder).write.parquet(work)
    found = spark.read.schema(schemas.ROUTES).parquet(work)
    return routes.enrich_routes(legs, found, on_missing="zero", by="positions").select(
        "mmsi", "dep_time", "arr_time", F.round("distance_nm", 6).alias("distance_nm"),
        F.size(F.from_json("route_geometry", schemas.GEOMETRY)["coordinates"]).alias("points"),
    )


def route_geojson(spark: SparkSession, folder: str) -> DataFrame:
    """Geometry text read back: type, and both ends in (lon, lat) order."""
    line = F.from_json("route_geometry", schemas.GEOMETRY)
    at = line["coordinates"]
    return _voyages(spark, folder).select(
        "mmsi", "dep_time",
        line["type"].alias("line_type"), F.size(at).alias("points"),
        at[0][0].alias("from_lon"), at[0][1].alias("from_lat"),
        at[1][0].alias("to_lon"), at[1][1].alias("to_lat"),
    )


def path_downsample(spark: SparkSession, folder: str) -> DataFrame:
    """Paths of 1 to 150 points, thinned by length."""
    path = F.sequence(F.lit(0).cast("bigint"), F.col("event_id") % 150)
    paths = samples.table(spark, folder, "events").select("event_id", path.alias("path"))
    kept = paths.select("event_id", geo.downsample_path(F.col("path")).alias("kept"))
    return kept.select(
        "event_id", F.size("kept").alias("points"),
        F.aggregate("kept", F.lit(0).cast("bigint"), lambda total, i: total + i).alias("index_sum"),
    )


# --- reports -----------------------------------------------------------------


def overview_totals(spark: SparkSession, folder: str) -> DataFrame:
    return reports.totals(_voyages(spark, folder)).withColumn("total_distance", F.round("total_distance", 2))


def recent_voyages(spark: SparkSession, folder: str) -> DataFrame:
    return reports.recent(_voyages(spark, folder)).withColumn("distance_nm", F.round("distance_nm", 3))


def vessel_stats(spark: SparkSession, folder: str) -> DataFrame:
    return reports.vessel_stats(_voyages(spark, folder), VESSEL).withColumn("total_nm", F.round("total_nm", 3))


def vessel_history(spark: SparkSession, folder: str) -> DataFrame:
    return reports.vessel_history(_voyages(spark, folder), VESSEL)


def vessel_page(spark: SparkSession, folder: str) -> DataFrame:
    """A page's own SQL with a named parameter."""
    sql = "select vessel_name, count(*) as total_trips from {voyages} where mmsi = try_cast(:mmsi as bigint) group by all"
    return reports.page_query(_voyages(spark, folder), sql, mmsi=VESSEL)


def voyages_last_n_days(spark: SparkSession, folder: str) -> DataFrame:
    report = reports.last_days(_voyages(spark, folder), LAST_DAYS, AS_OF)
    return report.withColumn("distance_nm", F.round("distance_nm", 3))


# --- incremental -------------------------------------------------------------


def _loaded_before(staged: DataFrame) -> DataFrame:
    return staged.where(F.col("dep_time") < F.lit(LAST_LOAD).cast("timestamp_ntz"))


def incremental_lookback(spark: SparkSession, folder: str) -> DataFrame:
    """Legs a run with the 14-day look-back adds to a table loaded up to a date."""
    staged = samples.staged(spark, folder)
    target = stitch.voyage_legs(_loaded_before(staged))
    return stitch.voyage_legs(voyages.lookback_input(staged, target))


def incremental_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """The table after that run, put in by key into stored partitions."""
    staged = samples.staged(spark, folder)
    path = _work(spark, "voyages")
    loaded = voyages.with_partition(stitch.voyage_legs(_loaded_before(staged)))
    upsert.upsert(path, loaded, schemas.VOYAGE_KEY, voyages.PARTITION)
    target = read_table(spark, path)
    batch = voyages.with_partition(stitch.voyage_legs(voyages.lookback_input(staged, target)))
    upsert.upsert(path, batch, schemas.VOYAGE_KEY, voyages.PARTITION)
    return spark.read.parquet(path).select(*schemas.LEGS.names)


def incremental_carry(spark: SparkSession, folder: str) -> DataFrame:
    """Five batches in a row, each stitched with the visits the one before left open."""
    staged = samples.staged(spark, folder)
    bounds = [None, *BATCH_STARTS, None]
    batches = []
    for first, last in zip(bounds, bounds[1:]):
        batch = staged
        if first is not None:
            batch = batch.where(F.col("dep_time") >= F.lit(first).cast("timestamp_ntz"))
        if last is not None:
            batch = batch.where(F.col("dep_time") < F.lit(last).cast("timestamp_ntz"))
        batches.append(batch)
    return voyages.carry_batches(batches)


def _store_day_files(pings: DataFrame, tables: config.Tables) -> None:
    ping_files.append_pings(pings.withColumn("dt", F.to_date("dep_time")), tables.raw_pings)


def _day(text: str) -> Column:
    return F.to_date("dep_time") == F.lit(text).cast("date")


def incremental_late(spark: SparkSession, folder: str) -> DataFrame:
    """The voyages job: pings of a day that are late for every fifth vessel come together with newer days."""
    tables, pings = config.Tables(_work(spark, "late")), samples.raw_pings(spark, folder)
    before, is_late = F.col("dep_time") < F.lit(LAST_LOAD).cast("timestamp_ntz"), _day(LATE_DAY) & (F.col("mmsi") % 5 == 0)
    _store_day_files(pings.where(before & ~is_late), tables)
    voyages.build_voyages(spark, tables)
    late = pings.where(_day(LATE_DAY) | ~before)
    days = [row["dt"] for row in late.select(F.to_date("dep_time").alias("dt")).distinct().toLocalIterator()]
    _store_day_files(late, tables)
    voyages.build_voyages(spark, tables, days=days)
    return spark.read.parquet(tables.voyages).select(*schemas.LEGS.names)


def incremental_replaced_day(spark: SparkSession, folder: str) -> DataFrame:
    """The voyages job after a stored day was replaced by one without a third of its vessels."""
    tables, pings = config.Tables(_work(spark, "replaced")), samples.raw_pings(spark, folder)
    pings = pings.where(F.col("dep_time") < F.lit(LAST_LOAD).cast("timestamp_ntz"))
    _store_day_files(pings, tables)
    voyages.build_voyages(spark, tables)
    _store_day_files(pings.where(_day(LATE_DAY) & (F.col("mmsi") % 3 != 0)), tables)
    voyages.build_voyages(spark, tables, days=[date.fromisoformat(LATE_DAY)])
    return spark.read.parquet(tables.voyages).select(*schemas.LEGS.names)


def dq_positive_duration(spark: SparkSession, folder: str) -> DataFrame:
    """Failing rows of the duration check over all linked visits, bad ones included.

    Every third visit is given its arrival as departure, so that the check has rows to find.
    """
    linked = stitch.link_visits(samples.staged(spark, folder)).where("not is_open")
    hours = time.duration_hours(F.col("dep_time"), F.col("arr_time"))
    shifted = linked.withColumn("duration_hrs", F.when(F.col("mmsi") % 3 == 0, -hours).otherwise(hours))
    failing = quality.failing_rows(shifted, quality.non_positive_duration())
    return failing.select("mmsi", "dep_time", "arr_time", "duration_hrs")


def dq_stored_voyages(spark: SparkSession, folder: str) -> DataFrame:
    """Voyages before and after the rule applied when they are stored, some with zero, negative or unknown duration."""
    n = F.col("mmsi") % 7
    hours = F.when(n == 0, 0.0).when(n == 1, -F.col("duration_hrs")).when(n != 2, F.col("duration_hrs"))
    given = _voyages(spark, folder).withColumn("duration_hrs", hours)
    kept = quality.drop_non_positive(given).groupBy("vessel_name").agg(
        F.count("*").alias("kept"), F.count_if(quality.non_positive_duration()).alias("failing_after")
    )
    before = given.groupBy("vessel_name").agg(
        F.count("*").alias("voyages"), F.count_if(quality.non_positive_duration()).alias("failing")
    )
    return before.join(kept, "vessel_name", "left").fillna(0, ["kept", "failing_after"])


# --- reference data ----------------------------------------------------------


def _places(rows: DataFrame) -> DataFrame:
    """Coordinate text ``place`` made from the number ``n`` of each row, well formed and not."""

    def digits(value, width):
        return F.lpad(value.cast("string"), width, "0")

    n, north, east = F.col("n"), F.col("north"), F.col("east")
    ends = rows.select(
        "*",
        F.concat(digits(n % 90, 2), digits(n % 60, 2), F.when(n % 2 == 0, "N").otherwise("S")).alias("north"),
        F.concat(digits(n % 180, 3), digits((n * 7) % 60, 2), F.when(n % 3 == 0, "E").otherwise("W")).alias("east"),
    )
    place = (
        F.when(n % 11 == 0, F.lit(""))
        .when(n % 11 == 1, north)
        .when(n % 11 == 2, F.concat(north, F.lit("  "), east))
        .when(n % 11 == 3, F.concat(F.lit("x"), F.substring(north, 2, 4), F.lit(" "), east))
        .when(n % 11 == 4, F.concat(F.lit("12N "), east))
        .otherwise(F.concat(north, F.lit(" "), east))
    )
    return ends.withColumn("place", place).drop("north", "east")


def unece_coords(spark: SparkSession, folder: str) -> DataFrame:
    """Coordinate text made from event numbers, read back."""
    places = _places(samples.table(spark, folder, "events").select(F.col("event_id").alias("n")))
    lat, lon = text.coordinate_pair(F.col("place"))
    return places.select(F.col("n").alias("event_id"), "place", F.round(lat, 9).alias("lat"), F.round(lon, 9).alias("lon"))


def _port_cells(n: Column) -> Column:
    """Cells of a code-list row made from a number, beside the column ``place``."""
    status = F.element_at(F.array(*[F.lit(c) for c in ("AI", "RL", "XX", "QQ")]), (n % 4 + 1).cast("int"))
    number = F.lpad((n % 1000).cast("string"), 3, "0")
    blank = F.lit("")
    return F.array(
        blank,
        F.when(n % 7 == 0, F.lit("ab")).when(n % 7 == 1, F.concat(F.lit("xy "), number)).otherwise(
            F.concat(F.lit(" \u00a0"), number)
        ),
        F.concat(F.lit("Port "), n.cast("string")),
        blank,
        blank,
        F.when(n % 5 == 0, "--3-----").otherwise("1-3-----"),
        F.concat(F.lit("\u00a0"), status),
        F.lit("0401"),
        blank,
        F.concat("place", F.lit(" ")),
    )


def port_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Raw code-list rows made from orders, reduced to usable sea ports."""
    n, cells = F.col("n"), _port_cells(F.col("n"))
    raw = _places(samples.table(spark, folder, "orders").select(F.col("o_orderkey").alias("n"))).select(
        F.concat(F.char(65 + n % 26), F.char(65 + (n * 3) % 26)).alias("iso"),
        # As on real pages, rows come out of an explode; no filter is pushed into the making of text.
        F.explode(F.array(F.slice(cells, 1, F.when(n % 13 == 0, 9).otherwise(10)))).alias("cells"),
    )
    return locodes.normalize_ports(raw).select(
        "locode", "name", F.round("lat", 9).alias("lat"), F.round("lon", 9).alias("lon")
    )


def country_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Codes made from orders, right and wrong ones; the first line of every tenth list is a heading."""
    n = F.col("o_orderkey")
    two = F.concat(F.char(65 + n % 26), F.char(65 + (n * 5) % 26))
    code = F.when(n % 4 == 0, F.lower(two)).when(n % 4 == 1, F.concat(two, F.lit("X"))).when(
        n % 4 == 2, F.concat(F.substring(two, 1, 1), F.lit("1"))
    ).otherwise(two)
    rows = samples.table(spark, folder, "orders").select((n % 10).alias("row_no"), F.array(code, F.lit("name")).alias("cells"))
    return locodes.country_codes(rows)


def staleness(spark: SparkSession, folder: str) -> DataFrame:
    """Age of the newest order against both limits."""
    current = samples.table(spark, folder, "orders").select(F.col("o_orderdate").cast("timestamp_ntz").alias("updated_at"))
    parts = [
        reference_data.staleness(current, days, NOW).withColumn("max_age_days", F.lit(days))
        for days in (config.COUNTRIES_MAX_AGE_DAYS, config.PORTS_MAX_AGE_DAYS)
    ]
    return parts[0].unionByName(parts[1])


def _code_list_pages(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Stored pages: port lists by country, made from suppliers, and the list of country codes, made from nations."""
    n = F.col("n")
    two = lambda key: F.concat(F.char(65 + key % 26), F.char(65 + (key * 3) % 26))
    tagged = lambda cells, tag: F.concat(F.lit("<tr>"), F.concat_ws("", F.transform(cells, lambda c: F.concat(F.lit(f"<{tag}>"), c, F.lit(f"</{tag}>")))), F.lit("</tr>"))
    rows = _places(samples.table(spark, folder, "supplier").select(F.col("s_suppkey").alias("n"), "s_nationkey"))
    rows = rows.select(two(F.col("s_nationkey")).alias("iso"), F.floor(n / 100).alias("page"), F.struct(n, tagged(_port_cells(n), "td").alias("row")).alias("r"))
    head = "<table>" + "<tr><td>about this list</td></tr>" * locodes.HEADER_ROWS
    listed = rows.groupBy("iso", "page").agg(F.array_sort(F.collect_list("r")).alias("rows"))
    ports = listed.select("iso", F.concat(F.lit(head), F.concat_ws("", "rows.row"), F.lit("</table>")).alias("html"))
    # Every fourth nation is on no list of countries.
    known = samples.table(spark, folder, "nation").where("n_nationkey % 4 <> 3").select(tagged(F.array(two(F.col("n_nationkey")), "n_name"), "td").alias("row"))
    listed = known.agg(F.concat_ws("", F.array_sort(F.collect_list("row"))).alias("rows"))
    opening = F.lit('<h2 id="Current_codes">Codes</h2><table><tr><th>Code</th><th>Name</th></tr>')
    return ports, listed.select(F.concat(opening, "rows", F.lit("</table>")).alias("html"))


def reference_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Stored countries and ports through their life: first build, still fresh, stale with new pages, stale without, and hubs where there never were pages."""
    tables, other = config.Tables(_work(spark, "reference")), config.Tables(_work(spark, "reference"))
    port_pages, country_pages = _code_list_pages(spark, folder)
    reference_data.ensure_countries(spark, tables, country_pages, NOW)
    some, none = port_pages.where(F.col("iso") < "M"), port_pages.where(F.lit(False))
    steps = [("built", tables, port_pages, 0), ("fresh", tables, some, 180), ("renewed", tables, some, 181), ("kept", tables, none, 400), ("hubs", other, none, 0)]
    parts = []
    for name, at, pages, days in steps:
        ports = reference_data.ensure_ports(spark, at, pages, NOW + timedelta(days=days))
        # Written, since a later step may replace what an earlier one read.
        ports.withColumn("step", F.lit(name)).write.parquet(f"{at.root}/steps/{name}")
        parts.append(spark.read.parquet(f"{at.root}/steps/{name}"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("step", "locode", "name", F.round("lat", 9).alias("lat"), F.round("lon", 9).alias("lon"), "updated_at")


def html_list_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and cells of the pages. They hold lists, not tables: items as rows, links as cells."""
    rows = html_rows(samples.table(spark, folder, "pages"), "li", ("a",))
    return rows.select("page_id", "row_no", F.size("cells").alias("cells"), F.array_join("cells", "|").alias("cell_text"))


def html_table_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and cells of tables made from the pages: one inside a cell of another, end tags and semicolons of references left out as in old pages."""
    digit, number = (F.col("page_id") % 7).cast("string"), F.col("page_id").cast("string")
    url = F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    parts = [
        "<TABLE class=list><tr><th>Page&#32;", number, "</th><th> Fish &amp chips&nbsp</th></tr><!-- <tr><td>no</td></tr> --><tr id=outer><td>", url,
        "<table><tr><td>", digit, "&eacute</td><td><b>in</b></table>tail</td><td>&nbsp", number, "<td>last</tr><tr><td>x&notit;</table><p>text</p>",
    ]
    made = samples.table(spark, folder, "pages").withColumn("html", F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]))
    return html_rows(made).select("page_id", "row_no", F.size("cells").alias("cells"), F.array_join("cells", "|").alias("cell_text"))


# --- run log -----------------------------------------------------------------


def _run_log(spark: SparkSession, folder: str) -> DataFrame:
    """A run log made from events: one run per day."""
    return samples.table(spark, folder, "events").select(
        F.date_format("ts", "yyyyMMdd").alias("run_id"),
        F.to_date("ts").cast("timestamp_ntz").alias("generated_at"),
        F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("model.ships.stg_ais_"), F.col("user_id").cast("string")))
        .when(F.col("event_id") % 4 == 1, F.lit("model.ships.voyages"))
        .when(F.col("event_id") % 4 == 2, F.lit("model.ships.stgXais")).alias("unique_id"),
        F.col("event_type").alias("status"),
        F.col("value").alias("execution_time"),
        F.col("user_id").alias("rows_affected"),
        F.lit(None).cast("string").alias("message"),
    )


def run_history(spark: SparkSession, folder: str) -> DataFrame:
    report = reports.run_history(_run_log(spark, folder))
    return report.withColumn("total_duration_sec", F.round("total_duration_sec", 2))


def staging_latency(spark: SparkSession, folder: str) -> DataFrame:
    return reports.latency(_run_log(spark, folder))


def _run_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Run-results documents as text ``d`` with their number ``n``, with and without the keys that may be absent."""
    n = F.col("o_orderkey")
    results = F.array(
        F.struct(
            F.concat(F.lit("model.a"), n.cast("string")).alias("unique_id"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_totalprice").alias("execution_time"),
            F.struct(F.when(n % 3 != 0, n).alias("rows_affected")).alias("adapter_response"),
        ),
        F.struct(
            F.concat(F.lit("model.b"), n.cast("string")).alias("unique_id"),
            F.when(n % 2 == 0, F.col("o_orderpriority")).alias("status"),
            F.lit(None).cast("double").alias("execution_time"),
            F.when(n % 5 == 0, F.struct(n.alias("rows_affected"))).alias("adapter_response"),
        ),
    )
    document = F.to_json(F.struct(
        F.struct(
            F.when(n % 7 != 0, F.concat(F.lit("run-"), n.cast("string"))).alias("run_id"),
            F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T10:00:00.250Z")).alias("generated_at"),
        ).alias("metadata"),
        results.alias("results"),
    ))
    return samples.table(spark, folder, "orders").select(n.alias("n"), document.alias("d"))


def run_results_flatten(spark: SparkSession, folder: str) -> DataFrame:
    documents = _run_documents(spark, folder).select(F.from_json("d", schemas.RUN_DOCUMENT).alias("d"))
    return runlog.flatten_documents(documents.select("d.*")).fillna(-1, ["rows_affected"])


def run_log_files(spark: SparkSession, folder: str) -> DataFrame:
    """The same documents from JSON files of up to 5,000, added to the run log and read from there."""
    work = _work(spark, "run-log")
    files = _run_documents(spark, folder).groupBy(F.floor(F.col("n") / 5000).alias("part")).agg(
        F.concat(F.lit("["), F.concat_ws(",", F.collect_list("d")), F.lit("]")).alias("text")
    )
    files.write.partitionBy("part").text(f"{work}/documents")
    runlog.load_run_results(spark, f"{work}/documents", f"{work}/log")
    return spark.read.parquet(f"{work}/log").fillna(-1, ["rows_affected"])


# --- files and streams -------------------------------------------------------


def date_range(spark: SparkSession, folder: str) -> DataFrame:
    """Planned days between the first and last ping, with the pings found for each (0 for none)."""
    events = samples.table(spark, folder, "events")
    first, last = events.agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    days = [d for year in range(first.year, last.year + 1) for d in ping_files.plan_dates(year) if first <= d <= last]
    found = events.groupBy(F.to_date("ts").alias("dt")).agg(F.count("*").alias("pings"))
    return ping_files.date_range(spark, days).join(found, "dt", "left").select(
        F.col("dt").cast("string").alias("dt"), "file_name", F.coalesce("pings", F.lit(0)).alias("pings")
    )


def time_parsing(spark: SparkSession, folder: str) -> DataFrame:
    """Times as text in several forms, some unreadable."""
    n = F.col("event_id")
    written = (
        F.when(n % 5 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(n % 5 == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .when(n % 5 == 2, F.lit(""))
        .when(n % 10 == 3, F.lit("not a time"))
        .when(n % 20 == 8, F.lit("T10:00"))
        .when(n % 20 == 18, F.date_format("ts", "yyyy"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    )
    return samples.table(spark, folder, "events").select("event_id", time.parse_time(written).alias("parsed"))


def _land_files(spark: SparkSession, folder: str, landing: str) -> None:
    """Write the pings as daily CSV files: columns in another order, one too many, bad fields."""
    event = F.col("event_id")
    dirty = samples.pings(spark, folder).select(
        F.col("base_date_time").cast("string").alias("base_date_time"),
        F.col("latitude").cast("string").alias("latitude"),
        F.when(event % 97 == 0, "bad").when(event % 89 == 0, "NaN").otherwise(F.col("longitude").cast("string")).alias("longitude"),
        F.when(event % 101 == 0, "x1").otherwise(F.col("mmsi").cast("string")).alias("mmsi"),
        event.alias("sequence_no"),
        "imo",
        "vessel_name",
        F.concat(F.lit("ais-"), F.date_format("base_date_time", "yyyy-MM-dd"), F.lit(".csv")).alias("name"),
    )
    dirty.write.partitionBy("name").option("header", True).option("compression", "gzip").csv(landing)


def _stored(spark: SparkSession, path: str) -> DataFrame:
    stored = spark.read.parquet(path).drop("ingested_at")
    return stored.withColumn("dt", F.col("dt").cast("string")).fillna(-1, ["mmsi"])


def csv_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """The daily files read, matched and stored, one day of them twice."""
    work = _work(spark, "ingest")
    _land_files(spark, folder, f"{work}/landing")
    ports = samples.ports(spark, folder)
    days = sorted(row["dt"] for row in ping_files.landed_files(spark, f"{work}/landing").select("dt").distinct().toLocalIterator())
    ingest_days(spark, f"{work}/landing", days, ports, f"{work}/pings")
    ingest_days(spark, f"{work}/landing", days[3:4], ports, f"{work}/pings")
    return _stored(spark, f"{work}/pings")


def ingest_report(spark: SparkSession, folder: str) -> DataFrame:
    """What an ingest of all days reports, with a day before them that cannot be read and an absent one after."""
    work = _work(spark, "ingest")
    _land_files(spark, folder, f"{work}/landing")
    days = sorted(row["dt"] for row in ping_files.landed_files(spark, f"{work}/landing").select("dt").distinct().toLocalIterator())
    asked = [days[0] - timedelta(days=1), *days, days[-1] + timedelta(days=1)]
    bad = spark.createDataFrame([("a,b",), ("1,2",)], "value string")
    bad.coalesce(1).write.text(f"{work}/landing/ais-{asked[0]}.csv")
    report = ingest_days(spark, f"{work}/landing", asked, samples.ports(spark, folder), f"{work}/pings")
    outcomes = [(d, name) for name in ("done", "absent") for d in getattr(report, name)] + [(d, "failed") for d in report.failed]
    told = spark.createDataFrame(outcomes, "dt date, outcome string").withColumn("dt", F.col("dt").cast("string"))
    stored = spark.read.parquet(f"{work}/pings").groupBy(F.col("dt").cast("string").alias("dt")).agg(F.count("*").alias("stored"))
    return told.join(stored, "dt", "left").select(
        "dt", "outcome", F.coalesce("stored", F.lit(0)).alias("stored"), F.lit(report.read).cast("long").alias("read"), F.lit(report.kept).cast("long").alias("kept")
    )


def stream_csv_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """The same files through the stream that takes each file once."""
    work = _work(spark, "ingest")
    _land_files(spark, folder, f"{work}/landing")
    query = stream_ingest(
        spark, f"{work}/landing", samples.ports(spark, folder), f"{work}/pings", f"{work}/checkpoint", max_files=16
    )
    query.awaitTermination()
    return _stored(spark, f"{work}/pings")


def stream_stitched(spark: SparkSession, folder: str) -> DataFrame:
    """Legs from a stream of pings in five micro-batches of four files: four in time order, then pings of a day that are late for every fifth vessel."""
    work = _work(spark, "stream")
    pings = samples.pings(spark, folder).withColumnRenamed("base_date_time", "dep_time")
    is_late = _day(LATE_DAY) & (F.col("mmsi") % 5 == 0)
    bounds = [None, *BATCH_STARTS[1:], None]
    for first, last in zip(bounds, bounds[1:]):
        part = pings.where(~is_late)
        if first is not None:
            part = part.where(F.col("dep_time") >= F.lit(first).cast("timestamp_ntz"))
        if last is not None:
            part = part.where(F.col("dep_time") < F.lit(last).cast("timestamp_ntz"))
        part.repartition(4).write.mode("append").parquet(f"{work}/landing")
    pings.where(is_late).repartition(4).write.mode("append").parquet(f"{work}/landing")
    arriving = spark.readStream.schema(pings.schema).option("maxFilesPerTrigger", 4).parquet(f"{work}/landing")
    staged = match_stream(arriving, samples.ports(spark, folder))
    stream_stitch(staged, f"{work}/out", f"{work}/checkpoint").awaitTermination()
    return stream_legs(spark, f"{work}/out")


REGISTERED: list[Query] = [
    nearest_port_pings, nearest_port_haversine, nearest_port_shuffled, stg_ais, port_visits, port_visits_gaps, voyage_legs,
    voyage_legs_thinned, voyage_duration, voyage_distance, angle_conversion, expected_duration,
    voyages_zero_policy, voyages_great_circle, route_key_pairs, route_lookup, route_positions, route_geojson, path_downsample,
    overview_totals, recent_voyages, vessel_stats, vessel_history, vessel_page, voyages_last_n_days,
    incremental_lookback, incremental_upsert, incremental_carry, incremental_late, incremental_replaced_day, dq_positive_duration, dq_stored_voyages,
    unece_coords, port_filter, country_codes, staleness, reference_refresh, html_list_rows, html_table_rows, run_history, staging_latency,
    run_results_flatten, run_log_files, date_range, time_parsing, csv_ingest, ingest_report, stream_csv_ingest, stream_stitched,
]
