"""What the registered queries must return, as SQL over the given tables."""

from __future__ import annotations

from quayside import config
from quayside.checks.queries import AS_OF, LAST_DAYS, LAST_LOAD, LATE_DAY, NOW, VESSEL
from quayside.plans.reference_data import FALLBACK_PORTS

PORTS = """ports as (
  select 'P' || lpad(cast(n_nationkey as varchar), 4, '0') as locode, n_name as name,
         cast(-60 + n_regionkey * 25 + n_nationkey % 5 as double) as lat,
         cast(-150 + n_nationkey * 12 as double) as lon
  from nation)"""

PINGS = """pings as (
  select 200000000 + e.user_id as mmsi,
         case when e.user_id % 3 = 0 then 'IMO' else '' end || cast(9000000 + e.user_id as varchar) as imo,
         'VESSEL ' || cast(e.user_id as varchar) as vessel_name,
         p.lat + ((e.event_id % 21) - 10) * 6e-3 as latitude,
         p.lon + ((e.event_id % 13) - 6) * 8e-3 as longitude,
         e.ts as base_date_time, e.event_id as event_id
  from events e join ports p
    on p.locode = 'P' || lpad(cast((e.user_id + case e.event_type when 'click' then 0 when 'view' then 1
         when 'error' then 2 when 'signup' then 3 else 4 end) % 25 as varchar), 4, '0'))"""

PLANAR = """sqrt((radians(g.latitude) - radians(p.lat)) * (radians(g.latitude) - radians(p.lat))
            + (radians(g.longitude) - radians(p.lon)) * (radians(g.longitude) - radians(p.lon))) * 6371e0"""

HAVERSINE = """2 * 6371e0 * asin(least(1e0, sqrt(
              power(sin((radians({lat2}) - radians({lat1})) / 2), 2)
              + cos(radians({lat1})) * cos(radians({lat2})) * power(sin((radians({lon2}) - radians({lon1})) / 2), 2))))"""


def _matched(distance: str) -> str:
    return f"""raw_pings as (
  select event_id, mmsi, imo, vessel_name, latitude, longitude, base_date_time as dep_time,
         locode as port_locode, dist_km
  from (select d.*, row_number() over (partition by event_id order by dist_km, locode) as rn
        from (select g.*, p.locode, {distance} as dist_km from pings g cross join ports p) d) t
  where rn = 1 and dist_km <= 5e0)"""


STG = """stg as (
  select mmsi, regexp_replace(imo, '^IMO', '') as imo, vessel_name, port_locode,
         latitude as lat, longitude as lon, dep_time
  from raw_pings)"""

ORDER = "partition by mmsi order by dep_time nulls last, port_locode, lat, lon, imo, vessel_name"


def _stitched(source: str, prefix: str = "") -> str:
    """Visits, links and legs of a staged relation.

    Rows are numbered and joined to their neighbours, so that the check does not share the lag and lead
    windows of what it checks.
    """
    p = prefix
    return f"""{p}numbered as (select *, row_number() over ({ORDER}) as n from {source}),
{p}visits as (
  select here.* exclude (n) from {p}numbered here left join {p}numbered before
    on before.mmsi is not distinct from here.mmsi and before.n + 1 = here.n
  where before.port_locode is null or before.port_locode <> here.port_locode),
{p}stops as (select *, row_number() over ({ORDER}) as n from {p}visits),
{p}links as (
  select a.mmsi, a.imo, a.vessel_name,
         a.port_locode as dep_locode, a.lat as dep_lat, a.lon as dep_lon, a.dep_time,
         b.port_locode as arr_locode, b.lat as arr_lat, b.lon as arr_lon, b.dep_time as arr_time
  from {p}stops a left join {p}stops b on b.mmsi is not distinct from a.mmsi and b.n = a.n + 1),
{p}legs as (select * from {p}links where arr_locode is not null and dep_time < arr_time)"""


STAGED = f"with {PORTS}, {PINGS}, {_matched(PLANAR)}, {STG}"
BASE = f"{STAGED}, {_stitched('stg')}"
LEG_KM = HAVERSINE.format(lat1="dep_lat", lon1="dep_lon", lat2="arr_lat", lon2="arr_lon")
HOURS = "date_diff('microsecond', dep_time, arr_time) / 1e6 / 3600e0"
LINE = """'{"type":"LineString","coordinates":[[' || dep_lon || ',' || dep_lat || '],[' || arr_lon || ',' || arr_lat || ']]}'"""
VOYAGES = f"""{BASE}, voyages as (
  select legs.*, {LINE} as route_geometry, {LEG_KM} / 1.852e0 as distance_nm, {HOURS} as duration_hrs
  from legs where {HOURS} > 0)"""
LEG_COLUMNS = """mmsi, imo, vessel_name, dep_locode, dep_lat, dep_lon, dep_time,
  arr_locode, arr_lat, arr_lon, arr_time"""
VOYAGE_COLUMNS = f"""{LEG_COLUMNS}, route_geometry,
  round(distance_nm, 3) as distance_nm, duration_hrs"""

LOOKBACK = f"""{STAGED}, before as (select * from stg where dep_time < timestamp '{LAST_LOAD}'),
{_stitched('before', 'b_')},
since as (select * from stg where dep_time >= (select max(arr_time) from b_legs) - interval 14 day),
{_stitched('since', 's_')}"""


def _place(n: str) -> str:
    north = f"""lpad(cast({n} % 90 as varchar), 2, '0') || lpad(cast({n} % 60 as varchar), 2, '0')
            || case when {n} % 2 = 0 then 'N' else 'S' end"""
    east = f"""lpad(cast({n} % 180 as varchar), 3, '0') || lpad(cast(({n} * 7) % 60 as varchar), 2, '0')
            || case when {n} % 3 = 0 then 'E' else 'W' end"""
    return f"""case {n} % 11 when 0 then '' when 1 then {north} when 2 then {north} || '  ' || {east}
            when 3 then 'x' || substring({north}, 2, 4) || ' ' || {east}
            when 4 then '12N ' || {east} else {north} || ' ' || {east} end"""


def _lat(n: str) -> str:
    return f"""case when {n} % 11 in (0, 3, 4) then null
            else (({n} % 90) + ({n} % 60) / 60e0) * case when {n} % 2 = 0 then 1 else -1 end end"""


def _lon(n: str) -> str:
    return f"""case when {n} % 11 in (0, 1, 2) then null
            else (({n} % 180) + (({n} * 7) % 60) / 60e0) * case when {n} % 3 = 0 then 1 else -1 end end"""


RUN_LOG = """with run_log as (
  select cast(cast(ts as date) as timestamp) as generated_at,
         case event_id % 4 when 0 then 'model.ships.stg_ais_' || cast(user_id as varchar)
              when 1 then 'model.ships.voyages' when 2 then 'model.ships.stgXais' end as unique_id,
         event_type as status, value as execution_time, user_id as rows_affected
  from events)"""

INGESTED = f"""with {PORTS}, {PINGS}, {_matched(PLANAR)}
select case when event_id % 101 = 0 then -1 else mmsi end as mmsi, imo, vessel_name, latitude, longitude,
       dep_time, port_locode, cast(cast(dep_time as date) as varchar) as dt
from raw_pings where event_id % 97 <> 0 and event_id % 89 <> 0"""

RUN_RESULTS = """with docs as (
  select o_orderkey as n, *, case when o_orderkey % 7 <> 0 then 'run-' || cast(o_orderkey as varchar) end as run_id,
         cast(cast(o_orderdate as date) as timestamp) + interval '10 hours' + interval '250 milliseconds' as generated_at
  from orders)
select run_id, generated_at, 'model.a' || cast(n as varchar) as unique_id, o_orderstatus as status,
  o_totalprice as execution_time, case when n % 3 <> 0 then n else -1 end as rows_affected, cast(null as varchar) as message
from docs
union all
select run_id, generated_at, 'model.b' || cast(n as varchar), case when n % 2 = 0 then o_orderpriority end,
  null, case when n % 5 = 0 then n else -1 end, null from docs"""

LEGS = f"{BASE} select {LEG_COLUMNS} from legs"

ORACLES: dict[str, str] = {
    "nearest_port_pings": f"""with {PORTS}, {PINGS}, {_matched(PLANAR)}
select mmsi, imo, vessel_name, latitude, longitude, dep_time, port_locode, round(dist_km, 6) as dist_km
from raw_pings""",
    "nearest_port_haversine": f"""with {PORTS}, {PINGS},
{_matched(HAVERSINE.format(lat1="g.latitude", lon1="g.longitude", lat2="p.lat", lon2="p.lon"))}
select event_id, port_locode, round(dist_km, 6) as dist_km from raw_pings""",
    "nearest_port_shuffled": f"""with {PORTS}, {PINGS}, {_matched(PLANAR)}
select event_id, port_locode, round(dist_km, 6) as dist_km from raw_pings""",
    "stg_ais": f"{STAGED} select * from stg",
    "port_visits": f"{BASE} select * from visits",
    "port_visits_gaps": f"""{STAGED},
gaps as (select * replace (case when (epoch_us(dep_time) + mmsi) % 5 <> 0 then port_locode end as port_locode) from stg),
again as (select * from gaps union all select gaps.* from gaps, range(2) where (epoch_us(dep_time) + mmsi) % 7 = 0),
{_stitched('again', 'g_')} select * from g_visits""",
    "voyage_legs": LEGS,
    "voyage_legs_thinned": LEGS,
    "voyage_duration": f"""{BASE} select mmsi, dep_time, {HOURS} as duration_hrs,
  -trunc(date_diff('microsecond', dep_time, arr_time) / 1e6) / 3600e0 as difference_hrs from legs""",
    "voyage_distance": f"""{BASE} select mmsi, dep_time, round({LEG_KM}, 3) as haversine_km,
  round({LEG_KM} / 1.852e0, 3) as distance_nm,
  round(sqrt(power(radians(dep_lat) - radians(arr_lat), 2) + power(radians(dep_lon) - radians(arr_lon), 2)) * 6371e0, 3)
    as planar_km
from legs""",
    "angle_conversion": f"""with {PORTS}, {PINGS}
select event_id, round(radians(latitude), 12) as lat_rad, round(radians(longitude), 12) as lon_rad,
  round(latitude, 10) as lat_deg, round(longitude, 10) as lon_deg from pings""",
    "expected_duration": f"""{BASE} select mmsi, dep_time,
  case when round({LEG_KM} / 1.852e0, 3) <> 0
       then round(round({LEG_KM} / 1.852e0, 3) / {config.DEFAULT_SPEED_KN}e0, 2) end as expected_hrs from legs""",
    "voyages_zero_policy": f"""{BASE} select {LEG_COLUMNS}, cast(null as varchar) as route_geometry,
  0e0 as distance_nm, {HOURS} as duration_hrs from legs where {HOURS} > 0""",
    "voyages_great_circle": f"{VOYAGES} select {VOYAGE_COLUMNS} from voyages",
    "route_key_pairs": f"""{BASE} select 'route_' || dep_locode || '_' || arr_locode as route_key,
  dep_locode, arr_locode, count(*) as legs from legs group by all""",
    "route_lookup": f"""{VOYAGES}, pairs as (
  select dep_locode, arr_locode, min(dep_lat) as y1, min(dep_lon) as x1, min(arr_lat) as y2, min(arr_lon) as x2
  from legs group by all)
select mmsi, dep_time, arr_time,
  round(case when x2 >= x1 then 60e0 * (abs(x2 - x1) + abs(y2 - y1)) else distance_nm end, 3) as distance_nm,
  cast(case when x2 >= x1 then 3 else 2 end as integer) as points
from voyages join pairs using (dep_locode, arr_locode)""",
    "route_positions": f"""{BASE} select mmsi, dep_time, arr_time,
  round(case when cast(floor(abs(dep_lat)) as integer) % 3 = 0 then 0e0 else abs(arr_lon - dep_lon) end, 6) as distance_nm,
  cast(case cast(floor(abs(dep_lat)) as integer) % 3 when 1 then 1 when 2 then 3 end as integer) as points
from legs where {HOURS} > 0""",
    "route_geojson": f"""{BASE} select mmsi, dep_time, 'LineString' as line_type, cast(2 as integer) as points,
  dep_lon as from_lon, dep_lat as from_lat, arr_lon as to_lon, arr_lat as to_lat from legs""",
    "path_downsample": """with paths as (
  select event_id, event_id % 150 as last_no, case when event_id % 150 + 1 > 100 then 3
         when event_id % 150 + 1 > 30 then 2 else 1 end as step from events),
points as (
  select event_id, i from (select event_id, last_no, step, unnest(range(0, last_no + 1)) as i from paths) p
  where i % step = 0 or i = last_no)
select event_id, cast(count(*) as integer) as points, cast(sum(i) as bigint) as index_sum from points group by event_id""",
    "overview_totals": f"""{VOYAGES} select count(*) as voyages, count(distinct mmsi) as vessels,
  round(sum(distance_nm), 2) as total_distance from voyages""",
    "recent_voyages": f"""{VOYAGES} select {VOYAGE_COLUMNS} from voyages
order by arr_time desc, mmsi, dep_time limit 10""",
    "vessel_stats": f"""{VOYAGES} select vessel_name, count(*) as total_trips, round(sum(distance_nm), 3) as total_nm
from voyages where mmsi = '{VESSEL}' group by all""",
    "vessel_history": f"""{VOYAGES} select dep_locode, arr_locode, dep_time, duration_hrs
from voyages where mmsi = '{VESSEL}' order by dep_time desc""",
    "vessel_page": f"""{VOYAGES} select vessel_name, count(*) as total_trips
from voyages where mmsi = '{VESSEL}' group by all""",
    "voyages_last_n_days": f"""{VOYAGES} select vessel_name, dep_locode, arr_locode, dep_time,
  round(distance_nm, 3) as distance_nm, route_geometry
from voyages where dep_time >= date '{AS_OF}' - interval '{LAST_DAYS} days'
order by dep_time desc, mmsi, arr_time limit 100""",
    "incremental_lookback": f"{LOOKBACK} select {LEG_COLUMNS} from s_legs",
    "incremental_upsert": f"""{LOOKBACK}
select {LEG_COLUMNS} from b_legs b
where not exists (select 1 from s_legs s where s.mmsi is not distinct from b.mmsi
                  and s.dep_time = b.dep_time and s.arr_time = b.arr_time)
union all select {LEG_COLUMNS} from s_legs""",
    "incremental_carry": LEGS,
    "incremental_late": LEGS,
    "incremental_replaced_day": f"""{STAGED}, kept as (
  select * from stg where dep_time < timestamp '{LAST_LOAD}' and not (cast(dep_time as date) = date '{LATE_DAY}' and mmsi % 3 = 0)),
{_stitched('kept', 'k_')} select {LEG_COLUMNS} from k_legs""",
    "dq_positive_duration": f"""{BASE}, timed as (
  select mmsi, dep_time, arr_time, case when mmsi % 3 = 0 then -1 else 1 end * {HOURS} as hours
  from links where arr_time is not null)
select mmsi, dep_time, arr_time, hours as duration_hrs from timed where hours <= 0""",
    "dq_stored_voyages": f"""{VOYAGES}, given as (
  select vessel_name, case mmsi % 7 when 0 then 0e0 when 1 then -duration_hrs when 2 then null else duration_hrs end as hours from voyages)
select vessel_name, count(*) as voyages, count(*) filter (where hours <= 0) as failing,
  count(*) filter (where hours > 0 or hours is null) as kept, cast(0 as bigint) as failing_after from given group by vessel_name""",
    "unece_coords": f"""select event_id, {_place('event_id')} as place,
  round({_lat('event_id')}, 9) as lat, round({_lon('event_id')}, 9) as lon from events""",
    "port_filter": f"""with raw as (
  select o_orderkey as n, {_lat('o_orderkey')} as lat, {_lon('o_orderkey')} as lon,
         chr(cast(65 + o_orderkey % 26 as integer)) || chr(cast(65 + (o_orderkey * 3) % 26 as integer)) as iso,
         lpad(cast(o_orderkey % 1000 as varchar), 3, '0') as no
  from orders)
select case when n % 7 = 1 then 'XY' || no else iso || no end as locode, 'Port ' || cast(n as varchar) as name,
  round(lat, 9) as lat, round(lon, 9) as lon
from raw
where n % 13 <> 0 and n % 7 <> 0 and n % 5 <> 0 and n % 4 <> 2 and lat is not null and lon is not null""",
    "country_codes": """select distinct chr(cast(65 + o_orderkey % 26 as integer))
  || case when o_orderkey % 4 = 2 then '1' else chr(cast(65 + (o_orderkey * 5) % 26 as integer)) end as code
from orders where o_orderkey % 10 >= 1 and o_orderkey % 4 in (2, 3) order by 1""",
    "staleness": f"""select max(o_orderdate) as last_update,
  cast(floor(date_diff('second', max(o_orderdate), timestamp '{NOW}') / 86400e0) as bigint) as age_days,
  floor(date_diff('second', max(o_orderdate), timestamp '{NOW}') / 86400e0) > max_age_days as is_stale,
  max_age_days
from orders cross join (select unnest([{config.COUNTRIES_MAX_AGE_DAYS}, {config.PORTS_MAX_AGE_DAYS}]) as max_age_days) d
group by max_age_days""",
    "reference_refresh": f"""with raw as (
  select s_suppkey as n, {_lat('s_suppkey')} as lat, {_lon('s_suppkey')} as lon, s_nationkey as k,
         chr(cast(65 + s_nationkey % 26 as integer)) || chr(cast(65 + (s_nationkey * 3) % 26 as integer)) as iso,
         lpad(cast(s_suppkey % 1000 as varchar), 3, '0') as no
  from supplier),
listed as (
  select case when n % 7 = 1 then 'XY' || no else iso || no end as locode, 'Port ' || cast(n as varchar) as name,
    round(lat, 9) as lat, round(lon, 9) as lon, iso
  from raw
  where n % 7 <> 0 and n % 5 <> 0 and n % 4 <> 2 and lat is not null and lon is not null
    and iso in (select chr(cast(65 + n_nationkey % 26 as integer)) || chr(cast(65 + (n_nationkey * 3) % 26 as integer)) from nation where n_nationkey % 4 <> 3)),
steps(step, since, only_some) as (values ('built', 0, false), ('fresh', 0, false), ('renewed', 181, true), ('kept', 181, true))
select step, locode, name, lat, lon, timestamp '{NOW}' + to_days(since) as updated_at
from listed cross join steps where not only_some or iso < 'M'
union all
select 'hubs', locode, name, lat, lon, timestamp '{NOW}' from (values {', '.join(map(str, FALLBACK_PORTS))}) hubs(locode, name, lat, lon)""",
    "html_list_rows": r"""with items as (
  select page_id, regexp_extract_all(html, '(?is)<li(?:\s[^>]*)?>(.*?)</li\s*>', 1) as rows from pages),
numbered as (
  select page_id, unnest(range(0, len(rows))) as row_no, unnest(rows) as row_html from items)
select page_id, cast(row_no as integer) as row_no,
  cast(len(regexp_extract_all(row_html, '(?is)<a(?:\s[^>]*)?>(.*?)</a\s*>', 1)) as integer) as cells,
  array_to_string(list_transform(regexp_extract_all(row_html, '(?is)<a(?:\s[^>]*)?>(.*?)</a\s*>', 1),
    lambda x: trim(regexp_replace(x, '<[^>]*>', '', 'g'))), '|') as cell_text
from numbered""",
    "html_table_rows": """with p as (
  select page_id, trim(coalesce(url, '')) as u, cast(page_id % 7 as varchar) as d from pages)
select page_id, 0 as row_no, 2 as cells, 'Page ' || page_id || '|Fish & chips' as cell_text from p
union all select page_id, 1, 5, u || d || 'éintail|' || d || 'é|in|' || page_id || '|last' from p
union all select page_id, 2, 2, d || 'é|in' from p
union all select page_id, 3, 1, 'x¬it;' from p""",
    "run_history": f"""{RUN_LOG} select generated_at as run_time, status, count(unique_id) as models_run,
  round(sum(execution_time), 2) as total_duration_sec
from run_log group by 1, 2 order by 1 desc, 2 limit 10""",
    "staging_latency": f"""{RUN_LOG} select unique_id, execution_time, rows_affected from run_log
where unique_id like '%stg_ais%' order by generated_at desc""",
    "run_results_flatten": RUN_RESULTS,
    "run_log_files": RUN_RESULTS,
    "date_range": """with days as (
  select cast(unnest(generate_series(cast(min(cast(ts as date)) as timestamp), cast(max(cast(ts as date)) as timestamp),
         interval 1 day)) as date) as dt from events)
select cast(dt as varchar) as dt, 'ais-' || strftime(dt, '%Y-%m-%d') || '.csv' as file_name, count(event_id) as pings
from days left join events on cast(ts as date) = dt group by days.dt""",
    "time_parsing": """select event_id, case event_id % 5 when 0 then date_trunc('second', ts) when 1 then ts
  when 4 then date_trunc('second', ts) end as parsed from events""",
    "csv_ingest": INGESTED,
    "stream_csv_ingest": INGESTED,
    "ingest_report": f"""with {PORTS}, {PINGS}, {_matched(PLANAR)},
good as (select cast(dep_time as date) as dt from raw_pings where event_id % 97 <> 0 and event_id % 89 <> 0),
days as (select distinct cast(base_date_time as date) as dt from pings),
ends as (select min(dt) - 1 as first, max(dt) + 1 as last from days),
outcomes as (select dt, 'done' as outcome from days union all select first, 'failed' from ends union all select last, 'absent' from ends)
select cast(o.dt as varchar) as dt, outcome, count(g.dt) as stored,
  (select count(*) from pings where event_id % 97 <> 0 and event_id % 89 <> 0) as read, (select count(*) from good) as kept
from outcomes o left join good g on g.dt = o.dt group by o.dt, outcome""",
    "stream_stitched": LEGS,
}
