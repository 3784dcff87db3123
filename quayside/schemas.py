"""Schemas at table boundaries. Timestamps carry no zone."""

from pyspark.sql import types as T

COUNTRIES = T.StructType([
    T.StructField("code", T.StringType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

PORTS = T.StructType([
    T.StructField("locode", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

RAW_PINGS = T.StructType([
    T.StructField("mmsi", T.LongType()),
    T.StructField("imo", T.StringType()),
    T.StructField("vessel_name", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("dep_time", T.TimestampNTZType()),
    T.StructField("port_locode", T.StringType()),
    T.StructField("ingested_at", T.TimestampNTZType()),
    T.StructField("dt", T.DateType()),
])

STAGED = T.StructType([
    T.StructField("mmsi", T.LongType()),
    T.StructField("imo", T.StringType()),
    T.StructField("vessel_name", T.StringType()),
    T.StructField("port_locode", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("dep_time", T.TimestampNTZType()),
])

LEGS = T.StructType([
    T.StructField("mmsi", T.LongType()),
    T.StructField("imo", T.StringType()),
    T.StructField("vessel_name", T.StringType()),
    T.StructField("dep_locode", T.StringType()),
    T.StructField("dep_lat", T.DoubleType()),
    T.StructField("dep_lon", T.DoubleType()),
    T.StructField("dep_time", T.TimestampNTZType()),
    T.StructField("arr_locode", T.StringType()),
    T.StructField("arr_lat", T.DoubleType()),
    T.StructField("arr_lon", T.DoubleType()),
    T.StructField("arr_time", T.TimestampNTZType()),
])

VOYAGES = T.StructType(LEGS.fields + [
    T.StructField("route_geometry", T.StringType()),
    T.StructField("distance_nm", T.DoubleType()),
    T.StructField("duration_hrs", T.DoubleType()),
])

VOYAGE_KEY = ("mmsi", "dep_time", "arr_time")

# What one vessel leaves behind after a run: its unfinished visit, and how far it was read.
OPEN_VISITS = T.StructType(STAGED.fields + [T.StructField("last_seen", T.TimestampNTZType())])

# Span of a vessel's pings in a file day that was read.
SEEN = T.StructType([
    T.StructField("mmsi", T.LongType()),
    T.StructField("first_ping", T.TimestampNTZType()),
    T.StructField("last_ping", T.TimestampNTZType()),
    T.StructField("dt", T.DateType()),
])

# Which folder of open visits counts: runs as they start and finish.
STATE_LOG = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("event", T.StringType()),
    T.StructField("folder", T.StringType()),
])

# Versions of a table in the order in which they were published.
VERSIONS = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("folder", T.StringType()),
])

GEOMETRY = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("coordinates", T.ArrayType(T.ArrayType(T.DoubleType()))),
])

ROUTES = T.StructType([
    T.StructField("route_key", T.StringType()),
    T.StructField("geometry", GEOMETRY),
    T.StructField("length_nm", T.DoubleType()),
])

RUN_RESULTS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("generated_at", T.TimestampNTZType()),
    T.StructField("unique_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("execution_time", T.DoubleType()),
    T.StructField("rows_affected", T.LongType()),
    T.StructField("message", T.StringType()),
])

# The run-results document. Absent keys read as null.
RUN_DOCUMENT = T.StructType([
    T.StructField("metadata", T.StructType([
        T.StructField("run_id", T.StringType()),
        T.StructField("generated_at", T.StringType()),
    ])),
    T.StructField("results", T.ArrayType(T.StructType([
        T.StructField("unique_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("execution_time", T.DoubleType()),
        T.StructField("adapter_response", T.StructType([T.StructField("rows_affected", T.LongType())])),
        T.StructField("message", T.StringType()),
    ]))),
])
