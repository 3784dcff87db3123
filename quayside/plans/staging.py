"""From ingested pings to the staged view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.text import strip_imo_prefix


# Columns of a ping matched to a port, in the order they are stored.
MATCHED_COLUMNS = ["mmsi", "imo", "vessel_name", "latitude", "longitude", "dep_time", "port_locode"]


def stage(raw_pings: DataFrame, keep_day: bool = False) -> DataFrame:
    """Short position names and the bare IMO number. A view: nothing is stored.

    With ``keep_day`` the file day ``dt`` stays, so that filters on it still prune partitions.
    """
    return raw_pings.select(
        "mmsi",
        strip_imo_prefix(F.col("imo")).alias("imo"),
        "vessel_name",
        "port_locode",
        F.col("latitude").alias("lat"),
        F.col("longitude").alias("lon"),
        "dep_time",
        *(["dt"] if keep_day else []),
    )
