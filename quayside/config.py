"""Fixed values, session settings and table locations."""

from __future__ import annotations

import tempfile
from dataclasses import dataclass

from pyspark.sql import SparkSession

# --- Fixed values: results depend on them -----------------------------------
EARTH_RADIUS_KM = 6371.0
PORT_RADIUS_KM = 5.0
KM_PER_NM = 1.852
COORDINATE_DECIMALS = 10
LONG_PATH_POINTS, LONG_PATH_KEEP_EVERY = 100, 3
MEDIUM_PATH_POINTS, MEDIUM_PATH_KEEP_EVERY = 30, 2
PORT_STATUS_CODES = ["AA", "AC", "AF", "AI", "AM", "AS", "AQ", "RL", "RQ", "RN", "QQ"]
SEAPORT_FUNCTION = "1"
LOOKBACK_DAYS = 14
# A day's file may hold pings of so many days after it; a look-back reads files from that much earlier.
FILE_DAY_MARGIN = 1
COUNTRIES_MAX_AGE_DAYS = 365
PORTS_MAX_AGE_DAYS = 180
DEFAULT_SPEED_KN = 12.5

# --- Limits of physical choices: results do not depend on them ---------------
# A side is broadcast only after a check that it has at most this many rows.
BROADCAST_MAX_ROWS = 1_000_000
# Tasks that a route finder runs in.
FINDER_TASKS = 64
# A vessel's pings are stitched in time slices of this width.
SLICE_MINUTES = 30


def build_session(app_name: str = "quayside", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the engine relies on; ``conf`` wins over the defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Do not look up the Python line of every column expression: it doubles plan-building time.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, for written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may go without: it gets
    a temporary folder, remembered in the session.
    """
    for key in ("spark.checkpoint.dir", "spark.quayside.scratch.dir"):
        folder = spark.conf.get(key, None)
        if folder:
            return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="quayside-")
    spark.conf.set("spark.quayside.scratch.dir", folder)
    return folder


@dataclass(frozen=True)
class Tables:
    """Where the tables live. One root folder, one sub-folder per table."""

    root: str

    def _at(self, *parts: str) -> str:
        return "/".join((self.root.rstrip("/"), *parts))

    @property
    def countries(self) -> str:
        return self._at("reference", "countries")

    @property
    def ports(self) -> str:
        return self._at("reference", "ports")

    @property
    def raw_pings(self) -> str:
        return self._at("silver", "raw_ais_pings")

    @property
    def voyages(self) -> str:
        return self._at("gold", "voyages")

    @property
    def open_visits(self) -> str:
        return self._at("gold", "open_visits")

    @property
    def routes(self) -> str:
        return self._at("gold", "routes")

    @property
    def run_results(self) -> str:
        return self._at("operations", "run_results")
