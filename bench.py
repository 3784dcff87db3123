"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Every query runs once to warm up and is then timed, result rows written to a no-op sink.
With ``--duckdb`` the SQL oracle is timed next to it, to compare on the same machine.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quayside.checks import oracles, queries  # noqa: E402
from quayside.config import build_session  # noqa: E402

HEADLINE = [
    "nearest_port_pings", "stg_ais", "port_visits", "voyage_legs", "voyage_distance", "voyages_great_circle",
    "route_key_pairs", "overview_totals", "recent_voyages", "vessel_stats", "voyages_last_n_days",
    "incremental_lookback", "unece_coords", "port_filter", "html_list_rows", "run_history",
]
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))


def spark_seconds(spark, query, folder: str) -> float:
    def run() -> float:
        start = time.perf_counter()
        query(spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run()
    return statistics.median(run() for _ in range(REPEATS))


def duckdb_seconds(folder: str, names: list[str]) -> dict[str, float]:
    import duckdb

    con = duckdb.connect()
    for file in os.listdir(folder):
        con.execute(f"create view {file.removesuffix('.parquet')} as select * from '{folder}/{file}'")
    result = {}
    for name in names:
        con.execute(oracles.ORACLES[name]).fetchall()
        start = time.perf_counter()
        con.execute(oracles.ORACLES[name]).fetchall()
        result[name] = round(time.perf_counter() - start, 3)
    return result


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = {q.__name__: q for q in queries.REGISTERED}
    names = sys.argv[1].split(",") if len(sys.argv) > 1 and not sys.argv[1].startswith("--") else HEADLINE
    seconds = {name: round(spark_seconds(spark, registered[name], folder), 3) for name in names}
    spark.stop()
    report = {
        "metric": "headline queries, total wall time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": folder.rsplit("sf", 1)[-1],
    }
    if "--duckdb" in sys.argv:
        report["duckdb"] = duckdb_seconds(folder, names)
    print(json.dumps(report))


if __name__ == "__main__":
    main()
