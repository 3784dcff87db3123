"""Command line.

``python -m quayside days --root R --landing L --pages P [--year Y [--month M [--day D]]]`` ingests daily files and builds voyages;
``P`` holds two Parquet tables of stored pages: ``countries`` (html) and ``ports`` (iso, html).
``python -m quayside run-log --root R --documents D`` adds run-results documents to the run log. Without a command, ``days`` is meant.
"""

from __future__ import annotations

import argparse
import importlib
import logging
import sys

from quayside.config import Tables, build_session
from quayside.operators.routes import RouteFinder
from quayside.plans.daily import run_days
from quayside.sources.pings import plan_dates
from quayside.sources.runlog import load_run_results


def finder_named(name: str | None) -> RouteFinder | None:
    """The function ``module:function``."""
    if name is None:
        return None
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="quayside", description="Port calls and voyages from vessel positions")
    commands = top.add_subparsers(dest="command", required=True)
    days = commands.add_parser("days", help="ingest daily files and build voyages")
    for name in ("root", "landing", "pages"):
        days.add_argument(f"--{name}", required=True)
    for name in ("year", "month", "day"):
        days.add_argument(f"--{name}", type=int)
    days.add_argument("--mode", choices=["carry", "lookback"], default="carry")
    days.add_argument("--routes-by", choices=["ports", "positions"], default="ports", help="one route for each port pair, or for each leg's own ends")
    days.add_argument("--on-missing", choices=["great_circle", "zero"], default="great_circle", help="what a leg without a route gets")
    days.add_argument("--finder", help="route finder as module:function")
    days.add_argument("--run-id", help="repeat a run that was interrupted")
    log = commands.add_parser("run-log", help="add run-results documents to the run log")
    log.add_argument("--root", required=True)
    log.add_argument("--documents", required=True)
    return top


def main(words: list[str] | None = None) -> None:
    words = sys.argv[1:] if words is None else words
    args = parser().parse_args(words if not words or not words[0].startswith("--") or words[0] == "--help" else ["days", *words])
    logging.basicConfig(level=logging.INFO, format="%(asctime)s [%(levelname)s] %(name)s: %(message)s")
    spark = build_session()
    tables = Tables(args.root)
    if args.command == "run-log":
        logging.info("%d rows added to the run log", load_run_results(spark, args.documents, tables.run_results))
    else:
        report = run_days(
            spark,
            tables,
            args.landing,
            plan_dates(args.year, args.month, args.day),
            spark.read.parquet(f"{args.pages}/countries"),
            spark.read.parquet(f"{args.pages}/ports"),
            mode=args.mode,
            finder=finder_named(args.finder),
            run_id=args.run_id,
            by=args.routes_by,
            on_missing=args.on_missing,
        )
        logging.info("%s", report)


if __name__ == "__main__":
    main()
