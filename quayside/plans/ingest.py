"""From the landing folder to the table of pings near ports."""

from __future__ import annotations

import json
import logging
from dataclasses import asdict, dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.nearest import nearest_port
from quayside.operators.quality import counted
from quayside.plans.staging import MATCHED_COLUMNS
from quayside.sources.pings import append_pings, clear_days, landed_files, read_pings

log = logging.getLogger(__name__)


@dataclass
class IngestReport:
    read: int = 0
    kept: int = 0
    done: list[date] = field(default_factory=list)
    absent: list[date] = field(default_factory=list)
    failed: dict[date, str] = field(default_factory=dict)

    def to_json(self, asked: list[date]) -> str:
        """As text, together with the days that were asked for."""
        return json.dumps(asdict(self) | {"failed": {str(d): why for d, why in self.failed.items()}, "asked": asked}, default=str)

    @classmethod
    def from_json(cls, text: str, asked: list[date]) -> IngestReport:
        """The report of the same days; of other days it is refused."""
        stored = json.loads(text)
        if stored.pop("asked") != [str(d) for d in asked]:
            raise ValueError("this run was begun for other days")
        dates = {name: [date.fromisoformat(d) for d in stored[name]] for name in ("done", "absent")}
        return cls(**stored | dates | {"failed": {date.fromisoformat(d): why for d, why in stored["failed"].items()}})


def match_pings(pings: DataFrame, ports: DataFrame, **options) -> DataFrame:
    """Pings near a port in the stored columns, with the day of their file."""
    return nearest_port(pings, ports, **options).select(*MATCHED_COLUMNS, "dt")


def ingest_files(
    spark: SparkSession,
    files: dict[date, list[str]],
    ports: DataFrame,
    path: str,
    mode: str = "overwrite_days",
) -> IngestReport:
    """Ingest the files of each day; a day that cannot be read does not stop the others.

    All days run as one job. If it fails, its days are halved and run again until the bad day is
    alone and is reported.
    """
    report = IngestReport()
    ports = ports.select("locode", "lat", "lon")
    pending = [sorted(files)] if files else []
    while pending:
        batch = pending.pop()
        try:
            pings, seen = counted(read_pings(spark, [p for d in batch for p in files[d]]), "read")
            kept, near = counted(match_pings(pings, ports), "kept", days=F.collect_set("dt"))
            append_pings(kept, path, mode)
            if mode == "overwrite_days":
                clear_days(spark, path, sorted(set(batch) - set(near.get["days"])))
            report.read += seen.get["rows"]
            report.kept += near.get["rows"]
            report.done += batch
        except Exception as error:
            if len(batch) == 1:
                log.error("day %s failed: %s", batch[0], error)
                # An error may come without a message.
                report.failed[batch[0]] = next(iter(str(error).splitlines()), repr(error))
            else:
                middle = len(batch) // 2
                pending += [batch[middle:], batch[:middle]]
    report.done.sort()
    log.info("read %d pings, kept %d, days done %d", report.read, report.kept, len(report.done))
    return report


def ingest_days(
    spark: SparkSession,
    landing: str,
    days: list[date],
    ports: DataFrame,
    path: str,
    mode: str = "overwrite_days",
) -> IngestReport:
    """Ingest the landed files of ``days``; days without a file are reported as absent."""
    files: dict[date, list[str]] = {}
    for row in landed_files(spark, landing).where(F.col("dt").isin(days)).toLocalIterator():
        files.setdefault(row["dt"], []).append(row["path"])
    report = ingest_files(spark, files, ports, path, mode)
    report.absent = sorted(set(days) - set(files))
    return report
