"""Snapshots that fail a check stay behind, each with its reason; the others go on.

What fails is a few lines for each snapshot and source, which the calendar bounds, not the data. They are kept in a
ledger on the driver, written to a table, and raised together when everything else is done.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationday.errors import DataQualityError, MissingRawObjects
from stationday.operators.joins import SHOWN_IDS, in_all

RAW_OBJECTS = "raw_objects"
FAILURE_SCHEMA = "snapshot_date date, source string, check string, message string, rows long, run_id string"


@dataclass
class Ledger:
    """The snapshots of a build and what is wrong with them."""

    days: list[dt.date]
    failures: list[dict] = field(default_factory=list)

    @property
    def good(self) -> list[dt.date]:
        bad = {f["snapshot_date"] for f in self.failures}
        return [day for day in self.days if day not in bad]

    def add(self, check: str, snapshot_date: dt.date, message: str, source: str | None = None, rows: int = 1, **more) -> None:
        self.failures.append({"snapshot_date": snapshot_date, "source": source, "check": check, "message": message, "rows": rows, **more})

    def block(self, found: DataFrame, check: str, message: Column) -> None:
        """Block the snapshots in ``found``, by source where it has one; the smallest message stands for all."""
        groups = [c for c in ("snapshot_date", "source") if c in found.columns]
        rows = found.groupBy(*groups).agg(F.min(message).alias("message"), F.count(F.lit(1)).alias("rows")).collect()
        for row in sorted(rows, key=str):
            self.add(check, **row.asDict())

    def block_rows(self, found: DataFrame, check: str) -> None:
        """Block the snapshots of failed check results, whose counts are kept."""
        for row in sorted(found.collect(), key=str):  # a row for each snapshot and source at most
            counts = row.asDict()
            day, source = counts.pop("snapshot_date"), counts.pop("source", None)
            self.add(check, day, f"Check {check} failed: {counts!r}", source, **counts)

    def write(self, spark: SparkSession, path: str, run_id: str) -> None:
        """Append the failures of a run to a table."""
        if self.failures:
            names = ("snapshot_date", "source", "check", "message", "rows")
            rows = [(*(f[n] for n in names), run_id) for f in self.failures]
            spark.createDataFrame(rows, FAILURE_SCHEMA).write.mode("append").parquet(path)

    def raise_failures(self) -> None:
        if not self.failures:
            return
        shown = self.failures[:SHOWN_IDS]
        lines = "; ".join(
            f"{f['snapshot_date']}{'' if f['source'] is None else ' ' + f['source']}: {f['check']}: {f['message']}" for f in shown
        )
        text = f"Snapshots not built: {lines}{in_all(shown, len(self.failures))}"
        if all(f["check"] == RAW_OBJECTS for f in self.failures):
            raise MissingRawObjects(text)
        raise DataQualityError(text, failures=self.failures, total=len(self.failures))
