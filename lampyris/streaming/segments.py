"""Log-structured store of mergeable rows by day.

Each micro-batch adds a segment. When `fan_in` segments of one level have gathered for a day they are merged into one of the next level, together with
higher levels that fill up by it, so a day has a logarithmic number of live segments however many batches it has seen, and a row is rewritten that often.
The newest batch is never merged: should it be repeated after a failure, its segment is replaced and each row has effect once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lampyris.sources.manifest import Manifest

FAN_IN = 3
_DAY = "_day"
NO_DAY = "none"


class Segments:
    """Segments under `path`, one manifest per day. Rows have a column `date`; those without one are a day of their own."""

    def __init__(self, spark: SparkSession, path: str, fan_in: int = FAN_IN):
        self.spark, self.path, self.fan_in = spark, path, fan_in

    def _manifest(self, day: str) -> Manifest:
        return Manifest(self.spark, f"{self.path}/days/{day}")

    def days(self) -> list[str]:
        return Manifest(self.spark, f"{self.path}/days").names(f"{self.path}/days")

    def live(self, day: str) -> list[dict]:
        return self._manifest(day).latest().get("segments", [])

    def _write(self, rows: DataFrame, name: str) -> dict[str, str]:
        """Store rows as one segment for each of their days."""
        day = F.coalesce(F.col("date").cast("string"), F.lit(NO_DAY))
        folder = f"{self.path}/data/{name}-{uuid.uuid4().hex}"
        rows.withColumn(_DAY, day).hint("rebalance", _DAY).write.partitionBy(_DAY).parquet(folder)
        found = Manifest(self.spark, folder).names(folder)
        return {n.partition("=")[2]: f"{folder}/{n}" for n in found if n.startswith(f"{_DAY}=")}

    def _commit(self, day: str, segments: Sequence[dict], schema: str) -> None:
        self._manifest(day).commit({"segments": list(segments), "folders": [s["folder"] for s in segments], "schema": schema})

    def add(self, batch: int, rows: DataFrame, merge: Callable[[DataFrame], DataFrame]) -> list[str]:
        """Add a batch's rows, then merge what has gathered; returns the days of the batch. Adding a batch again replaces it.

        `merge` brings rows of equal key together and keeps their columns.
        """
        schema = rows.schema.json()
        placed = self._write(rows, f"batch-{batch}")
        full: dict[str, list[dict]] = {}
        for day, folder in placed.items():
            before = self.live(day)
            if any(s["level"] and s["first"] <= batch <= s["last"] for s in before):
                continue  # merged long ago: it is no batch that could be repeated with other rows
            segments = [s for s in before if s["first"] != batch or s["level"]]
            segments.append({"folder": folder, "first": batch, "last": batch, "level": 0})
            self._commit(day, segments, schema)
            if due := self._due([s for s in segments if s["last"] < batch]):
                full[day] = due
        if full:
            self._merge(batch, full, schema, merge)
        return sorted(placed)

    def _due(self, segments: list[dict]) -> list[dict]:
        """The segments to merge: those of the lowest full level, and of the levels above that this fills."""
        due: list[dict] = []
        for level in range(1 + max((s["level"] for s in segments), default=-1)):
            own = [s for s in segments if s["level"] == level]
            if len(own) + bool(due) < self.fan_in:
                if due:
                    break
                continue
            due += own
        return due

    def _merge(self, batch: int, full: dict[str, list[dict]], schema: str, merge: Callable[[DataFrame], DataFrame]) -> None:
        """One job merges what is due on all days; each day's list of segments is then swapped."""
        folders = [s["folder"] for due in full.values() for s in due]
        stored = self._read(folders, schema)
        rows = merge(stored).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in stored.schema])
        merged = self._write(rows, f"merged-{batch}")
        for day, due in full.items():
            gone = {s["folder"] for s in due}
            new = {"folder": merged[day], "first": min(s["first"] for s in due), "last": max(s["last"] for s in due), "level": 1 + max(s["level"] for s in due)}
            self._commit(day, [s for s in self.live(day) if s["folder"] not in gone] + [new], schema)

    def _read(self, folders: list[str], schema: str) -> DataFrame:
        return self.spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(*folders)

    def read(self, days: Sequence[str] | None = None) -> DataFrame | None:
        """Rows of the live segments of the given days, or of all; None if there are none."""
        states = [state for day in (self.days() if days is None else days) if (state := self._manifest(day).latest())]
        folders = [f for state in states for f in state["folders"]]
        return self._read(folders, states[-1]["schema"]) if folders else None
