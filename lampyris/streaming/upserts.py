"""Keyed table of base and delta files: writes are small, reads merge, compaction touches only buckets that have changed.

Rows are dealt by a hash of the key into a fixed number of buckets. A batch of changes is stored as a delta. Each bucket has at most one base, with one row per
key; `compact` merges the deltas of a bucket into a new base beside the old one and then swaps the manifest, so a reader keeps the version it began with
and buckets without deltas are not read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lampyris.operators.keyed import latest_by_key
from lampyris.sources.manifest import Manifest

BATCH = "_batch"
_BUCKET = "_bucket"
BUCKETS = 64


class UpsertTable:
    """The greatest `version` per key is current, later batches win ties."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], version: Sequence[str] = (), buckets: int = BUCKETS):
        self.spark, self.path, self.keys, self.version = spark, path, tuple(keys), tuple(version)
        self.manifest = Manifest(spark, f"{path}/versions")
        self.buckets = self.manifest.latest().get("buckets", buckets)

    def _latest(self, rows: DataFrame) -> DataFrame:
        return latest_by_key(rows, self.keys, (*self.version, BATCH))

    def _write(self, rows: DataFrame, name: str) -> dict[str, str]:
        """Store rows by bucket; returns the folder of each bucket that has any."""
        folder = f"{self.path}/data/{name}-{uuid.uuid4().hex}"
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets))
        rows.withColumn(_BUCKET, bucket).hint("rebalance", _BUCKET).write.partitionBy(_BUCKET).parquet(folder)
        found = Manifest(self.spark, folder).names(folder)
        return {n.partition("=")[2]: f"{folder}/{n}" for n in found if n.startswith(f"{_BUCKET}=")}

    def _commit(self, base: dict[str, str], deltas: list[dict], schema: str) -> None:
        folders = [*base.values(), *(f for d in deltas for f in d["folders"].values())]
        self.manifest.commit({"buckets": self.buckets, "base": base, "deltas": deltas, "schema": schema, "folders": folders})

    def add(self, batch: int, changes: DataFrame) -> None:
        """Store a batch of changes; adding it again replaces it."""
        rows = self._latest(changes.withColumn(BATCH, F.lit(batch).cast("long")))
        folders = self._write(rows, f"delta-{batch}")
        now = self.manifest.latest()
        deltas = [d for d in now.get("deltas", []) if d["batch"] != batch]
        self._commit(now.get("base", {}), [*deltas, {"batch": batch, "folders": folders}], rows.schema.json())

    def _read(self, folders: Sequence[str], schema: str) -> DataFrame:
        return self.spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(*folders)

    def current(self) -> DataFrame | None:
        """The current row of each key, with the batch that wrote it, as of now; None before the first batch.

        Bases of buckets without deltas hold one row per key and are taken as they are; only the others are merged.
        """
        return self._as_of(self.manifest.latest())

    def _as_of(self, state: dict) -> DataFrame | None:
        if not state:
            return None
        touched = {b for d in state["deltas"] for b in d["folders"]}
        still = [f for b, f in state["base"].items() if b not in touched]
        mixed = [f for b, f in state["base"].items() if b in touched] + [f for d in state["deltas"] for f in d["folders"].values()]
        parts = ([self._read(still, state["schema"])] if still else []) + ([self._latest(self._read(mixed, state["schema"]))] if mixed else [])
        if not parts:
            return self.spark.createDataFrame([], T.StructType.fromJson(json.loads(state["schema"])))
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def compact(self) -> list[str]:
        """Merge all deltas into their buckets' bases; returns the buckets that were rewritten."""
        state = self.manifest.latest()
        touched = sorted({b for d in state.get("deltas", []) for b in d["folders"]}, key=int)
        if not touched:
            return []
        mixed = [state["base"][b] for b in touched if b in state["base"]] + [f for d in state["deltas"] for f in d["folders"].values()]
        folders = self._write(self._latest(self._read(mixed, state["schema"])), "base")
        self._commit(state["base"] | folders, [], state["schema"])
        return touched


def start_keyed_upsert(changes: DataFrame, table: UpsertTable, checkpoint: str, compact_every: int = 0, **trigger) -> StreamingQuery:
    """Store change rows batch by batch; with `compact_every`, that many deltas at most stand beside the bases."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        table.add(batch_id, batch)
        if compact_every and len(table.manifest.latest()["deltas"]) >= compact_every:
            table.compact()

    writer = changes.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
