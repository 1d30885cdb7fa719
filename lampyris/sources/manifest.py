"""Versioned lists of the folders that make up a table, swapped as a whole.

Data folders are written once and never changed. A version is a small JSON file that names the live ones; it is written under another name and then
renamed, so a reader sees one version or the next. A table has one writer at a time, as a streaming query has by its checkpoint.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

#: Versions whose data stays for readers that began with them.
KEPT = 3


class Manifest:
    """The versions under one folder of any file system that Spark writes to."""

    def __init__(self, spark: SparkSession, path: str):
        self.path, self._jvm = path, spark._jvm
        self._fs = self._at(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def names(self, path: str) -> list[str]:
        """What a folder holds; nothing if it is not there."""
        at = self._at(path)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def versions(self) -> list[int]:
        return [int(n[:-5]) for n in self.names(self.path) if n.endswith(".json")]

    def read(self, version: int) -> dict:
        stream = self._fs.open(self._at(f"{self.path}/{version:010d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self) -> dict:
        """The newest version; empty before the first."""
        known = self.versions()
        return self.read(known[-1]) if known else {}

    def commit(self, state: dict) -> None:
        """Make `state` the newest version and drop versions, and data folders named by "folders", that no kept version needs."""
        known = self.versions()
        version = known[-1] + 1 if known else 0
        target, pending = (self._at(f"{self.path}/{n}") for n in (f"{version:010d}.json", f".{uuid.uuid4().hex}"))
        stream = self._fs.create(pending)
        stream.write(bytearray(json.dumps(state), "utf-8"))
        stream.close()
        if self._fs.exists(target) or not self._fs.rename(pending, target):
            raise RuntimeError(f"version {version} of {self.path} was written by another query")
        old, kept = known[: 1 - KEPT], known[1 - KEPT :]
        if old:
            needed = set(state["folders"]).union(*(self.read(v)["folders"] for v in kept))
            for v in old:
                for folder in set(self.read(v)["folders"]) - needed:
                    self._fs.delete(self._at(folder), True)
                self._fs.delete(self._at(f"{self.path}/{v:010d}.json"), False)
