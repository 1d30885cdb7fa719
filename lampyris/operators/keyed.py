"""Last write wins per primary key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by_key(changes: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """The row with the greatest version per key.

    A maximum combines on the map side, so a key with very many versions is a
    handful of rows per task rather than one long window.
    """
    ordering = F.struct(*version)
    payload = F.struct(*[c for c in changes.columns if c not in keys])
    latest = changes.groupBy(*keys).agg(F.max_by(payload, ordering).alias("_row"))
    return latest.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in changes.columns])
