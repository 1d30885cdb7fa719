"""Privacy columns: text leaves the raw layer only as hash and length."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def hash_or_empty(text: Column) -> Column:
    return F.when(F.length(text) > 0, F.sha2(text, 256)).otherwise(F.lit(""))


def hashed_ip(ip: Column, salt: str = "") -> Column:
    """sha256 of ``salt:ip``."""
    return F.sha2(F.concat(F.lit(f"{salt}:"), ip), 256)
