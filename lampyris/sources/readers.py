"""Scans: Parquet, JSON lines with a declared schema, catalog tables, topics."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lampyris.contracts import FactContract


def text_schema(contract: FactContract, extra: tuple[str, ...] = ()) -> T.StructType:
    """The contract's columns as text; typing and rejecting happen downstream."""
    return T.StructType([T.StructField(name, T.StringType()) for name in (*contract.columns, *extra)])


def parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def json_lines(spark: SparkSession, path: str, contract: FactContract) -> DataFrame:
    """Raw events in one pass: no inference scan, undeclared keys are not read.

    Project with ``fill_nulls=True``: with a declared schema an absent key reads
    as NULL and takes the field default.
    """
    return spark.read.schema(text_schema(contract)).json(path)


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def between_dates(
    frame: DataFrame, start: date | str | None = None, end: date | str | None = None, column: str = "date", or_undated: bool = False
) -> DataFrame:
    """Inclusive range on the partition column, so partitions outside are not listed; ``or_undated`` keeps rows without a date."""
    day, inside = F.col(column), None
    for bound, holds in ((start, day.__ge__), (end, day.__le__)):
        if bound is not None:
            condition = holds(F.lit(str(bound)).cast("date"))
            inside = condition if inside is None else inside & condition
    if inside is None:
        return frame
    return frame.where(inside | day.isNull() if or_undated else inside)


def topic_stream(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Messages of a topic as text column ``value`` (needs the connector on the classpath)."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return reader.options(**options).load().selectExpr("cast(value as string) as value")


def file_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Messages from text files, one JSON object per line."""
    reader = spark.readStream.format("text")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def parse_messages(messages: DataFrame, contract: FactContract, extra: tuple[str, ...] = ()) -> DataFrame:
    """Typed columns of JSON messages; unparsable messages are dropped, absent keys are NULL."""
    schema = text_schema(contract, extra).add("_broken", T.StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    parsed = messages.select(F.from_json("value", schema, options).alias("m"))
    return parsed.where("m is not null and m._broken is null").select("m.*").drop("_broken")
