"""Streaming jobs: validated facts, hourly windows, continuous daily summaries.

Every sink writes one directory per (date, batch): a batch that is repeated
after a failure replaces exactly its own directories, which together with the
source checkpoint gives each row effect once.  Updating summaries keep mergeable
states in a log-structured store (`segments.py`) and recompute only the dates a
batch touches from its few live segments.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lampyris.contracts import CONTRACTS
from lampyris.operators.keyed import latest_by_key
from lampyris.operators.quality import STATUS, VALID
from lampyris.operators.rollup import Rollup
from lampyris.plans import facts, summaries
from lampyris.sources import writers
from lampyris.streaming.segments import Segments

BATCH = "_batch"
WATERMARK = "5 seconds"


def append_batch(rows: DataFrame, batch_id: int, path: str, by: Sequence[str] = ("date",)) -> None:
    """Append a micro-batch so that repeating it changes nothing."""
    writers.overwrite_dates(rows.withColumn(BATCH, F.lit(batch_id)), path, by=(*by, BATCH))


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path)


def _start(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, **trigger) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def dates_of(batch: DataFrame) -> list:
    """Days a batch touches, None for rows without one; a batch spans few days however many rows it has."""
    return sorted((row[0] for row in batch.select("date").distinct().collect()), key=lambda d: (d is not None, d))


def on_dates(rows: DataFrame, dates: Sequence) -> DataFrame:
    """Rows of the given days; None stands for rows without a date."""
    wanted = F.col("date").isin([d for d in dates if d is not None])
    return rows.where(wanted | F.col("date").isNull() if None in dates else wanted)


# -- stateless: messages to facts --------------------------------------------


def start_fact(messages: DataFrame, fact: str, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Typed, validated rows; valid and rejected rows land side by side by status."""
    checked = facts.validated(messages, fact, fill_nulls=True, null_fails=True)

    def handle(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch, batch_id, path, by=(STATUS, "date"))

    return _start(checked, handle, checkpoint, **trigger)


def stored_fact(spark: SparkSession, fact: str, path: str) -> DataFrame:
    stored = T.StructType(list(CONTRACTS[fact].schema.fields)).add(STATUS, T.StringType()).add(BATCH, T.LongType())
    return spark.read.schema(stored).parquet(path).where(F.col(STATUS) == VALID).drop(STATUS)


def start_topic_copy(messages: DataFrame, servers: str, topic: str, key: str, checkpoint: str) -> StreamingQuery:
    """Pass change rows through to a keyed topic (needs the connector)."""
    payload = messages.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))
    writer = payload.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
    return writer.option("checkpointLocation", checkpoint).start()


def start_file_copy(messages: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """The same pass-through to JSON files."""
    rows = messages.select(F.to_json(F.struct("*")).alias("value"))
    writer = rows.writeStream.format("text").option("path", path).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


# -- windowed: closed hours ----------------------------------------------------


def hourly_partials(requests: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Per closed event-time hour, additive parts by latency value.

    State is keyed by hour, dimensions and latency, so a busy dimension is
    spread over the state partitions.
    """
    rollup = summaries.FEATURE_HOURLY
    timed = requests.withWatermark("created_at", watermark)
    grain = [F.window("created_at", "1 hour").alias("_window"), *rollup.keys[2:], F.col("latency_ms").alias("_value")]
    parts = [F.count(F.lit(1)).alias("_rows")]
    parts += [F.expr(sql).alias(name) for m in rollup.measures for name, sql, _ in m.parts]
    closed = timed.groupBy(*grain).agg(*parts)
    return closed.withColumns(
        {"date": F.to_date("_window.start"), "hour": F.hour("_window.start")}
    ).drop("_window")


def start_hourly(requests: DataFrame, path: str, checkpoint: str, watermark: str = WATERMARK, **trigger) -> StreamingQuery:
    """Hourly feature summary of closed hours, exact percentiles included.

    All parts of an hour leave the state in the same batch, so finishing the
    roll-up inside the batch is complete.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        append_batch(summaries.FEATURE_HOURLY.finish(batch), batch_id, path)

    return _start(hourly_partials(requests, watermark), handle, checkpoint, **trigger)


def daily_from_hourly(spark: SparkSession, hourly_path: str) -> DataFrame:
    """Daily roll-up over the hourly rows written so far."""
    return summaries.feature_daily_from_hourly(read_appended(spark, hourly_path).drop(BATCH))


# -- updating: daily summaries ---------------------------------------------------


def start_rollup(
    rows: DataFrame, rollup: Rollup, partials_path: str, summary_path: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Continuously updated daily summary of one fact.

    A batch adds its states to a log-structured store and re-finishes the days
    it touched from the few live segments of each; facts are never read again.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        store = Segments(batch.sparkSession, partials_path)
        if days := store.add(batch_id, rollup.state(batch), rollup.merge):
            writers.overwrite_dates(rollup.result(store.read(days)), summary_path)

    return _start(rows, handle, checkpoint, **trigger)


def start_recompute(
    rows: DataFrame,
    fact_path: str,
    fact: str,
    build: Callable[[DataFrame, Sequence], DataFrame],
    summary_path: str,
    checkpoint: str,
    **trigger,
) -> StreamingQuery:
    """Summaries that join several facts: store the batch, rebuild its dates.

    ``build`` gets the stored fact limited to the touched dates and the dates
    themselves, and returns the summary rows for them.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch.withColumn(STATUS, F.lit(VALID)), batch_id, fact_path, by=(STATUS, "date"))
        stored = stored_fact(batch.sparkSession, fact, fact_path)
        touched = dates_of(stored.where(F.col(BATCH) == batch_id))
        if touched:
            writers.overwrite_dates(build(on_dates(stored, touched).drop(BATCH), touched), summary_path)

    return _start(rows, handle, checkpoint, **trigger)


# -- keyed upsert ---------------------------------------------------------------


def start_upsert(changes: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Store change rows; the current row per key is taken when reading."""
    return _start(changes, lambda batch, batch_id: append_batch(batch, batch_id, path), checkpoint, **trigger)


def current_rows(spark: SparkSession, path: str, keys: Sequence[str], version: Sequence[str] = ()) -> DataFrame:
    """Last write per key: the greatest version, later batches winning ties."""
    return latest_by_key(read_appended(spark, path), keys, (*version, BATCH)).drop(BATCH)


def compact(spark: SparkSession, path: str, target: str, keys: Sequence[str], version: Sequence[str] = ()) -> None:
    """Rewrite the change rows of ``path`` as one row per key under ``target``.

    The target is replaced as a whole: a key whose date has changed leaves no
    copy under the old date.
    """
    rows = current_rows(spark, path, keys, version).hint("rebalance", "date")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("date").parquet(target)
