"""Best-two-fit packing of documents into token sequences (operator 5).

A bin is filled greedily, each time with the longest document that still fits; then its smallest document is replaced by
the two unpacked ones that fill the gap it leaves more tightly, if there are such. Documents of one length are alike, so bins are
planned on the histogram of lengths: at most `capacity` counts reach the driver, whatever the corpus. Each plan step is
repeated as often as its lengths last. A document finds its place by its rank among those of its length.
"""

from __future__ import annotations

import gc
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lampyris.llm.cache import hand_back
from lampyris.llm.scratch import materialise
from lampyris.llm.tokens import VOCABULARY, Ids

CAPACITY, END = 1024, 2
#: Rows of one length that one window group should hold.
RANKED = 1_000_000


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best-two-fit on a histogram: (documents of each length in a bin, number of such bins)."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    lengths = np.arange(capacity + 1)
    plan = []
    while left.any():
        bin_: dict[int, int] = {}
        gap = capacity
        while len(fit := np.flatnonzero(left[: gap + 1])):
            longest = int(fit[-1])
            k = min(int(left[longest]), gap // longest)
            bin_[longest] = k
            left[longest] -= k
            gap -= k * longest
        smallest = min(bin_)
        if gap:
            # Two unpacked documents for the smallest one: for each a, the longest b that fits beside it.
            room = gap + smallest
            upto = np.maximum.accumulate(np.where(left > 0, lengths, 0))
            a = np.flatnonzero(left[: room + 1])
            b = upto[room - a]
            twin = b == a
            b[twin & (left[a] < 2)] = upto[np.maximum(a[twin & (left[a] < 2)] - 1, 0)]
            both = np.where(b > 0, a + b, 0)
            if len(both) and both.max() > smallest:
                best = int(np.argmax(both))
                bin_[smallest] -= 1
                left[smallest] += 1
                for x in (int(a[best]), int(b[best])):
                    bin_[x] = bin_.get(x, 0) + 1
                    left[x] -= 1
        bin_ = {x: k for x, k in bin_.items() if k}
        more = min(int(left[x]) // k for x, k in bin_.items())
        for x, k in bin_.items():
            left[x] -= more * k
        plan.append((bin_, more + 1))
    return plan


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, end: int = END, ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and the ids, if asked for) of every document, whole or cut.

    A document's ids are closed by `end`. One of more than `capacity` ids is cut so that all pieces but the first are full.
    A null text is empty: its one piece holds `end` alone.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Ids(vocabulary)
        names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * ids]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * ids]

        def made(rows: list[tuple]) -> pa.RecordBatch:
            return pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)

        for batch in batches:
            rows, held = [], 0
            for doc, text in zip(batch.column("doc_id"), batch.column("text")):
                own = encoder.of(text.as_py()) + end.to_bytes(4, "little")
                n = len(own) // 4
                start = 0
                for piece in range(-(-n // capacity)):
                    stop = n - capacity * (-(-n // capacity) - 1 - piece)
                    part = own[4 * start : 4 * stop]
                    rows.append((doc.as_py(), piece, start, stop - start, zlib.crc32(part), *[part] * ids))
                    start = stop
                held += len(own)
                if ids and held > 16 << 20:
                    yield made(rows)
                    rows, held = [], 0
            yield made(rows)
        # The encoder and its cache refer to each other, so they would stay until a full collection.
        del encoder
        gc.collect()
        hand_back()

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(cut, schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`pieces` (doc_id, piece, length and any others) with sequence_id and offset, in as few sequences as best-two-fit makes.

    Equal rows each get a place. No rows give no sequences.
    """
    pieces = materialise(pieces, "pieces")
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    slots, taken, sequence = [], dict.fromkeys(counts, 0), 0
    for bin_, times in plan_bins(counts, capacity):
        offset = 0
        for length, k in bin_.items():
            slots.append((length, taken[length], taken[length] + k * times, k, sequence, offset))
            taken[length] += k * times
            offset += k * length
        sequence += times
    spark = pieces.sparkSession
    slots = spark.createDataFrame(slots, "length long, low long, high long, k long, base long, at long")

    salts = 64 + sum(counts.values()) // RANKED
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    groups = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece")
    ranked = (
        salted.withColumn("own", F.row_number().over(own)).join(groups, ["length", "salt"])
        .withColumn("rank", F.col("before") + F.col("own") - 1).drop("salt", "own", "before")
    )
    r, s = ranked.alias("r"), F.broadcast(slots).alias("s")  # fewer than 4 plan steps for each length
    placed = r.join(s, F.expr("r.length = s.length and r.rank >= s.low and r.rank < s.high"))
    turn = F.col("rank") - F.col("low")
    return placed.select(
        *(F.col(f"r.{c}") for c in pieces.columns),
        (F.col("base") + F.floor(turn / F.col("k"))).alias("sequence_id"),
        (F.col("at") + turn % F.col("k") * F.col("r.length")).alias("offset"),
    )
