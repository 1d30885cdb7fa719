"""Exact length histogram: what every context limit costs (operator 1).

Each task counts its documents by encoded length, the counts are added up, and running sums over the histogram answer
totals, quantiles and truncated totals for all limits at once. The sums go in two levels (within blocks of 1,024 lengths, and over blocks),
so no task holds more than the block totals.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lampyris.llm.scratch import materialise
from lampyris.llm.tokens import VOCABULARY, Ids

BLOCK = 1024


def length_histogram(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(length, n_docs): documents by their number of tokens. Null and empty texts have length 0; no rows give none."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, seen = Ids(vocabulary), Counter()
        for batch in batches:
            for text in batch.column("text"):
                seen[len(ids.of(text.as_py())) // 4] += 1
        yield pa.record_batch({"length": pa.array(list(seen), pa.int64()), "n_docs": pa.array(list(seen.values()), pa.int64())})

    counted = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "length long, n_docs long")
    return counted.groupBy("length").agg(F.sum("n_docs").alias("n_docs"))


def context_limits(histogram: DataFrame) -> DataFrame:
    """One row for each length that occurs, taken as a limit.

    docs_within and tokens_within: documents of at most so many tokens; docs_over and tokens_over: the longer ones;
    truncated_tokens: all tokens left if longer documents are cut at the limit; quantile: share of documents within.
    """
    histogram = materialise(histogram, "lengths").withColumn("block", F.floor(F.col("length") / BLOCK))
    docs, tokens = F.col("n_docs"), F.col("n_docs") * F.col("length")
    blocks = histogram.groupBy("block").agg(F.sum(docs).alias("docs"), F.sum(tokens).alias("tokens"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    blocks = blocks.select(
        "block", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("docs", "tokens")),
        *(F.sum(c).over(every).alias(f"all_{c}") for c in ("docs", "tokens")),
    )
    upto = Window.partitionBy("block").orderBy("length")
    return (
        histogram.join(blocks, "block")
        .withColumn("docs_within", F.col("docs_before") + F.sum(docs).over(upto))
        .withColumn("tokens_within", F.col("tokens_before") + F.sum(tokens).over(upto))
        .select(
            "length", "n_docs", "docs_within", "tokens_within",
            (F.col("all_docs") - F.col("docs_within")).alias("docs_over"),
            (F.col("all_tokens") - F.col("tokens_within")).alias("tokens_over"),
            (F.col("tokens_within") + F.col("length") * (F.col("all_docs") - F.col("docs_within"))).alias("truncated_tokens"),
            (F.col("docs_within") / F.col("all_docs")).alias("quantile"),
        )
    )


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """(limit, docs_over, truncated_tokens) of any limits, whether or not a document has that length."""
    each = F.explode(F.array(*(F.lit(int(x)).cast("long") for x in limits))).alias("limit")
    return histogram.select("length", "n_docs", each).groupBy("limit").agg(
        F.coalesce(F.sum(F.when(F.col("length") > F.col("limit"), F.col("n_docs"))), F.lit(0)).alias("docs_over"),
        F.sum(F.least("length", "limit") * F.col("n_docs")).alias("truncated_tokens"),
    )
