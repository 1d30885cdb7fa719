"""Documents to packed training sequences, one operator of `lampyris.llm` for each stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lampyris.llm.fertility import accepted
from lampyris.llm.mixing import mixed
from lampyris.llm.ngram_join import without_similar
from lampyris.llm.packing import pack, token_pieces
from lampyris.llm.scratch import materialise
from lampyris.llm.secrets import redacted


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the fertility bands keep."""
    return accepted(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near copies."""
    return without_similar(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark. n_chars stays that of the source."""
    return redacted(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that every source has the same share of the text, in random order."""
    return mixed(docs).select(docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each document's pieces in sequences of 1024 tokens."""
    return pack(token_pieces(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("secret scans", secret_scans),
    ("mixing sources to target weights", source_mixing),
    ("best-fit packing", best_fit_packing),
]
#: No SQL has the forest of the secret scan or the vocabularies; the tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over `documents`; each is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
