"""Raw events to typed facts, and values derived on the way."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lampyris.contracts import CONTRACTS
from lampyris.operators import quality

# List prices of the default model, USD per million tokens (input, output).
DEFAULT_PRICES = (0.14, 0.28)


def typed(raw: DataFrame, fact: str, fill_nulls: bool = False) -> DataFrame:
    return CONTRACTS[fact].project(raw, fill_nulls)


def validated(raw: DataFrame, fact: str, fill_nulls: bool = False, null_fails: bool = False) -> DataFrame:
    return quality.validate(typed(raw, fact, fill_nulls), CONTRACTS[fact], null_fails)


def valid(raw: DataFrame, fact: str, fill_nulls: bool = False, null_fails: bool = False) -> DataFrame:
    return quality.keep_valid(typed(raw, fact, fill_nulls), CONTRACTS[fact], null_fails)


def with_estimated_cost(
    requests: DataFrame, models: DataFrame, default_prices: tuple[float, float] = DEFAULT_PRICES
) -> DataFrame:
    """Cost from list prices per million tokens; unknown models take the default prices."""
    prices = models.select(
        "model_name",
        F.col("input_price_per_1m_tokens").alias("_in"),
        F.col("output_price_per_1m_tokens").alias("_out"),
    )
    priced = requests.join(prices, "model_name", "left")
    million = F.lit(1_000_000)
    default_in, default_out = (F.lit(float(p)) for p in default_prices)
    cost = F.col("prompt_tokens") / million * F.coalesce("_in", default_in) + F.col(
        "completion_tokens"
    ) / million * F.coalesce("_out", default_out)
    return priced.withColumn("estimated_cost_usd", F.round(cost, 8)).drop("_in", "_out")


def knowledge_base_dimension(retrievals: DataFrame) -> DataFrame:
    """Latest known name per knowledge base, derived from its requests."""
    latest = F.struct("created_at", "knowledge_base_name")
    return (
        retrievals.where(F.col("knowledge_base_id").isNotNull())
        .groupBy("knowledge_base_id")
        .agg(
            F.max(latest)["knowledge_base_name"].alias("knowledge_base_name"),
            F.max("created_at").alias("last_updated_at"),
        )
        .select(
            "knowledge_base_id",
            F.coalesce("knowledge_base_name", F.lit("")).alias("knowledge_base_name"),
            F.lit("unknown").alias("knowledge_base_type"),
            F.lit(0).cast("bigint").alias("document_count"),
            F.lit("").alias("owner_team"),
            "last_updated_at",
            F.lit("active").alias("status"),
        )
    )


def guardrail_rule_dimension(checks: DataFrame) -> DataFrame:
    """Latest category and severity per rule, derived from its checks."""
    latest = F.max(F.struct("created_at", "rule_category", "severity"))
    return (
        checks.where(F.col("rule_name").isNotNull())
        .groupBy("rule_name")
        .agg(latest.alias("_latest"))
        .select(
            "rule_name",
            F.col("_latest.rule_category").alias("rule_category"),
            F.col("_latest.severity").alias("default_severity"),
            F.lit("").alias("owner_team"),
            F.lit(None).cast("string").alias("description"),
            F.lit("active").alias("status"),
        )
    )
