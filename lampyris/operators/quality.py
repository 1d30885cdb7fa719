"""Row validation, the valid/rejected split and status counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lampyris.contracts import FactContract, Rule, sql_literal

ERRORS = "_dq_errors"
STATUS = "_dq_status"
VALID = "valid"
REJECTED = "quarantine"


def _holds(rule: Rule, null_fails: bool) -> str:
    """A rule whose NULL outcome passes (batch) or fails (streaming)."""
    return f"coalesce({rule.predicate}, {'false' if null_fails else 'true'})"


def failed_labels(rules: tuple[Rule, ...], null_fails: bool = False) -> Column:
    """Array of labels of the rules a row breaks.

    A predicate that evaluates to NULL passes by default (batch convention);
    ``null_fails`` treats it as broken (streaming convention).
    """
    marks = [f"case when not {_holds(rule, null_fails)} then {sql_literal(rule.label)} end" for rule in rules]
    return F.expr(f"array_compact(array({', '.join(marks)}))") if marks else F.expr("cast(array() as array<string>)")


def validate(facts: DataFrame, contract: FactContract, null_fails: bool = False) -> DataFrame:
    """Add the broken-rule labels and the resulting status to every row."""
    labelled = facts.withColumn(ERRORS, failed_labels(contract.rules, null_fails))
    return labelled.withColumn(STATUS, F.when(F.size(ERRORS) > 0, F.lit(REJECTED)).otherwise(F.lit(VALID)))


def split(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two disjoint parts: valid rows without markers, rejected rows with them."""
    accepted = validated.where(F.col(STATUS) == VALID).drop(STATUS, ERRORS)
    return accepted, validated.where(F.col(STATUS) == REJECTED)


def keep_valid(facts: DataFrame, contract: FactContract, null_fails: bool = False) -> DataFrame:
    """Valid rows only, as one plain filter: no error array is built."""
    holds = " and ".join(_holds(rule, null_fails) for rule in contract.rules)
    return facts.where(holds) if holds else facts


def status_counts(validated: DataFrame) -> DataFrame:
    """Rows per status of a validated or stored fact."""
    return validated.groupBy(STATUS).agg(F.count(F.lit(1)).alias("row_count"))


def with_source_evidence(
    rejected: DataFrame, system: str, entity: Column | str, source_id: Column, trace_id: Column | None, payload_hash: Column
) -> DataFrame:
    """Columns that let a rejected external record be traced to its payload."""
    out = rejected.withColumn("_source_system", F.lit(system))
    out = out.withColumn("_source_entity", F.lit(entity) if isinstance(entity, str) else entity)
    out = out.withColumn("_source_id", source_id)
    if trace_id is not None:
        out = out.withColumn("_source_trace_id", trace_id)
    return out.withColumn("_source_payload_hash", payload_hash)
