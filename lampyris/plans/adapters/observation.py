"""Rules shared by the generation and trace adapters.

``record`` is the SQL name of a VARIANT holding one observation and ``md`` its
merged metadata (map of text).  ``read`` says how they are read, if the record
is a structure of its values.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from lampyris.functions.documents import first_of, instant, integer, integer_in, integer_of, layered, one_of, real, text, text_map

# --- Fixed values: accepted spellings ---------------------------------------
START = ("startTime", "start_time", "timestamp", "createdAt", "created_at")
END = ("endTime", "end_time")
TYPE = ("type", "observationType", "observation_type")
USAGE = ("usageDetails", "usage", "usage_details")
TOKEN_NAMES = {
    "prompt": ("prompt_tokens", "input_tokens", "promptTokens", "input"),
    "completion": ("completion_tokens", "output_tokens", "completionTokens", "output"),
    "total": ("total_tokens", "totalTokens", "total"),
}
COST = ("costDetails.total", "costDetails.totalCost", "cost_details.total", "totalCost")
METADATA_COST = ("estimated_cost_usd", "total_cost_usd")
LEVEL = ("level",)
STATUS = ("status",)
ERROR = ("error_type", "error")
MESSAGE = ("statusMessage", "status_message")


class Reading(NamedTuple):
    """How the first value of several names is read, in a record and in its metadata."""

    first: Callable[..., str] = first_of
    layered: Callable[..., str] = layered


def metadata_parts(record: str) -> tuple[str, str]:
    """An observation's metadata and that of the trace it embeds, as maps."""
    return text_map(record, "metadata"), text_map(record, "trace.metadata")


def start_time(record: str, read: Reading = Reading()) -> str:
    return instant(read.first(record, *START))


def end_time(record: str, read: Reading = Reading()) -> str:
    return instant(read.first(record, *END))


def token_paths(kind: str) -> list[str]:
    return [f"{container}.{name}" for container in USAGE for name in TOKEN_NAMES[kind]]


def tokens(record: str, md: str, kind: str) -> str:
    paths = token_paths(kind)
    stated, assumed = first_of(record, *paths), integer(layered(md, *TOKEN_NAMES[kind]))
    return f"if(({stated}) is null, {assumed}, {integer_of(record, *paths)})"


def tokens_in(held: str, md: str, kind: str, read: Reading) -> str:
    """``tokens`` where the JSON text of the stated count is a column."""
    return f"if({held} is null, {integer(read.layered(md, *TOKEN_NAMES[kind]))}, {integer_in(held)})"


def cost(record: str, md: str, read: Reading = Reading()) -> str:
    given, estimate = read.first(record, *COST), read.layered(md, *METADATA_COST)
    return f"coalesce(if(({given}) is not null, {real(given, 0.0)}, {real(estimate)}), 0D)"


def cost_source(record: str, md: str, read: Reading = Reading()) -> str:
    given, estimate = read.first(record, *COST), read.layered(md, *METADATA_COST)
    return (
        f"case when ({given}) is not null then 'langfuse_cost_details' "
        f"when ({estimate}) is not null then 'metadata_estimate' else 'default_zero' end"
    )


def status(record: str, md: str) -> str:
    return status_in(stated_status(md), record)


def stated_status(md: str, read: Reading = Reading()) -> str:
    return f"lower({text(read.layered(md, *STATUS))})"


def status_in(stated: str, record: str, read: Reading = Reading()) -> str:
    level = f"lower({text(read.first(record, *LEVEL))})"
    return f"case when {stated} in ('success', 'error') then {stated} when {level} in ('error', 'fatal') then 'error' else 'success' end"


def error_type(record: str, md: str, status_sql: str, fallback: str = "generation_error", read: Reading = Reading()) -> str:
    stated = f"nullif({text(read.layered(md, *ERROR))}, '')"
    message = text(read.first(record, *MESSAGE), fallback)
    return f"case when {status_sql} = 'error' then coalesce({stated}, {message}) end"


def missing(prefix: str, fields: Sequence[str]) -> list[tuple[str, str]]:
    """(condition, label) pairs for absent or empty fields."""
    stem = f"completeness:missing_{prefix}_" if prefix else "completeness:missing_"
    return [(f"coalesce(cast({f} as string), '') = ''", f"{stem}{f}") for f in fields]


def labels(checks: Sequence[tuple[str, str]]) -> str:
    """Array of the labels whose condition is true."""
    return "array_compact(array(" + ", ".join(f"case when {cond} then '{label}' end" for cond, label in checks) + "))"


def labels_if_any(checks: Sequence[tuple[str, str]]) -> str:
    """``labels`` over plain columns, where an array is built only for a row that breaks a rule."""
    broken = " or ".join(f"({cond})" for cond, _ in checks)
    return f"if({broken}, {labels(checks)}, cast(array() as array<string>))"
