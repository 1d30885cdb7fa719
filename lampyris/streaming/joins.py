"""Continuous summaries that join two facts, kept by what changes.

Everything known about one request or one session is a small state in Spark's state store. A row changes the state of its key; the difference
between what the state adds to the summary after and before the batch goes to a log-structured store of sums. So a late conflict or evaluation takes back
what was attributed earlier, and a batch costs what it holds, not what its day holds. With `keep`, states are forgotten that long after their last change while
the sums stay; such a query never runs out of batches, so it suits a processing-time trigger and not `availableNow`. For very many keys set Spark's RocksDB state store provider.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from datetime import date, timedelta
from decimal import Decimal
from threading import Lock

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lampyris.functions.numeric import is_blank, or_unknown
from lampyris.plans import summaries
from lampyris.sources import writers
from lampyris.streaming.segments import Segments

_KEY = "_key"


def changes(
    rows: DataFrame, keys: Sequence[str], fold: Callable[[dict | None, pd.DataFrame], dict],
    contribution: Callable[[dict, dict], dict[tuple, list]], output: T.StructType, keep: timedelta | None = None,
) -> DataFrame:
    """What the rows of a stream change in the contributions of their keys.

    `fold` adds rows to a key's state, a JSON object (None at first). `contribution` gives, for a key's values by name and its state, the sums per
    tuple of dimensions. `output` names the dimensions and sums of the result; a tuple is returned only if one of its sums has changed.
    """
    names = output.fieldNames()

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        given = json.loads(key[0])  # nulls are left out
        values = {name: given.get(name) for name in keys}
        now = json.loads(state.get[0]) if state.exists else None
        before = contribution(values, now) if now is not None else {}
        for batch in batches:
            now = fold(now, batch)
        after = contribution(values, now)
        state.update((json.dumps(now),))
        if keep:
            state.setTimeoutDuration(int(keep.total_seconds() * 1000))
        out = []
        for dims in sorted({*before, *after}, key=str):
            old, new = before.get(dims), after.get(dims)
            size = len(new or old)
            delta = [(new[i] if new else 0) - (old[i] if old else 0) for i in range(size)]
            if any(delta):
                out.append((*dims, *delta))
        if out:
            yield pd.DataFrame(out, columns=names)

    keyed = rows.withColumn(_KEY, F.to_json(F.struct(*keys))).drop(*keys)
    timeout = GroupStateTimeout.ProcessingTimeTimeout if keep else GroupStateTimeout.NoTimeout
    return keyed.groupBy(_KEY).applyInPandasWithState(step, output, "state string", "append", timeout)


def _day(values: dict) -> date | None:
    return date.fromisoformat(values["date"]) if values["date"] else None


def _start(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict) -> StreamingQuery:
    writer = stream.writeStream.outputMode("append").foreachBatch(handle).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


# -- requests and evaluations: prompt versions ------------------------------------

_TRIPLE = ("prompt_id", "prompt_version", "model_name")
_PROMPT_SUMS = ("evaluation_cnt_1d", "pass_cnt_1d", "fail_cnt_1d", "evaluation_score_num_1d", "evaluation_score_den_1d", "metadata_conflict_cnt_1d")
_PROMPT_OUTPUT = T.StructType(
    [T.StructField("date", T.DateType()), *(T.StructField(c, T.StringType()) for c in _TRIPLE)]
    + [T.StructField(c, T.DecimalType(38, 18) if c == "evaluation_score_num_1d" else T.LongType()) for c in _PROMPT_SUMS]
)


def _fold_request(state: dict | None, rows: pd.DataFrame) -> dict:
    """Prompt keys seen for a request, and its judgments per evaluated version and model."""
    state = state or {"keys": [], "judged": {}}
    for r in rows.itertuples(index=False):
        named = [r.prompt_id, r.prompt_version, r.model_name]
        if r.is_request:
            if named not in state["keys"]:
                state["keys"].append(named)
            continue
        own = state["judged"].setdefault(json.dumps(named[1:]), [0, 0, 0, "0", 0])
        own[0] += 1
        own[1] += r.passed == "true"
        own[2] += r.passed == "false"
        if r.score is not None:
            own[3], own[4] = str(Decimal(own[3]) + Decimal(r.score)), own[4] + 1
    return state


def _attributed(values: dict, state: dict) -> dict[tuple, list]:
    """Judgments of a request go to its prompt key if it has one only, else to the evaluated version; several keys are a conflict on each."""
    day, out = _day(values), {}
    zero = [0, 0, 0, Decimal(0), 0, 0]
    for named, (n, passed, failed, score, scored) in state["judged"].items():
        dims = (day, *(state["keys"][0] if len(state["keys"]) == 1 else ["unknown", *json.loads(named)]))
        own = out.setdefault(dims, list(zero))
        for i, more in enumerate((n, passed, failed, Decimal(score), scored)):
            own[i] += more
    if len(state["keys"]) > 1:
        for key in state["keys"]:
            out.setdefault((day, *key), list(zero))[5] += 1
    return out


def _prompt_merge(rows: DataFrame) -> DataFrame:
    return rows.groupBy("date", *_TRIPLE).agg(*[F.sum(c).alias(c) for c in _PROMPT_SUMS])


def prompt_changes(requests: DataFrame, evaluations: DataFrame, keep: timedelta | None = None) -> DataFrame:
    """Changes of evaluations and conflicts per prompt key; rows that name no request or day are attributed as they come."""
    asked = summaries.with_prompt_names(requests).where(~is_blank(F.col("request_id")) & F.col("date").isNotNull()).select(
        "date", "request_id", *_TRIPLE, F.lit(True).alias("is_request"), F.lit(None).cast("string").alias("score"), F.lit(None).cast("string").alias("passed")
    )
    judged = evaluations.select(
        "date", "request_id", F.lit("unknown").alias("prompt_id"), or_unknown(F.col("evaluated_prompt_version")).alias("prompt_version"),
        or_unknown(F.col("evaluated_model_name")).alias("model_name"), F.lit(False).alias("is_request"),
        F.col("score").cast("decimal(28,18)").cast("string").alias("score"), F.col("passed").cast("string").alias("passed"),
    )
    loose = is_blank(F.col("request_id")) | F.col("date").isNull()
    kept = changes(asked.unionByName(judged.where(~loose)), ("date", "request_id"), _fold_request, _attributed, _PROMPT_OUTPUT, keep)
    one = lambda c: F.when(c, 1).otherwise(0).cast("long")
    at_once = judged.where(loose).select(
        "date", *_TRIPLE, F.lit(1).cast("long").alias("evaluation_cnt_1d"), one(F.col("passed") == "true").alias("pass_cnt_1d"), one(F.col("passed") == "false").alias("fail_cnt_1d"),
        F.coalesce(F.col("score").cast("decimal(38,18)"), F.lit(0).cast("decimal(38,18)")).alias("evaluation_score_num_1d"), one(F.col("score").isNotNull()).alias("evaluation_score_den_1d"),
        F.lit(0).cast("long").alias("metadata_conflict_cnt_1d"),
    )
    return kept.unionByName(at_once)


def start_prompt_versions(
    requests: DataFrame, evaluations: DataFrame, path: str, summary_path: str, checkpoint: str, keep: timedelta | None = None, **trigger
) -> list[StreamingQuery]:
    """The prompt version summary, kept up by two queries: one over requests, one over what evaluations and conflicts change.

    Each publishes the days it touched from both stores under `path`; one at a time, so that the last to publish has seen what both hold.
    """
    turn = Lock()

    def publish(daily: Segments, counts: Segments, days: Sequence[str]) -> None:
        with turn:
            asked = daily.read(days) if days else None
            if asked is None:
                return
            sums = counts.read(days)
            out = summaries.prompt_summary(summaries.PROMPT_REQUESTS.result(asked), None if sums is None else _prompt_merge(sums))
            writers.overwrite_dates(out, summary_path)

    def handle_requests(batch: DataFrame, batch_id: int) -> None:
        daily, counts = (Segments(batch.sparkSession, f"{path}/{name}") for name in ("requests", "counts"))
        rollup = summaries.PROMPT_REQUESTS
        days = daily.add(batch_id, rollup.state(batch), rollup.merge)
        publish(daily, counts, days)

    def handle_changes(batch: DataFrame, batch_id: int) -> None:
        daily, counts = (Segments(batch.sparkSession, f"{path}/{name}") for name in ("requests", "counts"))
        days = counts.add(batch_id, _prompt_merge(batch), _prompt_merge)
        publish(daily, counts, days)

    named = summaries.with_prompt_names(requests)
    changed = prompt_changes(requests, evaluations, keep)
    return [_start(named, handle_requests, f"{checkpoint}/requests", trigger), _start(changed, handle_changes, f"{checkpoint}/counts", trigger)]


# -- requests and feedback: sessions ------------------------------------------------

_SESSION = ("date", "app_name", "feature_name", "session_id")
_SESSION_SUMS = ("sessions", "turns", "tokens", "with_tokens", "duration", "with_duration", "resolved")
_SESSION_OUTPUT = T.StructType(
    [T.StructField("date", T.DateType()), T.StructField("app_name", T.StringType()), T.StructField("feature_name", T.StringType())]
    + [T.StructField(c, T.LongType()) for c in _SESSION_SUMS]
)


def _fold_session(state: dict | None, rows: pd.DataFrame) -> dict:
    state = state or {"turns": 0, "tokens": None, "started": None, "ended": None, "resolved": False}
    least = lambda a, b, pick: b if a is None else a if b is None else pick(a, b)
    for r in rows.itertuples(index=False):
        if r.is_positive:
            state["resolved"] = True
            continue
        state["turns"] += 1
        tokens, started, ended = (None if pd.isna(x) else int(x) for x in (r.tokens, r.started, r.ended))
        state["tokens"] = least(state["tokens"], tokens, lambda a, b: a + b)
        state["started"], state["ended"] = least(state["started"], started, min), least(state["ended"], ended, max)
    return state


def _session_sums(values: dict, state: dict) -> dict[tuple, list]:
    if not state["turns"]:
        return {}
    timed = state["started"] is not None and state["ended"] is not None
    # Hundredths of a millisecond, half up.
    duration = (state["ended"] - state["started"] + 5) // 10 if timed else 0
    whole = all(v is not None for v in values.values())
    dims = (_day(values), values["app_name"], values["feature_name"])
    return {dims: [1, state["turns"], state["tokens"] or 0, int(state["tokens"] is not None), duration, int(timed), int(whole and state["resolved"])]}


def _session_merge(rows: DataFrame) -> DataFrame:
    return rows.groupBy("date", "app_name", "feature_name").agg(*[F.sum(c).alias(c) for c in _SESSION_SUMS])


def start_sessions(
    requests: DataFrame, feedback: DataFrame, path: str, summary_path: str, checkpoint: str, keep: timedelta | None = None, **trigger
) -> StreamingQuery:
    """The session summary: turns and feedback change the state of their session only, feedback that comes first waits for it."""
    started = F.unix_micros("created_at")
    empty = F.lit(None).cast("long")
    turns = requests.select(
        *_SESSION, F.lit(False).alias("is_positive"), F.col("total_tokens").cast("long").alias("tokens"), started.alias("started"),
        (started + F.col("latency_ms").cast("bigint") * 1000).alias("ended"),
    )
    praise = feedback.where(summaries.is_positive()).select(*_SESSION, F.lit(True).alias("is_positive"), empty.alias("tokens"), empty.alias("started"), empty.alias("ended"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        store = Segments(batch.sparkSession, path)
        if days := store.add(batch_id, _session_merge(batch), _session_merge):
            writers.overwrite_dates(session_summary(store.read(days)), summary_path)

    return _start(changes(turns.unionByName(praise), _SESSION, _fold_session, _session_sums, _SESSION_OUTPUT, keep), handle, checkpoint, trigger)


def session_summary(sums: DataFrame) -> DataFrame:
    mean = lambda total, n: F.round(F.col(total) / F.when(F.col(n) > 0, F.col(n)), 2)
    return _session_merge(sums).where("sessions > 0").select(
        "date", "app_name", "feature_name", F.col("sessions").alias("session_cnt_1d"), mean("turns", "sessions").alias("avg_turns_per_session"),
        mean("tokens", "with_tokens").alias("avg_tokens_per_session"),
        F.round(F.col("duration") / F.when(F.col("with_duration") > 0, F.col("with_duration")) / 100, 2).alias("avg_duration_per_session_ms"),
        F.col("resolved").alias("resolved_session_cnt_1d"),
    )
