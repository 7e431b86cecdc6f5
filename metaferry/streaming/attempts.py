"""The watch over running profiles as a stream: attempts, time-outs and late rows."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from metaferry.operators.profiling import ATTEMPTS, FAILED, INTERVAL_SECONDS, SUCCEEDED

RESULT = "asset_id bigint, begin timestamp, outcome string, attempts int, reason string"


def _outcome(rows: list[tuple[int, str]], attempts: int, step: float) -> tuple[str, int, str | None]:
    """Outcome of rows (micros since the begin, status) of one watch."""
    latest: dict[int, tuple[int, str]] = {}
    for at, status in rows:
        attempt = -int(-at // step)
        if attempt < attempts:
            latest[attempt] = max(latest.get(attempt, (-1, "")), (at, status))
    for attempt in sorted(latest):
        text = latest[attempt][1].upper()
        if text in SUCCEEDED or text in FAILED:
            return "done" if text in SUCCEEDED else "failed", attempt + 1, None
    return "failed", attempts, "Timeout waiting for profiling"


def watch_attempts(
    log_stream: DataFrame, late: str = "10 seconds", attempts: int = ATTEMPTS, interval: float = INTERVAL_SECONDS
) -> DataFrame:
    """As ``profiling_attempts`` for a stream ``log(asset_id, status, ts)``, one row per asset when its watch is over.

    A watch is settled by a timer, once the watermark (``late`` behind the latest
    row) has passed its last attempt, so rows may come in any order within that
    time; later ones are dropped. Until then the state holds the rows of the
    watch, afterwards only that it is over: further rows of the asset change
    nothing. ``asset_id`` is a whole number, as the catalog's ids are.
    """
    step = interval * 1_000_000
    span = int(step * (attempts - 1))

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        over, text = state.get if state.exists else (False, "[]")
        rows = [tuple(row) for row in json.loads(text)]
        if over:
            return
        for batch in batches:
            rows += zip((int(at) for at in batch["at"]), batch["status"].fillna("").astype(str))
        begin = min(at for at, _ in rows)
        rows = [row for row in rows if row[0] <= begin + span]
        # A timer must lie behind the watermark.
        due, now = (begin + span) // 1000 + 1, state.getCurrentWatermarkMs()
        if state.hasTimedOut or due <= now:
            outcome, attempt, reason = _outcome([(at - begin, status) for at, status in rows], attempts, step)
            state.update((True, "[]"))
            yield pd.DataFrame(
                {
                    "asset_id": [key[0]], "begin": [pd.Timestamp(begin, unit="us")], "outcome": [outcome],
                    "attempts": [attempt], "reason": [reason],
                }
            )
        else:
            state.update((False, json.dumps(rows)))
            state.setTimeoutTimestamp(due)

    log_stream = log_stream.withColumn("ts", F.col("ts").cast("timestamp"))
    known = log_stream.filter(F.col("asset_id").isNotNull() & F.col("ts").isNotNull()).withWatermark("ts", late)
    keyed = known.select("asset_id", "status", "ts", F.unix_micros("ts").alias("at")).groupBy("asset_id")
    return keyed.applyInPandasWithState(run, RESULT, "over boolean, rows string", "append", GroupStateTimeout.EventTimeTimeout)
