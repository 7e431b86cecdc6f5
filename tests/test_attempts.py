"""The watch over profiling runs: a stream gives what the batch gives."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from metaferry.operators.profiling import profiling_attempts
from metaferry.streaming.attempts import watch_attempts

LOG = "asset_id long, status string, ts timestamp"
START = datetime(2024, 5, 1)
FINAL = {"SUCCESS": "done", "FAILED": "failed", "CANCELLED": "failed", "ERROR": "failed"}


def log_of(seed=5, assets=60):
    dice = random.Random(seed)
    rows = []
    for asset in range(assets):
        at = START + timedelta(seconds=dice.randrange(30))
        for _ in range(dice.choice([1, 2, 4, 9])):
            rows.append((asset, dice.choice(["RUNNING", "running", "In Progress", "queued", None, "Success", "FAILED", "error"]), at))
            at += timedelta(milliseconds=dice.choice([0, 1000, 5000, 5001, 12_000]))
    return rows


def expected(rows, attempts=5, step=5.0):
    found = []
    for asset in sorted({row[0] for row in rows}):
        own = [(at, status or "") for key, status, at in rows if key == asset]
        begin = min(at for at, _ in own)
        outcome = ("failed", attempts, "Timeout waiting for profiling")
        for attempt in range(attempts):
            seen = [row for row in own if row[0] <= begin + timedelta(seconds=step * attempt)]
            state = FINAL.get(max(seen)[1].upper())
            if state:
                outcome = (state, attempt + 1, None)
                break
        found.append((asset, begin, *outcome))
    return found


def test_batch(spark):
    rows = log_of()
    found = profiling_attempts(spark.createDataFrame(rows + [(None, "SUCCESS", START), (7, "x", None)], LOG))
    assert sorted(map(tuple, found.collect())) == expected(rows)
    assert profiling_attempts(spark.createDataFrame([], LOG)).count() == 0


def test_stream_in_parts_with_restart_and_late_rows(spark, tmp_path):
    dice = random.Random(6)
    rows = log_of(6)
    end = START + timedelta(hours=1)
    source, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "checkpoint"))
    # Rows come out of order, in several files; then nothing but a row of much later, so that all timers run out.
    shuffled = sorted(rows, key=lambda row: (row[2] - START).total_seconds() // 20 + dice.random())
    cuts = [0, *sorted(dice.sample(range(1, len(rows)), 3)), len(rows)]
    files = [shuffled[a:b] for a, b in zip(cuts, cuts[1:])]
    files += [[(1000, "RUNNING", end)], [(0, "SUCCESS", START), (1001, "RUNNING", end)], [(1002, "RUNNING", end)]]
    for part in files:
        spark.createDataFrame(part, LOG).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(LOG).parquet(source)
        # Every file is a run of its own that goes on from the checkpoint.
        query = (
            watch_attempts(stream, late="10 minutes").writeStream.format("parquet").option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start(out)
        )
        query.awaitTermination(120)
    found = sorted(map(tuple, spark.read.parquet(out).collect()))
    assert found == expected(rows)
