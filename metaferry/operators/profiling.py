"""Which target assets still have to be profiled, and the state of running profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metaferry.functions.text import is_digits, strip
from metaferry.operators.joins import absent, hot_join

# Profiling states as the catalog spells them.
SUCCEEDED = ("SUCCESS",)
FAILED = ("FAILED", "CANCELLED", "ERROR")
RUNNING = ("RUNNING", "INPROGRESS", "IN PROGRESS")


def needs_profiling(policies: DataFrame, policy_types: str) -> DataFrame:
    """Policy rows whose type is in a comma-separated list."""
    wanted = [t.strip() for t in policy_types.split(",")] if policy_types else []
    return policies.filter(strip(F.col("type")).isin(wanted))


def never_profiled(asset_ids: DataFrame, id_map: DataFrame, profile_requests: DataFrame) -> DataFrame:
    """Target assets of ``asset_ids(source_id)`` without any profile request.

    Ids that are not mapped are left out. ``profile_requests`` has ``target_id``.
    """
    mapped = asset_ids.distinct().join(id_map, "source_id")
    open_assets = absent(mapped, profile_requests, "target_id")
    return open_assets.select(
        F.col("target_id").cast("long").alias("assetId"), F.col("target_uid").alias("assetUid")
    ).distinct()


def numeric_assets(rows: DataFrame, column: str = "assetId") -> DataFrame:
    return rows.filter(is_digits(F.col(column)))


def profiling_state(status: Column) -> Column:
    """``done``, ``failed``, ``running`` or ``unknown``."""
    text = F.upper(status)
    return (
        F.when(text.isin(*SUCCEEDED), "done")
        .when(text.isin(*FAILED), "failed")
        .when(text.isin(*RUNNING), "running")
        .otherwise("unknown")
    )


def latest_status(log: DataFrame) -> DataFrame:
    """Latest state per asset from ``log(asset_id, status, ts)``; works on a stream as well."""
    latest = log.groupBy("asset_id").agg(
        F.max_by("status", "ts").alias("status"), F.max("ts").alias("ts")
    )
    return latest.withColumn("state", profiling_state(F.col("status")))


def profiling_decision(assets: DataFrame, log: DataFrame) -> DataFrame:
    """State of every asset of ``assets(asset_id)``; those without a log row need a trigger."""
    joined = assets.join(latest_status(log).select("asset_id", "state"), "asset_id", "left")
    return joined.select("asset_id", F.coalesce("state", F.lit("needs_trigger")).alias("decision"))


# A running profile is asked for so many times, so many seconds apart.
ATTEMPTS, INTERVAL_SECONDS = 5, 5


def profiling_attempts(log: DataFrame, attempts: int = ATTEMPTS, interval: float = INTERVAL_SECONDS) -> DataFrame:
    """(asset_id, begin, outcome, attempts, reason) of the watch over every asset of ``log(asset_id, status, ts)``.

    A watch begins with an asset's first row and asks for the status then and
    after every interval. Each attempt sees the latest row so far; the first that
    sees a final state ends the watch as ``done`` or ``failed``. After the last
    attempt it is ``failed`` by time-out. Of rows of one time the largest status counts.
    """
    known = log.filter(F.col("asset_id").isNotNull() & F.col("ts").isNotNull())
    begin = known.groupBy("asset_id").agg(F.min("ts").alias("begin"))
    # An interval, so that no time zone of the session plays a part.
    micros = 1_000_000 * F.expr("CAST(CAST(ts - begin AS INTERVAL SECOND) AS DECIMAL(18, 6))")
    # The first attempt that sees the row.
    attempt = F.ceil(micros.cast("bigint") / F.lit(interval * 1_000_000)).cast("bigint")
    seen = hot_join(known, begin, "asset_id").withColumn("attempt", attempt).filter(F.col("attempt") < attempts)
    latest = seen.groupBy("asset_id", "attempt").agg(F.max_by("status", F.struct("ts", "status")).alias("status"))
    final = latest.withColumn("state", profiling_state(F.col("status"))).filter(F.col("state").isin("done", "failed"))
    ended = final.groupBy("asset_id").agg(F.min(F.struct("attempt", "state")).alias("end"))
    joined = hot_join(begin, ended, "asset_id", "left")
    return joined.select(
        "asset_id",
        "begin",
        F.coalesce("end.state", F.lit("failed")).alias("outcome"),
        F.coalesce(F.col("end.attempt") + 1, F.lit(attempts)).cast("int").alias("attempts"),
        F.when(F.col("end").isNull(), "Timeout waiting for profiling").alias("reason"),
    )
