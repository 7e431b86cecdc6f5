"""Quality by importance resampling with hashed n-gram models.

Two generative models count hashed words and word pairs: one over the target
texts, one over all raw texts. The log of their ratio, summed over a text, is
its importance weight. Documents are drawn without replacement in proportion to
their weights: each gets Gumbel noise on its log weight, and the largest
``share`` of all documents are kept.

The raw model counts every word of every document; tasks add up their counts
before the shuffle. The target model learns from a bounded sample of the
labelled rows: the ``TARGET_ROWS`` of quality 1 that come first in the order of
a hash. Only their ids are sent to all tasks, a few hundred kB. Both models have
``BUCKETS`` entries. Noise is a hash of the id, so reruns agree and no state is
kept. The kept share is that of quality 1 among all labelled rows. The lowest
kept value is found by narrowing a range with counts, so nothing is sorted as a
whole; equal values are kept or dropped together.

Defined results: a null or empty text has no features and log weight 0. Rows
with a null id have the same noise and are never targets. Repeated rows are
drawn alike. Other columns may have any name. Without target rows all weights
are 0; without labels all rows are kept; an empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaferry.llm.parts import parts
from metaferry.llm.shingles import mixed, word_hashes
from metaferry.sources.staging import staged

BUCKETS, TARGET_ROWS, PRIOR = 1 << 16, 20_000, 20.0
_BINS = 4096
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def features(text: str | None) -> np.ndarray:
    """The buckets of all words and pairs of neighbouring words."""
    words = word_hashes(text)
    pairs = mixed(words[:-1] * _PAIR + words[1:])
    return (np.concatenate([words, pairs]) % np.uint64(BUCKETS)).astype(np.int64)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals = np.zeros((2, BUCKETS), np.int64)
    for batch in parts(batches, 0):
        for text, target in zip(batch.column(0), batch.column(1).to_pylist()):
            found = np.bincount(features(text.as_py()), minlength=BUCKETS) if text.is_valid else 0
            totals[0] += found
            if target:
                totals[1] += found
    model, bucket = np.nonzero(totals)
    yield pa.RecordBatch.from_arrays(
        [pa.array(model.astype(np.int32)), pa.array(bucket.astype(np.int32)), pa.array(totals[model, bucket])],
        ["model", "bucket", "n"],
    )


def log_ratios(docs: DataFrame, target_ids: DataFrame, key: str = "doc_id", text: str = "text") -> np.ndarray:
    """The log of target over raw probability per bucket, each smoothed by ``PRIOR`` counts. Runs a job.

    ``target_ids`` (id) must be small, as it goes to all tasks.
    """
    marked = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(
        F.broadcast(target_ids.select("id", F.lit(True).alias("target"))), "id", "left"
    )
    rows = (
        marked.select("text", "target")
        .mapInArrow(_counts, "model int, bucket int, n bigint")
        .groupBy("model", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()  # at most twice BUCKETS rows
    )
    counts = np.zeros((2, BUCKETS))
    counts[rows["model"].to_numpy(int), rows["bucket"].to_numpy(int)] = rows["n"].to_numpy(float)
    if not counts[1].any():
        return np.zeros(BUCKETS)
    # Both models on the target's scale, so that rare features have a ratio near one.
    raw = counts[0] * counts[1].sum() / counts[0].sum() + PRIOR
    target = counts[1] + PRIOR
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def weights(docs: DataFrame, ratios: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_features, log_weight) per row."""
    kind = dict(docs.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, 1):
            found = [features(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(buckets) for buckets in found], pa.int64()),
                    pa.array([float(ratios[buckets].sum()) for buckets in found], pa.float64()),
                ],
                ["key", "n_features", "log_weight"],
            )

    chosen = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return chosen.mapInArrow(run, f"key {kind}, n_features bigint, log_weight double").withColumnRenamed("key", key)


def gumbel(key: str, seed: int = 1):
    """Noise of the standard Gumbel distribution from a hash of the id."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key).cast("string")), 12)
    uniform = (bits.cast("double") + 0.5) / float(1 << 52)
    return -F.log(-F.log(uniform))


def kth_largest(values: DataFrame, column: str, k: int) -> float:
    """The k-th largest number of a column: ranges are counted and narrowed. Runs a few jobs."""
    low, high = values.agg(F.min(column), F.max(column)).first()
    # The least and the greatest value always fall into different ranges.
    while low < high:
        width = (high - low) / _BINS
        place = F.least(F.floor((F.col(column) - F.lit(low)) / F.lit(width)), F.lit(_BINS - 1))
        if not width:  # so narrow that it holds no more values than a range is cut into
            place = F.col(column)
        bins = (
            values.filter(F.col(column).between(low, high))
            .groupBy(place.alias("bin"))
            .agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high"))
            .orderBy(F.desc("bin"))
            .collect()
        )
        for one in bins:
            if k <= one.n:
                low, high = one.low, one.high
                break
            k -= one.n
    return low


def resampled(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", quality: str = "quality", seed: int = 1
) -> DataFrame:
    """(key, n_features, log_weight, priority, kept) of every row. Runs jobs."""
    known, n_good = labels.agg(F.count(quality), F.sum(F.when(F.col(quality) == 1, 1).otherwise(0))).first()
    good = labels.filter((F.col(quality) == 1) & F.col(key).isNotNull()).select(F.col(key).alias("id")).distinct()
    order = F.xxhash64(F.lit(seed), F.col("id").cast("string"))
    # Few more rows than wanted are compared, so that not every task sends as many.
    near = good.filter(F.pmod(order, F.lit(1 << 20)) < math.ceil(min(1.0, 1.2 * TARGET_ROWS / max(1, n_good or 0)) * (1 << 20)))
    target = near.orderBy(F.pmod(order, F.lit(1 << 20)), order, "id").limit(TARGET_ROWS)
    ratios = log_ratios(docs, target, key, text)
    scored = staged(weights(docs, ratios, key, text).withColumn("priority", F.col("log_weight") + gumbel(key, seed)))
    n = scored.count()
    k = math.ceil(n * n_good / known) if known else n
    least = kth_largest(scored, "priority", k) if k else math.inf
    return scored.withColumn("kept", F.col("priority") >= F.lit(float(least if n else 0.0)))
