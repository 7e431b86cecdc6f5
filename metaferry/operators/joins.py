"""Joins of a large table whose keys may be very uneven."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hot_join(left: DataFrame, right: DataFrame, keys: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join in which one key may hold a large part of the left rows.

    At run time Spark splits a join partition that is far too large, but only if
    both sides come straight from a shuffle. A side that was just grouped or
    joined by the same key does not: Spark would keep its partitions and leave
    the hot key in one task. A hash of the key as second join key asks for a new
    shuffle of both sides, which makes the split possible in every case.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    mark, compared = "_key_hash", [f"_key_{k}" for k in range(len(keys))]
    kinds = [_common_type(left, right, key) for key in keys]
    if all(dict(left.dtypes)[key] == dict(right.dtypes)[key] for key in keys):
        hashed = F.xxhash64(*keys)
        return left.withColumn(mark, hashed).join(right.withColumn(mark, hashed), [*keys, mark], how).drop(mark)
    # Keys of unlike type are compared and hashed in one type; the left side's own values stay.
    typed = {name: F.col(key).try_cast(kind) for name, key, kind in zip(compared, keys, kinds)}
    right = right.withColumns(typed).drop(*keys).withColumn(mark, F.xxhash64(*compared))
    joined = left.withColumns(typed).withColumn(mark, F.xxhash64(*compared)).join(right, [*compared, mark], how)
    others = [name for name in joined.columns if name not in {*keys, *compared, mark}]
    return joined.select(*keys, *others)


def _common_type(left: DataFrame, right: DataFrame, key: str) -> str:
    """Type in which keys of both sides are compared: that of a union, or the numeric one against text."""
    one, other = dict(left.dtypes)[key], dict(right.dtypes)[key]
    if one == other or other == "string":
        return one
    if one == "string":
        return other
    return left.select(key).limit(0).union(right.select(key).limit(0)).dtypes[0][1]


def present(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left rows whose key occurs on the right. The right keys are first made distinct."""
    return hot_join(left, right.select(key).distinct(), key, "left_semi").select(*left.columns)


def absent(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left rows whose key does not occur on the right. The right keys are first made distinct."""
    return hot_join(left, right.select(key).distinct(), key, "left_anti").select(*left.columns)
