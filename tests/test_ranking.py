"""First, last, position and duplicates against brute force, with one group holding most rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from metaferry.operators import inventory, notify, ranking


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(3)
    ordinals = rng.sample(range(-5, 1 << 62), 300) + list(range(1000, 1300)) + [(1 << 20) * k for k in range(-3, 60)]
    ordinals = list(dict.fromkeys(ordinals))
    data = [("hot" if rng.random() < 0.6 else rng.choice("abc"), o, f"v{o}") for o in ordinals]
    data += [(None, 10**15, "n1"), (None, 10**15 + 1, "n2")]
    rng.shuffle(data)
    return data, spark.createDataFrame(data, "k string, o long, v string").repartition(7)


def by_key(data):
    groups = {}
    for k, o, v in sorted(data, key=lambda r: r[1]):
        groups.setdefault(k, []).append((o, v))
    return groups


def test_positions(table, rows):
    data, df = table
    wanted = [(k, o, v, n) for k, g in by_key(data).items() for n, (o, v) in enumerate(g)]
    assert rows(ranking.positions(df, "k", "o")) == sorted(wanted, key=str)


def test_positions_use_only_bounded_windows(table):
    plan = ranking.positions(table[1], "k", "o")._jdf.queryExecution().analyzed().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("_slice" in line or "_block" in line for line in windows)


def test_first_and_last(table, rows):
    data, df = table
    groups = by_key(data)
    assert rows(ranking.first_per_key(df, ["k"], "o")) == sorted(((k, *g[0]) for k, g in groups.items()), key=str)
    assert rows(ranking.last_per_key(df, ["k"], "o")) == sorted(((k, *g[-1]) for k, g in groups.items()), key=str)
    narrow = df.select("k", "o", (F.col("o") * 2 % 1000).alias("w"))
    wanted = sorted(((k, g[-1][0], narrow_value(g[-1][0])) for k, g in groups.items()), key=str)
    assert rows(ranking.last_per_key(narrow, ["k"], "o")) == wanted


def narrow_value(ordinal):
    # Long arithmetic that stays in range for the last rows of each group.
    return int(abs(ordinal * 2) % 1000) * (1 if ordinal >= 0 else -1)


def test_split_first(table, rows):
    data, df = table
    groups = by_key([r for r in data if r[0] is not None])
    first, later = ranking.split_first(df.filter("k IS NOT NULL"), "k", "o")
    assert rows(first) == sorted(((k, *g[0]) for k, g in groups.items()), key=str)
    assert rows(later.drop("duplicate_reason")) == sorted(((k, *r) for k, g in groups.items() for r in g[1:]), key=str)


def test_latest_version(spark, rows):
    df = spark.createDataFrame(
        [("p", 1, 0, "a"), ("p", 3, 1, "b"), ("p", 3, 2, "c"), ("q", None, 0, "d"), ("q", 0, 1, "e")],
        "policy string, version int, position int, name string",
    )
    assert rows(ranking.latest_version(df, "policy", "version", "position"), "policy", "name") == [("p", "b"), ("q", "d")]


CONFIGS = [("u1", 1, "a"), ("u2", 2, "b"), ("u1", 3, "c"), ("u3", 4, "d"), ("u3", 5, "e"), ("u3", 6, "f"), ("u4", 7, "g"), ("u4", 8, "h")]


@pytest.mark.parametrize(
    "default,kept,undecided",
    [
        ("first", ["b", "c", "g"], []),
        ("last", ["b", "c", "h"], []),
        ("error", ["b", "c"], ["g", "h"]),
    ],
)
def test_resolve_duplicates(spark, rows, default, kept, undecided):
    df = spark.createDataFrame(CONFIGS, "uid string, o long, v string")
    choices = spark.createDataFrame([("u1", 2), ("u3", None)], "uid string, option int")
    left, open_rows = ranking.resolve_duplicates(df, "uid", "o", choices, default)
    assert [r[0] for r in rows(left, "v")] == kept
    assert [r[0] for r in rows(open_rows, "v")] == undecided


def test_candidates_number_the_options(spark, rows):
    df = spark.createDataFrame(CONFIGS, "uid string, o long, v string")
    assert rows(ranking.candidates(df, "uid", "o"), "v", "option", "copies") == [
        ("a", 1, 2), ("c", 2, 2), ("d", 1, 3), ("e", 2, 3), ("f", 3, 3), ("g", 1, 2), ("h", 2, 2)
    ]


@pytest.fixture
def small_skew_limits(spark):
    """Run-time skew limits scaled down to test data, and no broadcast joins."""
    settings = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_uid_is_split_in_merge(spark, small_skew_limits):
    # One uid holds a third of the source rows.
    number = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    source = spark.range(0, 60000, 1, 8).select(
        F.concat(F.lit("PROD."), number).alias("source_uid"),
        F.col("id").alias("source_id"),
        F.concat(F.lit("PROD."), number).alias("target_uid"),
        F.lit("").alias("tags"),
        F.lit("TABLE").alias("asset_type"),
    )
    target = spark.range(0, 60000, 1, 8).select(
        F.concat(F.lit("DEV."), "id").alias("source_uid"), F.col("id").alias("source_id"), F.col("id").alias("ordinal")
    )
    merged = inventory.merge_assets(source, target, [("PROD", "DEV")])
    assert len(merged.collect()) == 60000
    assert "skew=true" in final_plan(merged)


def test_hot_key_among_candidates(spark):
    # No join by key is left to split: rows meet their offsets by key and slice, see above.
    number = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 20000)
    df = spark.range(0, 60000, 1, 8).select(number.alias("k"), F.col("id").alias("o"), F.lit("x" * 20).alias("v"))
    hot = ranking.candidates(df, "k", "o").filter("k = 0")
    # 20000 multiples of three and the two other multiples of 20000.
    assert sorted(r.option for r in hot.collect()) == list(range(1, 20003))


def test_hot_group_is_split_among_missing_groups(spark, small_skew_limits):
    # A third of all uses name the same missing group; the other side was grouped and joined by id before.
    group = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id"))
    use = spark.range(0, 60000, 1, 8).select(
        group.alias("group_id"), F.col("id").alias("rule_id"), F.lit("rule").alias("rule_name")
    )
    groups = spark.range(0, 60000, 7, 8)
    lost = notify.missing_groups(use, groups)
    got = lost.groupBy("referenced_by").count().collect()
    assert {(r.referenced_by, r["count"]) for r in got if r.referenced_by > 1} == {(20000, 20000)}
    lost.collect()
    assert "skew=true" in final_plan(lost)
