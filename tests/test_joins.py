"""Joins of uneven keys give what plain joins give."""

from __future__ import annotations

import pytest

from metaferry.operators import joins

LEFT = [(1, "a"), (1, "b"), (2, "c"), (None, "d"), (3, "e")]


@pytest.mark.parametrize("left_type", ["int", "long", "string"])
@pytest.mark.parametrize("right_type", ["int", "long", "string"])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_key_types(spark, rows, left_type, right_type, how):
    def table(data, kind, schema):
        return spark.createDataFrame([(k if k is None or kind != "string" else str(k), v) for k, v in data], schema)

    left = table(LEFT, left_type, f"k {left_type}, v string")
    right = table([(1, "x"), (3, "y"), (4, "z"), (None, "n")], right_type, f"k {right_type}, w string")
    got = joins.hot_join(left, right, "k", how)
    assert dict(got.dtypes)["k"] == dict(left.dtypes)["k"]
    found = [r[1] for r in rows(got.select("v", "v"))]
    wanted = {"inner": ["a", "b", "e"], "left": ["a", "b", "c", "d", "e"], "left_semi": ["a", "b", "e"], "left_anti": ["c", "d"]}
    assert sorted(found) == wanted[how]


def test_several_keys(spark, rows):
    left = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "k int, l string, n int")
    right = spark.createDataFrame([(1, "b", 5)], "k long, l string, m int")
    assert rows(joins.hot_join(left, right, ["k", "l"])) == [(1, "b", 2, 5)]


def test_present_and_absent_do_not_multiply(spark, rows):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1,), (1,)], "k int")
    assert rows(joins.present(left, right, "k")) == [(1,)]
    assert rows(joins.absent(left, right, "k")) == [(2,)]
