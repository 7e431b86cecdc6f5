"""Tables that keep a global order."""

from __future__ import annotations

import random

import pytest

from metaferry.sources import ordered

SCHEMA = "name string, id long, note string"


def rows_of(seed=3, n=500):
    dice = random.Random(seed)
    return [(dice.choice([None, "", "a", "B", "é", f"x{dice.randrange(99)}"]), k, dice.choice(["n", None])) for k in range(n)]


def test_twenty_parts_come_back_in_order(spark, tmp_path):
    rows, path = rows_of(), str(tmp_path / "table")
    halves = [spark.createDataFrame(part, SCHEMA) for part in (rows[300:], rows[:300])]
    ordered.write_in_order(halves[0].unionByName(halves[1]), ["name", "id"], path, 20)
    found = sorted((row.position, row.name, row.id, row.note) for row in ordered.read_in_order(spark, path).collect())
    wanted = sorted(rows, key=lambda row: (row[0] is not None, (row[0] or "").encode(), row[1]))
    assert found == [(k, *row) for k, row in enumerate(wanted)]


def test_bounds_part_the_order(spark, tmp_path):
    path = str(tmp_path / "table")
    ordered.write_in_order(spark.range(1000).toDF("id"), ["id"], path, 20)
    bounds = sorted((row.part, row.first.id, row.last.id, row.n) for row in ordered.bounds_of(spark, path).collect())
    assert len(bounds) == 20 and bounds[0][1] == 0 and bounds[-1][2] == 999
    assert all(last - first + 1 == n for _, first, last, n in bounds)
    assert all(one[2] + 1 == other[1] for one, other in zip(bounds, bounds[1:]))


def test_positions_need_no_sort(spark, tmp_path):
    path = str(tmp_path / "table")
    ordered.write_in_order(spark.range(100).toDF("id"), ["id"], path, 4)
    plan = ordered.read_in_order(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "rangepartitioning" not in plan


def test_equal_rows_empty_tables_and_taken_names(spark, tmp_path):
    ordered.write_in_order(spark.createDataFrame([("a",)] * 50, "v string"), ["v"], str(tmp_path / "same"), 5)
    found = ordered.read_in_order(spark, str(tmp_path / "same")).collect()
    assert sorted(row.position for row in found) == list(range(50))
    ordered.write_in_order(spark.createDataFrame([], "v string"), ["v"], str(tmp_path / "none"), 5)
    assert ordered.bounds_of(spark, str(tmp_path / "none")).count() == 0
    assert ordered.read_in_order(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(ValueError):
        ordered.write_in_order(spark.createDataFrame([(1,)], "part int"), ["part"], str(tmp_path / "x"), 2)
