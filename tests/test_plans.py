"""What the physical plans must and must not contain."""

from __future__ import annotations

import os
import re

import pytest

import __spark_entry__ as entry
from metaferry.operators import inventory
from metaferry.snapshots import all_queries
from metaferry.snapshots.tables import snapshot

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")

# Queries over real archives: packing (test data) and unpacking run in Python.
PYTHON = {"bundle_members", "usable_bundles"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(all_queries.QUERIES))
def test_no_pairs_no_python_no_whole_group_windows(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "NestedLoopJoin" not in text and "CartesianProduct" not in text
    assert ("Python" in text or "InPandas" in text) == (name in PYTHON)
    lines = text.splitlines()
    for line, below in zip(lines, lines[1:]):
        # Only totals that were summed up per task before go to one task.
        if "Exchange SinglePartition" in line:
            assert "Aggregate(keys=[], functions=[partial_" in below, below
    for line in lines:
        if re.search(r"\bWindow \[", line):
            assert "_slice" in line or "_block" in line, line


def test_inventory_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "inventory")
    snapshot(spark, SF, "source_inventory").write.parquet(path)
    rows = inventory.filter_inventory(spark.read.parquet(path), "0,3", "1,2").select("source_uid")
    text = plan(rows)
    assert "In(asset_type_id, [0,3])" in text and "In(assembly_id, [1,2])" in text
    schema = re.search(r"ReadSchema: (.*)", text).group(1)
    assert "tags" not in schema and "target_uid" not in schema


def test_policy_coverage_reads_ids_only(spark):
    text = plan(entry.queries()["policies_on_target"](spark, SF))
    lines = [line for line in text.splitlines() if "lineitem.parquet" in line]
    assert lines and all("l_quantity" not in line and "l_extendedprice" not in line for line in lines)


def test_rewriting_checks_a_document_once_and_cuts_only_at_source_words(spark):
    text = plan(entry.queries()["rewrite_documents"](spark, SF))
    assert text.count("_end_of_the_document_,IntegerType") == 1
    assert "trim(" not in text.replace("ltrim(", "")
    # No token for each word of a text.
    assert r"[\p{L}\p{N}_]++|[^\p{L}\p{N}_]++" not in text
