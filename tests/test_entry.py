"""The driver contract: registered queries agree with their SQL on the smallest data."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from compare import canonical
from metaferry.snapshots import all_queries
from metaferry.snapshots.tables import TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_entry(spark):
    assert entry.entry(spark).columns == ["source_id", "source_uid", "target_id", "target_uid", "tags", "source_asset_type"]


def test_every_query_has_sql():
    assert set(all_queries.ORACLES) == set(all_queries.QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(all_queries.QUERIES))
def test_query(spark, database, name):
    frame = entry.queries()[name](spark, SF)
    got = [tuple(row) for row in frame.collect()]
    result = database.execute(entry.oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == sorted(frame.columns)
    assert canonical(frame.columns, got) == canonical(names, result.fetchall())


def test_segment_export_takes_the_document_of_every_asset(spark):
    got = {row.target_uid for row in entry.queries()["segment_export"](spark, SF).collect()}
    orders = spark.read.parquet(f"{SF}/orders.parquet").filter("o_orderkey % 6 >= 3 AND o_orderpriority <> '5-LOW'")
    keys = {row.o_orderkey for row in orders.select("o_orderkey").collect()}
    assert any(key % 10 == 4 for key in keys)
    assert got == {f"x{key}" for key in keys}
