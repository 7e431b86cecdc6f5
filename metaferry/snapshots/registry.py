"""Registry of queries with the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from metaferry.snapshots.tables import plain_sql, snapshot

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Inputs:
    """Snapshots by attribute: ``inputs.policies`` is the policies DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return snapshot(self.spark, self.sf_dir, name)


def query(name: str, sql: str | None = None) -> Callable[[Callable[[Inputs], DataFrame]], Callable]:
    """Register a query over snapshots, with its equivalent SQL where there is one."""

    def register(build: Callable[[Inputs], DataFrame]) -> Callable:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = plain_sql(sql)
        return build

    return register
