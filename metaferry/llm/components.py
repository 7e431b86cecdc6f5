"""Connected components of a link table, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from metaferry.operators.joins import hot_join
from metaferry.sources.staging import staged


def _turned(links: DataFrame) -> DataFrame:
    return links.select(F.col("b").alias("a"), F.col("a").alias("b"))


def _stars(links: DataFrame) -> DataFrame:
    """Links every node's larger neighbours with its smallest neighbour or itself; a pair may come repeatedly."""
    both = links.unionByName(_turned(links))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    # A node may have a large part of all others as larger neighbours.
    return hot_join(both.filter("b > a"), least, "a").select(F.col("m").alias("a"), "b").filter("a < b")


def _hooks(links: DataFrame) -> DataFrame:
    """Links every node and its smaller neighbours with the smallest of these.

    After ``_stars`` a node has at most one smaller neighbour per link it had.
    """
    joined = links.withColumn("m", F.min("a").over(W.partitionBy("b")))
    up = F.struct(F.col("m").alias("a"), F.col("a").alias("b"))
    own = F.struct(F.col("m").alias("a"), F.col("b").alias("b"))
    return joined.select(F.inline(F.array(up, own))).filter("a < b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every node in links (a, b); the component is its smallest node.

    Each round writes its links to the shared folder; rounds end when nothing
    changes, after about the logarithm of the longest path. Self links and nulls
    are ignored.
    """
    now = staged(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct())
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        now = staged(_hooks(_stars(now)))
    own = now.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct()
    return now.select(F.col("b").alias("id"), F.col("a").alias("component")).unionByName(own)
