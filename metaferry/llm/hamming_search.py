"""Exact nearest neighbours of binary codes by incremental multi-index hashing.

A code of 64 bits is cut into m segments, and every code is indexed by each of
them. Two codes at distance d agree in some segment up to d // m bits. A query
first looks up its own segments, then segments that differ in one bit, in two,
and so on. After radius r all codes at a distance below m * (r + 1) have been
seen; a query ends as soon as its k-th verified distance lies below that. Only
queries that aren't done go to the next radius. The number of segments follows
the size of the index, so that a bucket holds a few codes.

Hot codes: of the vectors that share a code only the ``k`` + 1 smallest ids can
be in any result, so the index keeps those (Spark drops the others before the
shuffle), and all queries with the same code are searched once. A pair that
several segments find is taken at one of them only. Nothing is broadcast by
force and nothing but counters passes the driver.

Defined results: neighbours are ordered by distance, then id, and exclude the
query's own row id. A null or empty vector has no code: it is no neighbour and
has none. A vector of another length than 64 gives bit j from the sum of its
values at places j, j + 64, ...; null values count as 0 and NaN as positive.
Repeated ids are one neighbour if their codes agree. With fewer than k others
all are returned. Other columns may have any name. An empty table gives an empty one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from metaferry.operators.joins import hot_join
from metaferry.sources.staging import staged

BITS, NEIGHBOURS = 64, 10


def sign_code(vector: str) -> Column:
    """The signs of a vector as a 64-bit number; null without values."""
    name = f"`{vector}`"
    plain = f"aggregate(transform({name}, (x, i) -> if(x > 0, shiftleft(1L, i), 0L)), 0L, (a, b) -> a | b)"
    total = f"aggregate(filter({name}, (x, i) -> i % {BITS} = j), 0D, (a, x) -> a + coalesce(x, 0))"
    folded = f"aggregate(transform(sequence(0, {BITS - 1}), j -> if({total} > 0, shiftleft(1L, j), 0L)), 0L, (a, b) -> a | b)"
    return F.expr(f"CASE WHEN size({name}) = {BITS} THEN {plain} WHEN size({name}) > 0 THEN {folded} END")


def segments(rows: int) -> list[tuple[int, int]]:
    """(shift, width) of each segment: about as many buckets as a quarter of the codes."""
    width = min(24, max(8, round(math.log2(max(rows, 2))) - 2))
    number = math.ceil(BITS / width)
    cuts = [BITS * k // number for k in range(number + 1)]
    return [(low, high - low) for low, high in zip(cuts, cuts[1:])]


def _segment(code: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(code, shift).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))


def _by_segment(codes: DataFrame, code: str, parts: list[tuple[int, int]]) -> DataFrame:
    values = [
        F.struct(F.lit(k).alias("segment"), _segment(F.col(code), *part).alias("value"), F.lit(part[1]).alias("width"))
        for k, part in enumerate(parts)
    ]
    return codes.select("*", F.inline(F.array(*values)))


def _probes(queries: DataFrame, parts: list[tuple[int, int]], radius: int) -> DataFrame:
    """(query, bound, segment, value): the queries' segments with exactly ``radius`` bits turned, the bits in rising order."""
    found = _by_segment(queries, "query", parts).withColumn("bit", F.lit(-1))
    for _ in range(radius):
        found = (
            found.filter(F.col("bit") + 1 < F.col("width"))
            .withColumn("bit", F.explode(F.sequence(F.col("bit") + 1, F.col("width") - 1)))
            .withColumn("value", F.expr("value ^ shiftleft(1L, bit)"))
        )
    return found.select("query", "bound", "segment", "value")


def search(
    vectors: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = NEIGHBOURS
) -> DataFrame:
    """(query_id, neighbour_id, distance, rank) for the rows of ``queries`` against ``vectors``. Runs jobs per radius."""
    coded = vectors.select(F.col(key).alias("id"), sign_code(vector).alias("code")).filter(F.col("code").isNotNull() & F.col("id").isNotNull())
    place = F.row_number().over(W.partitionBy("code").orderBy("id"))
    kept = staged(coded.distinct().withColumn("place", place).filter(F.col("place") <= k + 1).select("code", "id"))
    parts = segments(kept.count())
    index = staged(_by_segment(kept.select("code").distinct(), "code", parts).select("segment", "value", "code"))
    asked = staged(
        queries.select(F.col(key).alias("query_id"), sign_code(vector).alias("query"))
        .filter(F.col("query").isNotNull() & F.col("query_id").isNotNull())
        .distinct()
    )

    def apart(shift: int, width: int) -> Column:
        return F.bit_count(_segment(F.col("query").bitwiseXOR(F.col("code")), shift, width))

    # The segment that takes a pair: the first of those in which it differs least.
    taker = F.least(*[apart(*part) * BITS + n for n, part in enumerate(parts)])
    # bound: the distance beyond which a code is of no use to the query any more.
    open_queries = asked.select("query", F.lit(BITS).alias("bound")).distinct()
    nearest = None
    for radius in range(max(width for _, width in parts) + 1):
        pairs = (
            # Both sides grow with the input, and Spark cannot foresee how many rows the turned bits make.
            hot_join(_probes(open_queries, parts, radius).hint("merge"), index.hint("merge"), ["segment", "value"])
            .filter(taker == F.col("segment") + radius * BITS)
            .withColumn("distance", F.bit_count(F.col("query").bitwiseXOR(F.col("code"))).cast("int"))
            .filter(F.col("distance") <= F.col("bound"))
            .select("query", "code", "distance")
        )
        if nearest is not None:
            pairs = pairs.unionByName(nearest)
        # The k + 1 nearest codes hold the k + 1 nearest vectors.
        by_code = W.partitionBy("query").orderBy("distance", "code")
        rank = F.row_number().over(by_code)
        # All codes at the last distance are kept, as ids decide among them.
        last = F.rank().over(W.partitionBy("query").orderBy("distance"))
        nearest = staged(pairs.withColumn("_rank", last).filter(F.col("_rank") <= k + 1).drop("_rank"))
        covered = len(parts) * (radius + 1)
        bounds = nearest.withColumn("_rank", rank).filter(F.col("_rank") == k + 1).select("query", "distance")
        open_queries = staged(
            open_queries.join(bounds, "query", "left")
            .select("query", F.coalesce("distance", "bound").alias("bound"))
            .filter(F.col("bound") >= covered)
        )
        if not open_queries.take(1):
            break
    with_ids = hot_join(nearest, kept, "code").select("query", "id", "distance")
    best = W.partitionBy("query").orderBy("distance", "id")
    with_ids = with_ids.withColumn("_rank", F.row_number().over(best)).filter(F.col("_rank") <= k + 1).drop("_rank")
    ranked = F.row_number().over(W.partitionBy("query_id", "query").orderBy("distance", "id"))
    return (
        hot_join(asked, with_ids, "query")
        .filter(F.col("query_id") != F.col("id"))
        .withColumn("rank", ranked)
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("id").alias("neighbour_id"), "distance", "rank")
    )
