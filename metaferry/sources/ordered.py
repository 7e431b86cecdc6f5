"""Tables that keep a global order over many files.

Rows are cut into ranges of the order, a file per range, sorted within. The number
of the range and the row's place in it are columns, and a manifest lists the
bounds and the size of every range: readers get positions back without sorting,
and what filters by ``part`` skips the other files by their statistics.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PART, ROW = "part", "row_in_part"
_ROWS, _BOUNDS = "rows", "bounds"
# A task numbers its rows in the low bits.
_ROW_BITS = 33


def write_in_order(df: DataFrame, order: Sequence[str], path: str, parts: int) -> None:
    """Write rows in the order of some columns, nulls first, in at most ``parts`` ranges. Runs jobs.

    Rows that agree in all of the columns share a range, in no certain order
    among themselves; name a unique column last where that matters. Several
    partial outputs are merged by giving their union. A column named ``part`` or
    ``row_in_part`` is refused.
    """
    if {PART, ROW} & set(df.columns):
        raise ValueError(f"columns {PART} and {ROW} are taken")
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    numbered = ranged.select("*", F.spark_partition_id().alias(PART), row.alias(ROW))
    numbered.write.parquet(f"{path}/{_ROWS}")
    written = df.sparkSession.read.schema(numbered.schema).parquet(f"{path}/{_ROWS}")
    key = F.struct(*order)
    bounds = written.groupBy(PART).agg(F.min(key).alias("first"), F.max(key).alias("last"), F.count(F.lit(1)).alias("n"))
    bounds.write.parquet(f"{path}/{_BOUNDS}")


def bounds_of(spark: SparkSession, path: str) -> DataFrame:
    """(part, first, last, n) of every range that has rows."""
    return spark.read.parquet(f"{path}/{_BOUNDS}")


def read_in_order(spark: SparkSession, path: str, name: str = "position") -> DataFrame:
    """The rows with their zero-based position in the whole order. The driver adds up one number per range."""
    sizes = sorted((part, n) for part, n in bounds_of(spark, path).select(PART, "n").collect())
    offsets, before = [], 0
    for part, n in sizes:
        offsets.append((part, before))
        before += n
    known = spark.createDataFrame(offsets, f"{PART} int, _before bigint")
    rows = spark.read.parquet(f"{path}/{_ROWS}")
    return rows.join(known, PART).withColumn(name, F.col("_before") + F.col(ROW)).drop(PART, ROW, "_before")
