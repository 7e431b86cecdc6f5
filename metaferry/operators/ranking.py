"""Order-dependent choices: first, last, latest, position within a group.

No operator here puts a whole group into one task. First, last and latest are
``min_by`` / ``max_by`` aggregates, which Spark combines before the shuffle.
Positions are counted in slices of the ordinal, see ``positions``. Row order is
always an explicit, unique ordinal column, never the order of rows in a file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from metaferry.operators.joins import hot_join

# A slice holds at most 2**20 ordinals, a block at most 2**20 slices.
_SLICE_BITS = 20
_BLOCK_BITS = 40

_FIXED_WIDTH = {"boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp"}


def with_ordinal(df: DataFrame, name: str = "ordinal") -> DataFrame:
    """Number the rows of a freshly scanned file in file order (unique, with gaps)."""
    return df.withColumn(name, F.monotonically_increasing_id())


def first_per_key(df: DataFrame, keys: Sequence[str], ordinal: str | Column) -> DataFrame:
    """The row with the lowest ordinal of each key."""
    return _pick(df, keys, F.min_by, ordinal)


def last_per_key(df: DataFrame, keys: Sequence[str], ordinal: str | Column) -> DataFrame:
    """The row with the highest ordinal of each key."""
    return _pick(df, keys, F.max_by, ordinal)


def _pick(df: DataFrame, keys: Sequence[str], chooser, ordinal: str | Column) -> DataFrame:
    others = [c for c in df.columns if c not in keys]
    kinds = dict(df.dtypes)
    if all(kinds[c] in _FIXED_WIDTH for c in others):
        # Each column on its own: the ordinal is unique, so all come from one row,
        # and buffers of fixed width let Spark hash instead of sort.
        return df.groupBy(*keys).agg(*[chooser(c, ordinal).alias(c) for c in others]).select(*df.columns)
    picked = df.groupBy(*keys).agg(chooser(F.struct(*others), ordinal).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


# Fixed value: the reason given for later rows.
LATER_REASON = "Duplicate assetId found in multiple pages/threads"


def split_first(
    df: DataFrame, key: str, ordinal: str, reason: str = LATER_REASON
) -> tuple[DataFrame, DataFrame]:
    """Rows that come first for their key, and all later rows with a reason.

    Later rows are found by ordinal, not by key: ordinals are unique, so the
    anti join stays even when one key holds a large part of the rows.
    """
    first = first_per_key(df, [key], ordinal)
    kept = df.groupBy(key).agg(F.min(ordinal).alias(ordinal)).select(ordinal)
    later = df.join(kept, ordinal, "left_anti").select(*df.columns)
    return first, later.withColumn("duplicate_reason", F.lit(reason))


def latest_version(df: DataFrame, key: str, version: str, position: str) -> DataFrame:
    """Row with the highest version of each key; a missing version counts as 0
    and the earliest position wins a tie."""
    rank = F.struct(F.coalesce(F.col(version), F.lit(0)), -F.col(position))
    return last_per_key(df, [key], rank)


def positions(
    df: DataFrame, group: str, ordinal: str, name: str = "position", total: str | None = None
) -> DataFrame:
    """Zero-based position of every row within its group, in ordinal order.

    With ``total`` the number of rows of the group is added under that name.

    The ordinal must be a whole number, unique within the group. It is cut into
    slices of 2**20 values, so a window never sorts more than 2**20 rows however
    large the group is. What precedes a slice is summed from slice counts, and
    slices in turn from blocks of slices, so those windows are bounded as well.
    """
    # A shift of a narrower number would count modulo its width.
    number = F.col(ordinal).cast("bigint")
    block, piece = F.shiftright(number, _BLOCK_BITS), F.shiftright(number, _SLICE_BITS)
    sliced = df.withColumn("_block", block).withColumn("_slice", piece)
    per_slice = sliced.groupBy(group, "_block", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    per_block = per_slice.groupBy(group, "_block").agg(F.sum("_n").alias("_n"))

    by_block = Window.partitionBy(group).orderBy("_block")
    by_slice = Window.partitionBy(group, "_block").orderBy("_slice")

    def earlier(window: WindowSpec) -> Column:
        return F.coalesce(F.sum("_n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    whole = by_block.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = per_block.select(
        F.col(group).alias("_bg"),
        F.col("_block").alias("_bb"),
        earlier(by_block).alias("_before_block"),
        F.sum("_n").over(whole).alias("_total"),
    )
    slices = per_slice.select(
        F.col(group).alias("_sg"),
        F.col("_block").alias("_sb"),
        F.col("_slice").alias("_ss"),
        earlier(by_slice).alias("_before_slice"),
    )
    same_block = F.col("_sg").eqNullSafe(F.col("_bg")) & (F.col("_sb") == F.col("_bb"))
    offsets = slices.join(blocks, same_block).select(
        "_sg", "_ss", (F.col("_before_block") + F.col("_before_slice")).alias("_offset"), "_total"
    )
    within_slice = Window.partitionBy(group, "_slice").orderBy(ordinal)
    ranked = sliced.withColumn("_rank", F.row_number().over(within_slice))
    joined = ranked.join(offsets, F.col(group).eqNullSafe(F.col("_sg")) & (F.col("_slice") == F.col("_ss")))
    extra = [F.col("_total").alias(total)] if total else []
    return joined.select(*df.columns, (F.col("_offset") + F.col("_rank") - 1).cast("long").alias(name), *extra)


def batches(df: DataFrame, group: str, ordinal: str, size: Column) -> DataFrame:
    """Position and batch number of each row when a group is cut into batches of ``size``."""
    placed = positions(df, group, ordinal)
    return placed.withColumn("batch", F.floor(F.col("position") / size).cast("long"))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def with_copies(df: DataFrame, key: str) -> DataFrame:
    """All rows with the number of ``copies`` of their key; null is a key of its own."""
    counts = df.groupBy(F.col(key).alias("_counted")).agg(F.count(F.lit(1)).alias("copies"), F.xxhash64(key).alias("_hash"))
    # A hash as second key asks for a new shuffle, which Spark can split where one key holds much of the rows.
    same = F.col(key).eqNullSafe(F.col("_counted")) & (F.xxhash64(key) == F.col("_hash"))
    return df.join(counts, same).select(*df.columns, "copies")


def candidates(df: DataFrame, key: str, ordinal: str) -> DataFrame:
    """Rows whose key is duplicated, numbered from 1 within the key (``option``), with the number of copies."""
    repeated = with_copies(df, key).filter(F.col("copies") > 1)
    return positions(repeated, key, ordinal, "option").withColumn("option", F.col("option") + 1).select(
        *df.columns, "option", "copies"
    )


def resolve_duplicates(
    df: DataFrame, key: str, ordinal: str, choices: DataFrame | None = None, default: str = "first"
) -> tuple[DataFrame, DataFrame]:
    """Keep one row per key: ``(kept, undecided)``.

    ``choices(key, option)`` names the option to keep, at most once per key; a
    null option drops the key. Keys without a choice follow ``default``:
    ``first`` or ``last`` row, or ``error``, which keeps none and returns all
    their rows as undecided. Keys with a single row are always kept.
    """
    if default not in ("first", "last", "error"):
        raise ValueError(f"unknown default: {default}")
    counted = with_copies(df, key)
    single = counted.filter(F.col("copies") == 1).select(*df.columns)
    rows = positions(counted.filter(F.col("copies") > 1), key, ordinal, "option").withColumn("option", F.col("option") + 1)
    if choices is None:
        rows = rows.withColumn("_chosen", F.lit(None).cast("long")).withColumn("_decided", F.lit(False))
    else:
        wanted = choices.select(key, F.col("option").cast("long").alias("_chosen"), F.lit(True).alias("_decided"))
        rows = hot_join(rows, wanted, key, "left").withColumn("_decided", F.coalesce("_decided", F.lit(False)))
    decided = F.col("_decided")
    by_default = {"first": F.col("option") == 1, "last": F.col("option") == F.col("copies"), "error": F.lit(False)}
    keep = F.when(decided, F.col("option") == F.col("_chosen")).otherwise(by_default[default])
    undecided = ~decided & F.lit(default == "error")
    kept = single.unionByName(rows.filter(keep).select(*df.columns))
    return kept, rows.filter(undecided).select(*df.columns, "option", "copies")
