"""Mixing sources to target weights with a low-discrepancy schedule.

1. Sizes are words. Sources, in code point order with null last, weigh 5, 2, 1
   and again 5, 2, 1, ... They share all words by weight, but none gets more than
   ``MOST`` times its own; the rest is shared again by weight among the others.
   In closed form: order sources by size over weight; those that reach their
   limit come first, and the rest share what is left.
2. The documents of a source are ordered by a hash of their id and laid end to
   end; this line of words is cut into blocks of equal size, about ``SLOTS``
   blocks or one per document in all.
3. Slot i of the schedule gets the i-th point of the golden-ratio sequence. The
   sequence runs on a grid of 2^31 points in whole numbers, so it visits every
   point once before it repeats. Sources own intervals of the grid in proportion
   to the blocks they are to deliver, so every stretch of the schedule has nearly
   the right mix.
4. The k-th slot of a source takes its block k modulo its number of blocks. What
   a document gives is what the taken blocks cover of it.

Hot sources: words before a document and slots before a slot are counted in two
steps (totals of parts, then within a part), so no task sorts a whole source.
All joins are on (source, part), (source, block) or grid cells. The only
windows that see a whole source or all sources run over these totals.

Only DataFrame functions are used. Sizes are computed once and written to the
shared folder, without texts.

Defined results: a null or empty text has 0 words, takes part in no block and
takes 0. Rows with the same id stand for themselves; identical rows are
interchangeable. A table without words has targets 0. Other columns may have
any name. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from metaferry.llm.columns import word_count
from metaferry.sources.staging import staged

WEIGHTS, MOST = (5, 2, 1), 3
SLOTS = 1 << 17
# The golden ratio's part of a grid of 2^31 points, made odd.
GRID_BITS, GOLDEN = 31, 1327217885
CELL_BITS = 12
PART_DIGITS, CHUNK_BITS = 3, 16


def sized(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """(key, source, size, order, part, fingerprint) of every document."""
    order = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    return docs.select(
        F.col(key).alias("key"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        order.alias("order"),
        F.substring(order, 1, PART_DIGITS).alias("part"),
        fingerprint(key, source, text).alias("print"),
    )


def fingerprint(key: str, source: str, text: str) -> Column:
    """128 bits of a row."""
    parts = [F.col(name).cast("string") for name in (key, source, text)]
    return F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(7), *parts).alias("b"))


def targets(sizes: DataFrame) -> DataFrame:
    """(source, sid, source_size, n_documents, weight, target) per source."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_documents"))
    ordered = totals.withColumn("sid", F.row_number().over(W.orderBy(F.asc_nulls_last("source"))))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.col("sid") - 1) % len(WEIGHTS) + 1).cast("int"))
    fullness = W.orderBy(F.col("source_size") / F.col("weight"), "sid")
    before, everything = fullness.rowsBetween(W.unboundedPreceding, -1), fullness.rowsBetween(
        W.unboundedPreceding, W.unboundedFollowing
    )
    none = F.lit(0).cast("bigint")
    limit = MOST * F.col("source_size")
    levels = (
        ordered.withColumn("weight", weight.cast("bigint"))
        .withColumn("_left", F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(before), none))
        .withColumn("_weights", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), none))
        .withColumn("_full", limit / F.col("weight") < F.col("_left") / F.col("_weights"))
        # The first source that isn't full sees the words and weights that the others share.
        .withColumn("_open", F.min(F.when(~F.col("_full"), F.struct(F.col("source_size") / F.col("weight"), "sid", "_left", "_weights"))).over(everything))
    )
    share = F.col("_open._left") / F.col("_open._weights") * F.col("weight")
    return levels.select(
        "source", "sid", "source_size", "n_documents", "weight",
        F.when(F.col("_full"), limit.cast("double")).otherwise(F.least(share, limit.cast("double"))).alias("target"),
    )


def blocks_of(sources: DataFrame) -> DataFrame:
    """Adds n_blocks, the words of a block (``base``, one more in the first ``larger`` blocks) and the slots wanted."""
    everything = W.partitionBy()
    per_block = F.greatest(
        F.lit(1.0), F.ceil(F.sum("source_size").over(everything) / F.greatest(F.sum("n_documents").over(everything), F.lit(SLOTS)))
    )
    n_blocks = F.when(F.col("source_size") > 0, F.greatest(F.lit(1), F.round(F.col("source_size") / per_block))).otherwise(0)
    with_blocks = sources.withColumn("n_blocks", n_blocks.cast("bigint"))
    size, number = F.col("source_size"), F.col("n_blocks")
    return (
        with_blocks.withColumn("base", F.when(number > 0, F.floor(size / number)).otherwise(0).cast("bigint"))
        .withColumn("larger", size - number * F.col("base"))
        .withColumn("slots", F.when(number > 0, F.col("target") / size * number).otherwise(F.lit(0.0)))
    )


def schedule(sources: DataFrame) -> DataFrame:
    """(slot, sid, rank, block, epoch): which block of which source stands in each slot.

    Runs a job that counts the slots.
    """
    grid = 1 << GRID_BITS
    # The total is the last running sum, so that it doesn't depend on the order of adding.
    running = F.sum("slots").over(W.orderBy("sid").rowsBetween(W.unboundedPreceding, 0))
    summed = sources.filter(F.col("slots") > 0).withColumn("_running", running)
    n_slots = summed.agg(F.round(F.max("_running")).cast("bigint").alias("n")).first()["n"] or 0
    upper = F.floor(F.col("_running") / F.max("_running").over(W.partitionBy()) * grid)
    owners = (
        summed.withColumn("_upper", upper.cast("bigint"))
        .withColumn("_lower", F.coalesce(F.lag("_upper").over(W.orderBy("sid")), F.lit(0).cast("bigint")))
        .filter(F.col("_upper") > F.col("_lower"))
    )
    cell = lambda point: F.shiftright(point, GRID_BITS - CELL_BITS)
    cells = owners.select(
        "sid", "n_blocks", "_lower", "_upper",
        F.explode(F.sequence(cell(F.col("_lower")), cell(F.col("_upper") - 1))).alias("cell"),
    )
    point = (F.col("slot").bitwiseAND(F.lit(grid - 1)) * F.lit(GOLDEN)).bitwiseAND(F.lit(grid - 1))
    placed = (
        sources.sparkSession.range(n_slots)
        .select(F.col("id").alias("slot"))
        .withColumn("point", point)
        .withColumn("cell", cell(F.col("point")))
        .join(cells, "cell")
        .filter((F.col("_lower") <= F.col("point")) & (F.col("point") < F.col("_upper")))
        .select("slot", "sid", "n_blocks", F.shiftright("slot", CHUNK_BITS).alias("chunk"))
    )
    earlier = W.partitionBy("sid").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    chunks = placed.groupBy("sid", "chunk").agg(F.count("*").alias("n")).select(
        "sid", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before")
    )
    rank = F.col("_before") + F.row_number().over(W.partitionBy("sid", "chunk").orderBy("slot")) - 1
    return (
        placed.join(chunks, ["sid", "chunk"])
        .withColumn("rank", rank.cast("bigint"))
        .withColumn("block", F.col("rank") % F.col("n_blocks"))
        .withColumn("epoch", F.floor(F.col("rank") / F.col("n_blocks")))
        # Rounding may give a full source a slot too many.
        .filter(F.col("epoch") < MOST)
        .select("slot", "sid", "rank", "block", "epoch")
    )


def laid_out(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """Every document with the number of its source's words before it."""
    known = sources.select("source", "sid", "source_size", "target", "base", "larger")
    placed = sizes.join(known, sizes["source"].eqNullSafe(known["source"])).drop(known["source"])
    earlier = W.partitionBy("sid").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = placed.groupBy("sid", "part").agg(F.sum("size").alias("n")).select(
        "sid", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before")
    )
    within = W.partitionBy("sid", "part").orderBy("order", "key", "size").rowsBetween(W.unboundedPreceding, 0)
    return (
        placed.join(parts, ["sid", "part"])
        .withColumn("start", F.col("_before") + F.sum("size").over(within) - F.col("size"))
        .drop("_before")
    )


def mix(
    docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text"
) -> DataFrame:
    """(key, source, print, size, source_size, target, taken): the words the mix takes of every document.

    Runs a job that measures the documents and writes their sizes.
    """
    sizes = staged(sized(docs, key, source, text))
    sources = staged(blocks_of(targets(sizes)))
    placed = laid_out(sizes, sources)
    times = schedule(sources).groupBy("sid", "block").agg(F.count("*").alias("times"))

    base, larger = F.col("base"), F.col("larger")
    long_part = larger * (base + 1)

    def block_at(word: Column) -> Column:
        later = larger + F.floor((word - long_part) / F.greatest(base, F.lit(1)))
        return F.when(word < long_part, F.floor(word / (base + 1))).otherwise(later).cast("bigint")

    def first_word(block: Column) -> Column:
        return block * base + F.least(block, larger)

    end = F.col("start") + F.col("size")
    pieces = (
        placed.filter(F.col("size") > 0)
        .withColumn("block", F.explode(F.sequence(block_at(F.col("start")), block_at(end - 1))))
        .withColumn("part_words", F.least(end, first_word(F.col("block") + 1)) - F.greatest("start", first_word(F.col("block"))))
    )
    identity = ["sid", "start", "key", "source", "print", "size", "source_size", "target"]
    taken = (
        pieces.join(times, ["sid", "block"], "left")
        .groupBy(*identity)
        .agg(F.sum(F.col("part_words") * F.coalesce(F.col("times"), F.lit(0))).alias("taken"))
    )
    empty = placed.filter(F.col("size") == 0).withColumn("taken", F.lit(0).cast("bigint"))
    columns = ["key", "source", "print", "size", "source_size", "target", "taken"]
    return taken.select(*columns).unionByName(empty.select(*columns)).withColumnRenamed("key", key)


def mixed_documents(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """``docs`` as often as the mix takes them: the words taken over the size, rounded. A document without words stays once."""
    copies = F.when(F.col("size") == 0, 1).otherwise(F.floor(F.col("taken") / F.col("size") + 0.5)).cast("bigint")
    wanted = (
        mix(docs, key, source, text)
        .groupBy(F.col("print").alias("_mix_print"))
        .agg(F.sum(copies).alias("_mix_copies"), F.count("*").alias("_mix_rows"))
    )
    marked = docs.withColumn("_mix_print", fingerprint(key, source, text)).join(wanted, "_mix_print")
    # Identical rows share their copies as evenly as possible.
    rank = F.row_number().over(W.partitionBy("_mix_print").orderBy("_mix_print"))
    share = F.floor(F.col("_mix_copies") / F.col("_mix_rows")) + F.when(
        rank <= F.col("_mix_copies") % F.col("_mix_rows"), 1
    ).otherwise(0)
    return (
        marked.withColumn("_mix_times", share)
        .withColumn("_mix_each", F.explode(F.array_repeat(F.lit(1), F.col("_mix_times").cast("int"))))
        .select(*[F.col(f"`{name}`") for name in docs.columns])
    )
