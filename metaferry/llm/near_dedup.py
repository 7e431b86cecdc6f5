"""MinHash near-dedup with an LSH forest.

1. Every text becomes its set of word shingles; equal sets are one class, so
   copies are gone before anything is compared. The class carries the smallest id.
2. A tree of the forest is one order of the signature. In a first pass classes are
   sorted by a few of these orders (a range sort, so a group that holds a third of
   all rows is spread over many tasks). Candidates of a row are its neighbour, which
   has the longest common prefix, and the first row of each prefix of ``STEPS``
   values it shares. The best candidate and one more per class are compared; they
   join most of every group of near copies.
3. A second pass takes from each region of these few trees the likeliest candidate of
   each component. Passes over the whole forest then look for what is still apart. A region of a tree
   is a prefix of ``LEAST_DEPTH`` values. It counts the pairs of classes in
   different components, and where these are more than ``REGION_PAIRS`` it is cut
   at the next value, down to ``DEPTH``: the depth adapts to what is undecided in
   the region. All such pairs of a region are candidates. As links join components,
   fewer pairs are undecided and the next pass cuts the same region less deep. Passes
   end when no region was cut, or when none found a new link.
4. Candidates that differ too much are dropped, by two bits of each value and by a
   sketch of the set with ``BINS`` bytes (both limits are about four standard
   deviations away at a similarity of 0.75). The others are confirmed on the full sets of the
   full texts, no pair twice.
5. Links are joined to components by star contraction, which halves paths in
   every round; each round is checkpointed.

No number of partners or candidates is capped. A region that is larger than a block
(only because one component holds most of it, or at full depth) is parted by a hash
of the id: if few rows are outside of its main component they go to each block,
otherwise each pair of blocks is a group of its own. No task has to hold more than
two blocks. Where no region is cut in the last pass, a pair at the bound shares no
region with a probability of (1 - 0.75^3)^18, less than 1 in 10,000. Regions that
stay cut hold very many loosely alike texts that are not linked with each other; there
a pair at the bound that shares d values is met with 1 - (1 - 0.75^d)^18. The README
has the recall measured against brute force.

Defined results: a text without words has an empty set and is linked with
nothing. Rows that share an id are one document: what one is linked with, the
other is. A row with a null id is never linked, its component is null and it is
kept. Other columns may have any name. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from metaferry.llm.components import components
from metaferry.llm.parts import parts
from metaferry.llm.shingles import mixed, shingle_set, word_hashes
from metaferry.operators.joins import hot_join
from metaferry.sources.staging import staged

PERCENT = 75
TREES, STRIDE, LEAST_DEPTH, DEPTH = 18, 4, 3, 24
# The first pass: trees, and the prefixes whose first row is a candidate.
FIRST_TREES, STEPS = 6, (3, 6, 12)
# Undecided pairs of a region that is not cut deeper, and rows of a block.
REGION_PAIRS, BLOCK_ROWS = 1 << 22, 1024
VALUES, BINS, COARSE = TREES * STRIDE, 1024, 4
_FACTORS = mixed(np.arange(1, VALUES + 1, dtype=np.uint64)) | np.uint64(1)
_BLOCK = 1 << 14
_KEPT = "_near_dedup_kept"


def _shuffled(left: DataFrame, right: DataFrame, key: str | list[str], how: str = "inner") -> DataFrame:
    """A join whose sides both grow with the input: neither is ever sent to all tasks."""
    return hot_join(left.hint("merge"), right.hint("merge"), key, how)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The smallest values of a set under ``VALUES`` hash functions, 16 bits of each."""
    least = np.full(VALUES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), _BLOCK):
        part = shingles[start : start + _BLOCK]
        for k, factor in enumerate(_FACTORS):
            least[k] = min(least[k], (part * factor).min())
    return (mixed(least) & np.uint64(0xFFFF)).astype(">u2")


def fine_sketch(shingles: np.ndarray) -> bytes:
    """The size of a set, and a byte of its smallest member in each of ``BINS`` ranges of hashes, 0 where a range has none."""
    edges = np.searchsorted(shingles, np.arange(BINS, dtype=np.uint64) << np.uint64(54))
    found = np.zeros(BINS, np.uint8)
    held = np.diff(edges, append=len(shingles)) > 0
    found[held] = mixed(shingles[edges[held]]) % np.uint64(255) + np.uint64(1)
    return np.int64(len(shingles)).tobytes() + found.tobytes()


def _coarse(fine: np.ndarray) -> np.ndarray:
    """Sketches of ranges that are ``COARSE`` times as wide: of each the first one that is held."""
    ranges = fine.reshape(len(fine), -1, COARSE)
    return np.take_along_axis(ranges, (ranges != 0).argmax(axis=2)[:, :, None], axis=2)[:, :, 0]


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in parts(batches, 1):
        sizes, prints, signatures, fines = [], [], [], []
        for text in batch.column(1):
            found = shingle_set(word_hashes(text.as_py()))
            sizes.append(len(found))
            if len(found):
                total, mix = found.sum(dtype=np.uint64), np.bitwise_xor.reduce(mixed(found + np.uint64(len(found))))
                prints.append(total.tobytes() + mix.tobytes())
                signatures.append(signature(found).tobytes())
                fines.append(fine_sketch(found))
            else:
                for column in (prints, signatures, fines):
                    column.append(None)
        binary = [pa.array(column, pa.binary()) for column in (prints, signatures, fines)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), *binary], ["id", "n_shingles", "print", "signature", "fine"]
        )


def sketches(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, print, signature, fine) per row; print identifies the set and is null where it is empty."""
    kind = dict(docs.dtypes)[key]
    return docs.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(
        _sketches, f"id {kind}, n_shingles bigint, print binary, signature binary, fine binary"
    )


def _values(column: pa.Array) -> np.ndarray:
    """Signatures as rows of numbers."""
    return np.frombuffer(b"".join(column.to_pylist()), ">u2").reshape(len(column), VALUES)


def _order(tree: int) -> list[int]:
    """The places of a signature in one tree's order: its own values first, then those of the next trees."""
    return [(tree * STRIDE + k) % VALUES for k in range(DEPTH)]


def _brief(values: np.ndarray) -> np.ndarray:
    """Two bits of each value of signatures, packed."""
    return np.packbits(np.stack([values >> 1 & 1, values & 1], axis=2).astype(np.uint8).reshape(len(values), -1), axis=1)


_BITS = np.array([bin(k).count("1") for k in range(256)], np.uint8)
# Values that may differ in two bits. At a similarity of 0.75 3/16 do on average; the limit is 3.8 standard deviations away.
_MOST_APART = int(0.37 * VALUES)
# Standard deviations that the estimate of a fine sketch may lie under the bound.
_SLACK = 4.0
_PAIRS_AT_ONCE = 1 << 12


def _near(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Which brief signatures are not far apart, row by row."""
    differing = one ^ other
    return _BITS[(differing | differing >> 1) & 0x55].sum(axis=1) <= _MOST_APART


def _agreement(one: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sketches row by row: ranges that either holds, and those in which both hold the same."""
    return ((one | other) != 0).sum(axis=1), ((one == other) & (one != 0)).sum(axis=1)


def _alike(one: np.ndarray, other: np.ndarray, union: np.ndarray | None = None) -> np.ndarray:
    """Which sketches may be of similar sets, row by row.

    A range shows whether one member of the union, drawn at random, is common. ``union`` is the size of the
    union at the bound; the more of it was drawn, the closer is the estimate.
    """
    held, common = _agreement(one, other)
    bound = PERCENT / 100
    rest = 1.0 if union is None else np.clip((union - held + 1) / union, 0, 1)
    return common >= bound * held - _SLACK * np.sqrt(bound * (1 - bound) * held * rest) - 1


def _alike_pairs(fine: np.ndarray, sizes: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The share of agreeing ranges of pairs of rows whose sketches may be of similar sets; 0 for others."""
    found = np.zeros(len(one))
    for start in range(0, len(one), _PAIRS_AT_ONCE):
        some = slice(start, start + _PAIRS_AT_ONCE)
        a, b = one[some], other[some]
        held, common = _agreement(fine[a], fine[b])
        found[some] = _alike(fine[a], fine[b], (sizes[a] + sizes[b]) / (1 + PERCENT / 100)) * common / held
    return found


def _rows_of_bytes(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), width)


def _sort_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (tree, path, id, coarse) of the first pass; a path is a signature in the order of its tree."""
    orders = np.array([_order(tree) for tree in range(FIRST_TREES)])
    for batch in batches:
        n = batch.num_rows
        if n:
            paths = _values(batch.column(1))[:, orders].tobytes()
            coarse = _coarse(_rows_of_bytes(batch.column(2), 8 + BINS)[:, 8:])
            owner = pa.array(np.repeat(np.arange(n), FIRST_TREES))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.tile(np.arange(FIRST_TREES, dtype=np.int32), n)),
                    pa.array([paths[k : k + DEPTH * 2] for k in range(0, len(paths), DEPTH * 2)], pa.binary()),
                    batch.column(0).take(owner),
                    pa.array([row.tobytes() for row in coarse], pa.binary()).take(owner),
                ],
                ["tree", "path", "id", "coarse"],
            )


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates (a, b, estimate) of the sorted rows of one task: the row before, and the first rows with the same prefix."""
    carried: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        known = carried.num_rows if carried else 0
        table = (pa.concat_tables([carried, now]) if carried else now).combine_chunks()
        keys = np.concatenate(
            [
                table.column(0).to_numpy()[:, None].astype(np.int64),
                _rows_of_bytes(table.column(1), DEPTH * 2).view(">u2").astype(np.int64),
            ],
            axis=1,
        )
        shared = np.full(len(keys), -1)
        shared[1:] = (keys[1:] == keys[:-1]).cumprod(axis=1).sum(axis=1) - 1  # -1: another tree
        rows = np.arange(known, len(keys))
        sources = [rows[shared[rows] >= LEAST_DEPTH] - 1]
        targets = [sources[0] + 1]
        leaders = []
        for place, depth in enumerate(STEPS):
            # Of the carried rows each step's leader stands at its own place, the last row behind them.
            begins = np.where(shared[known:] < depth, rows, place if known else 0)
            first = np.maximum.accumulate(begins)
            leaders.append(first[-1])
            sources.append(first[first < rows])
            targets.append(rows[first < rows])
        left, right = np.concatenate(sources), np.concatenate(targets)
        coarse = _rows_of_bytes(table.column(3), BINS // COARSE)
        keep = _alike(coarse[left], coarse[right])
        left, right = left[keep], right[keep]
        held, common = _agreement(coarse[left], coarse[right])
        estimate = common / held
        ids = table.column(2).combine_chunks()
        yield pa.RecordBatch.from_arrays(
            [*(_taken(ids, side) for side in (left, right)), pa.array(estimate)], ["a", "b", "estimate"]
        )
        carried = table.take(pa.array([*leaders, len(keys) - 1]))


def _taken(ids: pa.Array | pa.ChunkedArray, places: np.ndarray) -> pa.Array:
    found = ids.take(pa.array(places, pa.int64()))
    return pa.concat_arrays(found.chunks) if isinstance(found, pa.ChunkedArray) else found


def first_candidates(classes: DataFrame) -> DataFrame:
    """Pairs (a, b): for each class (id, signature, fine) its best candidate among sorted neighbours, and any other one. Runs a job."""
    kind = dict(classes.dtypes)["id"]
    rows = classes.select("id", "signature", "fine").mapInArrow(_sort_rows, f"tree int, path binary, id {kind}, coarse binary")
    tasks = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = (
        rows.repartitionByRange(tasks, "tree", "path", "id")
        .sortWithinPartitions("tree", "path", "id")
        .mapInArrow(_neighbours, f"a {kind}, b {kind}, estimate double")
    )
    best = F.max_by("a", F.struct("estimate", "a"))
    other = F.max_by("a", F.xxhash64("a", "b"))
    chosen = found.filter("a <> b").groupBy("b").agg(best.alias("best"), other.alias("other"))
    return staged(chosen.select(F.explode(F.array_distinct(F.array("best", "other"))).alias("a"), "b").transform(_ordered))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()


def _first_places(batches: Iterator[pa.RecordBatch], trees: int) -> Iterator[pa.RecordBatch]:
    """The region of each tree that classes (id, part, signature) lie in: the tree's number and its first values."""
    for batch in batches:
        n = batch.num_rows
        if n:
            values = _values(batch.column(2))
            place = np.repeat(np.arange(trees, dtype=np.int64)[None], n, axis=0)
            for k in range(LEAST_DEPTH):
                place = place << 16 | values[:, k::STRIDE][:, :trees].astype(np.int64)
            owner = pa.array(np.repeat(np.arange(n), trees))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(place.ravel()),
                    pa.array(np.tile(np.arange(trees, dtype=np.int32), n)),
                    batch.column(0).take(owner),
                    batch.column(1).take(owner),
                ],
                ["place", "tree", "id", "part"],
            )


def _next_places(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
    """Rows (place, tree, id, part, signature) with places that take in the value at ``depth`` of their tree's order."""
    column_of = np.array([_order(tree)[depth] for tree in range(TREES)])
    for batch in batches:
        if batch.num_rows:
            values = _values(batch.column(4))[np.arange(batch.num_rows), column_of[batch.column(1).to_numpy()]]
            place = mixed(batch.column(0).to_numpy().view(np.uint64)) ^ mixed(values.astype(np.uint64) + np.uint64(depth << 16))
            yield batch.set_column(0, "place", pa.array(mixed(place).view(np.int64)))


def undecided(classes: DataFrame, region_pairs: int = REGION_PAIRS, trees: int = TREES) -> tuple[DataFrame, bool]:
    """(place, cell, id) of classes (id, part, signature) that meet others of another part, and whether a region was cut. Runs jobs."""
    kind = dict(classes.dtypes)["id"]
    rows = classes.select("id", "part", "signature").mapInArrow(
        lambda batches: _first_places(batches, trees), f"place bigint, tree int, id {kind}, part {kind}"
    )
    signed = classes.select("id", "signature")
    settled, cut = [], False
    for depth in range(LEAST_DEPTH, DEPTH + 1):
        each = rows.groupBy("place", "part").agg(F.count("*").cast("double").alias("n"))
        regions = each.groupBy("place").agg(
            F.sum("n").alias("rows"),
            ((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2).alias("pairs"),
            F.max_by("part", F.struct("n", "part")).alias("main"),
            (F.sum("n") - F.max("n")).alias("few"),
        )
        regions = staged(regions.filter("pairs > 0"))
        crowded = F.col("pairs") > region_pairs
        if depth == DEPTH or regions.filter(crowded).isEmpty():
            settled.append(_cells(rows, regions))
            break
        cut = True
        settled.append(_cells(rows, regions.filter(~crowded)))
        names = ["place", "tree", "id", "part", "signature"]
        deeper = _shuffled(rows, regions.filter(crowded).select("place"), "place", "left_semi")
        deeper = _shuffled(deeper.select("place", "tree", "id", "part"), signed, "id").select(*names)
        next_depth = lambda batches, depth=depth: _next_places(batches, depth)
        rows = staged(
            deeper.mapInArrow(next_depth, f"place bigint, tree int, id {kind}, part {kind}, signature binary").drop("signature")
        )
    found = settled[0]
    for other in settled[1:]:
        found = found.unionByName(other)
    return found, cut


def _cells(rows: DataFrame, regions: DataFrame) -> DataFrame:
    """Rows (place, id, part) of ``regions`` by cell: every two of different parts meet in at least one cell.

    A region of several blocks whose rows outside of its main part fit one block has
    these in each cell and every other row in one; otherwise each pair of blocks is a cell.
    """
    dealt = _shuffled(rows.select("place", "id", "part"), regions, "place").withColumn(
        "blocks", F.ceil(F.col("rows") / BLOCK_ROWS)
    )
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    every = F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)
    others = F.filter(every, lambda other: other != F.col("block"))
    block_pairs = F.transform(others, lambda other: F.least("block", other) * F.col("blocks") + F.greatest("block", other))
    cells = (
        F.when(F.col("blocks") == 1, F.array(F.lit(-1).cast("bigint")))
        .when(F.col("few") > BLOCK_ROWS, block_pairs)
        .when(F.col("part") == F.col("main"), F.array("block"))
        .otherwise(every)
    )
    return dealt.select("place", F.explode(cells).alias("cell"), "id", "part")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list[tuple[int, int]]]]:
    """Tables of whole groups, rows that agree in the first two columns, and where in them the groups of several rows are."""
    held: list[pa.RecordBatch] = []

    def bounds(table: pa.Table) -> np.ndarray:
        keys = np.stack([table.column(k).to_numpy() for k in (0, 1)])
        return np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1

    def several(starts: list[int], end: int) -> list[tuple[int, int]]:
        return [(one, other) for one, other in zip([0, *starts], [*starts, end]) if other - one > 1]

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*held, batch])
        starts = bounds(table).tolist()
        if starts:
            yield table.slice(0, starts[-1]), several(starts[:-1], starts[-1])
        held = table.slice(starts[-1] if starts else 0).to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, several([], table.num_rows)


@lru_cache(maxsize=256)
def _all_pairs(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(n, 1)


def _pairs_of_groups(batches: Iterator[pa.RecordBatch], best: bool) -> Iterator[pa.RecordBatch]:
    """Candidates (a, b) among the rows (place, cell, id, part, brief, fine) of each group that have different parts.

    With ``best`` only the likeliest one of each part in a group.
    """
    for table, groups in _groups(batches):
        if not groups:
            continue
        part = table.column(3).combine_chunks().dictionary_encode()
        part = (part.combine_chunks() if isinstance(part, pa.ChunkedArray) else part).indices.to_numpy()
        brief = _rows_of_bytes(table.column(4), VALUES // 4)
        fine = _rows_of_bytes(table.column(5), 8 + BINS)
        sizes, fine = np.ascontiguousarray(fine[:, :8]).view(np.int64)[:, 0], fine[:, 8:]
        left, right = [], []
        for start, end in groups:
            if end - start <= 64:
                one, other = _all_pairs(end - start)
            else:
                # Common values of every two briefs as a product of matrices.
                bits = np.unpackbits(brief[start:end], axis=1)
                marks = ((bits[:, ::2] * 2 + bits[:, 1::2])[:, :, None] == np.arange(4)).reshape(end - start, -1)
                marks = marks.astype(np.float32)
                hit = (marks @ marks.T >= VALUES - _MOST_APART) & (part[start:end, None] != part[None, start:end])
                one, other = np.nonzero(np.triu(hit, 1))
            left.append(one + start)
            right.append(other + start)
        one, other = np.concatenate(left), np.concatenate(right)
        apart = part[one] != part[other]
        one, other = one[apart], other[apart]
        near = _near(brief[one], brief[other])
        one, other = one[near], other[near]
        share = _alike_pairs(fine, sizes, one, other)
        keep = share > 0
        one, other, share = one[keep], other[keep], share[keep]
        if best and len(one):
            group = np.searchsorted([start for start, _ in groups], one, side="right")
            chosen = []
            for side in (one, other):
                order = np.lexsort([-share, part[side], group])
                before = np.roll(order, 1)
                change = (group[order] != group[before]) | (part[side[order]] != part[side[before]])
                change[0] = True
                chosen.append(order[change])
            chosen = np.unique(np.concatenate(chosen))
            one, other = one[chosen], other[chosen]
        ids = table.column(2).combine_chunks()
        yield pa.RecordBatch.from_arrays([_taken(ids, one), _taken(ids, other)], ["a", "b"])


def _with_briefs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            briefs = pa.array([row.tobytes() for row in _brief(_values(batch.column(1)))], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), briefs, batch.column(2)], ["id", "brief", "fine"])


def crossing(
    classes: DataFrame, region_pairs: int = REGION_PAIRS, trees: int = TREES, best: bool = False
) -> tuple[DataFrame, bool]:
    """Distinct candidates (a, b) of classes (id, part, signature, fine) in different parts, and whether a region was cut.

    With ``best`` only the likeliest one of each part in a region. Runs jobs.
    """
    kind = dict(classes.dtypes)["id"]
    rows, cut = undecided(classes, region_pairs, trees)
    known = classes.select("id", "signature", "fine").mapInArrow(_with_briefs, f"id {kind}, brief binary, fine binary")
    tasks = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = (
        _shuffled(rows, known, "id")
        .select("place", "cell", "id", "part", "brief", "fine")
        .repartition(tasks, "place", "cell")
        .sortWithinPartitions("place", "cell")
    )
    return grouped.mapInArrow(lambda batches: _pairs_of_groups(batches, best), f"a {kind}, b {kind}").transform(_ordered), cut


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sets: dict[str, np.ndarray] = {}

    def known(text: str) -> np.ndarray:
        if text not in sets:
            if len(sets) >= 50:
                sets.clear()
            sets[text] = shingle_set(word_hashes(text))
        return sets[text]

    for batch in batches:
        keep = []
        for row in range(batch.num_rows):
            one, other = (known(batch.column(column)[row].as_py()) for column in (2, 3))
            common = len(np.intersect1d(one, other, assume_unique=True))
            keep.append(common > 0 and 100 * common >= PERCENT * (len(one) + len(other) - common))
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar; ``texts`` is (id, text), an id may have several. Runs jobs."""
    kind = dict(texts.dtypes)["id"]
    needed = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    found = _shuffled(texts, needed, "id", "left_semi").withColumn("_hash", F.xxhash64("text"))
    found = staged(found.dropDuplicates(["id", "_hash"]).drop("_hash"))
    both = _shuffled(pairs.select("a", "b"), found.select(F.col("id").alias("a"), F.col("text").alias("left")), "a")
    both = _shuffled(both, found.select(F.col("id").alias("b"), F.col("text").alias("right")), "b")
    return staged(both.select("a", "b", "left", "right").mapInArrow(_confirmed, f"a {kind}, b {kind}").distinct())


def links(
    docs: DataFrame, classes: DataFrame, key: str = "doc_id", text: str = "text", region_pairs: int = REGION_PAIRS
) -> DataFrame:
    """Links (a, b) that join all similar classes (id, signature, fine) into components. Runs jobs."""
    texts = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    tested = first_candidates(classes)
    linked = confirmed(tested, texts)
    for best in chain([True], repeat(False)):
        joined = components(linked).withColumnRenamed("component", "part")
        labelled = _shuffled(classes, joined, "id", "left").withColumn("part", F.coalesce("part", "id"))
        labelled = staged(labelled.select("id", "part", "signature", "fine"))
        pairs, cut = crossing(labelled, region_pairs, FIRST_TREES if best else TREES, best)
        pairs = staged(_shuffled(pairs, tested, ["a", "b"], "left_anti"))
        found = confirmed(pairs, texts)
        tested = tested.unionByName(pairs)
        if not found.isEmpty():
            linked = linked.unionByName(found)
        elif not best:
            break
        if not best and not cut:
            break
    return linked


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, kept) of every row; component_id is the smallest id reachable. Runs jobs."""
    known = staged(sketches(docs, key, text))
    member = known.filter(F.col("print").isNotNull() & F.col("id").isNotNull())
    labels = member.groupBy("print").agg(F.min("id").alias("label"))
    signed = member.select("id", "print", "signature", "fine").join(
        labels.select(F.col("label").alias("id"), "print"), ["id", "print"], "left_semi"
    )
    # An id may stand for several sets, each with a signature of its own.
    classes = staged(signed.dropDuplicates(["id", "print"]).select("id", "signature", "fine"))
    members = staged(hot_join(member.select("id", "print"), labels, "print").select("id", "label").distinct())
    # An id with several texts belongs to several classes.
    several = members.groupBy("id").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high")
    own = hot_join(members, several.select("id", "low"), "id").select(F.col("low").alias("a"), F.col("label").alias("b"))
    joined = components(links(docs, classes, key, text).unionByName(own))
    label = members.groupBy("id").agg(F.min("label").alias("label"))
    found = hot_join(label, joined.select(F.col("id").alias("label"), "component"), "label", "left").select(
        "id", F.coalesce("component", "label").alias("component")
    )
    component = F.coalesce("component", "id")
    return hot_join(known.select("id", "n_shingles"), found, "id", "left").select(
        F.col("id").alias(key),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group, with all columns; of rows that share its id, the one with the smallest text hash."""
    found = near_duplicates(docs, key, text).filter("kept").select(F.col(key).alias(_KEPT)).filter(
        F.col(_KEPT).isNotNull()
    ).distinct()
    kept = docs.join(found, docs[key] == found[_KEPT], "left_semi")
    first = W.partitionBy(key).orderBy(F.xxhash64(text), F.length(text))
    ranked = kept.withColumn(_KEPT, F.row_number().over(first)).filter(F.col(_KEPT) == 1).drop(_KEPT)
    return ranked.unionByName(docs.filter(F.col(key).isNull()))
