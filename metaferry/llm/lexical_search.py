"""Ranked lexical search of a set of items over all documents, with equal bags scored once.

1. Items are cut into blocks of at most ``BLOCK_TERMS`` (item, term) pairs, counted
   before anything is sent anywhere; an item with more terms is a block of its
   own. What tasks get of a block, its vocabulary and its postings, so has a
   bound; more items make more blocks, each one pass over the documents.
2. Every text is cut into terms and restricted to the block's vocabulary: its bag
   is the sorted term numbers with their frequencies, beside the number of all
   its terms. N and L are sums over these rows.
3. Documents with the same bag and the same length part m have the same score for
   every item: they are one class. Classes meet by a hash and are verified by
   the whole bag, which is part of the grouping key. The document frequency of a
   term is the sum of the sizes of the classes that hold it.
4. A task scores its classes against the items, in blocks of a matrix of exact
   whole numbers, and keeps per item the ``k`` best classes, equal scores by their
   smallest doc_id. No document of a later class can be among the ``k`` best, as
   every class before it has a document that comes first.
5. The best classes are expanded to their members, again by hash and verified by
   the bag; of a class the ``k`` smallest doc_ids are enough. Pairs of items and
   documents are never put out.

Defined results: a null text, or one without a term, counts for nothing and is
never found. Every row is a document, also where ids repeat; a null id comes
last among equals. Rows of items that share an id are one item with the terms of
all; an item without terms, or with terms no document has, has no rows. Other
columns may have any name. Empty tables give an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from metaferry.llm.parts import parts
from metaferry.operators.joins import hot_join
from metaferry.sources.staging import staged

# A term is a run of ASCII letters and digits and of all characters beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BEST = 10
BLOCK_TERMS = 1_000_000
# Cells of a matrix of scores, and of one of term values.
_CELLS = 1 << 21
_PIECE = 1 << 20
_TERM, _BREAK = re.compile(TERM), re.compile(BREAKS)
_LOWER = str.maketrans(CAPITALS, SMALL)


def item_terms(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """(item, term), once each; only A-Z are lower-cased."""
    lower = F.translate(F.col(text), CAPITALS, SMALL)
    terms = F.array_distinct(F.array_remove(F.split(lower, BREAKS), ""))
    return items.select(F.col(key).alias("item"), F.explode(terms).alias("term")).distinct()


def bag(text: str, numbers: dict[str, int]) -> tuple[dict[int, int], int]:
    """The frequencies of the terms that have a number, and the number of all terms, in pieces that end between terms."""
    counts: Counter[str] = Counter()
    at = 0
    while at < len(text):
        cut = _BREAK.search(text, at + _PIECE) if len(text) - at > _PIECE else None
        end = cut.start() if cut else len(text)
        counts.update(_TERM.findall(text[at:end].translate(_LOWER)))
        at = end
    return {numbers[term]: n for term, n in counts.items() if term in numbers}, sum(counts.values())


def bags(docs: DataFrame, vocabulary: list[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, n, terms, counts) of documents with a term: all terms counted, and the bag by place in ``vocabulary``."""
    kind = dict(docs.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = {term: place for place, term in enumerate(vocabulary)}
        for batch in parts(batches, 1):
            sizes, terms, counts = [], [], []
            for value in batch.column(1):
                found, n = bag(value.as_py() or "", numbers)
                order = sorted(found)
                sizes.append(n)
                terms.append(order)
                counts.append([found[term] for term in order])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(terms, pa.list_(pa.int32())),
                    pa.array(counts, pa.list_(pa.int32())),
                ],
                ["doc", "n", "terms", "counts"],
            )

    rows = docs.select(F.col(key).alias("doc"), F.col(text).alias("text")).filter(F.col("text") != "")
    return rows.mapInArrow(run, f"doc {kind}, n bigint, terms array<int>, counts array<int>").filter("n > 0")


def classes_of(members: DataFrame) -> DataFrame:
    """(hash, m, terms, counts, first, n_members) of members with equal m and bag."""
    return members.groupBy("hash", "m", "terms", "counts").agg(
        F.min("doc").alias("first"), F.count("*").alias("n_members")
    )


class Scores:
    """The postings of a block of items, and the weights of its terms."""

    def __init__(self, item_numbers: np.ndarray, terms: np.ndarray, weights: np.ndarray, n_items: int):
        order = np.argsort(item_numbers, kind="stable")
        self.terms = terms[order]
        self.bounds = np.searchsorted(item_numbers[order], np.arange(n_items + 1))
        self.weights, self.n_items = weights, n_items

    def blocks(self, m: np.ndarray, starts: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(first item, scores) of classes (rows) in blocks of items (columns).

        Doubles hold these whole numbers exactly: a term adds less than 2^36, so
        2^17 terms of an item fit into the 53 bits; longer items are added up in
        whole numbers, part by part.
        """
        n = len(m)
        used, place = np.unique(terms, return_inverse=True)
        owner = np.repeat(np.arange(n), np.diff(starts))
        counts = counts.astype(np.int64)
        values = np.zeros((n, len(used)))
        values[owner, place] = self.weights[terms] * (1_000_000_000 * counts // (1000 * counts + 8 * m[owner]))
        width = max(1, _CELLS // max(n, len(used), 1))
        for first in range(0, self.n_items, width):
            last = min(first + width, self.n_items)
            found = self.terms[self.bounds[first] : self.bounds[last]]
            item = np.repeat(np.arange(last - first), np.diff(self.bounds[first : last + 1]))
            at = np.searchsorted(used, found)
            known = at < len(used)
            known[known] = used[at[known]] == found[known]
            holds = np.zeros((len(used), last - first))
            holds[at[known], item[known]] = 1
            scores = np.zeros((n, last - first), np.int64)
            for begin in range(0, len(used), 1 << 17):
                some = slice(begin, begin + (1 << 17))
                scores += (values[:, some] @ holds[some]).astype(np.int64)
            yield first, scores


def _best(scores: Scores, k: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best ``k`` of a task's classes per item, as (item number, score, hash, m, first)."""
    kept: dict[int, list[tuple]] = {}
    least = np.zeros(scores.n_items, np.int64)
    for whole in batches:
        rows = 1024
        for batch in (whole.slice(at, rows) for at in range(0, whole.num_rows, rows)):
            hashes, m, first = (batch.column(k) for k in range(3))
            lists = batch.column(3)
            starts = lists.offsets.to_numpy().astype(np.int64)
            terms, counts = (batch.column(k).flatten().to_numpy() for k in (3, 4))
            ids = first.to_pylist()
            for begin, found in scores.blocks(m.to_numpy(), starts - starts[0], terms, counts):
                # A class with the worst kept score may still come first by its doc_id.
                row, item = np.nonzero((found > 0) & (found >= least[begin : begin + found.shape[1]]))
                for r, i in zip(row.tolist(), (begin + item).tolist()):
                    entry = (-int(found[r, i - begin]), ids[r] is None, ids[r] or 0, hashes[r].as_py(), m[r].as_py())
                    kept.setdefault(i, []).append(entry)
                    if len(kept[i]) >= 4 * k:
                        kept[i] = sorted(kept[i])[:k]
                        least[i] = -kept[i][-1][0]
    rows = [(i, -s, h, m, None if none else doc) for i, found in kept.items() for s, none, doc, h, m in sorted(found)[:k]]
    if rows:
        names, kinds = ["number", "score", "hash", "m", "first"], [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        columns = [list(values) for values in zip(*rows)]
        arrays = [pa.array(values, kind) for values, kind in zip(columns, kinds)]
        yield pa.RecordBatch.from_arrays([*arrays, pa.array(columns[4], first.type)], names)


def _search_block(docs: DataFrame, pairs: DataFrame, key: str, text: str, k: int) -> DataFrame:
    """(item, rank, doc, score) for the items of one block of (item, term) pairs. Runs jobs."""
    spark = docs.sparkSession
    posted = pairs.toArrow()  # at most BLOCK_TERMS rows, or one item
    items = posted.column("item").combine_chunks()
    names = items.unique()
    codes = items.dictionary_encode(null_encoding="encode")
    vocabulary = sorted(set(posted.column("term").to_pylist()))
    place = {term: number for number, term in enumerate(vocabulary)}
    numbers = np.array([place[term] for term in posted.column("term").to_pylist()], np.int64)
    item_numbers = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    known = spark.createDataFrame(
        pa.table({"number": pa.array(range(len(names)), pa.int32()), "item": codes.dictionary})
    )

    rows = staged(bags(docs, vocabulary, key, text))
    n_docs, n_terms = rows.agg(F.count("*"), F.sum("n")).first()
    if not n_docs:
        return _none(docs, pairs, key)
    m = F.expr(f"100 - 90 + (90 * n * {n_docs}L) div {n_terms}L")
    counted = rows.filter(F.size("terms") > 0).withColumn("m", m)
    members = counted.select("doc", "m", "terms", "counts", F.xxhash64("m", "terms", "counts").alias("hash"))
    classes = staged(classes_of(members))
    held = classes.select(F.explode("terms").alias("term"), "n_members").groupBy("term").agg(F.sum("n_members").alias("df"))
    weights = np.zeros(len(vocabulary), np.int64)
    for term, w in held.select("term", F.floor(1000 * F.log((2.0 * n_docs + 2) / (2.0 * F.col("df") + 1)))).toArrow().to_pandas().itertuples(index=False):
        weights[term] = w
    scores = Scores(item_numbers, numbers, weights, len(names))
    kind = dict(docs.dtypes)[key]
    found = classes.select("hash", "m", "first", "terms", "counts").mapInArrow(
        lambda batches: _best(scores, k, batches), f"number int, score bigint, hash bigint, m bigint, first {kind}"
    )
    by_score = W.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("first"), "hash", "m")
    best = staged(found.withColumn("_place", F.row_number().over(by_score)).filter(F.col("_place") <= k).drop("_place"))

    # The chosen classes with their bags, and the first members of each.
    same = [F.col(f"c.{name}").eqNullSafe(F.col(f"b.{name}")) for name in ("hash", "m", "first")]
    wanted = classes.alias("c").join(best.select("hash", "m", "first").distinct().alias("b"), [F.col("c.hash") == F.col("b.hash"), *same[1:]]).select("c.*")
    bag_of = [F.col(f"d.{name}") == F.col(f"c.{name}") for name in ("hash", "m", "terms", "counts")]
    of_class = members.alias("d").join(wanted.alias("c"), bag_of).select("d.doc", "c.hash", "c.m", "c.first")
    by_doc = W.partitionBy("hash", "m", "first").orderBy(F.asc_nulls_last("doc"))
    firsts = of_class.withColumn("_place", F.row_number().over(by_doc)).filter(F.col("_place") <= k).drop("_place")
    pair = [F.col("b.hash") == F.col("f.hash"), F.col("b.m") == F.col("f.m"), F.col("b.first").eqNullSafe(F.col("f.first"))]
    expanded = best.alias("b").join(firsts.alias("f"), pair).select("b.number", "b.score", "f.doc")
    order = W.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    ranked = expanded.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(known, "number").select("item", "rank", "doc", "score")


def _none(docs: DataFrame, pairs: DataFrame, key: str) -> DataFrame:
    kinds = f"item {dict(pairs.dtypes)['item']}, rank int, doc {dict(docs.dtypes)[key]}, score bigint"
    return docs.sparkSession.createDataFrame([], kinds)


def _blocks(pairs: DataFrame, block_terms: int) -> DataFrame:
    """``pairs`` with the number of a block; a block has ``block_terms`` pairs at most, or one item. Runs jobs."""
    n_pairs, n_items = pairs.agg(F.count("*"), F.count_distinct(F.struct("item"))).first()
    count = max(1, -(-n_pairs // block_terms))
    while True:
        dealt = pairs.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(count)))
        sizes = dealt.groupBy("block").agg(F.count("*").alias("n"), F.count_distinct(F.struct("item")).alias("items"))
        if not sizes.filter((F.col("n") > block_terms) & (F.col("items") > 1)).head(1):
            return dealt
        count *= 2


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = BEST,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """(item_key, rank, key, score): the ``k`` best documents of every item. Runs jobs."""
    pairs = staged(item_terms(items, item_key, item_text))
    dealt = _blocks(pairs, block_terms)
    result = _none(docs, pairs, key)
    for (block,) in dealt.select("block").distinct().orderBy("block").collect():
        chosen = dealt.filter(F.col("block") == block).drop("block")
        result = result.unionByName(_search_block(docs, chosen, key, text, k))
    return result.select(F.col("item").alias(item_key), "rank", F.col("doc").alias(key), "score")
