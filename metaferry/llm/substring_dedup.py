"""Removal of long repeated passages by a compacted de Bruijn graph.

The graph's edges are the windows of ``WINDOW`` consecutive words, its nodes what
two consecutive windows share. A window goes where its sequence of words starts
at two places or more, and only such windows are worth a row of their own:

1. Every text is cut, in its task, into runs of consecutive windows that have
   their anchor at the same place, the first k-mer of ``ANCHOR`` words with the
   smallest hash in the window. Equal windows have equal anchors, so what happens
   to a window is decided among the runs of its anchor, and no window stands twice
   in a run. A run is one row for about 13 edges.
2. Anchors that occur once are done: their windows occur once. Runs of the same
   words are one path of edges; where an anchor has several runs, its path branches.
3. Runs that occur twice or more are joined with their source, the place that
   comes first, and compacted: as long as a text's runs go on along the same
   stretch of one source, they are one path, a (place, source place, length) row.
4. The words at both coordinates of a path are read and digested; a path whose
   digests agree is a repeated span. Windows of a run that occurs once, beside a
   branch, are counted one by one, by a digest of their words, together with one
   source of every other run of their anchor; of these only the ones that occur
   once are sent back to their text.
5. A text is read once more together with its spans and loses the words that they
   cover.

Work on texts is done once per distinct text, with the number of its copies.
Texts are joined by a 128-bit hash, runs by hashes of 64 bits, and whatever these
find alike is confirmed by digests of the words themselves. Nothing is collected
per passage: a passage that a third of all rows hold is a count. Lists are per
text and no longer than the text.

Defined results: words are runs of other characters than ASCII white space; null
and empty texts have none. A text of fewer words than a window keeps all. Every
row is a document, also where ids repeat or are null; equal texts all lose their
repeated words, the first copy too. Columns of the result are the key and the
named ones, so other columns of the input don't matter. An empty table gives an
empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from metaferry.llm.parts import parts
from metaferry.llm.shingles import mixed, word_hashes
from metaferry.operators.joins import hot_join
from metaferry.sources.staging import staged

WINDOW = 35
ANCHOR = 10
_BASE = 0xD6E8FEB86659FD93
_UNBASE = np.uint64(pow(_BASE, -1, 1 << 64))
_ID = ["h1", "h2"]
# Kinds of stretches that a text is read with.
_PATH, _BRANCHED, _LONE, _WITNESS = 0, 1, 2, 3


def _id(text: Column) -> list[Column]:
    """128 bits of a text, as two numbers."""
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(7), text).alias("h2")]


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, np.uint64(base))]), dtype=np.uint64)


# Powers for texts of usual length; a longer one gets its own.
_USUAL = 1 << 16
_POWERS, _INVERSE = _powers(_BASE, _USUAL), _powers(int(_UNBASE), _USUAL)


class Spans:
    """Hashes of any spans of words, from sums over all words before a place."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        powers = _POWERS if n <= _USUAL else _powers(_BASE, n)
        self.inverse = _INVERSE if n <= _USUAL else _powers(int(_UNBASE), n)
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(words * powers[:n], dtype=np.uint64)])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        return mixed(raw + mixed((ends - starts).astype(np.uint64)))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the first smallest of every ``width`` values in a row."""
    places, least = np.arange(len(values), dtype=np.int32), values
    span = 1
    while span < width:
        step = min(span, width - span)
        first = least[:-step] <= least[step:]
        places = np.where(first, places[:-step], places[step:])
        least = np.minimum(least[:-step], least[step:])
        span += step
    return places


def runs(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, key, first window, last window) of the runs of windows of a text, by the hashes of its words."""
    n = len(words) - WINDOW + 1
    if n < 1:
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, nothing, nothing
    spans = Spans(words)
    kmers = np.arange(len(words) - ANCHOR + 1)
    hashes = spans.of(kmers, kmers + ANCHOR)
    places = _least(hashes, WINDOW - ANCHOR + 1)
    first = np.concatenate([[0], np.flatnonzero(places[1:] != places[:-1]) + 1])
    last = np.append(first[1:], n) - 1
    key = spans.of(first, last + WINDOW)
    return hashes[places[first]].view(np.int64), key.view(np.int64), first, last


def _cut(docs: DataFrame, text: str, places: bool) -> DataFrame:
    """Runs of all texts: their anchors alone, or (h1, h2, first, last, anchor, key)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, 0):
            found = [runs(word_hashes(value.as_py(), lower=False)) for value in batch.column(0)]
            anchor, key, first, last = (np.concatenate([each[k] for each in found]) for k in range(4))
            if not places:
                yield pa.RecordBatch.from_arrays([pa.array(anchor)], ["anchor"])
                continue
            owner = pa.array(np.repeat(np.arange(len(found)), [len(each[0]) for each in found]))
            ids = [batch.column(k).take(owner) for k in (1, 2)]
            columns = [*ids, pa.array(first, pa.int32()), pa.array(last, pa.int32()), pa.array(anchor), pa.array(key)]
            yield pa.RecordBatch.from_arrays(columns, [*_ID, "first", "last", "anchor", "key"])

    # Fewer characters hold fewer words than a window.
    long = docs.select(F.col(text).alias("text")).filter(F.length("text") >= 2 * WINDOW - 1)
    if places:
        return long.select("text", *_id(F.col("text"))).mapInArrow(
            run, "h1 bigint, h2 bigint, first int, last int, anchor bigint, key bigint"
        )
    return long.mapInArrow(run, "anchor bigint")


def sources(marks: DataFrame) -> DataFrame:
    """(anchor, key, n, source, beside) of all runs: how often, where first, and whether the anchor has a run that occurs once."""
    runs_of = marks.groupBy("anchor", "key").agg(
        F.sum("copies").alias("n"), F.min(F.struct("h1", "h2", "first", "last")).alias("source")
    )
    least = runs_of.groupBy("anchor").agg((F.min("n") == 1).alias("beside"))
    return hot_join(runs_of, least, "anchor")


def paths(linked: DataFrame) -> DataFrame:
    """(h1, h2, first, last, s1, s2, source_first): repeated runs compacted along their sources, all as windows."""
    shifted = linked.select(
        *_ID, "first", "last", F.col("source.h1").alias("s1"), F.col("source.h2").alias("s2"),
        (F.col("first") - F.col("source.first")).alias("shift"),
    )
    by_place = W.partitionBy(*_ID).orderBy("first")
    goes_on = F.lit(True)
    for now, before in [("first", F.lag("last").over(by_place) + 1), *((k, F.lag(k).over(by_place)) for k in ("s1", "s2", "shift"))]:
        goes_on = goes_on & F.col(now).eqNullSafe(before)
    numbered = shifted.withColumn("_new", F.when(goes_on, 0).otherwise(1)).withColumn("_path", F.sum("_new").over(by_place))
    return numbered.groupBy(*_ID, "_path", "s1", "s2", "shift").agg(
        F.min("first").alias("first"), F.max("last").alias("last")
    ).select(*_ID, "first", "last", "s1", "s2", (F.col("first") - F.col("shift")).alias("source_first"))


def _words(text: str) -> tuple[bytes, np.ndarray]:
    """The words of a text joined by one space, and where each begins (one more place at the end)."""
    words = text.encode().split()
    starts = np.concatenate([[0], np.cumsum([len(word) + 1 for word in words], dtype=np.int64)])
    return b" ".join(words), starts


def _digest(joined: bytes, starts: np.ndarray, first: int, last: int) -> bytes:
    """Digest of the words of windows ``first`` to ``last``."""
    return hashlib.blake2b(joined[starts[first] : starts[last + WINDOW] - 1], digest_size=16).digest()


def _probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h1, h2, copies, kind, first, last, digest) of the paths of texts and of each window of their other runs."""
    for batch in parts(batches, 2):
        owner, copies, columns = [], [], [[], [], [], []]
        for row, (text, notes) in enumerate(zip(batch.column(2), batch.column(3))):
            joined, starts = _words(text.as_py())
            for kind, first, last in ((note["kind"], note["first"], note["last"]) for note in notes.as_py()):
                stretches = [(first, last)] if kind == _PATH else [(at, at) for at in range(first, last + 1)]
                owner += [row] * len(stretches)
                copies += [2 if kind == _WITNESS else 1] * len(stretches)
                columns[0] += [kind] * len(stretches)
                columns[1] += [one for one, _ in stretches]
                columns[2] += [other for _, other in stretches]
                columns[3] += [_digest(joined, starts, *stretch) for stretch in stretches]
        ids = [batch.column(k).take(pa.array(owner, pa.int64())) for k in (0, 1)]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [*ids, pa.array(copies, pa.int64()), *(pa.array(values, kind) for values, kind in zip(columns, kinds))],
            [*_ID, "copies", "kind", "first", "last", "digest"],
        )


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in parts(batches, 2):
        removed, digests = [], []
        for text, notes in zip(batch.column(2), batch.column(3)):
            words = text.as_py().encode().split()
            change = np.zeros(len(words) + 1, np.int64)
            lone = np.zeros(len(words) + 1, bool)
            found = notes.as_py()
            for note in found:
                if note["kind"] == _LONE:
                    lone[note["first"]] = True
            for note in found:
                first, last = note["first"], note["last"]
                if note["kind"] == _PATH:
                    change[first] += 1
                    change[last + WINDOW] -= 1
                elif note["kind"] == _BRANCHED:
                    windows = first + np.flatnonzero(~lone[first : last + 1])
                    np.add.at(change, windows, 1)
                    np.add.at(change, windows + WINDOW, -1)
            kept = np.flatnonzero(change.cumsum()[:-1] == 0).tolist()
            removed.append(len(words) - len(kept))
            digests.append(hashlib.sha256(b" ".join([words[k] for k in kept])).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(digests)],
            [*_ID, "n_removed", "kept_sha256"],
        )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in parts(batches, 0):
        sizes, digests = [], []
        for text in batch.column(0):
            words = (text.as_py() or "").encode().split()
            sizes.append(len(words))
            digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
        columns = [*batch.columns[1:], pa.array(sizes, pa.int64()), pa.array(digests)]
        yield pa.RecordBatch.from_arrays(columns, ["key", *_ID, "n_words", "all_sha256"])


def _noted(texts: DataFrame, notes: DataFrame) -> DataFrame:
    """(h1, h2, text, notes) of the distinct texts that have notes (h1, h2, kind, first, last)."""
    listed = notes.groupBy(*_ID).agg(F.collect_list(F.struct("kind", "first", "last")).alias("notes"))
    return texts.hint("merge").join(listed.hint("merge"), _ID).select(*_ID, "text", "notes")


def _stretch(kind: int, first: str = "first", last: str = "last") -> list[Column]:
    return [F.lit(kind).alias("kind"), F.col(first).cast("int").alias("first"), F.col(last).cast("int").alias("last")]


def repeated(docs: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(h1, h2, text) of the texts that hold anything that may repeat, and their notes of what does. Runs jobs."""
    anchors = _cut(docs, text, False).groupBy("anchor").agg(F.count("*").alias("n"))
    known = staged(anchors.filter("n > 1").select("anchor"))
    found = hot_join(_cut(docs, text, True), known, "anchor")
    marks = staged(found.groupBy(*_ID, "first", "last", "anchor", "key").agg(F.count("*").alias("copies")))
    linked = staged(hot_join(marks, sources(marks), ["anchor", "key"]))
    path = staged(paths(linked.filter("n > 1")))
    branched = linked.filter("n = 1").select(*_ID, *_stretch(_BRANCHED))
    witnesses = linked.filter(
        (F.col("n") > 1) & F.col("beside") & (F.struct(*_ID, "first", "last") == F.col("source"))
    ).select(*_ID, *_stretch(_WITNESS))
    source_last = (F.col("source_first") + F.col("last") - F.col("first")).alias("source_last")
    at_source = path.withColumn("source_last", source_last).select(
        F.col("s1").alias("h1"), F.col("s2").alias("h2"), *_stretch(_PATH, "source_first", "source_last")
    )
    to_read = path.select(*_ID, *_stretch(_PATH)).unionByName(at_source).distinct().unionByName(branched).unionByName(witnesses)
    long = docs.select(F.col(text).alias("text")).filter(F.length("text") >= 2 * WINDOW - 1)
    distinct = long.groupBy(*_id(F.col("text"))).agg(F.any_value("text").alias("text"))
    texts = staged(_noted(distinct, to_read))
    probes = staged(texts.select(*_ID, "text", "notes").mapInArrow(
        _probes, "h1 bigint, h2 bigint, copies bigint, kind int, first int, last int, digest binary"
    ))
    read = probes.filter(F.col("kind") == _PATH).select(*_ID, "first", "last", "digest")
    source = read.select(F.col("h1").alias("s1"), F.col("h2").alias("s2"), F.col("first").alias("source_first"),
                         F.col("last").alias("source_last"), F.col("digest").alias("source_digest"))
    spans = hot_join(hot_join(path.withColumn("source_last", source_last), read, [*_ID, "first", "last"]), source,
                     ["s1", "s2", "source_first", "source_last"]).filter("digest = source_digest")
    alone = (
        probes.filter(F.col("kind") != _PATH)
        .groupBy("digest")
        .agg(F.sum("copies").alias("n"), F.min(F.struct(*_ID, "first", "last")).alias("at"))
        .filter("n = 1")
        .select("at.*")
    )
    notes = spans.select(*_ID, *_stretch(_PATH)).unionByName(branched).unionByName(alone.select(*_ID, *_stretch(_LONE)))
    return texts.select(*_ID, "text"), notes


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, n_removed, kept_sha256) of every row. Runs jobs."""
    kind = dict(docs.dtypes)[key]
    texts, notes = repeated(docs, text)
    cleaned = _noted(texts, notes).select(*_ID, "text", "notes").mapInArrow(
        _cleaned, "h1 bigint, h2 bigint, n_removed bigint, kept_sha256 string"
    )
    rows = docs.select(F.col(text).alias("text"), F.col(key).alias("key"), *_id(F.col(text))).mapInArrow(
        _counted, f"key {kind}, h1 bigint, h2 bigint, n_words bigint, all_sha256 string"
    )
    return hot_join(rows, cleaned, _ID, "left").select(
        F.col("key").alias(key),
        "n_words",
        F.coalesce("n_removed", F.lit(0).cast("bigint")).alias("n_removed"),
        F.coalesce("kept_sha256", "all_sha256").alias("kept_sha256"),
    )
