"""Alignment of two tokenizers by fragments that compose, and how often their tokens are linked.

Tokens of A and B cover the same bytes. Where a token of both ends, the text is
cut into groups. A byte range of a text gives a fragment: the tokens up to its
first common end (open prefix), the groups between its first and last common end
(closed), and the tokens behind it (open suffix). Two neighbouring fragments
compose to one: the left one's suffix and the right one's prefix close a group.
Composition is associative, so fragments may be joined in any tree.

- A text of at most ``RANGE`` characters is one range, and a task takes many such
  texts at once, as one array of ends. Nothing is shuffled for them.
- A longer text is cut into ranges, rows of their own that are dealt to all tasks.
  A range is encoded together with the text around it up to the next safe cut on
  either side and keeps the tokens that end within it. A cut is safe before a
  space that follows a character that is neither white space nor U+2581: no token
  of A or B goes over it. Where a stretch without a safe cut is longer than a
  range, it is one range. Fragments are composed in a tree, ``FAN`` at a time.
  Equal long texts are encoded once and count as often as they occur.

Every overlapping pair of an A and a B token is one stretch between two
neighbouring ends of either kind, so links are counted and listed in linear time.

The number of documents that hold a pair linked is one grouped count over all.
To bring the counts back, the ``HEAD`` most frequent pairs, a table of fixed size,
go to all tasks, and so does the highest count of each A id, of which there are no
more than the vocabulary has. The rare other pairs of a text are joined.

Defined results: null and empty texts, and those whose bytes A or B don't give
back (U+2581 in the text, for one), have no tokens: zeros and an empty digest.
Every row is a document, also where ids repeat or are null. Other columns of the
input don't matter. An empty table gives an empty one.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaferry.llm.parts import parts
from metaferry.operators.joins import hot_join
from metaferry.sources.staging import staged

RANGE = 1 << 17
FAN = 16
HEAD = 1 << 17
_ID = ["h1", "h2"]
# A space where neither tokenizer has a token over the place before it.
_SAFE = re.compile(r"(?<=[^\s▁\x1c-\x1f\x85]) ")


def _path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Tokenizers:
    """Both encoders, and the bytes of every token."""

    def __init__(self, byte_bpe: str, byte_ranks: str, pieces: str):
        import base64

        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(byte_bpe)
        self.library.encode_special_tokens = True
        names = {char: byte for byte, char in enumerate(_byte_characters())}
        vocab = self.library.get_vocab()
        with open(byte_ranks, "rb") as file:
            ranks = {base64.b64decode(one): int(rank) for one, rank in map(bytes.split, file)}
        # The ranks are the same vocabulary and several times as fast; what they can't encode goes to the library.
        self.ranks = tiktoken.Encoding("ranks", pat_str=_pattern(), mergeable_ranks=ranks, special_tokens={})
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for name, number in vocab.items():
            if all(char in names for char in name):
                self.bytes_a[number] = bytes(names[char] for char in name)
            else:
                self.bytes_a[number] = name.encode()
        if any(self.bytes_a[number] != name for name, number in ranks.items()):
            raise ValueError(f"{byte_ranks} is not the vocabulary of {byte_bpe}")
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.bytes_b = []
        for number in range(self.pieces.vocab_size()):
            piece = self.pieces.id_to_piece(number)
            raw = bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(number) else piece.replace("▁", " ").encode()
            self.bytes_b.append(raw)
        self.sizes_a, self.sizes_b = (np.array([len(raw) for raw in table], np.int64) for table in (self.bytes_a, self.bytes_b))
        # A token's number as text, with each of the separators that may follow it.
        n_a, n_b = len(self.bytes_a), len(self.bytes_b)
        self.names = [f"{k}{mark}" for n in (n_a, n_b) for mark in ",|;" for k in range(n)]
        self.name_b = 3 * n_a
        self.width = n_b

    def ids_of_a(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts by A, special tokens being plain text."""
        found = []
        for text in texts:
            try:
                found.append(self._by_ranks(text))
            except BaseException as problem:  # the ranks' library panics where its regex stack is too small
                if isinstance(problem, KeyboardInterrupt | SystemExit | MemoryError):
                    raise
                found.append(self.library.encode(text, add_special_tokens=False).ids)
        return found

    def _by_ranks(self, text: str) -> list[int]:
        return self.ranks.encode_ordinary(text)

    def ids_of_b(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts by B, which puts a space before each."""
        return self.pieces.encode(texts, num_threads=1)


def _pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _byte_characters() -> list[str]:
    """The character that stands for each byte: itself if it is visible, else the next one from 256."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(byte if byte in visible else next(hidden)) for byte in range(256)]


@functools.lru_cache(1)
def tokenizers(byte_bpe: str, byte_ranks: str, pieces: str) -> Tokenizers:
    return Tokenizers(byte_bpe, byte_ranks, pieces)


def default_paths() -> tuple[str, str, str]:
    return _path("byte_bpe_50k.json"), _path("byte_bpe_50k.tiktoken"), _path("piece_bpe_32k.model")


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the A and the B token of every overlapping pair, of tokens that begin and end together."""
    ends = np.union1d(ends_a, ends_b)
    return np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)


def groups_text(tok: Tokenizers, ids_a: np.ndarray, ends_a: np.ndarray, ids_b: np.ndarray, ends_b: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Parts of the text of the groups, and for each common end the number of parts up to it."""
    common = np.intersect1d(ends_a, ends_b, assume_unique=True)
    group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
    upto_a = np.searchsorted(group_a, np.arange(len(common)), side="right")
    upto_b = np.searchsorted(group_b, np.arange(len(common)), side="right")
    place_a = np.arange(len(ids_a)) + np.concatenate([[0], upto_b])[group_a]
    place_b = np.arange(len(ids_b)) + upto_a[group_b]
    mark_a = np.zeros(len(ids_a), np.int64)
    mark_a[upto_a - 1] = 1
    mark_b = np.zeros(len(ids_b), np.int64)
    mark_b[upto_b - 1] = 2
    codes = np.empty(len(ids_a) + len(ids_b), np.int64)
    codes[place_a] = mark_a * (tok.name_b // 3) + ids_a
    codes[place_b] = tok.name_b + mark_b * tok.width + ids_b
    return [tok.names[code] for code in codes.tolist()], upto_a + upto_b


@dataclass
class Fragment:
    """A range's tokens before the first common end, its closed groups, and its tokens behind the last one.

    Tokens are rows (id, end). Without a common end all tokens are in the prefix.
    """

    prefix_a: np.ndarray
    prefix_b: np.ndarray
    closed: bool
    n_a: int
    n_b: int
    n_groups: int
    text: str
    pairs: np.ndarray  # closed links: pair and how often
    suffix_a: np.ndarray
    suffix_b: np.ndarray


_NO_TOKENS = np.zeros((0, 2), np.int64)


def _closed(tok: Tokenizers, a: np.ndarray, b: np.ndarray) -> tuple[int, str, np.ndarray]:
    """Groups, their text and links of tokens that begin and end together."""
    if not len(a):
        return 0, "", _NO_TOKENS
    found, upto = groups_text(tok, a[:, 0], a[:, 1], b[:, 0], b[:, 1])
    one, other = links(a[:, 1], b[:, 1])
    pairs, times = np.unique(a[one, 0] * tok.width + b[other, 0], return_counts=True)
    return len(upto), "".join(found), np.stack([pairs, times], 1)


def fragment(tok: Tokenizers, a: np.ndarray, b: np.ndarray) -> Fragment:
    """The fragment of the tokens (id, end) of a range; ends are places in the whole text."""
    common = np.intersect1d(a[:, 1], b[:, 1])
    if not len(common):
        return Fragment(a, b, False, 0, 0, 0, "", _NO_TOKENS, _NO_TOKENS, _NO_TOKENS)
    (a0, a1), (b0, b1) = (np.searchsorted(side[:, 1], common[[0, -1]], side="right") for side in (a, b))
    n_groups, text, pairs = _closed(tok, a[a0:a1], b[b0:b1])
    return Fragment(a[:a0], b[:b0], True, int(a1 - a0), int(b1 - b0), n_groups, text, pairs, a[a1:], b[b1:])


def _added(*pairs: np.ndarray) -> np.ndarray:
    every = np.concatenate(pairs)
    found, place = np.unique(every[:, 0], return_inverse=True)
    return np.stack([found, np.bincount(place, every[:, 1], len(found)).astype(np.int64)], 1)


def compose(tok: Tokenizers, left: Fragment, right: Fragment) -> Fragment:
    """The fragment of two neighbouring ranges."""
    if not left.closed:
        a, b = np.concatenate([left.prefix_a, right.prefix_a]), np.concatenate([left.prefix_b, right.prefix_b])
        return Fragment(a, b, *(getattr(right, name) for name in list(Fragment.__dataclass_fields__)[2:]))
    a, b = np.concatenate([left.suffix_a, right.prefix_a]), np.concatenate([left.suffix_b, right.prefix_b])
    if not right.closed:
        return Fragment(
            left.prefix_a, left.prefix_b, True, left.n_a, left.n_b, left.n_groups, left.text, left.pairs, a, b
        )
    n_groups, text, pairs = _closed(tok, a, b)
    return Fragment(
        left.prefix_a, left.prefix_b, True, left.n_a + len(a) + right.n_a, left.n_b + len(b) + right.n_b,
        left.n_groups + n_groups + right.n_groups, left.text + text + right.text,
        _added(left.pairs, pairs, right.pairs), right.suffix_a, right.suffix_b,
    )


def _ranges(text: str, size: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(start, end, from, to, bytes before from) of a text's ranges, and of the stretch between safe cuts around each, in characters."""
    cuts = [0]
    start, at_byte, before = 0, 0, 0
    while start < len(text):
        end = min(start + size, len(text))
        behind = _SAFE.search(text, end) if end < len(text) else None
        to = behind.start() if behind else len(text)
        if to - end > size:
            end = to
        # The last safe cut up to the start of this range.
        at = cuts[-1]
        for found in _SAFE.finditer(text, max(cuts[-1] + 1, start - 2 * size) if start else 0, start + 1 if start else 0):
            at = found.start()
        at_byte += len(text[before:at].encode())
        before = at
        cuts.append(at)
        yield start, end, at, to, at_byte
        start = end


def _tokens(tok: Tokenizers, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bool]]:
    """Tokens (id, end) of A and B of stretches in a row, the number of each stretch's, and which stretches they give back.

    Every stretch stands for space + text; the others have no tokens. Ends go on from stretch to stretch.
    """
    ids = tok.ids_of_a([" " + text for text in texts]), tok.ids_of_b(texts)
    kept, whole, size = ([], []), [], 0
    counts = np.zeros((2, len(texts)), np.int64)
    for k, text in enumerate(texts):
        raw = b" " + text.encode()
        right = all(b"".join([table[i] for i in side[k]]) == raw for side, table in zip(ids, (tok.bytes_a, tok.bytes_b)))
        whole.append(right)
        for side in (0, 1):
            if right:
                kept[side].extend(ids[side][k])
                counts[side, k] = len(ids[side][k])
    found = []
    for side, sizes in zip(kept, (tok.sizes_a, tok.sizes_b)):
        numbers = np.array(side, np.int64)
        found.append(np.stack([numbers, sizes[numbers].cumsum()], 1))
    return found[0], found[1], counts[0], counts[1], whole


_RESULT = "h1 bigint, h2 bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, times array<int>"
_NAMES = [column.split(" ")[0] for column in _RESULT.split(", ")]


def _short(batches: Iterator[pa.RecordBatch], paths: tuple[str, str, str]) -> Iterator[pa.RecordBatch]:
    """Results of texts of one range each: (key, text, h1, h2) to (key, results)."""
    tok = tokenizers(*paths)
    for batch in parts(batches, 1):
        texts = [text.as_py() or "" for text in batch.column(1)]
        filled = [k for k, text in enumerate(texts) if text]
        a, b, n_a, n_b, _ = _tokens(tok, [texts[k] for k in filled])
        n = len(texts)
        counts = np.zeros((4, n), np.int64)
        counts[0, filled], counts[1, filled] = n_a, n_b
        digests, lists = [""] * n, [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * n
        if len(a):
            found, upto = groups_text(tok, a[:, 0], a[:, 1], b[:, 0], b[:, 1])
            one, other = links(a[:, 1], b[:, 1])
            pairs = a[one, 0] * tok.width + b[other, 0]
            # Texts end at common ends.
            end_a, end_b = counts[0].cumsum(), counts[1].cumsum()
            at_link = np.searchsorted(one, end_a, side="left")
            at_part = end_a + end_b
            group_ends = np.searchsorted(upto, at_part, side="right")
            counts[2] = np.diff(group_ends, prepend=0)
            counts[3] = np.diff(at_link, prepend=0)
            for k in np.flatnonzero(counts[0]).tolist():
                text = "".join(found[at_part[k] - counts[0, k] - counts[1, k] : at_part[k]])
                digests[k] = hashlib.sha256(text[:-1].encode()).hexdigest()
                lists[k] = np.unique(pairs[at_link[k] - counts[3, k] : at_link[k]], return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), batch.column(3), *map(pa.array, counts), pa.array(digests), *_lists(lists)],
            ["key", *_NAMES],
        )


def _lists(pairs: list[tuple[np.ndarray, np.ndarray]]) -> list[pa.Array]:
    offsets = pa.array(np.concatenate([[0], np.cumsum([len(one) for one, _ in pairs])]), pa.int32())
    flat = [np.concatenate([each[k] for each in pairs]) if pairs else np.zeros(0, np.int64) for k in (0, 1)]
    kinds = (pa.int64(), pa.int32())
    return [pa.ListArray.from_arrays(offsets, pa.array(values, kind)) for values, kind in zip(flat, kinds)]


_FRAGMENT = (
    "h1 bigint, h2 bigint, place bigint, whole boolean, prefix_a array<bigint>, prefix_b array<bigint>, closed boolean, "
    "n_a bigint, n_b bigint, n_groups bigint, text string, pairs array<bigint>, suffix_a array<bigint>, suffix_b array<bigint>"
)
_ARRAYS = {"prefix_a", "prefix_b", "pairs", "suffix_a", "suffix_b"}


def _row(found: Fragment, h1: int, h2: int, place: int, whole: bool) -> dict:
    values = {name: getattr(found, name) for name in Fragment.__dataclass_fields__}
    flat = {name: value.ravel().tolist() if name in _ARRAYS else value for name, value in values.items()}
    return {"h1": h1, "h2": h2, "place": place, "whole": whole, **flat}


def _fragment_of(row: dict) -> Fragment:
    values = {name: row[name] for name in Fragment.__dataclass_fields__}
    return Fragment(**{k: np.array(v, np.int64).reshape(-1, 2) if k in _ARRAYS else v for k, v in values.items()})


def _cut(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Ranges of long texts (h1, h2, text) as rows, with the stretch to encode and where in it the range is."""
    names = [*_ID, "place", "at_byte", "range_start", "range_end", "stretch"]
    kinds = [pa.int64()] * 6 + [pa.string()]
    for batch in batches:
        for h1, h2, text in zip(*(batch.column(k) for k in range(3))):
            value = text.as_py()
            for place, (start, end, first, last, at_byte) in enumerate(_ranges(value, size)):
                stretch = value[first:last]
                low = at_byte + len(value[first:start].encode()) + (1 if start else 0)
                high = low + len(value[start:end].encode()) + (0 if start else 1)
                row = [h1.as_py(), h2.as_py(), place, at_byte, low, high, stretch]
                yield pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip(row, kinds)], names)


def _fragments(batches: Iterator[pa.RecordBatch], paths: tuple[str, str, str]) -> Iterator[pa.RecordBatch]:
    tok = tokenizers(*paths)
    for batch in batches:
        for row in (row for k in range(batch.num_rows) for row in batch.slice(k, 1).to_pylist()):
            # B puts the space before; behind the first cut a stretch begins with one of its own.
            text = row["stretch"][1:] if row["at_byte"] else row["stretch"]
            a, b, _, _, whole = _tokens(tok, [text])
            for side in (a, b):
                side[:, 1] += row["at_byte"] + 1 if row["at_byte"] else 0
            a, b = (side[(side[:, 1] > row["range_start"]) & (side[:, 1] <= row["range_end"])] for side in (a, b))
            found = fragment(tok, a, b) if whole[0] else fragment(tok, _NO_TOKENS, _NO_TOKENS)
            yield _batch([_row(found, row["h1"], row["h2"], row["place"], whole[0])])


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64())}
    columns = [column.split(" ") for column in _FRAGMENT.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([row[name] for row in rows], kinds[kind]) for name, kind in columns], [name for name, _ in columns]
    )


def _composed(rows: pd.DataFrame, paths: tuple[str, str, str]) -> pd.DataFrame:
    """One fragment of up to ``FAN`` neighbouring ones."""
    tok = tokenizers(*paths)
    ordered = rows.sort_values("place").to_dict("records")
    found = functools.reduce(lambda left, right: compose(tok, left, right), map(_fragment_of, ordered))
    first = ordered[0]
    whole = all(row["whole"] for row in ordered)
    return pd.DataFrame([_row(found, first["h1"], first["h2"], first["place"] // FAN, whole)])


def _finished(batches: Iterator[pa.RecordBatch], paths: tuple[str, str, str]) -> Iterator[pa.RecordBatch]:
    """Results of whole texts. A text begins where groups do: the prefix of its fragment is the first group."""
    tok = tokenizers(*paths)
    begin = Fragment(_NO_TOKENS, _NO_TOKENS, True, 0, 0, 0, "", _NO_TOKENS, _NO_TOKENS, _NO_TOKENS)
    for batch in batches:
        columns, lists = [[] for _ in range(7)], []
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            found, whole = compose(tok, begin, _fragment_of(row)), row["whole"]
            values = [found.n_a, found.n_b, found.n_groups, int(found.pairs[:, 1].sum())] if whole else [0] * 4
            digest = hashlib.sha256(found.text[:-1].encode()).hexdigest() if whole else ""
            for column, value in zip(columns, [row["h1"], row["h2"], *values, digest]):
                column.append(value)
            lists.append((found.pairs[:, 0], found.pairs[:, 1]) if whole else (np.zeros(0, np.int64),) * 2)
        kinds = [pa.int64()] * 6 + [pa.string()]
        yield pa.RecordBatch.from_arrays([*(pa.array(v, kind) for v, kind in zip(columns, kinds)), *_lists(lists)], _NAMES)


def long_texts(texts: DataFrame, size: int = RANGE, paths: tuple[str, str, str] | None = None) -> DataFrame:
    """Results of distinct texts (h1, h2, text) of any length, composed of their ranges. Runs jobs."""
    paths = paths or default_paths()
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stretches = texts.mapInArrow(
        lambda batches: _cut(batches, size),
        "h1 bigint, h2 bigint, place bigint, at_byte bigint, range_start bigint, range_end bigint, stretch string",
    )
    dealt = stretches.repartition(tasks, "h1", "h2", "place")
    level = staged(dealt.mapInArrow(lambda batches: _fragments(batches, paths), _FRAGMENT))
    most = level.agg(F.max("place")).first()[0] or 0
    while most:
        node = F.expr(f"place div {FAN}").alias("node")
        level = level.groupBy("h1", "h2", node).applyInPandas(lambda rows: _composed(rows, paths), _FRAGMENT)
        most //= FAN
    return level.mapInArrow(lambda batches: _finished(batches, paths), _RESULT)


def _counted(batches: Iterator[pa.RecordBatch], pairs: np.ndarray, counts: np.ndarray, best: np.ndarray, width: int) -> Iterator[pa.RecordBatch]:
    """(row columns, n_best, count_sum, rest) by the counts of the frequent pairs; rest holds the other pairs and how often."""
    for batch in batches:
        found, times = batch.column("pairs"), batch.column("times")
        flat, often = found.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
        offsets = found.offsets.to_numpy().astype(np.int64)
        offsets = offsets - offsets[0]
        place = np.minimum(np.searchsorted(pairs, flat), max(len(pairs) - 1, 0))
        known = pairs[place] == flat if len(pairs) else np.zeros(len(flat), bool)
        count = np.where(known, counts[place] if len(pairs) else 0, 0)
        top = known & (count == best[flat // width])
        sums = [np.concatenate([[0], np.cumsum(values)])[offsets] for values in (often * top, often * count, ~known)]
        rest = np.flatnonzero(~known)
        bounds = pa.array(sums[2], pa.int32())
        lists = [
            pa.ListArray.from_arrays(bounds, pa.array(values, kind))
            for values, kind in ((flat[rest], pa.int64()), (often[rest], pa.int32()))
        ]
        kept = [name for name in batch.schema.names if name not in ("pairs", "times")]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(name) for name in kept), *(pa.array(np.diff(s), pa.int64()) for s in sums[:2]), *lists],
            [*kept, "n_best", "count_sum", "rest", "rest_times"],
        )


def alignment(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = RANGE, head: int = HEAD,
    paths: tuple[str, str, str] | None = None,
) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row. Runs jobs."""
    paths = paths or default_paths()
    width = tokenizers(*paths).width
    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("h1"),
                       F.xxhash64(F.lit(7), text).alias("h2"))
    is_long = F.length("text") > size
    short = rows.filter(F.coalesce(~is_long, F.lit(True))).mapInArrow(lambda batches: _short(batches, paths), f"key {kind}, {_RESULT}")
    long = rows.filter(is_long)
    distinct = long.groupBy(*_ID).agg(F.any_value("text").alias("text"))
    copies = long.groupBy(*_ID).agg(F.count("*").alias("copies"))
    composed = hot_join(long_texts(distinct, size, paths), copies, _ID)
    short_rows = staged(short)
    long_rows = staged(composed)

    every = short_rows.select("pairs", F.lit(1).cast("bigint").alias("copies")).unionByName(long_rows.select("pairs", "copies"))
    counts = staged(every.select(F.explode("pairs").alias("pair"), "copies").groupBy("pair").agg(F.sum("copies").alias("n_docs")))
    id_a = F.expr(f"CAST(pair div {width} AS INT)")
    highest = counts.groupBy(id_a.alias("id")).agg(F.max("n_docs").alias("best"))
    best = np.zeros(1 << 20, np.int64)
    for number, value in highest.toArrow().to_pandas().itertuples(index=False):
        best[number] = value
    frequent = counts.orderBy(F.desc("n_docs"), "pair").limit(head).toArrow().sort_by("pair")
    pairs, numbers = (frequent.column(name).to_numpy() for name in ("pair", "n_docs"))
    best = best[: int(np.max(np.flatnonzero(best), initial=0)) + 1]

    def counted(df: DataFrame, extra: str) -> DataFrame:
        results = "h1 bigint, h2 bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
        sums = "n_best bigint, count_sum bigint, rest array<bigint>, rest_times array<int>"
        names = [extra.split(" ")[0]] if extra else []
        chosen = df.select(*names, *_NAMES)
        return chosen.mapInArrow(
            lambda batches: _counted(batches, pairs, numbers, best, width), ", ".join([extra] * bool(extra) + [results, sums])
        )

    short_counted, long_counted = staged(counted(short_rows, f"key {kind}")), counted(long_rows, "")
    long_keys = long.select("key", *_ID)
    both = short_counted.unionByName(hot_join(long_keys, long_counted, _ID).select(short_counted.columns))
    # Pairs beyond the frequent ones, once per distinct text.
    rest = both.filter(F.size("rest") > 0).dropDuplicates(_ID).select(
        *_ID, F.explode(F.arrays_zip("rest", "rest_times")).alias("r")
    ).select(*_ID, F.col("r.rest").alias("pair"), F.col("r.rest_times").alias("times"))
    with_count = hot_join(rest, counts, "pair").withColumn("id", F.expr(f"CAST(pair div {width} AS INT)"))
    is_best = F.col("n_docs") == F.col("best")
    more = (
        hot_join(with_count, highest, "id")
        .groupBy(*_ID)
        .agg(F.sum(F.when(is_best, F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n_docs")).alias("more_sum"))
    )
    none = F.lit(0).cast("bigint")
    return hot_join(both, more, _ID, "left").select(
        F.col("key").alias(key), "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("more_best", none)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", none)).alias("count_sum"),
        "groups_sha256",
    )
