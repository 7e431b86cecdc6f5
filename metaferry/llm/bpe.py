"""BPE encoding with a pair occurrence index, and decoding.

A task encodes its documents in parts of about ``PART_BYTES`` bytes. All distinct words of a part lie
in one array of symbols, linked to their neighbours. An index maps every pair
that can be merged, by its rank, to all its positions in the part. The lowest
active rank is taken, all its positions are merged at once, and only the index
entries of the neighbours are updated; entries that a merge made stale are
recognised when their turn comes. Every word is so merged in the same order as
on its own, but each rank costs one step per part, not one per word.

Words, and the pieces between white space that they come from, are encoded once
per part. Memory is bounded by a part or a single text; nothing is shuffled.

The vocabulary is a file in the format of the tokenizers library, read on every
executor from ``path``. What such a file can ask for and this operator supports:
NFC, white space replaced, lower case; the split into contractions, letters,
single digits and the rest; bytes as characters; word-end suffixes; special
tokens, which are found in the raw text. Other files are refused.

Defined results: null and empty texts, and those of white space only, have no
ids and decode to an empty text. Rows are independent and keep their other
columns; a column named as the result is replaced. An empty table gives an
empty one.
"""

from __future__ import annotations

import functools
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from metaferry.llm.parts import parts

# The split pattern of the vocabulary files, and what it takes as white space.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_WORD = regex.compile(WORDS.replace(r"\s", r"\p{White_Space}"))
_GAP = regex.compile(r"\p{White_Space}+")
_ODD = regex.compile("[\x1c-\x1f]")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_characters() -> list[str]:
    """The character that stands for each byte: itself if it is visible, else the next one from 256."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in visible]
    names = {byte: chr(byte) for byte in visible} | {byte: chr(256 + k) for k, byte in enumerate(hidden)}
    return [names[byte] for byte in range(256)]


class Vocabulary:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        steps = [step["type"] for step in (content["normalizer"] or {}).get("normalizers", [])]
        splits = (content["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        if steps != ["NFC", "Replace", "Lowercase"] or splits[0].get("pattern") != {"Regex": WORDS} or content["decoder"]:
            raise ValueError(f"{path}: not a vocabulary of lower-case words")
        ids = model["vocab"]
        suffix = model["end_of_word_suffix"]
        added = {token["content"]: token["id"] for token in content["added_tokens"]}
        self.path, self.special = path, added
        self.byte_of = {name: byte for byte, name in enumerate(_byte_characters())}
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")")
        self.first = np.array([ids[name] for name in _byte_characters()], np.int64)
        self.last = np.array([ids[name + suffix] for name in _byte_characters()], np.int64)
        self.width = max([*ids.values(), *added.values()]) + 1
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        codes = np.array([ids[a] * self.width + ids[b] for a, b in pairs], np.int64)
        merged = np.array([ids[a + b] for a, b in pairs], np.int64)
        order = np.argsort(codes, kind="stable")
        self.codes, self.ranks, self.merged = codes[order], order, merged
        self.left, self.right = codes // self.width, codes % self.width
        self.tokens = [""] * self.width
        for name, number in [*ids.items(), *added.items()]:
            self.tokens[number] = name

    def words_of(self, piece: str) -> list[bytes]:
        """The words of a piece of text without white space.

        Characters that this Python's tables don't know may be letters to the
        library, whose tables are newer; such pieces are split by the library's rules.
        """
        if not piece.isascii() and any(unicodedata.category(character) == "Cn" for character in piece):
            rules = self.library_rules
            found = rules.pre_tokenizer.pre_tokenize_str(rules.normalizer.normalize_str(piece))
            return [bytes(self.byte_of[character] for character in word) for word, _ in found]
        return [word.encode() for word in _WORD.findall(piece.replace("Σ", "σ").lower())]

    @functools.cached_property
    def library_rules(self):
        import tokenizers

        return tokenizers.Tokenizer.from_file(self.path)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of symbols, or -1."""
        codes = left * self.width + right
        place = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[place] == codes, self.ranks[place], -1)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and where each word's ids begin (one more entry at the end)."""
        lengths = np.array([len(word) for word in words], np.int64)
        ends = lengths.cumsum()
        raw = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.first[raw]
        symbols[ends - 1] = self.last[raw[ends - 1]]
        n = len(symbols)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1] = -1
        before[ends - lengths] = -1

        places: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(left: np.ndarray) -> None:
            """Index the pairs that begin at these positions."""
            ranks = self.rank_of(symbols[left], symbols[after[left]])
            left, ranks = left[ranks >= 0], ranks[ranks >= 0]
            if not len(left):
                return
            order = np.argsort(ranks, kind="stable")
            left, ranks = left[order], ranks[order]
            bounds = np.flatnonzero(np.diff(ranks)) + 1
            for rank, part in zip(ranks[np.concatenate([[0], bounds])].tolist(), np.split(left, bounds)):
                if rank not in places:
                    places[rank] = []
                    heapq.heappush(active, rank)
                places[rank].append(part)

        enter(np.flatnonzero(after >= 0))
        while active:
            rank = heapq.heappop(active)
            found = places.pop(rank)
            at = np.unique(np.concatenate(found)) if len(found) > 1 else found[0]
            left, right = self.left[rank], self.right[rank]
            at = at[(symbols[at] == left) & (after[at] >= 0)]
            at = at[symbols[after[at]] == right]
            if left == right and len(at) > 1:
                at = _apart(at, after)
            if not len(at):
                continue
            gone = after[at]
            symbols[at], symbols[gone] = self.merged[rank], -1
            beyond = after[gone]
            after[at] = beyond
            inner = beyond >= 0
            before[beyond[inner]] = at[inner]
            previous = before[at]
            enter(np.unique(np.concatenate([previous[previous >= 0], at[inner]])))
        alive = symbols >= 0
        starts = np.concatenate([[0], alive.cumsum()[ends - 1]])
        return symbols[alive], starts


def _apart(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of positions whose pairs overlap, every other one from the left."""
    kept, taken = [], -1
    for place in at.tolist():
        if place != taken:
            kept.append(place)
            taken = int(after[place])
    return np.array(kept, np.int64)


@functools.lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _between_gaps(text: str) -> list[str]:
    """The pieces of a text between white space."""
    if not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    # split() also takes these four separators as white space.
    return [piece for piece in _GAP.split(text) if piece] if _ODD.search(text) else text.split()


def _gathered(values: np.ndarray, starts: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slices ``chosen`` of values in a row, and where each begins."""
    lengths = (starts[1:] - starts[:-1])[chosen]
    begins = np.concatenate([[0], lengths.cumsum()])
    return values[np.arange(begins[-1]) + np.repeat(starts[chosen] - begins[:-1], lengths)], begins


def encode_batch(texts: list[str | None], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts in a row, and where each text's ids begin."""
    pieces: dict[str, int] = {}  # distinct pieces between white space; special tokens are pieces too
    used: list[int] = []
    ends = [0]
    for text in texts:
        stretches = vocab.special_pattern.split(text) if text and "<|" in text else [text or ""]
        for k, part in enumerate(stretches):
            found = [part] if k % 2 else _between_gaps(part)
            if k % 2 == 0 and vocab.special.keys() & set(found):
                raise AssertionError("a special token was not recognised")
            used.extend([pieces.setdefault(piece, len(pieces)) for piece in found])
        ends.append(len(used))
    words: dict[bytes, int] = {}
    of_piece: list[int] = []
    piece_starts = [0]
    for piece in pieces:
        if piece in vocab.special:
            of_piece.append(-1 - vocab.special[piece])
        else:
            of_piece.extend([words.setdefault(word, len(words)) for word in vocab.words_of(piece)])
        piece_starts.append(len(of_piece))
    ids, starts = vocab.encode_words(list(words)) if words else (np.zeros(0, np.int64), np.zeros(1, np.int64))
    # Special tokens lie behind the words' ids.
    special = sorted(vocab.special.values())
    starts = np.concatenate([starts, len(ids) + np.arange(1, len(special) + 1)])
    ids = np.concatenate([ids, special])
    behind = {number: len(words) + k for k, number in enumerate(special)}
    chosen = np.array([k if k >= 0 else behind[-1 - k] for k in of_piece], np.int64)
    chosen, chosen_starts = _gathered(chosen, np.array(piece_starts), np.array(used, np.int64))
    ids, begins = _gathered(ids, starts, chosen)
    return ids.astype(np.int32), begins[chosen_starts][np.array(ends)]


def decode_ids(ids: np.ndarray, vocab: Vocabulary) -> str:
    """The tokens of ids joined by spaces, as the vocabulary has no decoder."""
    return " ".join([vocab.tokens[k] for k in ids.tolist()])


def encode(
    docs: DataFrame, text: str = "text", path: str | None = None, ids: str = "ids", decoded: str | None = None
) -> DataFrame:
    """``docs`` with the ids of each text as array<int>, and on request with what these ids decode to."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in parts(batches, text):
            found, begins = encode_batch(batch.column(batch.schema.get_field_index(text)).to_pylist(), vocab)
            column = pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(found, pa.int32()))
            batch = _with_column(batch, ids, column)
            if decoded:
                texts = [decode_ids(found[start:end], vocab) for start, end in zip(begins, begins[1:])]
                batch = _with_column(batch, decoded, pa.array(texts, pa.string()))
            yield batch

    schema = _schema_with(docs.dtypes, ids, "array<int>")
    return docs.mapInArrow(run, _ddl(_schema_with(schema, decoded, "string") if decoded else schema))


def decode(docs: DataFrame, ids: str = "ids", path: str | None = None, text: str = "decoded") -> DataFrame:
    """``docs`` with the text of an id array; empty for a null array."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            texts = [decode_ids(row.values.to_numpy(), vocab) if row.is_valid else "" for row in column]
            yield _with_column(batch, text, pa.array(texts, pa.string()))

    return docs.mapInArrow(run, _ddl(_schema_with(docs.dtypes, text, "string")))


def _with_column(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    columns = {field.name: batch.column(k) for k, field in enumerate(batch.schema) if field.name != name}
    columns[name] = column
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _schema_with(columns: list[tuple[str, str]], name: str, kind: str) -> list[tuple[str, str]]:
    return [(column, of) for column, of in columns if column != name] + [(name, kind)]


def _ddl(columns: list[tuple[str, str]]) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in columns)
