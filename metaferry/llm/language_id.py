"""Language of a text by cross-parsing entropy.

A suffix automaton of labelled text per language finds, for each position of a
text, the longest run of characters that occurs in that language's text. A text
is parsed from left to right into such runs; the language that needs the fewest
phrases for its length describes it best.

Learning takes a bounded sample: per language up to ``SAMPLE_ROWS`` rows, in the
order of a hash, those of at most ``ROW_CHARS`` characters first, until they hold
``SAMPLE_CHARS`` characters. Only this sample passes the driver; every Python
worker builds the automata from it. Scoring covers every whole text.

Every letter of a sample has a symbol of its own, whatever its script; a letter
that no sample holds matches nothing.

Texts are compared in lower case, with every run of other characters than
letters as one gap, and in pieces of ``PIECE`` characters that are parsed side
by side in numpy; a phrase ends at the end of a piece.

Defined results: a null text or one without a letter is ``und`` with score 0.
Otherwise the score is 1 minus the phrases of the best language over those of
the second, and 1 if only one language is known. Ties go to the language that
comes first by code point. If nothing was learned, all is ``und``. Rows are
independent; repeated ids give repeated rows; an empty table an empty one.
"""

from __future__ import annotations

import functools
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from metaferry.llm.parts import parts

SAMPLE_ROWS, ROW_CHARS, SAMPLE_CHARS = 100, 4000, 30_000
PIECE, LANES = 1024, 4096
UNDETERMINED = "und"
_GAP, _OTHER = 0, 1
# Up to so many symbols of a language its transitions are one full table.
TABLE_WIDTH = 128


def sample(docs: DataFrame, key: str, text: str, lang: str, learn: Column) -> dict[str, list[str]]:
    """The texts to learn from, by language. Runs a job; its result is bounded by the sample's parameters."""
    order = (F.length(text) > ROW_CHARS, F.md5(F.col(key).cast("string")), F.col(key))
    usable = docs.filter(learn & F.col(lang).isNotNull() & (F.length(text) > 0))
    first = (
        usable.select(F.col(lang).alias("lang"), F.substring(text, 1, SAMPLE_CHARS).alias("text"), *[c.alias(f"o{k}") for k, c in enumerate(order)])
        .withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy("o0", "o1", "o2", "text")))
        .filter(F.col("rank") <= SAMPLE_ROWS)
    )
    before = F.sum(F.length("text")).over(W.partitionBy("lang").orderBy("rank").rowsBetween(W.unboundedPreceding, -1))
    chosen = first.withColumn("before", F.coalesce(before, F.lit(0))).filter(F.col("before") < SAMPLE_CHARS)
    found: dict[str, list[str]] = {}
    # The last text of a language is cut where the sample is full.
    cut = F.substring("text", F.lit(1), F.lit(SAMPLE_CHARS) - F.col("before").cast("int")).alias("text")
    for row in chosen.orderBy("lang", "rank").select("lang", cut).collect():
        found.setdefault(row.lang, []).append(row.text)
    return found


@functools.cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: is it a letter, and its lower case."""
    lower = np.arange(0x110000, dtype=np.uint32)
    letter = np.zeros(0x110000, bool)
    for code in range(0x110000):
        character = chr(code)
        if unicodedata.category(character)[0] == "L":
            letter[code] = True
            small = character.lower()
            if len(small) == 1:
                lower[code] = ord(small)
    return letter, lower


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class _Transitions:
    """Where states go by symbols less than ``width``, as a table or, for many symbols, as a sorted list; -1 is nowhere."""

    def __init__(self, following: list[dict[int, int]], width: int):
        self.width = width
        self.table = None
        if width <= TABLE_WIDTH:
            table = np.full((len(following), width), -1, np.int32)
            for state, arcs in enumerate(following):
                table[state, list(arcs)] = list(arcs.values())
            self.table = table.ravel()
            return
        arcs = sorted((state * width + symbol, to) for state, found in enumerate(following) for symbol, to in found.items())
        self.keys, self.targets = np.array([key for key, _ in arcs]), np.array([to for _, to in arcs], np.int32)

    def after(self, states: np.ndarray | int, symbols: np.ndarray) -> np.ndarray:
        places = np.asarray(states, np.int64) * self.width + symbols
        if self.table is not None:
            return self.table[places]
        found = np.minimum(np.searchsorted(self.keys, places), len(self.keys) - 1)
        return np.where(self.keys[found] == places, self.targets[found], np.int32(-1))


def _automaton(symbols: list[int]) -> list[dict[int, int]]:
    """The transitions of each state of the suffix automaton of a sequence."""
    following: list[dict[int, int]] = [{}]
    length, link, last = [0], [-1], 0
    for symbol in symbols:
        own = len(length)
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in following[at]:
            following[at][symbol] = own
            at = link[at]
        if at >= 0:
            target = following[at][symbol]
            if length[target] == length[at] + 1:
                link[own] = target
            else:
                copy = len(length)
                following.append(dict(following[target]))
                length.append(length[at] + 1)
                link.append(link[target])
                while at >= 0 and following[at].get(symbol) == target:
                    following[at][symbol] = copy
                    at = link[at]
                link[target] = link[own] = copy
        last = own
    return following


class Languages:
    def __init__(self, texts: dict[str, list[str]]):
        self.names = sorted(texts, key=lambda name: name.encode())
        letter, lower = _letters()
        seen: Counter = Counter()
        for of_one in texts.values():
            codes = lower[_codes("".join(of_one))]
            seen.update(dict(zip(*np.unique(codes[letter[codes]], return_counts=True))))
        # Symbols are numbered from the most frequent letter.
        ranked = sorted(seen.items(), key=lambda item: (-item[1], item[0]))
        number = np.zeros(0x110000, np.int32)
        number[[code for code, _ in ranked]] = np.arange(2, len(ranked) + 2)
        known = number[lower]
        self.classes = np.where(letter, np.where(known > 0, known, _OTHER), _GAP).astype(np.uint8 if len(ranked) < 254 else np.int32)
        # Each automaton has columns for the symbols of its own language alone; the pieces of its text are parted by
        # gaps, and column _OTHER, of all other letters, matches nothing.
        self.tables = []
        for name in self.names:
            symbols = np.concatenate([each for text in texts[name] for each in ([_GAP], self.symbols(text))]).astype(np.int64)
            own = np.union1d([_GAP, _OTHER], symbols)
            columns = np.full(len(ranked) + 2, _OTHER, np.int32)
            columns[own] = np.arange(len(own))
            following = _automaton(columns[symbols].tolist())
            self.tables.append((_Transitions(following, len(own)), columns))

    def symbols(self, text: str) -> np.ndarray:
        """Classes of characters, with runs of gaps as one; empty if there is no letter."""
        found = self.classes[_codes(text)]
        if not found.any():
            return found[:0]
        keep = np.ones(len(found), bool)
        keep[1:] = (found[1:] != _GAP) | (found[:-1] != _GAP)
        return found[keep]

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases per text and language."""
        owner, pieces = [], []
        for k, symbols in enumerate(texts):
            for start in range(0, len(symbols), PIECE):
                owner.append(k)
                pieces.append(symbols[start : start + PIECE])
        total = np.zeros((len(texts), len(self.names)), np.int64)
        order = sorted(range(len(pieces)), key=lambda k: -len(pieces[k]))
        for start in range(0, len(order), LANES):
            chosen = order[start : start + LANES]
            lengths = np.array([len(pieces[k]) for k in chosen])
            grid = np.zeros((lengths[0], len(chosen)), self.classes.dtype)
            for lane, k in enumerate(chosen):
                grid[: lengths[lane], lane] = pieces[k]
            owners = np.array([owner[k] for k in chosen])
            active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
            for lang, (transitions, columns) in enumerate(self.tables):
                np.add.at(total[:, lang], owners, self._parse(columns[grid], active, transitions))
        return total

    def _parse(self, grid: np.ndarray, active: np.ndarray, transitions: _Transitions) -> np.ndarray:
        """Phrases of each lane, a column of the grid; lanes are sorted, the longest first."""
        state = np.zeros(grid.shape[1], np.int32)
        count = np.zeros(grid.shape[1], np.int64)
        for row, n in zip(grid, active.tolist()):
            symbols = row[:n]
            reached = transitions.after(state[:n], symbols)
            broken = np.flatnonzero(reached < 0)
            if len(broken):
                # The phrase ends before this character, which begins the next one or is one of its own.
                again = transitions.after(0, symbols[broken])
                count[broken] += (state[broken] > 0).astype(np.int64) + (again < 0)
                reached[broken] = np.maximum(again, 0)
            state[:n] = reached
        return count + (state > 0)


_LEARNED: dict[int, Languages] = {}


def predict(docs: DataFrame, texts: dict[str, list[str]], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score) of every row, with what ``sample`` found."""
    mark = hash(repr(sorted(texts.items())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if mark not in _LEARNED:
            _LEARNED.clear()
            _LEARNED[mark] = Languages(texts)
        known = _LEARNED[mark]
        for batch in parts(batches, 1):
            found = [known.symbols(value.as_py() or "") for value in batch.column(1)]
            phrases = known.phrases(found) if known.names else np.zeros((len(found), 0))
            names, scores = [], []
            for symbols, row in zip(found, phrases):
                if not len(symbols) or not len(row):
                    names.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                best = int(row.argmin())
                second = np.delete(row, best).min() if len(row) > 1 else None
                names.append(known.names[best])
                scores.append(1.0 if second is None else 1.0 - row[best] / second)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["key", "lang_pred", "score"]
            )

    kind = dict(docs.dtypes)[key]
    return (
        docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
        .mapInArrow(run, f"key {kind}, lang_pred string, score double")
        .withColumnRenamed("key", key)
    )


def held_out(key: str = "doc_id") -> Column:
    """Rows that are never learned from; a null id is learned from by nobody and held out by nobody."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))


def language_id(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(key, held_out, lang_pred, score), learned from the rows that are not held out. Runs a job for the sample."""
    learn = F.crc32(F.col(key).cast("string")) % 3 != 1
    texts = sample(docs, key, text, lang, learn)
    return predict(docs, texts, key, text).select(key, held_out(key).alias("held_out"), "lang_pred", "score")
