"""Word-piece counts by a linear longest-match automaton.

Greedy word pieces take the longest vocabulary entry that begins the rest of a
word; entries that begin words and entries that continue them are two sets. The
automaton is a trie of both. A node's failure link leads to where matching goes
on when no longer entry fits, and its popped count says how many pieces are
complete by then. A word is read once, character by character; no piece is cut
out and nothing is read twice.

A word with a character that no piece covers counts as one unknown piece.

With ``lone_mark`` the word mark alone, if the vocabulary has it, begins words that
begin with no longer entry: 1999 is the mark and four digits. Without it, the
default, such a word is unknown. The query ``op10_token_counts`` counts with it.

The vocabulary is a sentencepiece model, read on every executor: its pieces that
start with the word mark begin words, the others continue them; control, unknown
and byte entries are left out. Words are runs of other characters than ASCII
white space. Every distinct word is matched once per task as long as fewer than
``REMEMBERED`` are known; nothing is shuffled.

Defined results: null and empty texts have 0 words and pieces. Rows are
independent; repeated ids give repeated rows; only the id column is kept, other
columns may have any name. An empty table gives an empty one.
"""

from __future__ import annotations

import functools
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaferry.llm.parts import parts

WORD_MARK = "▁"
REMEMBERED = 1 << 20
_UNKNOWN = 1 << 32  # unknown words are counted above the pieces


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Automaton:
    """Counts the greedy pieces of a word."""

    def __init__(self, beginning: Iterable[str], continuing: Iterable[str], lone_mark: bool = False):
        self.next: list[dict[str, int]] = [{}, {}]  # node 0 begins words, node 1 continues them
        entry = [False, False]
        for root, pieces in ((0, beginning), (1, continuing)):
            for piece in pieces:
                node = root
                for character in piece:
                    if character not in self.next[node]:
                        self.next[node][character] = len(self.next)
                        self.next.append({})
                        entry.append(False)
                    node = self.next[node][character]
                entry[node] = bool(piece)
        self.link: list[int] = [-1] * len(self.next)
        self.popped = [0] * len(self.next)
        if lone_mark:
            self.link[0], self.popped[0] = 1, 1
        waiting = deque([0, 1])
        while waiting:
            parent = waiting.popleft()
            for character, node in self.next[parent].items():
                waiting.append(node)
                if entry[node]:
                    self.link[node], self.popped[node] = 1, 1
                    continue
                # What was popped for the parent, and what must go before this character fits again.
                at, popped = self.link[parent], self.popped[parent]
                while at >= 0 and character not in self.next[at]:
                    popped += self.popped[at]
                    at = self.link[at]
                if at >= 0:
                    self.link[node], self.popped[node] = self.next[at][character], popped
        self.known: dict[bytes, int] = {}

    def count(self, word: str) -> int:
        """The pieces of a word, or ``_UNKNOWN`` + 1."""
        following, link, popped = self.next, self.link, self.popped
        at = total = 0
        for character in word:
            while character not in following[at]:
                total += popped[at]
                at = link[at]
                if at < 0:
                    return _UNKNOWN + 1
            at = following[at][character]
        while at > 1:
            total += popped[at]
            at = link[at]
        return total if at == 1 else _UNKNOWN + 1

    def counts(self, words: list[bytes]) -> int:
        """The sum over words."""
        known = self.known
        for word in set(words).difference(known):
            if len(known) >= REMEMBERED:
                known.clear()
                return sum(self.count(each.decode()) for each in words)
            known[word] = self.count(word.decode())
        return sum(map(known.__getitem__, words))


@functools.lru_cache(2)
def automaton(path: str, lone_mark: bool = False) -> Automaton:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    odd = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
    pieces = [model.id_to_piece(k) for k in range(model.get_piece_size()) if not any(test(k) for test in odd)]
    marked = [piece[1:] for piece in pieces if piece.startswith(WORD_MARK)]
    return Automaton(marked, [piece for piece in pieces if WORD_MARK not in piece], lone_mark and WORD_MARK in pieces)


def token_counts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, lone_mark: bool = False
) -> DataFrame:
    """(key, n_words, n_pieces, n_unknown) per row; an unknown word is one of the pieces."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = automaton(path, lone_mark)
        for batch in parts(batches, 1):
            n_words, sums = [], []
            for value in batch.column(1):
                words = (value.as_py() or "").encode().split()
                n_words.append(len(words))
                sums.append(pieces.counts(words))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n_words, pa.int64()),
                    pa.array([total % _UNKNOWN for total in sums], pa.int64()),
                    pa.array([total // _UNKNOWN for total in sums], pa.int64()),
                ],
                ["key", "n_words", "n_pieces", "n_unknown"],
            )

    kind = dict(docs.dtypes)[key]
    counted = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        run, f"key {kind}, n_words bigint, n_pieces bigint, n_unknown bigint"
    )
    return counted.withColumnRenamed("key", key)
