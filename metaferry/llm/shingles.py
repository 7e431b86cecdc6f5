"""Hashes of words and word shingles of whole texts, in numpy."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

WIDTH = 5
_PIECE = 1 << 20
_BLANK = re.compile(rb"[\x20\x09-\x0d]")
_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BYTES = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _ROLL = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all others."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _pieces(data: bytes) -> Iterator[bytes]:
    """A text in pieces that end between words."""
    start = 0
    while len(data) - start > _PIECE:
        cut = _BLANK.search(data, start + _PIECE)
        if cut is None:
            break
        yield data[start : cut.start()]
        start = cut.end()
    yield data[start:]


def word_hashes(text: str | None, lower: bool = True) -> np.ndarray:
    """One 64-bit hash per word of a text, with A-Z in lower case or as it is."""
    data = (text or "").encode()
    found = [_hashes(piece) for piece in _pieces(data.lower() if lower else data)]
    return found[0] if len(found) == 1 else np.concatenate(found)


def _hashes(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    blank = _IS_BLANK[raw]
    starts = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]])) if len(raw) else np.zeros(0, np.int64)
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = np.diff(starts, append=len(raw))
    place = np.arange(starts[0], len(raw)) - np.repeat(starts, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), _BASE, np.uint64))
    values = np.where(blank[starts[0] :], np.uint64(0), _BYTES[raw[starts[0] :]] * powers[place])
    return mixed(np.add.reduceat(values, starts - starts[0]))


def shingle_set(words: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``width`` words; of all words, if there are fewer; empty without words."""
    if not len(words):
        return words
    span = min(width, len(words))
    rolled = np.full(len(words) - span + 1, np.uint64(span))
    for k in range(span):
        rolled = rolled * _ROLL + words[k : len(words) - span + 1 + k]
    return np.unique(mixed(rolled))
