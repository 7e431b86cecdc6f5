"""Substring dedup against a count of all windows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np

from metaferry.llm import shingles, substring_dedup

DOCS = "doc_id long, text string, h1 int, kind string, digest string"


def table(spark, rows):
    return spark.createDataFrame([(key, text, 1, "k", "d") for key, text in rows], DOCS)


def words_of(text):
    return (text or "").encode().split()


def expected(rows, width=substring_dedup.WINDOW):
    lists = [(key, words_of(text)) for key, text in rows]
    seen = Counter(tuple(words[k : k + width]) for _, words in lists for k in range(len(words) - width + 1))
    found = []
    for key, words in lists:
        gone = set()
        for k in range(len(words) - width + 1):
            if seen[tuple(words[k : k + width])] > 1:
                gone.update(range(k, k + width))
        kept = b" ".join(word for k, word in enumerate(words) if k not in gone)
        found.append((key, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=str)


def corpus(seed=6):
    dice = random.Random(seed)
    word = lambda: "".join(dice.choice("abcdeÉ") for _ in range(4))
    prose = lambda n: [word() for _ in range(n)]
    shared = [prose(n) for n in (34, 35, 36, 60, 200)]
    lists = []
    for _ in range(60):
        words = prose(dice.choice([0, 5, 40, 150]))
        for _ in range(dice.randrange(4)):
            passage = dice.choice(shared)
            start = dice.choice([0, 0, dice.randrange(len(passage))])
            words += passage[start : start + dice.choice([20, 34, 35, 500])] + prose(dice.choice([0, 1, 30]))
        lists.append(words)
    for _ in range(30):  # near copies: the graph branches at every change
        copy = list(shared[4])
        for _ in range(dice.randrange(1, 4)):
            copy[dice.randrange(len(copy))] = word()
        lists.append(copy)
    lists += [shared[3] * 3, ["one"] * 34, ["two"] * 35, ["three"] * 36, ["a", "b"] * 40]
    rows = [(k, dice.choice([" ", "\n", "\t \x0b"]).join(words)) for k, words in enumerate(lists)]
    rows += [(900, rows[70][1]), (900, rows[70][1]), (None, rows[0][1]), (901, "Case " + " ".join(shared[3]).upper())]
    rows += [(902, None), (903, ""), (904, " \n"), (905, None), (906, " ".join(prose(60_000) + shared[1] + prose(10)))]
    rows += [(907, "y" * 2_000_000), (908, " ".join(shared[1]) + " x"), (909, "\x1c".join(shared[1]))]
    return rows


def test_removed_words(spark):
    rows = corpus()
    found = substring_dedup.without_repeats(table(spark, rows))
    assert found.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == expected(rows)


def test_crowd_of_copies_with_unlike_ends(spark):
    dice = random.Random(8)
    passage = [f"p{k}" for k in range(80)]
    rows = [(k, " ".join([f"x{k}"] * 3 + passage[dice.randrange(5) : 80 - dice.randrange(5)] + [f"y{k}"])) for k in range(2000)]
    found = substring_dedup.without_repeats(table(spark, rows))
    assert sorted(map(tuple, found.collect()), key=str) == expected(rows)


def test_empty_and_short_tables(spark):
    assert substring_dedup.without_repeats(table(spark, [(1, "a")]).limit(0)).count() == 0
    rows = [(1, "a b"), (2, None)]
    assert sorted(map(tuple, substring_dedup.without_repeats(table(spark, rows)).collect()), key=str) == expected(rows)


def test_runs_cover_all_windows_once():
    dice = random.Random(9)
    words = shingles.word_hashes(" ".join(dice.choice("abcdefg") for _ in range(3000)), lower=False)
    anchor, key, first, last = substring_dedup.runs(words)
    assert first[0] == 0 and last[-1] == len(words) - substring_dedup.WINDOW
    assert (first[1:] == last[:-1] + 1).all()
    spans = substring_dedup.Spans(np.concatenate([words, words[:100]]))
    assert spans.of(np.array([0, 7]), np.array([100, 50])).tolist() == spans.of(np.array([3000, 3007]), np.array([3100, 3050])).tolist()


def test_repeated_runs_are_compacted(spark):
    text = " ".join(f"w{k}" for k in range(500))
    marks = spark.createDataFrame(
        [(i, i, *run, 1) for i in (1, 2) for run in [(0, 9, 70, 5), (10, 30, 71, 6), (31, 60, 72, 7)]],
        "h1 long, h2 long, first int, last int, anchor long, key long, copies long",
    )
    linked = marks.join(substring_dedup.sources(marks), ["anchor", "key"])
    found = sorted(map(tuple, substring_dedup.paths(linked).collect()))
    assert found == [(1, 1, 0, 60, 1, 1, 0), (2, 2, 0, 60, 1, 1, 0)]
    texts, notes = substring_dedup.repeated(table(spark, [(1, text), (2, text + " tail"), (3, "w1 w2")]))
    assert [row.kind for row in notes.collect()].count(0) <= 4 and texts.count() == 2


def test_powers_of_long_and_short_texts_agree(monkeypatch):
    words = substring_dedup.word_hashes(" ".join(f"w{n * n % 97}" for n in range(500)), lower=False)
    usual = substring_dedup.runs(words)
    monkeypatch.setattr(substring_dedup, "_USUAL", 10)
    assert all((one == other).all() for one, other in zip(usual, substring_dedup.runs(words)))
