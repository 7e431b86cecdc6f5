"""Importance resampling, language id, token counts and Hamming search against plain Python."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from metaferry.llm import hamming_search, importance, language_id, token_counts

DOCS = "doc_id long, text string, lang string, source string, key string, score double"


def docs_of(spark, texts, langs=None):
    langs = langs or [None] * len(texts)
    return spark.createDataFrame([(k, t, g, "s", "k", 1.0) for k, (t, g) in enumerate(zip(texts, langs))], DOCS)


# Importance resampling


def texts_of_two_kinds(n=200):
    dice = random.Random(1)
    good, bad = [f"good{k}" for k in range(30)], [f"bad{k}" for k in range(30)]
    return [" ".join(dice.choice(good if k % 4 else bad) for _ in range(40)) for k in range(n)]


def test_resampling_keeps_what_is_like_the_target(spark):
    texts = texts_of_two_kinds()
    labels = spark.createDataFrame([(k, int(k % 4 > 0), 0) for k in range(0, 200, 3)], "doc_id long, quality int, toxic int")
    found = importance.resampled(docs_of(spark, texts), labels).collect()
    assert len(found) == 200
    kept = {row.doc_id for row in found if row.kept}
    n_good, known = sum(1 for k in range(0, 200, 3) if k % 4), len(range(0, 200, 3))
    assert len(kept) == math.ceil(200 * n_good / known)
    assert sum(1 for k in kept if k % 4) >= 0.95 * min(len(kept), 150)


def test_weights_match_the_formula(spark):
    texts = [*texts_of_two_kinds(20), None, "", "A a"]
    ratios = np.random.default_rng(0).normal(size=importance.BUCKETS)
    for row in importance.weights(docs_of(spark, texts), ratios).collect():
        assert row.log_weight == pytest.approx(float(ratios[importance.features(texts[row.doc_id])].sum()))
        words = len((texts[row.doc_id] or "").split())
        assert row.n_features == max(0, 2 * words - 1)


@pytest.mark.parametrize("values", [[1.0], [2.0] * 9, [-5e-324, 5e-324, 0.0], [float(k) for k in range(5000)], [1e300, -1e300, 1.0, 1.0]])
def test_kth_largest(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for k in {1, len(values) // 2 or 1, len(values)}:
        assert importance.kth_largest(df, "v", k) == sorted(values, reverse=True)[k - 1]


def test_resampling_without_labels_or_rows(spark):
    docs, labels = docs_of(spark, ["a b", None, ""]), spark.createDataFrame([], "doc_id long, quality int")
    assert all(row.kept and row.log_weight == 0 for row in importance.resampled(docs, labels).collect())
    assert importance.resampled(docs.limit(0), labels).count() == 0


# Language id


def phrases_by_search(symbols, training):
    text, n = bytes(symbols), 0
    for start in range(0, len(text), language_id.PIECE):
        piece, at = text[start : start + language_id.PIECE], 0
        while at < len(piece):
            end = at
            while end < len(piece) and piece[end] != 1 and piece[at : end + 1] in training:
                end += 1
            n += 1
            at = max(end, at + 1)
    return n


def test_phrases_match_substring_search():
    dice = random.Random(4)
    make = lambda letters, n: "".join(dice.choice(letters) for _ in range(n))
    texts = {"x": [make("abc de ", 400), "Zz"], "y": [make("abé ñ.", 300)]}
    known = language_id.Languages(texts)
    parsed = [known.symbols(text) for text in [make("abcdeéñ .ß", n) for n in (1, 5, 300, 1024, 3000)] + ["a", "", "...", "中"]]
    training = {n: b"".join(b"\0" + bytes(known.symbols(t)) for t in texts[n]) for n in known.names}
    assert known.phrases(parsed).tolist() == [[phrases_by_search(s, training[n]) for n in known.names] for s in parsed]


def test_languages_and_undetermined(spark):
    english, german = "the cat sat on the mat and the dog ran over there ", "der hund und die katze sind nicht mehr hier gewesen "
    texts, langs = [], []
    for k in range(120):
        texts.append((english if k % 2 else german) * (1 + k % 3))
        langs.append(["de", "en"][k % 2])
    texts += [None, "", "123 !!", "the dog over there", "die katze und der hund"]
    langs += ["en", "de", "en", None, None]
    rows = {row.doc_id: row for row in language_id.language_id(docs_of(spark, texts, langs)).collect()}
    assert len(rows) == 125
    assert [rows[k].lang_pred for k in (120, 121, 122)] == ["und"] * 3
    assert (rows[123].lang_pred, rows[124].lang_pred) == ("en", "de")
    assert all(rows[k].lang_pred == langs[k] for k in range(120))
    assert all(0 <= row.score <= 1 for row in rows.values())


def test_nothing_to_learn_from(spark):
    docs = docs_of(spark, ["hello", None])
    assert {row.lang_pred for row in language_id.language_id(docs).collect()} == {"und"}
    assert language_id.language_id(docs.limit(0)).count() == 0


def test_sample_is_bounded_and_skips_held_out_rows(spark):
    docs = docs_of(spark, ["word " * 50] * 900, ["en"] * 900)
    learn = F.col("doc_id") >= 450
    found = language_id.sample(docs, "doc_id", "text", "lang", learn)
    assert len(found["en"]) <= language_id.SAMPLE_ROWS
    assert sum(map(len, found["en"][:-1])) < language_id.SAMPLE_CHARS


# Token counts


def greedy(word, beginning, continuing):
    at = n = 0
    while at < len(word):
        pieces = continuing if at else beginning
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return None
        at, n = end, n + 1
    return n


def test_automaton_matches_greedy_search():
    dice = random.Random(6)
    for _ in range(60):
        words = {"".join(dice.choice("abc") for _ in range(dice.randrange(1, 5))) for _ in range(dice.randrange(1, 14))}
        beginning = {w for w in words if dice.random() < 0.6}
        continuing = {w for w in words if dice.random() < 0.6}
        built = token_counts.Automaton(sorted(beginning), sorted(continuing))
        for _ in range(100):
            word = "".join(dice.choice("abcd") for _ in range(dice.randrange(1, 12)))
            wanted = greedy(word, beginning, continuing)
            assert built.count(word) == (token_counts._UNKNOWN + 1 if wanted is None else wanted)


def test_counts_of_documents(spark):
    texts = ["the of and", None, "", " \t", "x" * 30_000, "zażółć 中文 \x85a", "the the", "word " * 50_000]
    model = sentencepiece.SentencePieceProcessor(model_file=token_counts.default_path())
    pieces = [model.id_to_piece(k) for k in range(3 + 256, model.get_piece_size())]
    beginning = {p[1:] for p in pieces if p.startswith("▁")}
    continuing = {p for p in pieces if "▁" not in p}
    for row in token_counts.token_counts(docs_of(spark, texts)).collect():
        words = (texts[row.doc_id] or "").encode().split()
        found = {w: greedy(w.decode(), beginning, continuing) for w in set(words) if len(w) < 1000}
        if any(w not in found for w in words):
            assert row.n_words == 1 and row.n_pieces > 1000
            continue
        assert (row.n_words, row.n_pieces, row.n_unknown) == (
            len(words),
            sum(found[w] or 1 for w in words),
            sum(found[w] is None for w in words),
        )
    assert token_counts.token_counts(docs_of(spark, texts).limit(0)).count() == 0


# Hamming search


def neighbours(vectors, queries, k):
    code = {key: tuple(x > 0 for x in v) for key, v in vectors if v and key is not None}
    found = {}
    for query in queries:
        if query in code:
            order = sorted((sum(a != b for a, b in zip(code[query], code[o])), o) for o in code if o != query)
            found[query] = order[:k]
    return found


@pytest.mark.parametrize("shape", ["random", "copies", "few"])
def test_search_matches_all_distances(spark, shape):
    dice = np.random.default_rng(2)
    n = {"random": 150, "copies": 300, "few": 6}[shape]
    base = dice.normal(size=(n, 64))
    if shape == "copies":
        base[50:250] = base[0]
        base[250:] = base[1] * np.where(dice.random((50, 64)) < 0.1, -1, 1)
    vectors = [(k, [float(x) for x in v]) for k, v in enumerate(base)] + [(1000, None), (1020, [])]
    df = spark.createDataFrame([(k, v, 1, 2.0) for k, v in vectors], "vec_id long, embedding array<float>, rank int, distance double")
    found: dict = {}
    for row in hamming_search.search(df, df.filter("vec_id % 20 = 0")).orderBy("query_id", "rank").collect():
        found.setdefault(row.query_id, []).append((row.distance, row.neighbour_id))
    wanted = neighbours(vectors, [k for k, _ in vectors if k % 20 == 0], hamming_search.NEIGHBOURS)
    assert found == {query: order for query, order in wanted.items() if order}


def test_search_over_nothing_and_other_lengths(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert hamming_search.search(empty, empty).count() == 0
    odd = spark.createDataFrame([(0, [1.0] * 70), (1, [1.0, None]), (2, [-1.0])], "vec_id long, embedding array<double>")
    assert hamming_search.search(odd, odd).count() == 6


def test_letters_of_many_scripts_are_told_apart():
    dice = random.Random(9)
    alphabets = {
        "el": range(0x3B1, 0x3CA),
        "en": range(0x61, 0x7B),
        "ko": range(0xAC00, 0xAC00 + 900),
        "ru": range(0x430, 0x450),
        "uk": [*range(0x450, 0x460), *range(0x430, 0x440)],
        "zh": range(0x4E00, 0x4E00 + 900),
    }
    words = {
        name: ["".join(chr(dice.choice(codes)) for _ in range(dice.randrange(2, 6))) for _ in range(300)]
        for name, codes in alphabets.items()
    }
    texts = {name: [" ".join(dice.choices(words[name], k=2000))] for name in words}
    known = language_id.Languages(texts)
    asked = {name: known.symbols(" ".join(dice.choices(words[name], k=40))) for name in words}
    phrases = known.phrases(list(asked.values()))
    assert [known.names[best] for best in phrases.argmin(axis=1)] == list(asked)
    for own, symbols, row in zip(range(len(asked)), asked.values(), phrases):
        assert row[own] < 0.7 * min(count for lang, count in enumerate(row) if lang != own)
    # A list of transitions and a table say the same.
    following = language_id._automaton([0, 2, 3, 2, 2, 0, 3])
    states, symbols = np.divmod(np.arange(len(following) * 4), 4)
    table, listed = language_id._Transitions(following, 4), language_id._Transitions(following, 4)
    wide = language_id._Transitions(following, language_id.TABLE_WIDTH + 1)
    assert table.after(states, symbols).tolist() == wide.after(states, symbols).tolist() == listed.after(states, symbols).tolist()


def greedy_marked(word, pieces):
    """Pieces of a marked word by the longest entry first, None if one is missing."""
    word, at, n = "▁" + word, 0, 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return None
        at, n = end, n + 1
    return n


def test_words_that_begin_with_the_mark_alone(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=token_counts.default_path())
    pieces = {model.id_to_piece(k) for k in range(3 + 256, model.get_piece_size())}
    words = "1999 2024-05-01 7th 中文 αβγ the zażółć x1 \u0e01\u0e02 -- 日本語 \x85a".split(" ")
    built = token_counts.automaton(token_counts.default_path(), True)
    assert greedy_marked("1999", pieces) == 5
    for word in words:
        wanted = greedy_marked(word, pieces)
        assert built.count(word) == (token_counts._UNKNOWN + 1 if wanted is None else wanted), word
    rows = token_counts.token_counts(docs_of(spark, ["1999 中文"]), lone_mark=True).collect()
    assert [(row.n_words, row.n_pieces, row.n_unknown) for row in rows] == [(2, 8, 0)]
