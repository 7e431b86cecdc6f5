"""Cross-tokenizer alignment against a plain walk over both token lists."""

from __future__ import annotations

import functools
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from metaferry.llm import token_alignment as T

DOCS = "doc_id long, text string, h1 int, key string, pairs string"


def table(spark, rows):
    return spark.createDataFrame([(key, text, 1, "k", "p") for key, text in rows], DOCS)


@functools.cache
def libraries():
    one = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    one.encode_special_tokens = True
    return one, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def spans_of(text):
    """((id, start, end) of A, of B), or nothing."""
    one, other = libraries()
    characters = {char: byte for byte, char in enumerate(T._byte_characters())}
    ids = one.encode(" " + text, add_special_tokens=False).ids
    raw_a = [bytes(characters[char] for char in one.id_to_token(k)) for k in ids]
    pieces = other.encode(text)
    names = [other.id_to_piece(k) for k in pieces]
    raw_b = [bytes([int(n[3:5], 16)]) if other.is_byte(k) else n.replace("▁", " ").encode() for k, n in zip(pieces, names)]
    wanted = (" " + text).encode()
    if b"".join(raw_a) != wanted or b"".join(raw_b) != wanted:
        return [], []
    found = []
    for numbers, raws in ((ids, raw_a), (pieces, raw_b)):
        at, spans = 0, []
        for number, raw in zip(numbers, raws):
            spans.append((number, at, at + len(raw)))
            at += len(raw)
        found.append(spans)
    return found[0], found[1]


def expected(rows):
    documents, held = [], Counter()
    for key, text in rows:
        a, b = spans_of(text) if text else ([], [])
        linked, i, j = [], 0, 0
        while i < len(a) and j < len(b):
            linked.append((a[i][0], b[j][0]))
            end = min(a[i][2], b[j][2])
            i, j = i + (a[i][2] == end), j + (b[j][2] == end)
        ends = sorted({end for *_, end in a} & {end for *_, end in b})
        groups, i, j = [], 0, 0
        for end in ends:
            ids = []
            for side, at in ((a, i), (b, j)):
                to = at
                while side[to][2] < end:
                    to += 1
                ids.append(",".join(str(number) for number, *_ in side[at : to + 1]))
            i += len(ids[0].split(","))
            j += len(ids[1].split(","))
            groups.append("|".join(ids))
        documents.append((key, a, b, linked, groups))
        held.update(set(linked))
    best = Counter()
    for (one, _), n in held.items():
        best[one] = max(best[one], n)
    return sorted(
        (
            (key, len(a), len(b), len(groups), len(linked), sum(held[pair] == best[pair[0]] for pair in linked),
             sum(held[pair] for pair in linked), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
            for key, a, b, linked, groups in documents
        ),
        key=str,
    )


TEXTS = [
    None, "", " ", "\n", "a", "Hello  world", "tokenization isn't  the\tsame\n\n\n as it was", "<|endoftext|> <s> </s> <unk> <0x41>",
    "naïve café — 日本語テキスト 한국어 🎉👩‍👩‍👧 ½ ﬁ", "with▁mark", "zero\x00byte \x1c\x85 x", "'s 't're 're", "x" * 300, " lead and trail ",
    "1999 2024-12-01 3.14159", "é é", "   wide", "Ünïcödé " * 9, "def f(x):\n    return  x\n" * 4,
]


def corpus(seed=2):
    dice = random.Random(seed)
    rows = list(enumerate(TEXTS))
    words = ["running", "Straße", "internationalization", "a", "  b", "日本", "x1y2", "\n", "—", "don't", "\t", "supercalifragilistic"]
    for k in range(60):
        rows.append((100 + k, " ".join(dice.choice(words) for _ in range(dice.choice([1, 3, 40, 400])))))
    return rows + [(100, rows[-1][1]), (None, rows[-2][1]), (100, rows[-1][1]), (400, "日本語" * 700), (401, "ab" * 900 + " end")]


@pytest.mark.parametrize("size,head", [(1 << 17, 1 << 17), (64, 5), (7, 0)])
def test_counts_and_groups(spark, size, head):
    rows = corpus()
    found = T.alignment(table(spark, rows), size=size, head=head)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == expected(rows)


def test_empty_table(spark):
    assert T.alignment(table(spark, [(1, "a")]).limit(0)).count() == 0
    assert [tuple(row)[1:7] for row in T.alignment(table(spark, [(1, None), (2, "")])).collect()] == [(0,) * 6] * 2


def test_fragments_compose_in_any_tree():
    tok = T.tokenizers(*T.default_paths())
    dice = random.Random(3)
    text = " ".join(dice.choice(["alignment", "日本語", "isn't", "extraordinarily", "ab12", "🎉"]) for _ in range(200))
    a, b, *_ = T._tokens(tok, [text])
    whole = T.fragment(tok, a, b)
    for _ in range(20):
        cuts = sorted(dice.sample(range(1, int(a[-1, 1])), dice.choice([1, 5, 60])))
        parts = []
        for low, high in zip([0, *cuts], [*cuts, 1 << 40]):
            parts.append(T.fragment(tok, *(side[(side[:, 1] > low) & (side[:, 1] <= high)] for side in (a, b))))
        while len(parts) > 1:
            k = dice.randrange(len(parts) - 1)
            parts[k : k + 2] = [T.compose(tok, parts[k], parts[k + 1])]
        for name in T.Fragment.__dataclass_fields__:
            assert np.array_equal(getattr(parts[0], name), getattr(whole, name)), name


def test_ranks_give_the_ids_of_the_library():
    tok = T.tokenizers(*T.default_paths())
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    texts = [every[k : k + 4096] for k in range(0, len(every), 4096)] + [f"{char}a {char} 1{char}" for char in every[:0x3000]]
    wanted = [one.ids for one in tok.library.encode_batch(texts, add_special_tokens=False)]
    found = tok.ids_of_a(texts)
    assert [k for k, (one, other) in enumerate(zip(found, wanted)) if one != other] == []


def test_very_long_texts(spark):
    rows = [(1, "x" * 400_000), (2, "long text. " * 60_000), (3, " " * 300_000), (4, "日本" * 100_000), (5, "long text. " * 60_000)]
    found = {row.doc_id: row for row in T.alignment(table(spark, rows)).collect()}
    for key, text in rows:
        a, b = spans_of(text)
        assert (found[key].n_a, found[key].n_b) == (len(a), len(b))
    assert tuple(found[2])[1:] == tuple(found[5])[1:]
