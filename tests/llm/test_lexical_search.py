"""Ranked lexical search against a plain computation of every score."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

from metaferry.llm import lexical_search

DOCS = "doc_id long, text string, item_id string, m int, rank string"
ITEMS = "item_id long, text string, doc_id int, term string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tables(spark, docs, items):
    return (
        spark.createDataFrame([(key, text, "x", 1, "r") for key, text in docs], DOCS),
        spark.createDataFrame([(key, text, 1, "t") for key, text in items], ITEMS),
    )


def terms_of(text):
    return re.findall(r"[0-9A-Za-z\u0080-\U0010ffff]+", (text or "").translate(LOWER))


def expected(docs, items, k=10):
    bags = [(key, Counter(terms_of(text))) for key, text in docs]
    bags = [(key, bag, sum(bag.values())) for key, bag in bags if bag]
    total, df = sum(n for _, _, n in bags), Counter(term for _, bag, _ in bags for term in bag)
    wanted = {}
    for key, text in items:
        wanted.setdefault(key, set()).update(terms_of(text))
    rows = []
    for item, terms in wanted.items():
        scores = []
        for key, bag, n in bags:
            m = 100 - 90 + 90 * n * len(bags) // total
            score = 0
            for term in terms & bag.keys():
                weight = math.floor(1000 * math.log((2 * len(bags) + 2) / (2 * df[term] + 1)))
                score += weight * (1_000_000_000 * bag[term] // (1000 * bag[term] + 8 * m))
            if score:
                scores.append((-score, key is None, key or 0))
        rows += [(item, rank, None if none else key, -score) for rank, (score, none, key) in enumerate(sorted(scores)[:k], 1)]
    return rows


def corpus(seed=4):
    dice = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["É", "é", "straße", "日本語", "A1", "a1", "x'y", "under_score"]
    text = lambda n: " ".join(dice.choice(words[: dice.choice([6, 30, 68])]) for _ in range(n))
    docs = [(k, text(dice.choice([1, 3, 20, 200]))) for k in range(120)]
    # Copies, some with other words outside the items' vocabulary but of the same number.
    docs += [(1000 - k, docs[k % 3][1]) for k in range(60)] + [(2000 + k, docs[5][1] + f" other{k}") for k in range(20)]
    docs += [(7, docs[7][1]), (7, "w1 w2"), (None, docs[4][1]), (None, None), (500, None), (501, ""), (502, " .,;\n")]
    docs += [(503, "W3 " * 400_000), (504, "z" * 1_500_000 + " w5")]
    items = [(k, text(dice.choice([1, 2, 12, 40]))) for k in range(25)]
    items += [(3, "w1 extra"), (None, "w9 w8"), (90, None), (91, ""), (92, "nowhere"), (93, "?!")]
    return docs, items


def sort_key(row):
    return (row[0] is None, row[0] or 0, row[1])


def test_ranks_and_scores(spark):
    docs, items = corpus()
    found = lexical_search.search(*tables(spark, docs, items))
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=sort_key) == sorted(expected(docs, items), key=sort_key)


def test_blocks_of_items_and_fewer_results(spark):
    docs, items = corpus(5)
    found = lexical_search.search(*tables(spark, docs, items), k=3, block_terms=60).collect()
    assert sorted(map(tuple, found), key=sort_key) == sorted(expected(docs, items, 3), key=sort_key)


def test_all_members_of_a_class_in_order(spark):
    docs = [(k, "same words here") for k in range(400, 0, -1)] + [(0, "else"), (900, "unlike")]
    found = lexical_search.search(*tables(spark, docs, [(1, "words")])).collect()
    assert [(row.rank, row.doc_id) for row in sorted(found)] == [(k, k) for k in range(1, 11)]


def test_empty_tables(spark):
    docs, items = tables(spark, [(1, "a b")], [(1, "a")])
    assert lexical_search.search(docs.limit(0), items).count() == 0
    assert lexical_search.search(docs, items.limit(0)).count() == 0
    assert lexical_search.search(*tables(spark, [(1, None), (2, "..")], [(1, "a")])).count() == 0


def test_pieces_of_a_long_text():
    text = " ".join(f"t{k % 1000}" for k in range(400_000)) + "y" * 3_000_000
    found, n = lexical_search.bag(text, {"t7": 0, "t999": 1})
    assert n == 400_000 and found == {0: 400, 1: 399}  # the last t999 goes on as y
