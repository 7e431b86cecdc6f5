"""Near-dedup against all pairs of full sets."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from metaferry.llm import components, near_dedup, shingles

DOCS = "doc_id long, text string, id string, component_id int"


def table(spark, rows):
    return spark.createDataFrame([(key, text, "x", 1) for key, text in rows], DOCS)


def sets_of(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def expected(rows):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    sets = [(key, sets_of(text)) for key, text in rows if key is not None]
    for k, (a, left) in enumerate(sets):
        for b, right in sets[:k]:
            if left and right and 100 * len(left & right) >= 75 * len(left | right) or a == b:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {key: root(key) for key, _ in sets}


def corpus(seed=3):
    dice = random.Random(seed)
    word = lambda: "".join(dice.choice("abcdefgh") for _ in range(4))
    rows = []
    for group in range(12):
        base = [word() for _ in range(dice.choice([6, 40, 300]))]
        for _ in range(dice.choice([1, 2, 30])):
            copy = list(base)
            for _ in range(dice.randrange(0, 1 + len(base) // 25)):
                copy[dice.randrange(len(copy))] = word()
            rows.append((len(rows) + 10, dice.choice([" ", "\n", "\t "]).join(copy).title()))
        rows.append((len(rows) + 10, " ".join(base)))
    rows += [(5, None), (6, ""), (7, " \n"), (8, "a b"), (9, "A  B"), (3, "a b c d"), (2, "b a")]
    rows += [(len(rows) + 10, "long " * 30_000), (len(rows) + 11, "x" * 2_000_000)]
    return rows


def test_components_and_sizes(spark):
    rows = corpus()
    found = near_dedup.near_duplicates(table(spark, rows)).collect()
    assert len(found) == len(rows)
    wanted, sizes = expected(rows), {key: len(sets_of(text)) for key, text in rows}
    assert {row.doc_id: row.component_id for row in found} == wanted
    assert {row.doc_id: row.n_shingles for row in found} == sizes
    assert all(row.kept == (row.doc_id == row.component_id) for row in found)


def test_repeated_and_null_ids(spark):
    text = " ".join(f"w{k}" for k in range(50))
    rows = [(1, text), (1, text), (None, text), (2, text + " more"), (4, "other words stand here now"), (4, text), (3, "other words stand here now")]
    found = near_dedup.near_duplicates(table(spark, rows)).collect()
    assert {(row.doc_id, row.component_id) for row in found} == {(1, 1), (2, 1), (3, 1), (4, 1), (None, None)}
    kept = near_dedup.without_near_duplicates(table(spark, rows))
    assert kept.columns == ["doc_id", "text", "id", "component_id"]
    assert sorted((row.doc_id or 0) for row in kept.collect()) == [0, 1]


def test_one_id_with_two_texts_that_have_near_copies(spark):
    one, two = (" ".join(f"{letter}{k}" for k in range(60)) for letter in "ab")
    rows = [(1, one), (1, two), (2, one + " x"), (3, two + " y"), (4, "something else stands here now")]
    found = near_dedup.near_duplicates(table(spark, rows)).collect()
    assert {(row.doc_id, row.component_id) for row in found} == {(1, 1), (2, 1), (3, 1), (4, 4)}


def test_empty_table(spark):
    empty = table(spark, []) if False else table(spark, [(1, "a")]).limit(0)
    assert near_dedup.near_duplicates(empty).count() == 0
    assert near_dedup.without_near_duplicates(empty).count() == 0


def test_shingle_sets_match_tuples():
    dice = random.Random(5)
    for _ in range(200):
        text = "".join(dice.choice("abAB \n\té ") for _ in range(dice.randrange(60)))
        assert len(shingles.shingle_set(shingles.word_hashes(text))) == len(sets_of(text))
    long = "word " * 10 + "y" * 3_000_000 + " tail" * 300_000
    assert len(shingles.word_hashes(long)) == len(long.split())


def test_chain_of_links(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 99), (5, 5), (200, 201), (201, 202)], "a long, b long")
    found = {row.id: row.component for row in components.components(links).collect()}
    assert found == {**{k: 0 for k in range(61)}, 99: 99, 100: 99, 200: 200, 201: 200, 202: 200}


def crowd(base_id, leaves, seed=11):
    """Leaves that are 0.76 to 0.82 like one base and less than 0.75 like each other."""
    dice = random.Random(seed)
    base = [f"b{k}" for k in range(200)]
    rows = [(base_id, " ".join(base))]
    for k in range(leaves):
        copy = list(base)
        for at in dice.sample(range(10, 190, 20), 4):
            copy[at] = f"n{k}x{at}"
        rows.append((k + 10, " ".join(copy)))
    return rows


def test_every_member_of_a_crowd_meets_its_base(spark):
    for base_id in (1, 100_000):
        rows = crowd(base_id, 3000)
        found = {row.component_id for row in near_dedup.near_duplicates(table(spark, rows)).collect()}
        assert found == {min(base_id, 10)}


def test_one_link_joins_two_large_components(spark):
    base = [f"b{k}" for k in range(200)]
    other = [f"o{k}" if k in (20, 60, 100, 140, 180) else word for k, word in enumerate(base)]
    rows = [(1, " ".join(base)), (2, " ".join(other))]
    for k in range(3000):
        copy = list((base, other)[k % 2])
        copy[(10, 40, 80, 120, 160)[k // 2 % 5]] = f"n{k}"
        rows.append((k + 10, " ".join(copy)))
    found = {row.component_id for row in near_dedup.near_duplicates(table(spark, rows)).collect()}
    assert found == {1}


def loosely_alike(n, base_words=300, seed=4):
    """Texts that share a base and are about 0.57 alike, and the pairs of them that are near copies."""
    dice = random.Random(seed)
    base = [f"b{k}" for k in range(base_words)]
    rows = []
    for k in range(n):
        rows.append((k, " ".join(base + [f"n{k}x{j}" for j in range(113)])))
        if k % 100 == 0:
            copy = rows[-1][1].split()
            copy[dice.randrange(len(copy))] = "changed"
            rows.append((n + k, " ".join(copy)))
    return rows


def test_loosely_alike_texts_cause_few_candidates(spark):
    rows = loosely_alike(4000)
    found = near_dedup.near_duplicates(table(spark, rows)).collect()
    wanted = {key: key - 4000 if key >= 4000 else key for key, _ in rows}
    assert {row.doc_id: row.component_id for row in found} == wanted
    signed = near_dedup.sketches(table(spark, rows)).selectExpr("id", "id AS part", "signature", "fine").cache()
    pairs, _ = near_dedup.crossing(signed)
    assert pairs.count() < len(rows)


def test_regions_with_many_undecided_pairs_are_cut(spark):
    compared = []
    for n in (500, 2000):
        signed = near_dedup.sketches(table(spark, loosely_alike(n))).selectExpr("id", "id AS part", "signature", "fine").cache()
        rows, cut = near_dedup.undecided(signed, 1 << 11)
        assert cut
        sizes = [row.n for row in rows.groupBy("place", "cell").agg(F.count("*").alias("n")).collect()]
        compared.append(sum(size * (size - 1) // 2 for size in sizes))
    assert compared[1] < 6 * compared[0]


def test_passes_go_on_while_regions_are_cut(spark):
    rows = crowd(1, 400)
    docs = table(spark, rows)
    classes = near_dedup.sketches(docs).select("id", "signature", "fine").cache()
    joined = components.components(near_dedup.links(docs, classes, region_pairs=1 << 10)).collect()
    assert len(joined) == len(rows) and {row.component for row in joined} == {1}


def test_blocks_of_a_region_lose_no_pair(spark, monkeypatch):
    """Rows outside of the main part meet all others, whether they fit one block or not."""
    for block in (4, 64):
        monkeypatch.setattr(near_dedup, "BLOCK_ROWS", block)
        rows = [(7, k, 0 if k < 90 else k) for k in range(120)]
        dealt = spark.createDataFrame(rows, "place long, id long, part long")
        regions = spark.createDataFrame([(7, 120.0, 9.0, 0, 30.0)], "place long, rows double, pairs double, main long, few double")
        cells = {}
        for row in near_dedup._cells(dealt, regions).collect():
            cells.setdefault(row.cell, []).append((row.id, row.part))
        met = {frozenset((a, b)) for held in cells.values() for a, p in held for b, q in held if p != q}
        assert met == {frozenset((a, b)) for _, a, p in rows for _, b, q in rows if p != q}
