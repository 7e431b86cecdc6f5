"""Quality rules, line dedup and mixing against plain Python."""

from __future__ import annotations

import re
from collections import Counter

import pytest

from metaferry.llm import line_dedup, mixing, quality_rules

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, n_words int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark, texts, sources=None):
    sources = sources or ["a"] * len(texts)
    return spark.createDataFrame([(k, t, None, s, None, "x", 1) for k, (t, s) in enumerate(zip(texts, sources))], DOCS)


ODD = [
    None,
    "",
    " \t\n\x0b\x0c\r ",
    "one",
    "a b a b a b a b",
    "a b c a b c x a b c",
    "same\nsame\n\n  \nsame\nother",
    "é中   x y # * $ % & | < >",
    "w " * 3000,
    " ".join(f"w{k % 700}" for k in range(20_000)),
    "x" * 50_000,
    "l m\x85n\no",
]


def measured(text):
    words = WORD.findall(text or "")
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    often = Counter(windows)
    covered = {k + d for k, window in enumerate(windows) if often[window] > 1 for d in range(3)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_measurements(spark):
    found = quality_rules.ledger(table(spark, ODD)).collect()
    assert {row.doc_id: tuple(row)[1:7] for row in found} == {k: measured(text) for k, text in enumerate(ODD)}


def test_ledger_keeps_rows_and_bits(spark):
    good = " ".join(f"word{k}" for k in range(60))
    docs = table(spark, [good, good, None, "# " * 60 + good])
    bits = [row.failed_bits for row in quality_rules.ledger(docs).orderBy("doc_id").collect()]
    assert bits == [0, 0, 1, 4]  # a text without words fails on their number alone
    assert quality_rules.accepted(docs).columns == docs.columns
    assert sorted(row.doc_id for row in quality_rules.accepted(docs).collect()) == [0, 1]
    assert quality_rules.ledger(docs.limit(0)).count() == 0


def test_ablation_counts(spark):
    good = " ".join(f"word{k}" for k in range(60))
    entries = quality_rules.ledger(table(spark, [good, "a b", "# # a", "# " * 60 + good]))
    rows = {(row.policy, row.rule): row for row in quality_rules.ablation(entries).collect()}
    few, symbols = rows["2026-1", "few_words"], rows["2026-1", "symbols"]
    assert (few.n_documents, few.n_rejected, few.n_failing) == (4, 3, 2)
    assert symbols.n_failing == 2 and symbols.n_only_failing == 1
    assert {rule for policy, rule in rows if policy == "base"} == {"few_words", "repeated_windows"}


def test_lines_are_cut_per_site(spark):
    texts = [f"menu\ntext {k}\n\nfoot" for k in range(10)] + ["menu\nother"] * 2 + [None, "", "menu\nmenu"]
    sources = ["a"] * 10 + ["b", None] + ["a", "a", "a"]
    docs = table(spark, texts, sources)
    rows = {row.doc_id: row for row in line_dedup.without_boilerplate(docs).collect()}
    assert rows[3].text == "text 3\n" and rows[3].n_chars == 7
    assert rows[10].text == "menu\nother" and rows[11].text == "menu\nother"
    assert rows[12].text is None and rows[13].text == "" and rows[14].text == ""
    assert rows[10].n_chars is None  # untouched
    assert line_dedup.without_boilerplate(docs).columns == docs.columns
    assert line_dedup.without_boilerplate(docs.limit(0)).count() == 0


def test_line_needs_a_share_and_a_number_of_pages(spark):
    few = table(spark, ["menu\nx"] * 4)
    assert all(row.text == "menu\nx" for row in line_dedup.without_boilerplate(few).collect())
    rare = table(spark, ["menu"] * 5 + [f"t{k}" for k in range(95)])
    assert line_dedup.boilerplate(rare).count() == 0
    assert line_dedup.boilerplate(rare, percent=4).count() == 1


def shares(sizes, weights):
    """Targets by sharing again and again."""
    target, free, left = {}, set(sizes), sum(sizes.values())
    while True:
        whole = sum(weights[s] for s in free)
        share = {s: left * weights[s] / whole for s in free} if whole else {}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = 3 * sizes[s]
            left -= 3 * sizes[s]
        free -= over


@pytest.mark.parametrize("words", [[1000, 10, 500, 30], [5, 5, 5, 5000], [0, 7, 0, 9], [2000, 2000, 2000, 2000]])
def test_targets(spark, words):
    names = ["a", "é", "中", None]
    docs = table(spark, ["w " * n for n in words], names)
    found = mixing.targets(mixing.sized(docs)).collect()
    assert [row.source for row in sorted(found, key=lambda row: row.sid)] == names
    expected = shares(dict(zip(names, words)), dict(zip(names, [5, 2, 1, 5])))
    for row in found:
        assert row.target == pytest.approx(expected[row.source])


def test_mix_meets_targets(spark):
    texts = [" ".join(["w"] * (k % 50)) for k in range(600)] + ["w " * 4000, None]
    sources = [["a", "b", "c", None][k % 4] if k % 3 else "a" for k in range(602)]
    docs = table(spark, texts, sources)
    rows = mixing.mix(docs).collect()
    assert len(rows) == 602
    again = mixing.mix(docs.repartition(7)).collect()
    key = lambda row: (row.doc_id, row.taken)
    assert sorted(map(key, rows)) == sorted(map(key, again))
    taken = Counter()
    for row in rows:
        assert 0 <= row.taken <= 3 * row["size"]
        taken[row.source] += row.taken
    for row in rows:
        assert abs(taken[row.source] - row.target) <= max(0.02 * row.target, 5)


def test_mixed_documents(spark):
    texts = [" ".join(["w"] * 20) + f" {k}" for k in range(40)]
    docs = table(spark, texts + [None] + texts[:1] * 3, ["a"] * 10 + ["b"] * 33 + [None])
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    copies = Counter(row.doc_id for row in mixed.collect())
    assert copies[40] == 1 and max(copies.values()) <= 3
    assert mixing.mixed_documents(docs.limit(0)).count() == 0


def test_schedule_is_even(spark):
    docs = table(spark, ["w " * 1000] * 4, ["a", "b", "c", "d"])
    slots = mixing.schedule(mixing.blocks_of(mixing.targets(mixing.sized(docs)))).collect()
    first = Counter(row.sid for row in slots if row.slot < 1000)
    whole = Counter(row.sid for row in slots)
    for sid, n in whole.items():
        assert abs(first[sid] / 1000 - n / len(slots)) < 0.02
    ranks = sorted(row["rank"] for row in slots if row.sid == 1)
    assert ranks == list(range(len(ranks)))
