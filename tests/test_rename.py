"""Whole-word renames, against a direct Python statement of the rules."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from metaferry.functions import rename


def expected(value: str, pairs) -> str:
    """Spans of the value that words take, an earlier pair first; a taken span counts as letters."""
    free, spans = value, []
    for source, target in dict(pairs).items():
        found = [m.span() for m in re.finditer(rf"\b{re.escape(source)}\b", free)] if source != target else []
        spans += [(start, end, target) for start, end in found]
        for start, end in found:
            free = free[:start] + "\ua66e" * (end - start) + free[end:]
    parts, at = [], 0
    for start, end, target in sorted(spans):
        parts += [value[at:start], target]
        at = end
    return "".join([*parts, value[at:]])


def run(spark, values, column):
    df = spark.createDataFrame(list(enumerate(values)), "n int, v string")
    return [r[0] for r in df.select("n", column.alias("r")).orderBy("n").select("r").collect()]


CASES = [
    ("PROD_DB.users", [("PROD_DB", "DEV_DB")], "DEV_DB.users"),
    ("PROD_DB_X PROD_DB xPROD_DB", [("PROD_DB", "DEV_DB")], "PROD_DB_X DEV_DB xPROD_DB"),
    ("A", [("A", "B"), ("B", "C")], "B"),
    ("A.B.C", [("B.C", "x"), ("A.B", "y")], "A.x"),
    ("éPROD PROD", [("PROD", "DEV")], "éPROD DEV"),
    ("a PROD b", [("PROD", "$1\\x")], "a $1\\x b"),
    ("a.b axb", [("a.b", "z")], "z axb"),
    ("same", [("same", "same")], "same"),
    ("x-y -y", [("-y", "Q")], "xQ -y"),
    ("n 0 1", [("n", "0"), ("0", "1")], "0 1 1"),
    ("", [("a", "b")], ""),
]


@pytest.mark.parametrize("value,pairs,wanted", CASES)
def test_atomic(spark, value, pairs, wanted):
    assert expected(value, pairs) == wanted
    assert run(spark, [value], rename.rename_words(F.col("v"), pairs)) == [wanted]


def test_null_stays_null(spark):
    assert run(spark, [None], rename.rename_words(F.col("v"), [("a", "b")])) == [None]


def test_empty_source_is_refused():
    with pytest.raises(ValueError):
        rename.as_pairs([("", "x")])


def test_random_values(spark):
    dice = random.Random(7)
    pieces = ["A", "B", "AB", "A_B", ".", " ", "-", "é", "1", "_", "日", "A.B", "B.C", "C"]
    sources = ["A", "B", "C", "A.B", "B.C", "-A", "é"]
    texts = ["".join(dice.choices(pieces, k=dice.randrange(13))) for _ in range(120)]
    for _ in range(25):
        pairs = [(dice.choice(sources), dice.choice(pieces)) for _ in range(dice.randrange(5))]
        got = run(spark, texts, rename.rename_words(F.col("v"), pairs))
        assert got == [expected(t, pairs) for t in texts]


def test_in_turn_cascades_with_literal_targets(spark):
    pairs = [("A", "B"), ("B", "$0")]
    assert run(spark, ["A B AB"], rename.rename_words_in_turn(F.col("v"), pairs)) == ["$0 $0 AB"]


def test_columns_and_target_uid(spark, rows):
    df = spark.createDataFrame(
        [("PROD_DB.a", "id1", "PROD_DB.table1", "PROD_DB:x", 7)],
        "source_uid string, source_id string, target_uid string, tags string, n int",
    )
    pairs = {"PROD_DB": "DEV_DB"}
    assert rows(rename.rename_columns(df, pairs)) == [("PROD_DB.a", "id1", "DEV_DB.table1", "DEV_DB:x", 7)]
    assert rows(rename.rename_target_uid(df, pairs)) == [("PROD_DB.a", "id1", "DEV_DB.table1", "PROD_DB:x", 7)]


def test_long_lists(spark):
    pairs = [(f"w{n}", f"w{n + 1}") for n in range(400)] + [("a.b", "$1"), ("é", "w3")]
    values = ["w1 w399 xw5 w5x w12", "a.b.w7 é", "none", " ".join(f"w{n}" for n in range(400))]
    assert run(spark, values, rename.rename_words(F.col("v"), pairs)) == [expected(v, pairs) for v in values]
    assert run(spark, values, rename.renames_used(F.col("v"), pairs)) == [3, 3, 0, 400]


@pytest.mark.parametrize("n", [1, 39, 40, 41, 60, 1000])
def test_any_number_of_pairs(spark, n):
    dice = random.Random(n)
    words = [f"{letter}{k}" for k in range(60) for letter in "abcdefghijklmnopqrs"]
    sources = [dice.choice(["{0}", "{0}", "{0}.{1}", "-{0}", "{0} {1} {0}"]).format(*dice.sample(words, 2)) for _ in range(2 * n)]
    pairs = [(source, dice.choice([*words, "$1", ""])) for source in dict.fromkeys(sources)][:n]
    texts = ["".join(dice.choice([*words[:40], dice.choice(pairs)[0]]) + dice.choice([" ", ".", "-", "\n"]) for _ in range(60)) for _ in range(20)]
    assert run(spark, texts, rename.rename_words(F.col("v"), pairs)) == [expected(text, pairs) for text in texts]


def test_renames_used_counts_pairs(spark):
    pairs = [("A", "B"), ("B", "C"), ("Q", "R")]
    assert run(spark, ["A.B", "A", "x"], rename.renames_used(F.col("v"), pairs)) == [2, 1, 0]


def test_a_text_is_cut_only_at_source_words(spark):
    values = ["the cat and the dog", "then", "", "the", "a\x01the\x01\x01"]
    got = run(spark, values, rename.cut_at(F.col("v"), ["the", "and", "t"]))
    assert got == [["", "the", " cat ", "and", " ", "the", " dog"], ["then"], [""], ["", "the", ""], ["a", "", "", "the", "", "", "", "", ""]]


def test_nested_words_of_any_length(spark):
    words = ["a" * n for n in range(1, 300)] + [chr(0x4E00 + n) for n in range(500)]
    pairs = [(word, f"<{len(word)}{word[0]}>") for word in words]
    values = [" ".join(words), "a" * 300, "b" + "a" * 7 + "-aa_ aa"]
    assert run(spark, values, rename.rename_words(F.col("v"), pairs)) == [expected(v, pairs) for v in values]
