"""JSON rewriting and scanning against a recursive walk of the parsed document."""

from __future__ import annotations

import json
import random

from pyspark.sql import functions as F

from metaferry.functions import jsondoc, rename, truth
from metaferry.operators.documents import rewrite_documents
from tests.test_rename import expected

PAIRS = [("PROD_DB", "DEV_DB"), ("tab", "x\"y\\z\n"), ("é", "E")]


def rewrite(value):
    if isinstance(value, str):
        return expected(value, PAIRS)
    if isinstance(value, list):
        return [rewrite(v) for v in value]
    if isinstance(value, dict):
        return {k: rewrite(v) for k, v in value.items()}
    return value


def changed(value) -> int:
    if isinstance(value, str):
        return int(expected(value, PAIRS) != value)
    if isinstance(value, list):
        return sum(changed(v) for v in value)
    if isinstance(value, dict):
        return sum(changed(v) for v in value.values())
    return 0


def uids(value, found):
    if isinstance(value, list):
        for v in value:
            uids(v, found)
    elif isinstance(value, dict):
        for k, v in value.items():
            if isinstance(v, str) and v.strip() and ("uid" in k.lower() or k == "backingAssetId"):
                found.add(v.strip())
            uids(v, found)
    return found


def random_value(rng: random.Random, depth: int):
    words = ["PROD_DB", "PROD_DB_X", "tab", "é", "\tPROD_DB\n", 'q"uid":"v"', "\\PROD_DB", "a:b", "", "  u ", "😀", "{", "]", "uid"]
    kind = rng.random()
    if depth == 0 or kind < 0.45:
        return rng.choice([*words, rng.choice(words) + rng.choice(words), 1, -2.5, True, None])
    if kind < 0.7:
        return [random_value(rng, depth - 1) for _ in range(rng.randint(0, 4))]
    keys = ["uid", "assetUid", "GUID", "backingAssetId", "PROD_DB", 'k"', "plain", "u\tid"]
    return {rng.choice(keys): random_value(rng, depth - 1) for _ in range(rng.randint(0, 4))}


def documents():
    rng = random.Random(5)
    for n in range(300):
        value = random_value(rng, 5)
        style = n % 4
        yield value, json.dumps(
            value,
            ensure_ascii=style == 0,
            indent=2 if style == 1 else None,
            separators=(",", ":") if style == 2 else ((" , ", " : ") if style == 3 else None),
        )


def test_rewrite_and_scan(spark):
    cases = list(documents())
    df = spark.createDataFrame([(n, text) for n, (_, text) in enumerate(cases)], "n int, d string")
    got = df.select(
        "n",
        jsondoc.rewrite_strings(F.col("d"), PAIRS).alias("plain"),
        jsondoc.rewrite_strings(F.col("d"), PAIRS, compact=True).alias("compact"),
        F.array_join(jsondoc.tokens(F.col("d")), "").alias("same"),
        jsondoc.find_uids(F.col("d")).alias("uids"),
    ).collect()
    for row in got:
        value, text = cases[row.n]
        assert row.same == text
        assert json.loads(row.plain.text) == rewrite(value)
        assert json.loads(row.compact.text) == rewrite(value)
        assert row.plain.changes == row.compact.changes == changed(value)
        assert set(row.uids or []) == uids(value, set())
        if not changed(value):
            assert row.plain.text == text


def test_compact_has_no_white_space(spark):
    text = '{ "a" : [ 1 , "x y" ] ,\n "b" : { } }'
    df = spark.createDataFrame([(text,)], "d string")
    assert df.select(jsondoc.rewrite_strings(F.col("d"), None, compact=True)["text"]).first()[0] == '{"a":[1,"x y"],"b":{}}'


def test_long_escaped_text(spark):
    value = {"uid": '\\"\n' * 60000 + " PROD_DB"}
    df = spark.createDataFrame([(json.dumps(value),)], "d string")
    row = df.select(jsondoc.rewrite_strings(F.col("d"), PAIRS).alias("r")).first()
    assert json.loads(row.r.text) == rewrite(value)


def test_json_problems(spark):
    texts = ["", " ", "{", "[1]", '"x"', "{}", '{"a":1}', None]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, d string")
    got = [r[0] for r in df.orderBy("n").select(jsondoc.json_problem(F.col("d"))).collect()]
    assert got == ["blank", "blank", "invalid_json", "not_an_object", "not_an_object", "empty_object", None, "blank"]


def test_truth_and_equality(spark):
    values = [None, False, True, 0, 1, 1.0, 2, "", "x", "false", [], [0], {}, {"b": 1, "a": 2}, {"a": 2, "b": 1}, 1.5]
    df = spark.createDataFrame([(n, json.dumps(v)) for n, v in enumerate(values)], "n int, j string")
    text = df.select("n", jsondoc.json_text(F.parse_json("j")).alias("t")).cache()
    flags = [r[0] for r in text.orderBy("n").select(truth.is_set(F.col("t"))).collect()]
    assert flags == [bool(v) for v in values]
    pairs = text.alias("a").crossJoin(text.alias("b")).select(
        F.col("a.n"), F.col("b.n"), truth.same_value(F.col("a.t"), F.col("b.t"))
    )
    for a, b, same in pairs.collect():
        assert same == (values[a] == values[b]), (values[a], values[b])


def test_repeated_keys_are_valid_json(spark):
    text = '{"uid":"PROD_DB","uid":"PROD_DB.x"}'
    df = spark.createDataFrame([(text, "m")], "text string, member string")
    row = rewrite_documents(df, PAIRS).first()
    assert (row.text, row.status, row.changes) == ('{"uid":"DEV_DB","uid":"DEV_DB.x"}', "rewritten", 2)


def test_texts_that_are_not_json_stay(spark, rows):
    texts = ['{"a":"PROD_DB"} x', '{"a":"PROD_DB"', "PROD_DB", '["PROD_DB",]', ""]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    done = rewrite_documents(df, PAIRS)
    assert sorted(r.text for r in done.collect()) == sorted(texts)
    assert {r.status for r in done.collect()} == {"error"}


def test_single_words_behind_escapes(spark):
    rng = random.Random(11)
    pairs = [("n", "N\n\x1f\"\\"), ("the", "and"), ("and", "\x01"), ("bé", "$0\\u"), ("u", ""), ("nthe", "x"), ("𠮷", "é")]
    pieces = ["n", "the", "and", "bé", "u", "t", "𠮷", "\n", "\\", '"', "\t", "\b", "/", "\x01", "\x1f", "\x7f", "é", "_", " ", " ", ".", "\\n", " "]
    values = ["".join(rng.choices(pieces, k=rng.randint(0, 12))) for _ in range(900)]
    texts = [json.dumps({"the": value, "list": [value, "x"]}, ensure_ascii=k % 3 == 0) for k, value in enumerate(values)]
    texts = [text.replace("/", "\\/") if k % 5 == 0 else text for k, text in enumerate(texts)]
    df = spark.createDataFrame([(n, value, text) for n, (value, text) in enumerate(zip(values, texts))], "n int, v string, d string")
    encoded = F.to_json(F.array(rename.rename_words(F.col("v"), pairs)))
    got = df.select("n", jsondoc.rewrite_strings(F.col("d"), pairs).alias("r"), encoded.alias("e")).collect()
    for row in got:
        new = expected(values[row.n], pairs)
        assert json.loads(row.e) == [new]
        assert json.loads(row.r.text) == {"the": new, "list": [new, "x"]}
        assert row.r.changes == 2 * (new != values[row.n])
        # A changed value is written as Spark writes it, whatever it looked like before.
        assert row.r.text == texts[row.n] if new == values[row.n] else row.e[1:-1] in row.r.text
