"""Values that ordinary data does not hold: large, mixed, repeated, broken."""

from __future__ import annotations

import zipfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from metaferry.functions.jsondoc import is_json
from metaferry.functions.truth import same_value
from metaferry.operators import config, documents, imports, inventory, joins, notify, ranking
from metaferry.sources import bundles, staging


@pytest.mark.parametrize("kind", ["tinyint", "smallint", "int", "bigint"])
def test_narrow_and_negative_ordinals(spark, rows, kind):
    df = spark.range(200).select((F.col("id") % 3).alias("g"), (F.col("id") - 100).cast(kind).alias("o"))
    placed = ranking.positions(df, "g", "o")
    assert placed.count() == 200
    assert rows(placed.groupBy("g").agg(F.max("position"))) == [(0, 66), (1, 66), (2, 65)]
    kept, _ = ranking.resolve_duplicates(df, "g", "o", default="last")
    assert kept.count() == 3


@pytest.mark.parametrize("kind", ["int", "double", "float", "decimal(20,2)", "string", "smallint"])
def test_join_of_unlike_keys(spark, rows, kind):
    ids = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "d")], "k long, x string")
    other = spark.createDataFrame([("1", 10), ("3", 30), ("7", 70), (None, 0)], "k string, y int").select(
        F.col("k").cast(kind).alias("k"), "y"
    )
    assert rows(joins.hot_join(ids, other, "k"), "x", "y") == [("a", 10), ("c", 30)]
    assert rows(joins.hot_join(other, ids, "k"), "x", "y") == [("a", 10), ("c", 30)]
    assert rows(joins.absent(ids, other, "k"), "x") == [("b",), ("d",)]
    assert dict(joins.hot_join(other, ids, "k").dtypes)["k"] == kind


def test_join_keeps_fractions_apart(spark):
    whole = spark.createDataFrame([(1,), (2,)], "k long")
    parts = spark.createDataFrame([(Decimal("1.50"),), (Decimal("2.00"),)], "k decimal(20,2)")
    assert [row.k for row in joins.present(whole, parts, "k").collect()] == [2]


def test_archives_of_one_name_stay_apart(spark, tmp_path, rows):
    for folder, content in (("a", "1"), ("b", "2")):
        (tmp_path / folder).mkdir()
        with zipfile.ZipFile(tmp_path / folder / "p.zip", "w") as archive:
            archive.writestr("m.json", content)
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "p.zip").write_bytes(b"no archive")
    members = bundles.read_bundles(spark, str(tmp_path))
    assert rows(bundles.usable_bundles(members)) == [("a/p.zip", 1), ("b/p.zip", 1)]


def test_archive_beyond_the_limit_is_an_error_row(spark, tmp_path, monkeypatch, rows):
    with zipfile.ZipFile(tmp_path / "p.zip", "w") as archive:
        archive.writestr("m.json", "1")
    monkeypatch.setattr(bundles, "LARGEST_ARCHIVE", 10)
    found = bundles.read_bundles(spark, f"file://{tmp_path}")
    assert rows(found.select("bundle", "member", F.col("error").contains("too large"))) == [("p.zip", None, True)]


JSON = {
    "{}": True, "[1, 2]": True, " null ": True, '"x"': True, '{"a": 1, "a": 2}': True, "3": True,
    "": False, " ": False, "{": False, '{"uid":"x"': False, "1, 2": False, "{} x": False, "1} {": False, "x": False, '{"a": nul}': False,
}


def test_is_json(spark):
    df = spark.createDataFrame([(text,) for text in JSON] + [(None,)], "t string")
    assert {row.t: row.v for row in df.select("t", is_json(F.col("t")).alias("v")).collect()} == {**JSON, None: None}


def test_long_values_and_repeated_keys_are_rewritten_in_any_session(spark):
    long = spark.range(1).select(
        F.concat(F.lit('{"k": "OLD_DB", "k": "'), F.repeat(F.lit("x"), 25_000_000), F.lit('"}')).alias("text")
    )
    setting = "spark.sql.variant.allowDuplicateKeys"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        row = documents.rewrite_documents(long, {"OLD_DB": "NEW"}).select("status", "changes", F.left("text", F.lit(12))).first()
    finally:
        spark.conf.set(setting, before)
    assert tuple(row) == ("rewritten", 1, '{"k": "NEW",')


def test_broken_texts_mention_no_uids(spark, rows):
    df = spark.createDataFrame([('{"uid":"x"',), ('{"uid":"y"}',)], "text string")
    assert rows(documents.document_uids(df)) == [("y",)]


def test_numbers_compare_exactly(spark):
    pairs = [("9007199254740993", "9007199254740992", False), ("1", "1.0", True), ("2", "2", True), ("1", "true", True), ("7", "8", False)]
    df = spark.createDataFrame(pairs, "a string, b string, same boolean")
    assert df.filter(same_value(F.col("a"), F.col("b")) != F.col("same")).count() == 0


def test_all_counters_and_fractions(spark):
    body = "{" + ",".join(f'"{name}": {k}.0' for k, name in enumerate(imports.COUNTERS)) + "}"
    uploads = spark.createDataFrame([("f", "u", body, True), ("g", "v", '{"preChecks": "n/a", "totalPolicyCount": 2}', True)], "file string, uuid string, response string, applied boolean")
    row = imports.import_statistics(uploads).first().asDict()
    for k, name in enumerate(imports.COUNTERS):
        assert row[name] == k + 2 * (name == "totalPolicyCount")


def test_repeated_and_null_child_ids(spark):
    children = spark.createDataFrame(
        [(1, [(7, "old"), (None, "none"), (8, "x"), (7, "new")])], "asset_id long, child_assets array<struct<asset_id: long, uid: string>>"
    )
    mapping = spark.createDataFrame([("1", "1")], "source_id string, target_id string")
    assert inventory.child_maps(mapping, children, children).first().source_children == {7: "new", 8: "x"}


def test_repeated_mapping_and_text_ids(spark):
    mapping = spark.createDataFrame(
        [("5", "10", "Mapped", 0), ("5", "11", "Mapped", 1)],
        "source_notification_id string, target_notification_id string, mapping_status string, ordinal long",
    )
    usable = notify.usable_mapping(mapping)
    assert [tuple(row) for row in usable.collect()] == [(5, 11)]
    body = '{"profileSettingsConfigs":{"profileNotificationChannels":{"configuredNotificationGroupIds":["x", 5]}}}'
    configs = spark.createDataFrame([("t", body)], "target_uid string, profile_json string")
    assert config.map_notification_ids(configs, usable).first().mapped_ids == [11]


def test_no_local_folder_on_a_cluster(spark, monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return "spark://host:1" if key == "spark.master" else default

    class Session:
        conf = Conf()

    with pytest.raises(ValueError):
        staging.staging_folder(Session())
    assert staging.staging_folder(spark)
