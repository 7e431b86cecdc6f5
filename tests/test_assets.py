"""Inventories, mappings, pages and tags on literal rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from metaferry.operators import inventory, tags
from metaferry.plans import assets as jobs

SOURCE = "source_uid string, source_id string, target_uid string, tags string, asset_type string"


def test_transform_and_merge(spark, rows):
    source = spark.createDataFrame(
        [
            ("asset-1", "1", "Lake", "tag1:tag2", "TABLE"),
            ("asset-2", "2", "LAKE_SAMPLE_DATA", "tag3", "TABLE"),
            ("asset-3", "3", "OTHER_DATA", "tag4", "SQL_VIEW"),
        ],
        SOURCE,
    )
    target = spark.createDataFrame(
        [("lake_test", "100", 1), ("lake_test", "101", 2), ("CAMPUS", "102", 3), ("CAMPUS", "99", 0)],
        "source_uid string, source_id string, ordinal long",
    )
    renames = {"Lake": "lake_test", "LAKE_SAMPLE_DATA": "CAMPUS"}
    job = jobs.transform_and_merge(source, target, renames)
    assert rows(job.merged) == [
        ("1", "asset-1", "101", "lake_test", "tag1:tag2", "TABLE"),
        ("2", "asset-2", "102", "CAMPUS", "tag3", "TABLE"),
    ]
    assert rows(job.unmatched_views, "source_uid") == [("asset-3",)]
    assert rows(job.coverage) == [(3, 2, 2, 1, 66.666667)]


def test_merge_without_renames_matches_directly(spark, rows):
    source = spark.createDataFrame([("a", "1", "x", "", "TABLE"), ("b", "2", None, "", "TABLE")], SOURCE)
    target = spark.createDataFrame([("x", "7", 0)], "source_uid string, source_id string, ordinal long")
    assert rows(inventory.merge_assets(source, target, None), "source_id", "target_id") == [("1", "7")]


def test_migrated_assets(spark, rows):
    mapping = spark.createDataFrame(
        [
            (" 1 ", "s1", "11", "t1", "tag", None),
            ("2", "s2", "12", "t2", "", " Table "),
            ("3", "s3", "13", "t3", "", "COLUMN"),
            ("", "s4", "14", "t4", "tag", "TABLE"),
            ("5", "s5", "15", " ", "tag", "TABLE"),
            ("6", "s6", "16", "t6", None, None),
        ],
        "source_id string, source_uid string, target_id string, target_uid string, tags string, source_asset_type string",
    )
    assert rows(inventory.migrated_assets(mapping), "source_id") == [("1",), ("2",)]


@pytest.mark.parametrize("text,wanted", [(None, None), ("", None), ("None", None), ("null", None), ("1, 2,", ["1", "2"])])
def test_id_list(text, wanted):
    assert inventory.id_list(text) == wanted


def test_asset_inventory_from_pages(spark, rows):
    pages = spark.createDataFrame(
        [
            (0, '{"assets":[{"assetId":2,"assetUid":"b","assetTypeId":5},{"assetId":10,"assetUid":"a","assetTypeId":5,'
                '"tags":[{"name":"kept-first","autoTagged":false},{"name":"auto","autoTagged":true},{"name":"kept-second"}]}]}'),
            (1, '{"items":[{"assetId":2,"assetUid":"late","assetTypeId":5},{"assetId":9,"assetUid":"a","assetTypeId":5},'
                '{"assetId":3,"assetUid":"z","assetTypeId":6}]}'),
            (2, '{"message":"down"}'),
        ],
        "page long, body string",
    )
    job = jobs.asset_inventory(pages, asset_types="5", assembly_ids="None")
    got = [tuple(r) for r in job.assets.select("source_uid", "source_id", "tags").collect()]
    assert got == [("a", 9, ""), ("a", 10, "kept-first:kept-second"), ("b", 2, "")]
    assert rows(job.duplicates, "source_uid", "source_id") == [("late", 2)]
    assert rows(job.pages) == [(3, 1)]


def test_tag_rows_of_each_layout(spark, rows):
    merged = spark.createDataFrame(
        [("id1", "s1", "t1", "u1", "tag1:tag2"), ("id3", "s3", "t3", "u3", ""), ("id4", "s4", "t4", "u4", " tag4:tag5 ::tag6")],
        "source_id string, source_uid string, target_id string, target_uid string, tags string",
    )
    found = tags.tag_rows(merged)
    assert rows(found, "source_id", F.size("tags")) == [("id1", 2), ("id4", 3)]
    ready = merged.withColumn("error", F.when(F.col("source_id") == "id1", "boom").otherwise(" "))
    assert rows(tags.tag_rows(ready), "source_id") == [("id4",)]
    moved = spark.createDataFrame(
        [("T", " 5 ", "x", "A", "S", "1"), ("T", "", "x", "A", "S", "1"), (" ", "5", "x", "A", "S", "1")],
        "Source_Tag_Name string, Target_Asset_ID string, Target_Asset_UID string, Asset_Type string, source_Asset_UID string, "
        "source_Asset_ID string",
    )
    assert rows(tags.tag_rows(moved), "target_asset_id", "tags") == [("5", ["T"])]
    with pytest.raises(ValueError):
        tags.tag_rows(merged.select("tags"))


def test_tag_plan_marks_unknown_assets(spark, rows):
    merged = spark.createDataFrame([("i", "s", "t", "u1", "a:b"), ("j", "s", "t", "u2", "c")],
        "source_id string, source_uid string, target_id string, target_uid string, tags string")
    target = spark.createDataFrame([("u1", 8, "TABLE", 1), ("u1", 9, "VIEW", 2)], "source_uid string, source_id long, asset_type string, ordinal long")
    assert rows(jobs.tag_plan(merged, target), "target_asset_id", "tag", "status") == [
        ("8", "a", "ready"), ("8", "b", "ready"), (None, "c", "asset_not_found")
    ]


def test_response_outcome(spark):
    df = spark.createDataFrame(
        [
            (0, "Tag Already assigned", None, None, None),
            (1, "ok", "already_exists", None, None),
            (2, None, None, 409, None),
            (3, "ok", None, 200, None),
            (4, None, None, None, "409 Client Error"),
            (5, None, None, None, "Conflict"),
            (6, "already", None, None, "timeout"),
        ],
        "n int, message string, status string, code int, error string",
    )
    outcome = tags.response_outcome(*[F.col(c) for c in ("message", "status", "code", "error")])
    got = [r[0] for r in df.orderBy("n").select(outcome).collect()]
    assert got == ["already_exists"] * 3 + ["imported"] + ["already_exists"] * 2 + ["failed"]


def test_rule_tags(spark, rows):
    df = spark.createDataFrame(
        [("1", ["a", None, "b"]), ("x", ["a"]), ("3", [""]), ("4", None), ("5", ["b"])], "rule_id string, names array<string>"
    ).select("rule_id", F.transform("names", lambda n: F.struct(n.alias("name"))).alias("rule_tags"))
    assert rows(tags.rule_tags(df)) == [(1, "a,b"), (5, "b")]
    assert [tuple(r) for r in tags.tag_frequency(df, 1).collect()] == [("a", 2, 40.0)]
    assert rows(tags.tag_coverage(df)) == [(5, 3, 2, 4, 80.0)]
