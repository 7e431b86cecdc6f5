"""Policies, batches, versions and bundles on literal rows and real archives."""

from __future__ import annotations

import json
import zipfile

import pytest
from pyspark.sql import functions as F

from metaferry.functions.text import slug
from metaferry.operators import policy, sqlrefs
from metaferry.plans import policies as jobs
from metaferry.sources import bundles, sinks


@pytest.fixture(scope="module")
def inputs(spark):
    policies = spark.createDataFrame(
        [
            (1, "DATA_QUALITY", "SPARK", "SQL", "p1", True),
            (2, None, "JDBC_SQL", None, "p2", True),
            (3, "EQUALITY", "SPARK", "", "p3", False),
            (4, "EQUALITY", "OTHER", "", "p4", True),
        ],
        "id long, type string, engine_type string, sub_type string, name string, is_segmented boolean",
    ).withColumn("status", F.lit("ENABLED"))
    backing = spark.createDataFrame(
        [(1, 0, 102), (1, 1, 101), (1, 2, 102), (2, 0, 103), (2, 1, 0), (3, 0, 999)],
        "policy_id long, position int, table_asset_id long",
    )
    assets = spark.createDataFrame(
        [(101, 201, "TABLE"), (102, 202, "SQL_VIEW"), (103, 0, "VIEW")], "id long, assembly_id long, asset_type string"
    )
    assemblies = spark.createDataFrame(
        [(201, "Assembly 1", "PostgreSQL"), (202, "Assembly 2", "MySQL")], "id long, name string, source_type string"
    )
    return policies, backing, assets, assemblies


LIST = [
    (1, "DATA_QUALITY", "SPARK", "102,101,102", "201,202", "Assembly 1,Assembly 2", "MySQL,PostgreSQL", "SQL", "p1",
     "SQL_VIEW,TABLE,SQL_VIEW"),
    (2, "", "JDBC_SQL", "103", "", "", "", "", "p2", "VIEW"),
    (3, "EQUALITY", "SPARK", "999", "", "", "", "", "p3", ""),
    (4, "EQUALITY", "OTHER", "", "", "", "", "", "p4", ""),
]


def test_policy_list(inputs):
    assert [tuple(r) for r in policy.order_by_id(policy.policy_list(*inputs)).collect()] == LIST
    assert policy.policy_list(*inputs).columns[:10] == list(policy.POLICY_LIST_COLUMNS)


def test_policy_assets(inputs, rows):
    _, backing, assets, _ = inputs
    found = rows(policy.policy_assets(backing, assets).filter("policy_id = 1"), "position", "table_asset_id", "asset_type")
    assert [(asset, kind) for _, asset, kind in found] == [(102, "SQL_VIEW"), (101, "TABLE"), (102, "SQL_VIEW")]


def test_inventory_job(spark, inputs, rows):
    known = spark.createDataFrame([(101,)], "table_asset_id long")
    views = spark.createDataFrame([(103, "uid103")], "source_id long, source_uid string")
    job = jobs.policy_inventory(*inputs, known_ids=known)
    assert [r.id for r in job.policies.collect()] == [1, 4]
    job = jobs.policy_inventory(*inputs, known_ids=known, view_assets=views)
    assert [r.id for r in job.policies.collect()] == [1, 2, 4]
    assert rows(job.view_hits) == [(103, "uid103", 2, "p2")]
    assert [r.id for r in job.sql_policies.collect()] == [1]
    assert [r.id for r in job.view_policies.collect()] == [1]
    assert rows(job.types) == [("DATA_QUALITY", 1, 33.333333), ("EQUALITY", 1, 33.333333), ("UNKNOWN", 1, 33.333333)]
    assert rows(job.assemblies) == [("Assembly 1", 1, 33.333333), ("Assembly 2", 2, 66.666667)]
    assert rows(job.sql_counts) == [(1, 2)]


@pytest.mark.parametrize(
    "export_type,only,wanted",
    [
        (None, None, {"DATA_QUALITY": [1], "EQUALITY": [3, 4]}),
        ("rule-types", "EQUALITY", {"EQUALITY": [3, 4]}),
        ("engine-types", None, {"SPARK": [1, 3], "JDBC_SQL": [2], "OTHER": [4]}),
        ("assemblies", None, {"Assembly 1": [1]}),
        ("source-types", None, {"MySQL": [1]}),
    ],
)
def test_categories(inputs, export_type, only, wanted):
    got: dict = {}
    for r in policy.categorised(policy.policy_list(*inputs), export_type, only).orderBy("id").collect():
        got.setdefault(r.category, []).append(r.id)
    assert got == wanted


def test_batches(spark, rows):
    df = spark.range(105).select("id", F.lit("DATA (quality)").alias("type"), F.col("id").alias("ordinal")).unionByName(
        spark.range(200, 203).select("id", F.lit("EQUALITY").alias("type"), F.col("id").alias("ordinal"))
    )
    job = jobs.policy_batches(df, "01-02-2025-03-04")
    assert rows(job.manifest, "category", "first_position", "last_position", "policies", "file_name") == [
        ("DATA (quality)", 0, 49, 50, "data_quality-01-02-2025-03-04-0-49.zip"),
        ("DATA (quality)", 100, 104, 5, "data_quality-01-02-2025-03-04-100-104.zip"),
        ("DATA (quality)", 50, 99, 50, "data_quality-01-02-2025-03-04-50-99.zip"),
        ("EQUALITY", 0, 1, 2, "equality-01-02-2025-03-04-0-1.zip"),
        ("EQUALITY", 2, 2, 1, "equality-01-02-2025-03-04-2-2.zip"),
    ]
    assert rows(job.manifest.filter("category = 'EQUALITY'"), "policy_ids") == [("200,201",), ("202",)]
    assert rows(job.summary) == [("DATA (quality)", 105, 3), ("EQUALITY", 3, 2)]
    custom = jobs.policy_batches(df, "x", sizes={"EQUALITY": 3, "default": 1000}).summary
    assert rows(custom) == [("DATA (quality)", 105, 1), ("EQUALITY", 3, 1)]


def test_slug(spark):
    df = spark.createDataFrame([("My Type-1 (é_x) ! ",), ("A/B",)], "s string")
    assert [r[0] for r in df.select(slug(F.col("s"))).collect()] == ["my_type-1_é_x", "ab"]


def test_prune_versions(spark, rows):
    df = spark.createDataFrame(
        [
            ("SCHEMA_DRIFT", [(1, "a"), (3, "b"), (3, "c"), (None, "d")]),
            ("SCHEMA_DRIFT", [(None, "e")]),
            ("SCHEMA_DRIFT", [(None, "g"), (0, "h")]),
            ("DATA_DRIFT", [(1, "i"), (2, "j")]),
            ("SCHEMA_DRIFT", []),
        ],
        "type string, items array<struct<ruleVersion: int, name: string>>",
    )
    pruned = policy.prune_versions(df)
    assert rows(pruned, F.transform("items", lambda i: i["name"])) == [(["b"],), (["e"],), (["g"],), (["i", "j"],), ([],)]
    assert rows(policy.version_counts(df, pruned)) == [(5, 4)]


POLICIES = [
    {"name": "seg_spark", "isSegmented": True, "engineType": "SPARK", "backingAssets": [{"uid": "PROD_DB.a"}, {"uid": "PROD_DB.b"}]},
    {"name": "seg_jdbc", "isSegmented": True, "engineType": "JDBC_SQL", "backingAssets": [{"uid": "PROD_DB.c"}]},
    {"name": "plain", "isSegmented": False, "engineType": "SPARK", "backingAssets": [{"uid": "PROD_DB.d"}]},
    {"name": "other", "isSegmented": True, "engineType": "FLINK"},
]


@pytest.fixture(scope="module")
def bundle_dir(tmp_path_factory):
    folder = tmp_path_factory.mktemp("bundles")
    (folder / "deep").mkdir()
    with zipfile.ZipFile(folder / "deep" / "one.ZIP", "w") as z:
        z.writestr("data_quality_policy_definitions.json", json.dumps(POLICIES, indent=1))
        z.writestr("readme.txt", b"\xff\x00 PROD_DB")
        z.writestr("latin.json", '{"note":"café PROD_DB"}'.encode("latin-1"))
        z.writestr("broken.json", "{")
    with zipfile.ZipFile(folder / "empty.zip", "w"):
        pass
    (folder / "bad.zip").write_bytes(b"PK not a zip")
    damaged = folder / "damaged.zip"
    with zipfile.ZipFile(damaged, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a.json", "x" * 1000)
        z.writestr("b.json", "{}")
    raw = bytearray(damaged.read_bytes())
    raw[36:44] = b"\xff" * 8
    damaged.write_bytes(bytes(raw))
    (folder / "loose.json").write_text('{"uid": "PROD_DB.loose"}')
    return str(folder)


def test_read_bundles(spark, bundle_dir, rows):
    members = bundles.read_bundles(spark, bundle_dir)
    assert rows(members, "bundle", "member", "kind", F.col("error").isNotNull()) == [
        ("bad.zip", None, "Other/Unknown", True),
        ("damaged.zip", "a.json", "Other/Unknown", True),
        ("damaged.zip", "b.json", "Other/Unknown", False),
        ("deep/one.ZIP", "broken.json", "Other/Unknown", False),
        ("deep/one.ZIP", "data_quality_policy_definitions.json", "Data Quality Policy Definitions", False),
        ("deep/one.ZIP", "latin.json", "Other/Unknown", False),
        ("deep/one.ZIP", "readme.txt", "Other/Unknown", False),
        ("empty.zip", None, "Other/Unknown", True),
    ]
    assert rows(bundles.usable_bundles(members)) == [("deep/one.ZIP", 4)]
    assert rows(members.filter("member = 'latin.json'"), "text") == [('{"note":"café PROD_DB"}',)]
    assert rows(bundles.read_documents(spark, bundle_dir), "text") == [('{"uid": "PROD_DB.loose"}',)]


@pytest.mark.parametrize("staging", [False, True])
def test_bundle_rewrite_job(spark, bundle_dir, rows, tmp_path, monkeypatch, staging):
    monkeypatch.setattr("metaferry.sources.staging.staging_folder", lambda _: str(tmp_path / "staging"))
    members = bundles.read_bundles(spark, bundle_dir).filter("bundle = 'deep/one.ZIP'")
    job = jobs.bundle_rewrite(members, {"PROD_DB": "DEV_DB"}, staging=staging)
    texts = {r.member: r for r in job.members.collect()}
    assert json.loads(texts["data_quality_policy_definitions.json"].text)[0]["backingAssets"][1]["uid"] == "DEV_DB.b"
    assert texts["latin.json"].text == '{"note":"café DEV_DB"}'
    assert (texts["broken.json"].text, texts["broken.json"].status) == ("{", "error")
    assert bytes(texts["readme.txt"].content) == b"\xff\x00 PROD_DB"
    assert rows(job.segmented_uids) == [("PROD_DB.a", "DEV_DB.a"), ("PROD_DB.b", "DEV_DB.b")]
    assert [r.source_env[-1] for r in job.all_uids.collect()] == ["a", "b", "c", "d"]
    # Every JSON member counts: latin.json holds one more object, which is not segmented.
    counts, all_counts = (4, 1, 1, 1), (5, 1, 1, 2)
    found = job.policy_statistics.filter("level <> 'member' OR member LIKE 'data_quality%'")
    assert rows(found) == sorted(
        [("deep/one.ZIP", "data_quality_policy_definitions.json", "member", *counts), ("deep/one.ZIP", None, "bundle", *all_counts),
         (None, None, "total", *all_counts)], key=str,
    )
    assert rows(job.changes) == [(4, 2, 1, 1, 2, 5)]
    assert rows(job.reconciliation) == [("deep/one.ZIP", 4, 3, "count_mismatch")]
    out = str(tmp_path / "out")
    sinks.write_members(job.members, out)
    assert rows(spark.read.parquet(out).groupBy("bundle").count()) == [("deep/one-import-ready", 4)]


def test_custom_sql_diff(spark, rows):
    def members(*policies):
        return spark.createDataFrame(
            [("b.zip", "data_quality_policy_1.json", json.dumps(list(policies))), ("b.zip", "sub/data_quality_policy_2.json", json.dumps(list(policies) * 2))],
            "bundle string, member string, text string",
        ).unionByName(spark.createDataFrame([("b.zip", "other.json", json.dumps(list(policies)))], "bundle string, member string, text string"))

    source = members(
        {"name": " p1 ", "customSqlConfig": {"sqlExpression": "select * from db.s.t join a.b.c.d, db.s.u"}},
        {"name": "p2", "customSqlConfig": [{"sqlExpression": "x.y.z"}, {"sqlExpression": None}, {"other": 1}]},
        {"name": " ", "customSqlConfig": {"sqlExpression": "q.q.q"}},
        {"name": "p3"},
        {"name": 7, "customSqlConfig": {"sqlExpression": "n.n.n"}},
    )
    sink = members(
        {"name": "p1", "customSqlConfig": {"sqlExpression": "from new.s.t, old.s.t, db.s.u"}},
        {"name": "p4", "customSqlConfig": [{"sqlExpression": "k.k.k"}]},
    )
    job = jobs.custom_sql_diff(source, sink)
    assert rows(job.mapping, "policy", "reference", "in_source", "in_sink", "matched", "unchanged") == [
        ("7", "n.n.n", True, False, False, False),
        ("p1", "a.b.c", True, False, False, False),
        ("p1", "db.s.t", True, False, True, False),
        ("p1", "db.s.u", True, True, True, True),
        ("p1", "new.s.t", False, True, True, False),
        ("p1", "old.s.t", False, True, True, False),
        ("p2", "x.y.z", True, False, False, False),
        ("p4", "k.k.k", False, True, False, False),
    ]
    report = ["policy", "source_tables", "sink_tables", "source_tables_matched", "source_tables_without_match", "unchanged_tables"]
    assert rows(job.report, *report) == [
        ("7", 1, 0, 0, 1, 0), ("p1", 3, 3, 2, 1, 1), ("p2", 1, 0, 0, 1, 0), ("p4", 0, 1, 0, 0, 0)
    ]
    assert rows(job.unchanged) == [("p1", "db.s.u")]
    assert rows(spark.createDataFrame([("a.b.c",)], "r string").select(sqlrefs.schema_table(F.col("r")))) == [("b.c",)]


def test_sql_diff_is_linear_in_one_large_key(spark):
    """100,000 references of one schema.table on both sides give as many rows, not their product."""
    names = spark.range(100_000).select(F.lit("p").alias("policy"), F.concat(F.lit("d"), "id", F.lit(".s.t")).alias("reference"))
    mapped = sqlrefs.reference_mapping(names, names.withColumn("reference", F.concat(F.lit("x"), "reference")))
    assert mapped.agg(F.count("*"), F.count_if("matched"), F.count_if("unchanged")).first() == (200_000, 200_000, 0)
