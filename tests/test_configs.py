"""Configurations, verification, notifications, segments and profiling on literal rows."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from metaferry.operators import config, notify, profiling, verify
from metaferry.plans import configs as jobs


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "d string").select(column(F.col("d"))).first()[0]


def test_asset_id_is_set_and_the_rest_kept(spark):
    given = {
        "assetConfiguration": {"assetId": 1, "x": {"deep": [1, None, "é"]}, "freshnessColumnInfo": {"assetId": 1, "c": True}},
        "other": [1.5, "a\"b"],
    }
    got = json.loads(one(spark, lambda d: config.with_asset_id(d, F.lit(77)), json.dumps(given)))
    given["assetConfiguration"]["assetId"] = given["assetConfiguration"]["freshnessColumnInfo"]["assetId"] = 77
    assert got == given
    bare = {"assetConfiguration": {"freshnessColumnInfo": {"c": 1}, "y": None}}
    got = json.loads(one(spark, lambda d: config.with_asset_id(d, F.lit(5)), json.dumps(bare)))
    assert got == {"assetConfiguration": {"assetId": 5, "freshnessColumnInfo": {"c": 1}, "y": None}}


@pytest.mark.parametrize(
    "document,kind",
    [
        ('{"assetConfiguration":{}}', "with_config"),
        ('{"assetConfiguration":null}', "null_config"),
        ('{"a":1}', "missing_field"),
        ('{"assetConfiguration":[1]}', "invalid_format"),
        ("{", "unparsable"),
        ("[1]", "missing_field"),
    ],
)
def test_config_class(spark, document, kind):
    assert one(spark, config.config_class, document) == kind


def test_config_import_job(spark, rows):
    df = spark.createDataFrame(
        [
            ("u1", '{"assetConfiguration":{"a":1}}', 1),
            ("u1", '{"assetConfiguration":{"a":2}}', 2),
            ("u2", '{"assetConfiguration":null}', 3),
            ("u3", '{"assetConfiguration":{}}', 4),
        ],
        "target_uid string, config_json string, ordinal long",
    )
    ids = spark.createDataFrame([("u1", 11), ("u2", 12)], "target_uid string, asset_id long")
    job = jobs.config_import(df, ids, default="last")
    assert rows(job.plan, "target_uid", "status", "payload") == [
        ("u1", "importable", '{"assetConfiguration":{"a":2,"assetId":11}}'),
        ("u2", "skipped", None),
        ("u3", "failed", None),
    ]
    assert rows(job.reasons) == [("assetConfiguration is null (default config)", 1)]
    undecided = jobs.config_import(df, ids, default="error")
    assert rows(undecided.undecided, "target_uid", "option") == [("u1", 1), ("u1", 2)]
    assert rows(undecided.plan, "target_uid") == [("u2",), ("u3",)]


def test_profile_ids_are_mapped_in_order(spark, rows):
    document = json.dumps(
        {"profileSettingsConfigs": {"enabled": True, "profileNotificationChannels": {"x": 1, "configuredNotificationGroupIds": [3, 1, 2, 3]}}}
    )
    df = spark.createDataFrame(
        [("u1", document, 1), ("u2", '{"a":1}', 2), ("u3", "{", 3), (" ", "{}", 4)], "target_uid string, profile_json string, ordinal long"
    )
    ids = spark.createDataFrame([("u1", 11), ("u2", 12), ("u3", 13)], "target_uid string, asset_id long")
    mapping = spark.createDataFrame([(3, 30), (2, 20)], "source_id long, target_id long")
    plan = {r.target_uid: r for r in jobs.profile_import(df, ids, mapping).plan.collect()}
    channels = json.loads(plan["u1"].payload)["profileSettingsConfigs"]["profileNotificationChannels"]
    assert channels == {"x": 1, "configuredNotificationGroupIds": [30, 20, 30]}
    assert plan["u2"].payload == '{"a":1}'
    assert (plan["u3"].status, plan["u3"].reason) == ("failed", "Invalid JSON in profile_json for UID u3")
    unmapped = {r.target_uid: r for r in jobs.profile_import(df, ids, mapping.limit(0)).plan.collect()}
    assert unmapped["u1"].payload == document
    mapped = config.map_notification_ids(df.filter("target_uid = 'u1'"), mapping)
    assert rows(mapped) == [("u1", [30, 20, 30], [1])]


def test_segments(spark, rows):
    documents = [
        ("a", {"assetSegments": {"segments": [{"id": 1, "name": "north", "conditions": [{"id": 2, "columnId": 7, "value": "v"}]}, {"name": "south"}]}}),
        ("b", {"segments": [{"conditions": [{"columnId": "c", "condition": None}]}]}),
        ("c", {"segments": []}),
        ("d", {"assetSegments": {}}),
    ]
    df = spark.createDataFrame([(u, json.dumps(d)) for u, d in documents], "target_uid string, segments_json string")
    assert rows(config.with_segments(df), "target_uid") == [("a",), ("b",)]
    ids = spark.createDataFrame([(u, n) for n, (u, _) in enumerate(documents)], "target_uid string, asset_id long")
    plan = {r.target_uid: r for r in config.segment_import_plan(df, ids).collect()}
    assert json.loads(plan["a"].payload) == [
        {"id": None, "name": "north", "conditions": [{"id": None, "columnId": 7, "condition": "CUSTOM", "value": "v"}]},
        {"id": None, "name": "south", "conditions": []},
    ]
    assert plan["a"].segments == 2
    assert json.loads(plan["b"].payload)[0]["name"] == ""
    assert plan["c"].payload == "[]"
    assert plan["d"].reason == "No segments array"


def test_apply_payload(spark):
    custom = '{"policyOverride":false,"uuid":"wrong","assemblyMap":{"1":2}}'
    got = one(spark, lambda d: config.apply_payload(F.lit("u-1"), d), custom)
    assert json.loads(got) == {
        "assemblyMap": {"1": 2}, "policyOverride": False, "sqlViewOverride": True, "visualViewOverride": False, "uuid": "u-1"
    }
    assert json.loads(one(spark, lambda _: config.apply_payload(F.lit("u-2")), "")) == {
        "assemblyMap": {}, "policyOverride": True, "sqlViewOverride": True, "visualViewOverride": False, "uuid": "u-2"
    }


# The nine compared fields.
FIELDS = [name for name, _, _ in verify.COMPARED]
VALUES = [None, False, True, 0, 1, "", "UTC", "false", [], {"a": 1}, 1.5]


def python_detail(title, e, a):
    if e and not a:
        return f"{title}: Default config present in source but missing in target"
    if not e and a:
        return f"{title}: Default config missing in source but present in target"
    shown = [v if not isinstance(v, (list, dict)) else json.dumps(v, separators=(",", ":")) for v in (e, a)]
    return f"{title}: Expected={shown[0]}, Actual={shown[1]}"


def test_mismatches_of_every_pair_of_values(spark):
    data, wanted = [], {}
    for x in range(len(VALUES)):
        for y in range(len(VALUES)):
            name, label, title = verify.COMPARED[(x + y) % 9]
            uid = f"u{x}_{y}"
            data.append((uid, json.dumps({"assetConfiguration": {name: VALUES[x]}}), json.dumps({"assetConfiguration": {name: VALUES[y]}})))
            if VALUES[x] == VALUES[y]:
                wanted[uid] = ("success", [])
            else:
                wanted[uid] = ("mismatch", [python_detail(title, VALUES[x], VALUES[y])])
    df = spark.createDataFrame(data, "target_uid string, config_json string, actual_json string")
    ids = df.select("target_uid", F.xxhash64("target_uid").alias("asset_id"))
    actual = df.select(F.xxhash64("target_uid").alias("asset_id"), "actual_json")
    got = verify.verify_configs(df.select("target_uid", "config_json"), ids, actual)
    assert {r.target_uid: (r.status, r.mismatch_details) for r in got.collect()} == wanted


def test_verify_statuses_and_reports(spark, rows):
    expected = spark.createDataFrame(
        [
            ("ok", '{"assetConfiguration":{"timeZone":"UTC"}}'),
            ("gone", "{}"),
            ("bare", "{}"),
            ("broken", "{"),
            ("blank", '{"assetConfiguration":{"timeZone":"","x":null}}'),
        ],
        "target_uid string, config_json string",
    )
    ids = spark.createDataFrame([("ok", 1), ("bare", 2), ("broken", 3), ("blank", 4)], "target_uid string, asset_id long")
    actual = spark.createDataFrame(
        [
            (1, '{"assetConfiguration":{"timeZone":"UTC","sparkResourceConfig":{"a":1},"resourceStrategyType":null}}'),
            (3, '{"assetConfiguration":null}'),
            (2, '{"other":1}'),
            (4, '{"assetConfiguration":{"timeZone":"","autoRetryEnabled":true}}'),
        ],
        "asset_id long, actual_json string",
    )
    job = jobs.verify_configs(expected, ids, actual)
    assert rows(job.results, "target_uid", "status", "config_status") == [
        ("bare", "config_not_found", None),
        ("blank", "mismatch", "Default Config Present"),
        ("broken", "error", None),
        ("gone", "asset_not_found", None),
        ("ok", "success", "Config Changed"),
    ]
    report = {r.Target_UID: r for r in job.report.collect()}
    assert report["ok"].Verification_Status == "✅ PASSED" and report["ok"].Has_Spark_Config == "Yes"
    assert report["gone"].Asset_ID == "N/A" and report["gone"].Config_Status == "Unknown"
    assert report["blank"].Verification_Details == "Auto retry enabled mismatch"
    assert rows(job.fields) == [("Auto Retry", 1)]
    assert rows(job.statuses, "status", "share") == [
        (s, 20.0) for s in ("asset_not_found", "config_not_found", "error", "mismatch", "success")
    ]


def test_verify_profiles(spark, rows):
    imported = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("e",)], "target_uid string")
    ids = spark.createDataFrame([("a", 1), ("b", 2), ("d", 4), ("e", 5)], "target_uid string, asset_id long")
    full = {"profileSettingsConfigs": {"enabled": True, "schedule": "x", "profileNotificationChannels": {"configuredNotificationGroupIds": [5, 6]}}}
    profiles = spark.createDataFrame([(1, json.dumps(full)), (4, "{}"), (5, '{"x":1}')], "asset_id long, profile_json string")
    job = jobs.verify_profiles(imported, ids, profiles)
    assert rows(job.report, "Target_UID", "Verification_Details") == [
        ("a", "Asset ID: 1 | Notifications: Yes | Schedule: Yes | Enabled: Yes | Notification IDs: 5, 6"),
        ("b", "Error: Profile configuration not found for asset ID: 2"),
        ("c", "Error: Asset not found for UID: c"),
        ("d", "Error: Profile configuration not found for asset ID: 4"),
        ("e", "Asset ID: 5 | Notifications: No | Schedule: No | Enabled: No"),
    ]


GROUP = "id long, name string, channels array<struct<type: string>>, ordinal long"


def test_notifications(spark, rows):
    source = spark.createDataFrame(
        [(1, " Ops ", [("SLACK",), (None,), ("EMAIL",), ("SLACK",)], 1), (2, "Dev", [], 2), (3, None, None, 3), (9, "Unused", [], 4)], GROUP
    )
    target = spark.createDataFrame([(11, "OPS", [], 1), (12, "ops", [], 2), (0, "dev", [], 3), (13, "  ", [], 4)], GROUP)
    mapping = [tuple(r)[:6] for r in jobs.notification_mapping(source, target).collect()]
    assert mapping[0] == (1, " Ops ", "EMAIL, N/A, SLACK", "12", " Ops ", "Mapped")
    assert [m[5] for m in mapping] == ["Mapped"] + ["Not Found in Target"] * 3
    assert rows(notify.usable_mapping(notify.map_groups(source, target))) == [(1, 12)]
    rules = spark.createDataFrame(
        [
            (None,),
            ((7, "r7", None),),
            ((8, None, ([],)),),
            ((5, "r5", ([1, 2, 40],)),),
            ((6, None, ([40],)),),
        ],
        "rule struct<id: long, name: string, notificationChannels: struct<configuredNotificationGroupIds: array<long>>>",
    )
    job = jobs.notification_check(rules, source, target)
    assert rows(job.groups, "notification_id") == [(1,), (2,)]
    assert [r[2].split("'")[0] for r in rows(job.rejected)] == ["No ", "Missing ", "Missing "] or len(rows(job.rejected)) == 3
    assert rows(job.missing) == [(40, 2, 5, "r5"), (40, 2, 6, "Unnamed")]
    assert rows(job.comparison, "notification_id", "present_in_target") == [(1, "Yes"), (2, "Yes")]


def test_profiling(spark, rows):
    log = spark.createDataFrame(
        [(1, "running", 1), (1, "success", 2), (2, "Cancelled", 5), (2, "RUNNING", 3), (3, "in progress", 1), (4, "odd", 1)],
        "asset_id long, status string, ts long",
    )
    assets = spark.createDataFrame([(n,) for n in range(1, 6)], "asset_id long")
    assert rows(profiling.profiling_decision(assets, log)) == [
        (1, "done"), (2, "failed"), (3, "running"), (4, "unknown"), (5, "needs_trigger")
    ]
    policies = spark.createDataFrame(
        [("DQ ", "1"), ("DQ", "2"), ("DQ", "1"), ("DQ", "1,2"), ("OTHER", "3")], "type string, tableAssetIds string"
    )
    id_map = spark.createDataFrame([("1", "101", "u101"), ("2", "102", "u102"), ("3", "103", "u103")], "source_id string, target_id string, target_uid string")
    requests = spark.createDataFrame([("102",), ("102",)], "target_id string")
    job = jobs.profile_check(policies, "DQ, X", id_map, requests, log)
    assert rows(job.never_profiled) == [(101, "u101")]
    assert rows(job.decisions) == [(101, "needs_trigger")]
