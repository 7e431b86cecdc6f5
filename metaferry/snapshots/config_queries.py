"""Queries over configurations, profiles, segments, notifications and verification."""

from __future__ import annotations

from pyspark.sql import functions as F

from metaferry.functions import text
from metaferry.operators import config, inventory, notify, profiling, ranking, verify
from metaferry.plans import configs as jobs
from metaferry.snapshots.asset_queries import MERGED, asset_map
from metaferry.snapshots.registry import Inputs, query

_CLASS = """CASE c_custkey % 29 WHEN 3 THEN 'unparsable' WHEN 4 THEN 'null_config' WHEN 5 THEN 'missing_field'
    ELSE 'with_config' END"""


@query(
    "config_census",
    f"""WITH c AS (SELECT {_CLASS} AS kind FROM $expected_configs)
    SELECT count(*) AS total, count(*) FILTER (kind = 'with_config') AS with_config,
           count(*) FILTER (kind = 'null_config') AS null_config, count(*) FILTER (kind = 'missing_field') AS missing_field,
           count(*) FILTER (kind = 'unparsable') AS unparsable FROM c""",
)
def _(i: Inputs):
    return config.config_census(i.expected_configs)


@query(
    "config_rows",
    """SELECT target_uid, config_json, CASE WHEN c_custkey % 3 = 0 THEN 'Unknown' ELSE concat('s', c_custkey) END AS source_uid,
           CASE WHEN c_custkey % 2 = 0 THEN '{}' ELSE 'null' END AS anomaly_json
    FROM $expected_configs WHERE c_custkey % 5 <> 0""",
)
def _(i: Inputs):
    rows = i.expected_configs.selectExpr(
        "CASE WHEN c_custkey % 5 = 0 THEN '  ' ELSE concat(' ', target_uid, '\t') END AS target_uid",
        "concat(config_json, ' ') AS config_json",
        "CASE WHEN c_custkey % 2 = 0 THEN '{}' ELSE 'null' END AS profile_anomaly_json",
        "CASE WHEN c_custkey % 3 = 0 THEN ' ' ELSE concat('s', c_custkey) END AS source_uid",
    )
    return config.config_rows(rows)


@query(
    "config_problems",
    """SELECT '' AS target_uid, 'blank_key' AS problem FROM $expected_configs WHERE c_custkey % 37 = 1
    UNION ALL SELECT CASE WHEN c_custkey % 37 = 1 THEN '' ELSE target_uid END, 'invalid_json'
    FROM $expected_configs WHERE c_custkey % 29 = 3""",
)
def _(i: Inputs):
    key = F.when(F.col("c_custkey") % 37 == 1, "").otherwise(F.col("target_uid"))
    return config.config_problems(i.expected_configs.withColumn("target_uid", key), "target_uid", "config_json")


_PLAN = f"""WITH p AS (
    SELECT e.target_uid, e.c_custkey AS k, t.asset_id, e.config_json,
           CASE WHEN t.asset_id IS NULL THEN 'Asset not found in target'
                WHEN {_CLASS} = 'missing_field' THEN 'No assetConfiguration field in config'
                WHEN {_CLASS} = 'null_config' THEN 'assetConfiguration is null (default config)'
                WHEN {_CLASS} = 'unparsable' THEN 'Exception occurred' END AS reason,
           CASE WHEN t.asset_id IS NULL OR {_CLASS} = 'unparsable' THEN 'failed' WHEN reason IS NOT NULL THEN 'skipped'
                ELSE 'importable' END AS status
    FROM $expected_configs e LEFT JOIN $target_ids t ON e.target_uid = t.target_uid)"""


@query(
    "config_import_plan",
    _PLAN
    + """ SELECT target_uid, status, coalesce(reason, '') AS reason,
        CASE WHEN reason IS NULL THEN CAST(asset_id AS VARCHAR) ELSE '' END AS top_id,
        CASE WHEN reason IS NULL THEN CAST(asset_id AS VARCHAR) ELSE '' END AS freshness_id,
        CASE WHEN reason IS NULL THEN json_extract_string(config_json, '$.assetConfiguration.extra[0]') ELSE '' END AS extra,
        CASE WHEN reason IS NULL THEN json_extract_string(config_json, '$.assetConfiguration.timeZone') ELSE '' END AS zone
    FROM p""",
)
def _(i: Inputs):
    plan = config.config_import_plan(i.expected_configs, i.target_ids)

    def part(path: str):
        return text.or_blank(F.get_json_object("payload", "$.assetConfiguration." + path))

    return plan.select(
        "target_uid",
        "status",
        text.or_blank(F.col("reason")).alias("reason"),
        part("assetId").alias("top_id"),
        part("freshnessColumnInfo.assetId").alias("freshness_id"),
        part("extra[0]").alias("extra"),
        part("timeZone").alias("zone"),
    )


@query(
    "config_skip_reasons",
    _PLAN + " SELECT reason, count(*) AS n FROM p WHERE status = 'skipped' GROUP BY reason",
)
def _(i: Inputs):
    return config.skip_counts(config.config_import_plan(i.expected_configs, i.target_ids))


@query(
    "config_payload_text",
    """SELECT id AS target_uid, concat('{"assetConfiguration":{"a":[1,{"z":null}],"assetId":', o_custkey,
        CASE WHEN id % 2 = 0 THEN concat(',"freshnessColumnInfo":{"assetId":', o_custkey, ',"c":"é"}')
             ELSE ',"freshnessColumnInfo":{"c":1}' END, '},"b":1.5}') AS payload FROM $policies""",
)
def _(i: Inputs):
    document = F.expr(
        """concat('{"b":1.5,"assetConfiguration":{"a":[1,{"z":null}],"assetId":0,"freshnessColumnInfo":{"c":',
        CASE WHEN id % 2 = 0 THEN '"é","assetId":7' ELSE '1' END, '}}}')"""
    )
    payload = config.with_asset_id(document, F.col("o_custkey"))
    # Field order is not part of the payload: parse and print it with sorted keys.
    return i.policies.select(F.col("id").alias("target_uid"), F.to_json(F.parse_json(payload)).alias("payload"))


@query(
    "anomaly_monitor_columns",
    f"""WITH {MERGED}, a AS (SELECT id, o_custkey, id % 3 AS k FROM $policies WHERE id % 5 <> 4),
    ids AS (SELECT id, 1 AS pos, o_custkey AS c FROM a WHERE k >= 1 UNION ALL SELECT id, 2, id % 200 FROM a WHERE k >= 1
            UNION ALL SELECT id, 3, o_custkey + 1 FROM a WHERE k = 2)
    SELECT concat('t', id) AS target_uid, string_agg(merged.target_id, ',' ORDER BY pos) AS columns
    FROM ids JOIN merged ON CAST(c AS VARCHAR) = source_id GROUP BY id""",
)
def _(i: Inputs):
    found = config.monitor_columns(_anomalies(i), asset_map(i))
    return found.select("target_uid", F.array_join(F.col("monitor_columns").cast("array<string>"), ",").alias("columns"))


def _anomalies(i: Inputs):
    document = """CASE WHEN id % 5 = 4 THEN CASE WHEN id % 2 = 0 THEN ' {} ' ELSE 'null' END
        WHEN id % 3 = 0 THEN '{"details":{"items":[]}}'
        WHEN id % 3 = 1 THEN concat('{"details":{"items":[{"monitorColumns":[', o_custkey, ',', id % 200, ']}]}}')
        ELSE concat('{"details":{"items":[{"monitorColumns":[', o_custkey, ',', id % 200, ']},{"x":1},{"monitorColumns":["',
            o_custkey + 1, '"]}]}}') END"""
    return i.policies.selectExpr("concat('t', id) AS target_uid", f"{document} AS anomaly_json")


@query(
    "anomaly_import_plan",
    f"""WITH {MERGED}, a AS (SELECT id, o_custkey, id % 3 AS k FROM $policies WHERE id % 5 <> 4),
    ids AS (SELECT id, 1 AS pos, o_custkey AS c FROM a WHERE k >= 1 UNION ALL SELECT id, 2, id % 200 FROM a WHERE k >= 1
            UNION ALL SELECT id, 3, o_custkey + 1 FROM a WHERE k = 2),
    m AS (SELECT id, string_agg(merged.target_id, ',' ORDER BY pos) AS columns
          FROM ids JOIN merged ON CAST(c AS VARCHAR) = source_id GROUP BY id),
    p AS (SELECT concat('t', r.id) AS target_uid, r.id % 5 = 4 AS is_empty, r.id % 7 = 3 AS is_unknown, r.id % 7 = 5 AS is_broken,
               concat('{{"items":[{{"monitorColumns":[', coalesce(columns, ''), '],"name":"i1"}},{{"monitorColumns":[',
                   coalesce(columns, ''), ']}}],"rule":{{"id":', r.id, '}}}}') AS payload
          FROM $policies r LEFT JOIN m ON r.id = m.id)
    SELECT target_uid, CASE WHEN is_empty THEN 'skipped' WHEN is_unknown OR is_broken THEN 'failed' ELSE 'importable' END AS status,
           CASE WHEN is_empty THEN 'Empty anomaly configuration' WHEN is_unknown THEN concat('No asset found for UID: ', target_uid)
               WHEN is_broken THEN concat('No anomaly rule for UID: ', target_uid) ELSE '' END AS reason,
           CASE WHEN is_empty OR is_unknown OR is_broken THEN '' ELSE payload END AS payload
    FROM p""",
)
def _(i: Inputs):
    document = """CASE WHEN id % 7 = 5 THEN '[]'
        ELSE concat('{"rule":{"id":', id, '},"details":{"items":[{"name":"i1","monitorColumns":[1]},{}]}}') END"""
    known = i.policies.filter("id % 7 <> 3")
    rules = known.selectExpr("concat('t', id) AS target_uid", f"{document} AS rule_json")
    plan = config.anomaly_import_plan(_anomalies(i), asset_map(i), rules)
    payload = F.to_json(F.parse_json("payload")).alias("payload")
    return plan.select("target_uid", "status", text.or_blank(F.col("reason")).alias("reason"), text.or_blank(payload).alias("payload"))


_GROUP_MAP = """gm AS (
    SELECT s.id AS source_id, s.name, s.kind, t.id AS target_id, s.ordinal
    FROM $source_groups s LEFT JOIN (
        SELECT lower(trim(name)) AS name, arg_max(id, ordinal) AS id FROM $target_groups WHERE trim(name) <> '' GROUP BY 1) t
      ON lower(trim(s.name)) = t.name)"""


def _source_groups(i: Inputs):
    kind = F.col("kind")
    listed = F.array(
        F.struct(F.when(kind != 2, F.lit("SLACK")).alias("type")),
        F.struct(F.lit("EMAIL").alias("type")),
        F.struct(F.lit("EMAIL").alias("type")),
    )
    channels = F.when(kind == 1, F.filter(listed, lambda _: F.lit(False))).otherwise(listed)
    return i.source_groups.withColumn("channels", channels)


_TYPES = "CASE kind WHEN 0 THEN 'EMAIL, SLACK' WHEN 1 THEN '' ELSE 'EMAIL, N/A' END"


@query(
    "notification_mapping",
    f"""WITH {_GROUP_MAP} SELECT source_id AS source_notification_id, name AS source_notification_name,
        {_TYPES} AS source_notification_type, coalesce(CAST(target_id AS VARCHAR), '') AS target_notification_id,
        CASE WHEN target_id IS NULL THEN '' ELSE name END AS target_notification_name,
        CASE WHEN target_id IS NULL THEN 'Not Found in Target' ELSE 'Mapped' END AS mapping_status, ordinal
    FROM gm ORDER BY target_id IS NULL, ordinal""",
)
def _(i: Inputs):
    return notify.order_mapping(notify.map_groups(_source_groups(i), i.target_groups))


@query(
    "usable_notification_mapping",
    f"WITH {_GROUP_MAP} SELECT source_id, target_id FROM gm WHERE target_id IS NOT NULL",
)
def _(i: Inputs):
    return notify.usable_mapping(notify.map_groups(_source_groups(i), i.target_groups))


@query(
    "notification_comparison",
    f"""WITH names AS (SELECT DISTINCT lower(trim(name)) AS name FROM $target_groups)
    SELECT id AS notification_id, g.name AS notification_name, {_TYPES} AS notification_type,
        CASE WHEN n.name IS NULL THEN 'No' ELSE 'Yes' END AS present_in_target,
        CASE WHEN n.name IS NULL THEN 'Missing in target environment' ELSE '' END AS comment
    FROM $source_groups g LEFT JOIN names n ON lower(trim(g.name)) = n.name""",
)
def _(i: Inputs):
    return notify.compare_groups(_source_groups(i), i.target_groups)


_USE = """r AS (SELECT o_orderkey AS id, o_orderkey % 7 AS k, concat('rule_', o_orderkey) AS name, o_custkey AS c FROM $orders),
    used AS (SELECT id, name, c AS g FROM r WHERE k > 2 UNION ALL SELECT id, name, c * 3 FROM r WHERE k > 2)"""


def _rules(i: Inputs):
    key, kind = F.col("o_orderkey"), F.col("o_orderkey") % 7
    ids = F.array("o_custkey", F.col("o_custkey") * 3)
    none = F.filter(ids, lambda _: F.lit(False))
    channels = F.when(kind != 1, F.struct(F.when(kind == 2, none).otherwise(ids).alias("configuredNotificationGroupIds")))
    rule = F.struct(key.alias("id"), F.concat(F.lit("rule_"), key).alias("name"), channels.alias("notificationChannels"))
    return i.orders.select(F.when(kind != 0, rule).alias("rule"))


@query(
    "rejected_rules",
    f"""WITH {_USE} SELECT CASE WHEN k = 0 THEN '' ELSE CAST(id AS VARCHAR) END AS rule_id,
        CASE WHEN k = 0 THEN 'Unnamed' ELSE name END AS rule_name,
        CASE k WHEN 0 THEN 'Missing ''rule'' object' WHEN 1 THEN 'Missing ''notificationChannels'''
            ELSE 'No ''configuredNotificationGroupIds''' END AS reject_reason
    FROM r WHERE k < 3""",
)
def _(i: Inputs):
    rejected = notify.rejected_rules(notify.classified_rules(_rules(i)))
    return rejected.withColumn("rule_id", text.or_blank(F.col("rule_id")))


def _use(i: Inputs):
    return notify.group_use(notify.classified_rules(_rules(i)))


@query("notification_group_use", f"WITH {_USE} SELECT g AS group_id, count(*) AS rules FROM used GROUP BY g")
def _(i: Inputs):
    return notify.group_usage_counts(_use(i))


@query(
    "used_notification_groups",
    f"""WITH {_USE} SELECT id AS notification_id, name AS notification_name, {_TYPES} AS notification_type
    FROM $source_groups WHERE id IN (SELECT g FROM used)""",
)
def _(i: Inputs):
    return notify.group_rows(notify.used_groups(_source_groups(i), _use(i)))


@query(
    "missing_notification_groups",
    f"""WITH {_USE}, lost AS (SELECT * FROM used WHERE g NOT IN (SELECT id FROM $source_groups))
    SELECT g AS group_id, count(*) OVER (PARTITION BY g) AS referenced_by, id AS rule_id, name AS rule_name FROM lost""",
)
def _(i: Inputs):
    return notify.missing_groups(_use(i), i.source_groups)


@query(
    "missing_notification_group_ids",
    f"WITH {_USE} SELECT DISTINCT g AS group_id FROM used EXCEPT SELECT id FROM $source_groups",
)
def _(i: Inputs):
    return notify.missing_group_ids(_use(i), i.source_groups)


_PROFILE_IDS = f"""{_GROUP_MAP}, pids AS (
    SELECT target_uid, c_custkey AS k, 1 AS pos, id1 AS id FROM $profiles UNION ALL
    SELECT target_uid, c_custkey, 2, id2 FROM $profiles),
    used_ids AS (SELECT * FROM pids WHERE k % 31 NOT IN (3, 4) AND k % 4 <> 0),
    remapped AS (SELECT u.target_uid, string_agg(gm.target_id, ',' ORDER BY pos) AS mapped_ids,
        string_agg(CASE WHEN gm.target_id IS NULL THEN u.id END, ',' ORDER BY pos) AS unmapped_ids
        FROM used_ids u LEFT JOIN gm ON u.id = gm.source_id GROUP BY u.target_uid)"""


def _group_map(i: Inputs):
    return notify.usable_mapping(notify.map_groups(_source_groups(i), i.target_groups))


@query(
    "mapped_notification_ids",
    f"""WITH {_PROFILE_IDS} SELECT p.target_uid, coalesce(mapped_ids, '') AS mapped_ids, coalesce(unmapped_ids, '') AS unmapped_ids
    FROM $profiles p LEFT JOIN remapped r ON p.target_uid = r.target_uid""",
)
def _(i: Inputs):
    mapped = config.map_notification_ids(i.profiles, _group_map(i))
    return mapped.select(
        "target_uid", *[F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in ("mapped_ids", "unmapped_ids")]
    )


@query(
    "profile_import_plan",
    f"""WITH {_PROFILE_IDS} SELECT p.target_uid,
        CASE WHEN t.asset_id IS NULL THEN concat('No asset found for UID: ', p.target_uid)
             WHEN c_custkey % 31 = 3 THEN concat('Invalid JSON in profile_json for UID ', p.target_uid) ELSE '' END AS reason,
        CASE WHEN c_custkey % 31 = 3 OR t.asset_id IS NULL THEN 'failed' ELSE 'importable' END AS status,
        CASE WHEN c_custkey % 31 = 3 OR t.asset_id IS NULL THEN '' WHEN c_custkey % 31 = 4 THEN 'null'
             ELSE concat('[', coalesce(mapped_ids, ''), ']') END AS ids,
        CASE WHEN c_custkey % 31 = 3 OR t.asset_id IS NULL THEN '' WHEN c_custkey % 31 = 4 OR c_custkey % 2 = 0 THEN 'true'
             ELSE 'false' END AS enabled
    FROM $profiles p LEFT JOIN remapped r ON p.target_uid = r.target_uid LEFT JOIN $target_ids t ON p.target_uid = t.target_uid""",
)
def _(i: Inputs):
    configs = i.profiles.select("target_uid", "profile_json")
    plan = config.profile_import_plan(configs, i.target_ids, _group_map(i))
    root = "$.profileSettingsConfigs."
    ids = F.get_json_object("payload", root + "profileNotificationChannels.configuredNotificationGroupIds")
    return plan.select(
        "target_uid",
        text.or_blank(F.col("reason")).alias("reason"),
        "status",
        F.when(F.col("payload").isNull(), "").otherwise(F.coalesce(ids, F.lit("null"))).alias("ids"),
        text.or_blank(F.get_json_object("payload", root + "enabled")).alias("enabled"),
    )


def _segment_documents(i: Inputs):
    document = """CASE id % 6 WHEN 0 THEN '{"assetSegments":{"segments":[]}}' WHEN 1 THEN '{"x":1}' WHEN 2 THEN '{"segments":'
        WHEN 3 THEN concat('{"segments":[{"id":5,"name":"s', id, '","conditions":[{"id":1,"columnId":', o_custkey,
            ',"condition":"EQ","value":"v"},{"columnId":"c"}]}]}')
        ELSE concat('{"assetSegments":{"segments":[{"name":"a', id, '"},{"conditions":[]}]}}') END"""
    return i.policies.selectExpr("concat(' t', id) AS target_uid", f"{document} AS segments_json")


@query("segments_present", "SELECT concat(' t', id) AS target_uid FROM $policies WHERE id % 6 >= 3")
def _(i: Inputs):
    return config.with_segments(_segment_documents(i)).select("target_uid")


@query(
    "segment_import_plan",
    """SELECT concat('t', id) AS target_uid, coalesce(CASE WHEN id % 6 = 2 THEN 'Invalid JSON' WHEN id % 6 = 1 THEN 'No segments array'
            WHEN status = 'DISABLED' THEN 'No asset found' END, '') AS reason,
        CASE WHEN id % 6 IN (1, 2) OR status = 'DISABLED' THEN '' WHEN id % 6 = 0 THEN '[]'
            WHEN id % 6 = 3 THEN concat('[{"id":null,"name":"s', id, '","conditions":[{"id":null,"columnId":', o_custkey,
                ',"condition":"EQ","value":"v"},{"id":null,"columnId":"c","condition":"CUSTOM","value":""}]}]')
            ELSE concat('[{"id":null,"name":"a', id, '","conditions":[]},{"id":null,"name":"","conditions":[]}]') END AS payload
    FROM $policies""",
)
def _(i: Inputs):
    ids = i.policies.filter("status <> 'DISABLED'").selectExpr("concat('t', id) AS target_uid", "id AS asset_id")
    plan = config.segment_import_plan(_segment_documents(i), ids)
    return plan.select("target_uid", *[text.or_blank(F.col(c)).alias(c) for c in ("reason", "payload")])


@query(
    "apply_payloads",
    """SELECT file, concat('{"assemblyMap":', CASE WHEN applied THEN '{"1":2}' ELSE '{}' END, ',"extra":true,',
        '"policyOverride":', CASE WHEN applied THEN 'false' ELSE 'true' END,
        ',"sqlViewOverride":true,"uuid":"', uuid, '","visualViewOverride":false}') AS payload
    FROM $uploads""",
)
def _(i: Inputs):
    overrides = F.when(
        F.col("applied"), F.lit('{"policyOverride":false,"assemblyMap":{"1":2},"uuid":"x","extra":true}')
    ).otherwise(F.lit('{"extra":true}'))
    payload = config.apply_payload(F.col("uuid"), overrides)
    return i.uploads.select("file", F.to_json(F.parse_json(payload)).alias("payload"))


_VERIFY = """WITH v AS (
    SELECT e.target_uid, e.c_custkey AS k, t.asset_id, a.actual_json IS NOT NULL AS found,
        k % 29 = 3 AS broken, k % 29 IN (4, 5) AS bare,
        CASE WHEN bare <> (k % 11 = 0) THEN 1 ELSE 0 END AS scheduled,
        CASE WHEN bare THEN 1 WHEN (k % 3 = 0) <> (k % 3 = 0 OR k % 17 = 1) THEN 1 ELSE 0 END AS zone,
        CASE WHEN bare OR k % 7 = 0 THEN 1 ELSE 0 END AS level,
        CASE WHEN bare THEN 1 ELSE 0 END AS strategy,
        CASE WHEN bare AND k % 5 <> 0 THEN 1 ELSE 0 END AS sensitivity
    FROM $expected_configs e LEFT JOIN $target_ids t ON e.target_uid = t.target_uid
         LEFT JOIN $actual_configs a ON t.asset_id = a.asset_id),
    w AS (SELECT *, concat_ws(', ', CASE WHEN scheduled = 1 THEN 'Schedule mismatch' END,
            CASE WHEN zone = 1 THEN 'Timezone mismatch' END, CASE WHEN level = 1 THEN 'Column level mismatch' END,
            CASE WHEN strategy = 1 THEN 'Resource strategy mismatch' END,
            CASE WHEN sensitivity = 1 THEN 'Profile anomaly sensitivity mismatch' END) AS labels FROM v),
    s AS (SELECT *, CASE WHEN asset_id IS NULL THEN 'asset_not_found' WHEN NOT found THEN 'config_not_found'
            WHEN broken THEN 'error' WHEN labels <> '' THEN 'mismatch' ELSE 'success' END AS status FROM w)"""


def _verified(i: Inputs):
    return verify.verify_configs(i.expected_configs, i.target_ids, i.actual_configs)


@query(
    "verified_configs",
    _VERIFY
    + """ SELECT target_uid, status, CASE status WHEN 'success' THEN 'All configurations match' WHEN 'mismatch' THEN labels ELSE '' END
            AS verification_details,
        CASE WHEN status IN ('success', 'mismatch') THEN CASE WHEN bare THEN 'Default Config Present' ELSE 'Config Changed' END
            ELSE '' END AS config_status,
        found AND asset_id IS NOT NULL AND k % 6 <> 0 AS has_spark_config,
        found AND asset_id IS NOT NULL AND k % 4 <> 0 AS incremental_strategy,
        found AND asset_id IS NOT NULL AND k % 2 = 0 AND k % 11 <> 0 AS has_schedule
    FROM s""",
)
def _(i: Inputs):
    return _verified(i).select(
        "target_uid",
        "status",
        text.or_blank(F.col("verification_details")).alias("verification_details"),
        text.or_blank(F.col("config_status")).alias("config_status"),
        "has_spark_config",
        "incremental_strategy",
        "has_schedule",
    )


@query(
    "config_report",
    _VERIFY
    + """ SELECT s.target_uid AS "Target_UID", coalesce(CAST(asset_id AS VARCHAR), 'N/A') AS "Asset_ID",
        CASE status WHEN 'success' THEN '✅ PASSED' WHEN 'mismatch' THEN '⚠️ MISMATCH' WHEN 'error' THEN '❌ ERROR'
            ELSE concat('❌ ', upper(status)) END AS "Verification_Status",
        CASE WHEN status IN ('success', 'mismatch') THEN CASE WHEN bare THEN 'Default Config Present' ELSE 'Config Changed' END
            ELSE 'Unknown' END AS "Config_Status",
        CASE WHEN found AND asset_id IS NOT NULL AND k % 6 <> 0 THEN 'Yes' ELSE 'No' END AS "Has_Spark_Config",
        CASE WHEN found AND asset_id IS NOT NULL AND k % 4 <> 0 THEN 'Yes' ELSE 'No' END AS "Incremental_Strategy",
        CASE WHEN status IN ('success', 'mismatch') THEN lower(c_mktsegment) ELSE 'N/A' END AS "Resource_Strategy",
        'No' AS "Auto_Retry_Enabled", 'No' AS "Is_User_Marked_Reference", 'No' AS "Is_Reference_Check_Valid",
        'No' AS "Has_Reference_Check_Config",
        CASE status WHEN 'asset_not_found' THEN concat('No asset found for UID: ', target_uid)
            WHEN 'config_not_found' THEN concat('No configuration found for asset ID: ', asset_id)
            WHEN 'error' THEN 'Invalid expected config JSON' WHEN 'mismatch' THEN concat('Configuration mismatch: ', labels)
            ELSE '' END AS "Error_Message",
        CASE status WHEN 'success' THEN 'All configurations match' WHEN 'mismatch' THEN labels ELSE '' END AS "Verification_Details"
    FROM s JOIN $customer c ON c.c_custkey = s.k""",
)
def _(i: Inputs):
    return verify.config_report(_verified(i))


@query(
    "config_status_counts",
    _VERIFY
    + " SELECT status, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS share FROM s GROUP BY status",
)
def _(i: Inputs):
    return verify.status_counts(_verified(i))


@query(
    "config_failure_counts",
    _VERIFY
    + """ SELECT CASE status WHEN 'error' THEN 'Invalid expected config JSON' WHEN 'mismatch' THEN concat('Configuration mismatch: ', labels)
            WHEN 'asset_not_found' THEN concat('No asset found for UID: ', target_uid)
            ELSE concat('No configuration found for asset ID: ', asset_id) END AS reason, count(*) AS n
    FROM s WHERE status <> 'success' GROUP BY 1""",
)
def _(i: Inputs):
    return verify.failure_counts(_verified(i))


@query(
    "config_mismatch_fields",
    _VERIFY
    + """, f AS (SELECT unnest([CASE WHEN scheduled = 1 THEN 'Schedule' END, CASE WHEN zone = 1 THEN 'Timezone' END,
            CASE WHEN level = 1 THEN 'Column Level' END, CASE WHEN strategy = 1 THEN 'Resource Strategy' END,
            CASE WHEN sensitivity = 1 THEN 'Profile Anomaly Sensitivity' END]) AS field FROM s WHERE status = 'mismatch')
    SELECT field, count(*) AS n FROM f WHERE field IS NOT NULL GROUP BY field""",
)
def _(i: Inputs):
    return verify.mismatch_fields(_verified(i))


@query(
    "config_mismatch_details",
    _VERIFY
    + """, f AS (
        SELECT CASE WHEN k % 2 = 0 AND (NOT bare) THEN 'Schedule: Default config present in source but missing in target'
                WHEN bare AND k % 2 = 0 AND k % 11 <> 0 THEN 'Schedule: Default config missing in source but present in target'
                WHEN bare AND k % 11 = 0 THEN NULL
                ELSE concat('Schedule: Expected=', CASE WHEN bare THEN 'None' ELSE 'False' END, ', Actual=',
                    CASE WHEN k % 11 = 0 THEN 'None' ELSE 'False' END) END AS reason
        FROM s WHERE status = 'mismatch' AND scheduled = 1
        UNION ALL SELECT CASE WHEN NOT bare THEN 'Timezone: Default config present in source but missing in target'
                WHEN k % 3 = 0 OR k % 17 = 1 THEN 'Timezone: Expected=None, Actual='
                ELSE 'Timezone: Default config missing in source but present in target' END
        FROM s WHERE status = 'mismatch' AND zone = 1
        UNION ALL SELECT CASE WHEN bare THEN CASE WHEN k % 7 <> 0 AND k % 4 = 0 THEN 'Column Level: Expected=None, Actual=0'
                    ELSE 'Column Level: Default config missing in source but present in target' END
                WHEN k % 4 = 0 THEN 'Column Level: Default config missing in source but present in target'
                ELSE concat('Column Level: Expected=', k % 4, ', Actual=9') END
        FROM s WHERE status = 'mismatch' AND level = 1
        UNION ALL SELECT 'Resource Strategy: Default config missing in source but present in target'
        FROM s WHERE status = 'mismatch' AND strategy = 1
        UNION ALL SELECT 'Profile Anomaly Sensitivity: Default config missing in source but present in target'
        FROM s WHERE status = 'mismatch' AND sensitivity = 1)
    SELECT reason, count(*) AS n FROM f WHERE reason IS NOT NULL GROUP BY reason""",
)
def _(i: Inputs):
    return verify.mismatch_counts(_verified(i))


_PROFILES = """WITH v AS (
    SELECT p.target_uid, c_custkey AS k, t.asset_id,
        CASE WHEN t.asset_id IS NULL THEN 'asset_not_found' WHEN s.asset_id IS NULL THEN 'profile_not_found'
             WHEN k % 31 = 3 THEN 'error' ELSE 'success' END AS status,
        status = 'success' AND k % 31 <> 4 AND k % 4 <> 0 AS noted,
        status = 'success' AND k % 31 <> 4 AND k % 3 <> 0 AS timed,
        status = 'success' AND (k % 31 = 4 OR k % 2 = 0) AS active,
        CASE WHEN noted THEN concat(k, ', ', k * 7) ELSE 'None' END AS ids
    FROM $profiles p LEFT JOIN $target_ids t ON p.target_uid = t.target_uid
         LEFT JOIN $stored_profiles s ON t.asset_id = s.asset_id)"""


def _checked_profiles(i: Inputs):
    stored = i.stored_profiles.select("asset_id", "profile_json")
    return verify.verify_profiles(i.profiles.select("target_uid"), i.target_ids, stored)


@query(
    "verified_profiles",
    _PROFILES + " SELECT target_uid, status, noted AS has_notifications, timed AS has_schedule, active AS is_enabled FROM v",
)
def _(i: Inputs):
    return _checked_profiles(i).select("target_uid", "status", "has_notifications", "has_schedule", "is_enabled")


@query(
    "profile_report",
    _PROFILES
    + """, y AS (SELECT *, CASE WHEN noted THEN 'Yes' ELSE 'No' END AS n, CASE WHEN timed THEN 'Yes' ELSE 'No' END AS s,
            CASE WHEN active THEN 'Yes' ELSE 'No' END AS e, coalesce(CAST(asset_id AS VARCHAR), 'N/A') AS aid,
            CASE status WHEN 'asset_not_found' THEN concat('Asset not found for UID: ', target_uid)
                WHEN 'profile_not_found' THEN concat('Profile configuration not found for asset ID: ', asset_id)
                WHEN 'error' THEN concat('Error verifying ', target_uid) ELSE '' END AS problem FROM v)
    SELECT target_uid AS "Target_UID", aid AS "Asset_ID",
        CASE status WHEN 'success' THEN '✅ PASSED' WHEN 'error' THEN '❌ ERROR' ELSE concat('❌ ', upper(status)) END
            AS "Verification_Status",
        n AS "Has_Notifications", s AS "Has_Schedule", e AS "Profiling_Enabled", ids AS "Notification_Group_IDs",
        problem AS "Error_Message",
        CASE WHEN status = 'success' THEN concat('Asset ID: ', aid, ' | Notifications: ', n, ' | Schedule: ', s, ' | Enabled: ', e,
            CASE WHEN noted THEN concat(' | Notification IDs: ', ids) ELSE '' END)
            ELSE concat('Error: ', problem) END AS "Verification_Details"
    FROM y""",
)
def _(i: Inputs):
    return verify.profile_report(_checked_profiles(i))


@query(
    "profile_status_counts",
    _PROFILES
    + " SELECT status, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS share FROM v GROUP BY status",
)
def _(i: Inputs):
    return verify.status_counts(_checked_profiles(i))


_STATE = """CASE upper(status) WHEN 'SUCCESS' THEN 'done' WHEN 'FAILED' THEN 'failed' WHEN 'RUNNING' THEN 'running'
    WHEN 'IN PROGRESS' THEN 'running' ELSE 'unknown' END"""


@query(
    "profiling_decision",
    f"""WITH l AS (SELECT asset_id, arg_max(status, ts) AS status FROM $status_log GROUP BY asset_id)
    SELECT c_custkey AS asset_id, CASE WHEN l.asset_id IS NULL THEN 'needs_trigger' ELSE {_STATE} END AS decision
    FROM $customer LEFT JOIN l ON c_custkey = l.asset_id""",
)
def _(i: Inputs):
    return profiling.profiling_decision(i.customer.select(F.col("c_custkey").alias("asset_id")), i.status_log)


@query(
    "profiling_attempts",
    f"""WITH b AS (SELECT asset_id, min(ts) AS start FROM $status_log GROUP BY asset_id),
    s AS (SELECT l.asset_id, status, ts, CAST(ceil((epoch_us(ts) - epoch_us(start)) / 43200000000.0) AS BIGINT) AS k
          FROM $status_log l JOIN b ON l.asset_id = b.asset_id),
    l AS (SELECT asset_id, k, arg_max(status, ts) AS status FROM s WHERE k < 5 GROUP BY asset_id, k),
    f AS (SELECT asset_id, arg_min({_STATE}, k) AS outcome, min(k) + 1 AS n FROM l WHERE {_STATE} IN ('done', 'failed')
          GROUP BY asset_id)
    SELECT b.asset_id, coalesce(outcome, 'failed') AS outcome, CAST(coalesce(n, 5) AS INTEGER) AS attempts,
           CASE WHEN n IS NULL THEN 'Timeout waiting for profiling' ELSE '' END AS reason
    FROM b LEFT JOIN f ON b.asset_id = f.asset_id""",
)
def _(i: Inputs):
    watched = profiling.profiling_attempts(i.status_log, interval=12 * 3600)
    return watched.select("asset_id", "outcome", "attempts", text.or_blank(F.col("reason")).alias("reason"))


@query(
    "latest_profiling_status",
    f"""WITH l AS (SELECT asset_id, arg_max(status, ts) AS status, max(ts) AS ts FROM $status_log GROUP BY asset_id)
    SELECT asset_id, status, CAST(epoch_us(ts) AS BIGINT) AS micros, {_STATE} AS state FROM l""",
)
def _(i: Inputs):
    latest = profiling.latest_status(i.status_log)
    # Read as UTC whatever the session's time zone.
    utc = F.concat(F.col("ts").cast("string"), F.lit("Z")).cast("timestamp")
    return latest.select("asset_id", "status", F.unix_micros(utc).alias("micros"), "state")


@query(
    "never_profiled",
    f"""WITH {MERGED}, n AS (SELECT DISTINCT o_custkey AS id FROM $policies WHERE type IN ('DATA_QUALITY', 'EQUALITY'))
    SELECT CAST(target_id AS BIGINT) AS "assetId", target_uid AS "assetUid" FROM merged
    WHERE CAST(source_id AS BIGINT) IN (SELECT id FROM n)
      AND CAST(target_id AS BIGINT) NOT IN (SELECT user_id + 1000000000 FROM $events WHERE event_type = 'view')""",
)
def _(i: Inputs):
    wanted = profiling.needs_profiling(i.policies, "DATA_QUALITY, EQUALITY").select(
        F.col("o_custkey").cast("string").alias("source_id")
    )
    requests = i.events.filter("event_type = 'view'").selectExpr("CAST(user_id + 1000000000 AS STRING) AS target_id")
    return profiling.never_profiled(wanted, asset_map(i).select("source_id", "target_id", "target_uid"), requests)


@query(
    "profiling_candidates",
    "SELECT o_orderkey AS \"assetId\" FROM $orders WHERE o_orderkey % 3 <> 0",
)
def _(i: Inputs):
    raw = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("-"), "o_orderkey")).otherwise(F.col("o_orderkey").cast("string"))
    return profiling.numeric_assets(i.orders.select(raw.alias("assetId"))).select(F.col("assetId").cast("long").alias("assetId"))


_TWICE = """twice AS (
    SELECT c_custkey AS k, concat('u', c_nationkey, '_', c_custkey % 50) AS target_uid, c_mktsegment, c_acctbal FROM $customer),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY target_uid ORDER BY k) AS option,
        count(*) OVER (PARTITION BY target_uid) AS copies FROM twice)"""


@query(
    "profile_options",
    f"""WITH {_TWICE} SELECT target_uid, option, k % 2 = 0 AS has_notifications, k % 3 = 0 AS has_schedule,
        k % 5 = 0 AS is_enabled, CASE WHEN c_acctbal > 5000 THEN concat('src', k) WHEN k % 7 = 0 THEN concat('json', k)
            ELSE concat('Config #', option, ' (no source UID)') END AS source
    FROM numbered WHERE copies > 1""",
)
def _(i: Inputs):
    document = """concat('{"profileSettingsConfigs":{"enabled":', c_custkey % 5 = 0, ',"schedule":"',
        CASE WHEN c_custkey % 3 = 0 THEN 'daily' ELSE '' END, '","profileNotificationChannels":{"configuredNotificationGroupIds":[',
        CASE WHEN c_custkey % 2 = 0 THEN '1' ELSE '' END, ']}}', CASE WHEN c_custkey % 7 = 0 THEN
        concat(',"sourceUid":"json', c_custkey, '"') ELSE '' END, '}')"""
    rows = i.customer.selectExpr(
        "concat('u', c_nationkey, '_', c_custkey % 50) AS target_uid",
        f"{document} AS profile_json",
        "CASE WHEN c_acctbal > 5000 THEN concat(' src', c_custkey) WHEN c_acctbal > 2500 THEN 'Unknown' ELSE '' END AS given",
        "c_custkey AS ordinal",
    )
    return config.profile_options(ranking.candidates(rows, "target_uid", "ordinal"), "given")


@query(
    "config_options",
    f"""WITH {_TWICE} SELECT target_uid, option, CASE WHEN c_acctbal > 5000 THEN concat('Source UID: src', k)
            ELSE 'Source UID: Not available (from legacy export)' END AS source,
        CASE WHEN k % 29 = 3 OR k % 4 = 0 THEN 'N/A' ELSE lower(c_mktsegment) END AS resource_strategy,
        k % 29 <> 3 AND k % 3 = 0 AS auto_retry_enabled, k % 29 <> 3 AND k % 5 = 0 AS is_user_marked_reference,
        k % 29 = 3 AS invalid_json
    FROM numbered WHERE copies > 1""",
)
def _(i: Inputs):
    document = """CASE WHEN c_custkey % 29 = 3 THEN '{' ELSE concat('{"assetConfiguration":{"autoRetryEnabled":',
        CASE WHEN c_custkey % 3 = 0 THEN '1' ELSE 'null' END, ',"isUserMarkedReference":', c_custkey % 5 = 0,
        CASE WHEN c_custkey % 4 = 0 THEN '' ELSE concat(',"resourceStrategyType":"', lower(c_mktsegment), '"') END, '}}') END"""
    rows = i.customer.selectExpr(
        "concat('u', c_nationkey, '_', c_custkey % 50) AS target_uid",
        f"{document} AS config_json",
        "CASE WHEN c_acctbal > 5000 THEN concat('src', c_custkey) WHEN c_acctbal > 2500 THEN 'Unknown' ELSE ' ' END AS source_uid",
        "c_custkey AS ordinal",
    )
    return config.config_options(ranking.candidates(rows, "target_uid", "ordinal"))


@query(
    "segment_export",
    """SELECT target_uid, concat('t', id) AS source_uid, 'a' AS kind FROM (
        SELECT id, concat('x', id) AS target_uid FROM $policies WHERE id % 6 >= 3 AND type <> 'EQUALITY')""",
)
def _(i: Inputs):
    rows = _segment_export(i, _stored_segments(i)).rows
    return rows.select("target_uid", F.replace("target_uid", F.lit("x"), F.lit("t")).alias("source_uid"), F.lit("a").alias("kind"))


def _stored_segments(i: Inputs):
    asset_id = F.regexp_extract("target_uid", r"(\d+)", 1).cast("long").alias("asset_id")
    return _segment_documents(i).select(asset_id, "segments_json")


def _segment_export(i: Inputs, stored):
    pairs = i.policies.selectExpr("concat('t', id) AS source_uid", "concat('x', id) AS target_uid")
    ids = F.array(F.struct(F.when(F.col("type") != "EQUALITY", F.col("id")).alias("id")))
    responses = i.policies.select(F.concat(F.lit("t"), "id").alias("source_uid"), ids.alias("data"))
    return jobs.segment_export(pairs, responses, stored)


@query(
    "segment_export_problems",
    """SELECT concat('t', id) AS source_uid, CASE WHEN type = 'EQUALITY' THEN 'no id'
        WHEN id % 10 = 4 THEN concat('No segments document found for asset ID ', id, ' (source-env: t', id, ')')
        ELSE concat('No segments found for asset ID ', id, ' (source-env: t', id, ')') END AS reason
    FROM $policies WHERE type = 'EQUALITY' OR id % 10 = 4 OR id % 6 < 3""",
)
def _(i: Inputs):
    # Some assets have no document, which is one of the problems.
    return _segment_export(i, _stored_segments(i).filter("asset_id % 10 <> 4")).problems


@query(
    "config_export",
    f"""WITH {MERGED} SELECT m.target_uid, m.source_uid, e.config_json, concat('{{"a":', m.source_id, '}}')
        AS asset_profile_anomaly_config_json, '{{}}' AS source_children_json, '{{}}' AS target_children_json
    FROM merged m JOIN $expected_configs e ON m.source_id = CAST(e.c_custkey AS VARCHAR)""",
)
def _(i: Inputs):
    key = F.col("c_custkey").cast("string").alias("source_id")
    configs = i.expected_configs.select(key, "config_json")
    anomalies = i.customer.select(key, F.concat(F.lit('{"a":'), "c_custkey", F.lit("}")).alias("anomaly_json"))
    listed = F.array(F.struct(F.lit(1).alias("asset_id"), F.lit("x").alias("uid")))
    none = F.filter(listed, lambda _: F.lit(False)).alias("child_assets")
    sources = i.customer.select(F.col("c_custkey").alias("asset_id"), none)
    targets = asset_map(i).select(F.col("target_id").alias("asset_id"), none)
    mapping = asset_map(i).select("source_id", "source_uid", "target_id", "target_uid")
    return jobs.config_export(mapping, configs, anomalies, sources, targets).rows
