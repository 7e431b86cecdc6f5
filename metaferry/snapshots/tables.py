"""Snapshots of a source and a target environment, derived from the driver's tables.

Each derivation is one SELECT in the SQL that Spark and DuckDB share, so that
both sides of a check start from the same rows. ``$name`` stands for a driver
table or another snapshot.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

SNAPSHOTS = {
    # Asset inventories. Accounts with a low balance did not reach the target, those with a high one are listed twice.
    "source_inventory": """
        SELECT concat('PROD_DB.', n_name, '.', c_name) AS source_uid, c_custkey AS source_id,
               concat('PROD_DB.', n_name, '.', c_name) AS target_uid,
               CASE WHEN c_custkey % 3 = 0 THEN '' ELSE concat(lower(c_mktsegment), ': tier', c_custkey % 4, ' : ') END
                   AS tags,
               c_nationkey AS assembly_id, c_custkey % 7 AS asset_type_id,
               CASE c_custkey % 7 WHEN 0 THEN 'TABLE' WHEN 1 THEN 'SQL_VIEW' WHEN 2 THEN 'COLUMN'
                   WHEN 3 THEN 'FILE' ELSE 'KAFKA_TOPIC' END AS asset_type,
               c_custkey AS ordinal
        FROM $customer JOIN $nation ON c_nationkey = n_nationkey""",
    "target_inventory": """
        SELECT concat('DEV_DB.', CASE n_name WHEN 'NATION_1' THEN 'COUNTRY_1' ELSE n_name END, '.', c_name)
                   AS source_uid,
               c_custkey + 1000000000 AS source_id, 'TABLE' AS asset_type, c_custkey + 1000000000 AS ordinal
        FROM $customer JOIN $nation ON c_nationkey = n_nationkey WHERE c_acctbal >= 1000
        UNION ALL
        SELECT concat('DEV_DB.', CASE n_name WHEN 'NATION_1' THEN 'COUNTRY_1' ELSE n_name END, '.', c_name),
               c_custkey + 2000000000, 'VIEW', c_custkey + 2000000000
        FROM $customer JOIN $nation ON c_nationkey = n_nationkey WHERE c_acctbal > 9000""",
    "assemblies": """
        SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, r_name AS source_type
        FROM $nation JOIN $region ON n_regionkey = r_regionkey""",
    "assets": """
        SELECT source_id AS id, source_uid AS uid, concat('asset_', source_id) AS name,
               CAST(assembly_id AS BIGINT) AS assembly_id, asset_type
        FROM $source_inventory""",
    # Policies are orders, their backing assets the distinct parts of the lines.
    "policies": """
        SELECT o_orderkey AS id,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'DATA_QUALITY' WHEN '2-HIGH' THEN 'DATA_DRIFT'
                   WHEN '3-MEDIUM' THEN 'SCHEMA_DRIFT' WHEN '5-LOW' THEN 'EQUALITY' ELSE '' END AS type,
               CASE o_orderstatus WHEN 'F' THEN 'SPARK' WHEN 'O' THEN 'JDBC_SQL' ELSE 'PUSH DOWN (x)' END
                   AS engine_type,
               CASE WHEN o_orderkey % 4 = 0 THEN 'SQL' ELSE 'COLUMN' END AS sub_type,
               concat('policy_', o_orderkey) AS name,
               o_orderkey % 3 = 0 AS is_segmented,
               CASE o_orderkey % 5 WHEN 0 THEN 'DISABLED' WHEN 1 THEN 'ACTIVE' ELSE 'ENABLED' END AS status,
               o_custkey, o_orderkey AS ordinal
        FROM $orders""",
    "backing": """
        SELECT policy_id, position, table_asset_id, concat('PROD_DB.ASSET_', table_asset_id) AS uid
        FROM (SELECT DISTINCT l_orderkey AS policy_id, l_linenumber AS position, l_partkey AS table_asset_id
              FROM $lineitem) AS lines""",
    "versions": """
        SELECT l_orderkey AS policy_id, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linenumber END AS rule_version,
               l_partkey * 10000000000 + l_suppkey * 100000
                   + CAST(round(l_quantity * 100) AS BIGINT) AS position
        FROM $lineitem""",
    # Tags.
    "tag_links": """
        SELECT CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS tag_id, p_partkey AS asset_id FROM $part""",
    "tags": """
        SELECT DISTINCT CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS tag_id, p_brand AS tag_name FROM $part""",
    # Notification groups.
    "source_groups": """
        SELECT s_suppkey AS id, s_name AS name, s_nationkey % 3 AS kind, s_suppkey AS ordinal FROM $supplier""",
    "target_groups": """
        SELECT s_suppkey + 5000 AS id,
               CASE WHEN s_suppkey % 4 = 0 THEN concat('  ', upper(s_name), ' ')
                   WHEN s_suppkey % 13 = 0 THEN ' ' ELSE s_name END AS name,
               s_suppkey AS ordinal
        FROM $supplier WHERE s_acctbal >= 1000
        UNION ALL
        SELECT s_suppkey + 1000005000, s_name, s_suppkey + 1000000000
        FROM $supplier WHERE s_acctbal > 8000""",
    # Configurations and profiles, as JSON text.
    "expected_configs": """
        SELECT concat('DEV_DB.', n_name, '.', c_name) AS target_uid, c_custkey,
               CASE WHEN c_custkey % 29 = 3 THEN '{"assetConfiguration":'
                    WHEN c_custkey % 29 = 4 THEN '{"assetConfiguration":null}'
                    WHEN c_custkey % 29 = 5 THEN '{"other":1}'
                    ELSE concat('{"assetConfiguration":{"assetId":', c_custkey,
                        ',"scheduled":', CASE WHEN c_custkey % 2 = 0 THEN 'true' ELSE 'false' END,
                        ',"timeZone":"', CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'UTC' END,
                        '","columnLevel":', c_custkey % 4,
                        ',"resourceStrategyType":"', lower(c_mktsegment),
                        '","profileAnomalyModelSensitivity":', CASE WHEN c_custkey % 5 = 0 THEN 'null' ELSE '1.5' END,
                        ',"sparkResourceConfig":', CASE WHEN c_custkey % 6 = 0 THEN '{}' ELSE '{"cores":2}' END,
                        ',"freshnessColumnInfo":{"assetId":', c_custkey, ',"column":"ts"}',
                        ',"extra":["', c_name, '"]}}') END AS config_json
        FROM $customer JOIN $nation ON c_nationkey = n_nationkey""",
    "actual_configs": """
        SELECT c_custkey + 1000000000 AS asset_id,
               concat('{"assetConfiguration":{"assetId":', c_custkey + 1000000000,
                   CASE WHEN c_custkey % 11 = 0 THEN '' ELSE concat(',"scheduled":',
                       CASE WHEN c_custkey % 2 = 0 THEN 'true' ELSE 'false' END) END,
                   ',"timeZone":"', CASE WHEN c_custkey % 3 = 0 OR c_custkey % 17 = 1 THEN '' ELSE 'UTC' END,
                   '","columnLevel":', CASE WHEN c_custkey % 7 = 0 THEN 9 ELSE c_custkey % 4 END,
                   ',"resourceStrategyType":"', lower(c_mktsegment),
                   '","profileAnomalyModelSensitivity":', CASE WHEN c_custkey % 5 = 0 THEN 'null' ELSE '1.5' END,
                   ',"sparkResourceConfig":', CASE WHEN c_custkey % 6 = 0 THEN '{}' ELSE '{"cores":2}' END,
                   ',"markerConfiguration":', CASE WHEN c_custkey % 4 = 0 THEN '""' ELSE '"m"' END,
                   '}}') AS actual_json
        FROM $customer WHERE c_acctbal < 9500""",
    "target_ids": """
        SELECT concat('DEV_DB.', n_name, '.', c_name) AS target_uid, c_custkey + 1000000000 AS asset_id
        FROM $customer JOIN $nation ON c_nationkey = n_nationkey WHERE c_acctbal >= 1000""",
    "profiles": """
        SELECT concat('DEV_DB.', n_name, '.', c_name) AS target_uid, c_custkey,
               c_custkey + 1000000000 AS asset_id, c_custkey AS id1, c_custkey * 7 AS id2,
               CASE WHEN c_custkey % 31 = 3 THEN '{"profileSettingsConfigs":{'
                    WHEN c_custkey % 31 = 4 THEN '{"profileSettingsConfigs":{"enabled":true,"schedule":""}}'
                    ELSE concat('{"profileSettingsConfigs":{"enabled":',
                        CASE WHEN c_custkey % 2 = 0 THEN 'true' ELSE 'false' END,
                        ',"schedule":"', CASE WHEN c_custkey % 3 = 0 THEN '' ELSE '0 0 * * *' END,
                        '","profileNotificationChannels":{"configuredNotificationGroupIds":',
                        CASE WHEN c_custkey % 4 = 0 THEN '[]'
                             ELSE concat('[', c_custkey, ',', c_custkey * 7, ']') END,
                        '}}}') END AS profile_json
        FROM $customer JOIN $nation ON c_nationkey = n_nationkey""",
    "stored_profiles": """
        SELECT target_uid, asset_id, profile_json FROM $profiles JOIN $customer USING (c_custkey)
        WHERE c_mktsegment <> 'MACHINERY'""",
    "duplicate_choices": """
        SELECT c_custkey AS asset_id, CASE WHEN c_mktsegment = 'BUILDING' THEN 2 END AS option
        FROM $customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""",
    # SQL policies are web pages: their host names have the form of table references.
    "source_sql": """
        SELECT concat('pol_', page_id % 40) AS policy, html AS sql FROM $pages""",
    "sink_sql": """
        SELECT concat('pol_', page_id % 40) AS policy, replace(html, 'blog.', 'news.') AS sql
        FROM $pages WHERE url LIKE 'https%'""",
    # Status and request logs are events.
    "status_log": """
        SELECT user_id AS asset_id,
               CASE event_type WHEN 'signup' THEN 'RUNNING' WHEN 'purchase' THEN 'Success' WHEN 'error' THEN 'FAILED'
                   WHEN 'view' THEN 'In Progress' ELSE 'QUEUED' END AS status, ts
        FROM $events""",
    "request_log": """
        SELECT user_id AS asset_id,
               CASE WHEN event_id % 7 = 0 THEN 'Tag ALREADY there' ELSE 'done' END AS message,
               CASE WHEN event_id % 11 = 0 THEN 'already_exists' ELSE 'ok' END AS status,
               CASE WHEN event_id % 13 = 0 THEN 409 ELSE 200 END AS code,
               CASE WHEN event_id % 971 = 5 THEN 'HTTP 500' WHEN event_id % 17 = 5 THEN '409 Client Error'
                    WHEN event_id % 19 = 5 THEN 'Conflict' END AS error
        FROM $events""",
    "uploads": """
        SELECT concat('bundle-', o_orderkey, '.zip') AS file,
               CASE WHEN o_orderkey % 8 = 0 THEN '' ELSE concat('u-', o_orderkey) END AS uuid,
               concat('{"totalPolicyCount":', o_orderkey % 50, ',"conflictingPolicies":', o_custkey % 3,
                   ',"totalDataQualityPolicyCount":', o_orderkey % 7, ',"preChecks":"n/a"}') AS response,
               o_orderkey % 9 <> 0 AS applied
        FROM $orders""",
}


def _needs(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\$([a-z]\w*)", text)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def snapshot(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table or derived snapshot as a DataFrame."""
    if name in TABLES:
        return table(spark, sf_dir, name)
    text = SNAPSHOTS[name]
    inputs = {need: snapshot(spark, sf_dir, need) for need in _needs(text)}
    escaped = text.replace("{", "{{").replace("}", "}}")
    return spark.sql(re.sub(r"\$([a-z]\w*)", r"{\1}", escaped), **inputs)


def plain_sql(text: str) -> str:
    """A query over ``$name`` snapshots as one self-contained statement over the driver's tables."""
    ordered: dict[str, str] = {}

    def visit(name: str) -> None:
        if name in SNAPSHOTS and name not in ordered:
            for need in _needs(SNAPSHOTS[name]):
                visit(need)
            ordered[name] = SNAPSHOTS[name]

    for name in _needs(text):
        visit(name)
    body = re.sub(r"\$([a-z]\w*)", r"\1", text).strip()
    if not ordered:
        return body
    views = ",\n".join(f"{name} AS ({re.sub(r'[$]([a-z]\w*)', r'\1', sql)})" for name, sql in ordered.items())
    if body[:5].upper() == "WITH ":
        return f"WITH {views},\n{body[5:]}"
    return f"WITH {views}\n{body}"
