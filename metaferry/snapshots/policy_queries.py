"""Queries over policies, their backing assets, export batches, versions and imports."""

from __future__ import annotations

from pyspark.sql import functions as F

from metaferry.functions import text
from metaferry.operators import imports, inventory, policy, ranking
from metaferry.snapshots.asset_queries import MERGED, RENAMES, asset_map
from metaferry.snapshots.registry import Inputs, query

_KIND = """CASE WHEN NOT is_segmented THEN 'non_segmented' WHEN engine_type = 'SPARK' THEN 'segmented_spark'
    WHEN engine_type = 'JDBC_SQL' THEN 'segmented_jdbc' END"""


@query("policy_classes", f"SELECT id, coalesce({_KIND}, 'other') AS kind FROM $policies")
def _(i: Inputs):
    kind = policy.policy_class(F.col("is_segmented"), F.col("engine_type"))
    return i.policies.select("id", F.coalesce(kind, F.lit("other")).alias("kind"))


@query(
    "policy_statistics",
    f"""SELECT status, count(*) AS total_policies, count(*) FILTER ({_KIND} = 'segmented_spark') AS segmented_spark,
           count(*) FILTER ({_KIND} = 'segmented_jdbc') AS segmented_jdbc,
           count(*) FILTER ({_KIND} = 'non_segmented') AS non_segmented FROM $policies GROUP BY status""",
)
def _(i: Inputs):
    return policy.policy_statistics(i.policies, "status")


@query(
    "policy_statistics_by_level",
    f"""SELECT CASE grouping_id(type, status) WHEN 0 THEN 'member' WHEN 1 THEN 'bundle' ELSE 'total' END AS level,
           coalesce(type, '-') AS bundle, coalesce(status, '-') AS member,
           count(*) AS total_policies, count(*) FILTER ({_KIND} = 'segmented_spark') AS segmented_spark,
           count(*) FILTER ({_KIND} = 'segmented_jdbc') AS segmented_jdbc,
           count(*) FILTER ({_KIND} = 'non_segmented') AS non_segmented
    FROM $policies GROUP BY GROUPING SETS ((type, status), (type), ())""",
)
def _(i: Inputs):
    found = policy.statistics_by_level(i.policies, "type", "status")
    names = [F.coalesce(of, F.lit("-")).alias(name) for of, name in (("type", "bundle"), ("status", "member"))]
    return found.select("level", *names, *found.columns[3:])


@query(
    "segmented_spark_uids",
    """SELECT DISTINCT uid AS source_env, replace(uid, 'PROD_DB.', 'DEV_DB.') AS target_env
    FROM $backing JOIN $policies ON policy_id = id WHERE is_segmented AND engine_type = 'SPARK' ORDER BY 1""",
)
def _(i: Inputs):
    from metaferry.operators.documents import uid_table

    return uid_table(policy.segmented_spark_uids(i.policies, i.backing), RENAMES)


@query("sql_policies", "SELECT id, name FROM $policies WHERE sub_type = 'SQL'")
def _(i: Inputs):
    return policy.is_sql_policy(i.policies.withColumnRenamed("sub_type", "subType")).select("id", "name")


@query(
    "sql_policy_counts",
    """SELECT count(*) FILTER (sub_type = 'SQL') AS sql_policies,
           count(*) FILTER (sub_type <> 'SQL') AS column_policies FROM $policies""",
)
def _(i: Inputs):
    return policy.sql_policy_counts(i.policies)


@query("policies_by_status", "SELECT id, status FROM $policies WHERE status IN ('ENABLED', 'ACTIVE')")
def _(i: Inputs):
    return inventory.with_status(i.policies, "ENABLED,ACTIVE").select("id", "status")


_KNOWN = f"""{MERGED}, known AS (SELECT CAST(source_id AS BIGINT) AS source_id FROM merged)"""


def _known(i: Inputs):
    return asset_map(i).select(F.col("source_id").cast("long").alias("table_asset_id"))


def _views(i: Inputs):
    return inventory.unmatched_views(i.source_inventory, asset_map(i)).select("source_id", "source_uid")


@query(
    "policies_on_target",
    f"""WITH {_KNOWN}, b AS (SELECT * FROM $backing WHERE table_asset_id <> 0)
    SELECT id, name FROM $policies
    WHERE id NOT IN (SELECT policy_id FROM b)
       OR id IN (SELECT policy_id FROM b WHERE table_asset_id IN (SELECT source_id FROM known))""",
)
def _(i: Inputs):
    return policy.policies_on_target(i.policies, i.backing, _known(i)).select("id", "name")


_VIEWS = """views AS (SELECT source_id, source_uid FROM $source_inventory
    WHERE asset_type = 'SQL_VIEW' AND source_id NOT IN (SELECT source_id FROM known))"""


@query(
    "policies_on_target_or_view",
    f"""WITH {_KNOWN}, {_VIEWS}, b AS (SELECT * FROM $backing WHERE table_asset_id <> 0)
    SELECT id, name FROM $policies
    WHERE id NOT IN (SELECT policy_id FROM b)
       OR id IN (SELECT policy_id FROM b WHERE table_asset_id IN (SELECT source_id FROM known)
                    OR table_asset_id IN (SELECT source_id FROM views))""",
)
def _(i: Inputs):
    kept, _ = policy.policies_on_target_or_view(i.policies, i.backing, _known(i), _views(i))
    return kept.select("id", "name")


@query(
    "policies_using_views",
    f"""WITH {_KNOWN}, {_VIEWS} SELECT v.source_id AS asset_id, v.source_uid AS source_asset_uid, p.id AS policy_id,
           p.name AS policy_name
    FROM $backing b JOIN views v ON b.table_asset_id = v.source_id JOIN $policies p ON b.policy_id = p.id""",
)
def _(i: Inputs):
    return policy.policies_on_target_or_view(i.policies, i.backing, _known(i), _views(i))[1]


_DETAILS = """details AS (
    SELECT b.policy_id, b.position, b.table_asset_id, a.asset_type, m.id AS assembly_id, m.name AS assembly_name,
           m.source_type
    FROM $backing b LEFT JOIN $assets a ON b.table_asset_id = a.id
         LEFT JOIN $assemblies m ON a.assembly_id = m.id AND a.assembly_id <> 0
    WHERE b.table_asset_id <> 0)"""

_LIST = f"""{_DETAILS}, policy_rows AS (
    SELECT p.id, p.type, p.engine_type AS "engineType",
           coalesce(string_agg(d.table_asset_id, ',' ORDER BY position, d.table_asset_id), '') AS "tableAssetIds",
           coalesce(string_agg(DISTINCT CAST(d.assembly_id AS VARCHAR), ',' ORDER BY CAST(d.assembly_id AS VARCHAR)), '')
               AS "assemblyIds",
           coalesce(string_agg(DISTINCT d.assembly_name, ',' ORDER BY d.assembly_name), '') AS "assemblyNames",
           coalesce(string_agg(DISTINCT d.source_type, ',' ORDER BY d.source_type), '') AS "sourceTypes",
           p.sub_type AS "subType", p.name AS "policyName",
           CASE WHEN count(d.policy_id) = 0 THEN '' ELSE
               string_agg(coalesce(d.asset_type, ''), ',' ORDER BY position, d.table_asset_id) END AS "tableAssetIdsTypes"
    FROM $policies p LEFT JOIN details d ON p.id = d.policy_id
    GROUP BY p.id, p.type, p.engine_type, p.sub_type, p.name)"""


def policy_rows(i: Inputs):
    return policy.policy_list(i.policies, i.backing, i.assets, i.assemblies)


@query("policy_inventory", f"WITH {_LIST} SELECT * FROM policy_rows ORDER BY id")
def _(i: Inputs):
    return policy.order_by_id(policy_rows(i))


@query(
    "policy_assets",
    f"""WITH {_DETAILS} SELECT policy_id, position, table_asset_id, coalesce(asset_type, '-') AS asset_type FROM details""",
)
def _(i: Inputs):
    return policy.policy_assets(i.backing, i.assets).withColumn("asset_type", F.coalesce("asset_type", F.lit("-")))


@query(
    "positions_in_group_int",
    """SELECT o_orderkey, o_orderstatus AS status,
           row_number() OVER (PARTITION BY o_orderstatus ORDER BY CAST(o_orderkey AS INTEGER)) - 1 AS position FROM $orders""",
)
def _(i: Inputs):
    rows = i.orders.select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_orderkey").cast("int").alias("o"))
    return ranking.positions(rows, "status", "o").select("o_orderkey", "status", "position")


@query(
    "view_policies",
    f"""WITH {_LIST} SELECT id, "policyName" FROM policy_rows
    WHERE list_contains(string_split("tableAssetIdsTypes", ','), 'SQL_VIEW')""",
)
def _(i: Inputs):
    return policy.references_view(policy_rows(i)).select("id", "policyName")


@query(
    "data_source_names",
    f"WITH {_LIST} SELECT DISTINCT trim(unnest(string_split(\"assemblyNames\", ','))) AS name FROM policy_rows WHERE \"assemblyNames\" <> ''",
)
def _(i: Inputs):
    return policy.data_source_names(policy_rows(i))


def _share_sql(value: str, source: str) -> str:
    return f"""SELECT value, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS share
    FROM (SELECT {value} AS value FROM {source}) AS t WHERE value IS NOT NULL GROUP BY value"""


@query("policy_type_shares", _share_sql("CASE WHEN type = '' THEN 'UNKNOWN' ELSE type END", "$policies"))
def _(i: Inputs):
    return policy.type_shares(i.policies)


@query("policy_engine_shares", _share_sql("engine_type", "$policies"))
def _(i: Inputs):
    return policy.engine_shares(i.policies)


@query("assembly_shares", f"WITH {_DETAILS} " + _share_sql("assembly_name", "details"))
def _(i: Inputs):
    return policy.assembly_shares(policy.backing_details(i.backing, i.assets, i.assemblies))


@query("source_type_shares", f"WITH {_DETAILS} " + _share_sql("source_type", "details"))
def _(i: Inputs):
    return policy.source_type_shares(policy.backing_details(i.backing, i.assets, i.assemblies))


@query(
    "categories_by_source",
    f"""WITH {_LIST} SELECT id, split_part("sourceTypes", ',', 1) AS category FROM policy_rows WHERE "sourceTypes" <> ''""",
)
def _(i: Inputs):
    return policy.categorised(policy_rows(i), "source-types").select("id", "category")


@query(
    "categories_by_assembly",
    f"""WITH {_LIST} SELECT id, split_part("assemblyNames", ',', 1) AS category FROM policy_rows
    WHERE split_part("assemblyNames", ',', 1) = 'NATION_11'""",
)
def _(i: Inputs):
    return policy.categorised(policy_rows(i), "assemblies", "NATION_11").select("id", "category")


def _manifest_sql(category: str, size: str, name: str) -> str:
    return f"""WITH p AS (SELECT id, {category} AS category, {size} AS size FROM $policies WHERE {category} <> ''),
    n AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY id) - 1 AS position FROM p),
    b AS (SELECT *, position // size AS batch FROM n)
    SELECT category, batch, min(position) AS first_position, max(position) AS last_position, count(*) AS policies,
           string_agg(id, ',' ORDER BY position) AS policy_ids,
           concat({name}, '-01-31-2025-10-00-', min(position), '-', max(position), '.zip') AS file_name
    FROM b GROUP BY category, batch"""


def _manifest(i: Inputs, export_type: str | None = None):
    rows = i.policies.select("id", "type", F.col("engine_type").alias("engineType"), "ordinal")
    return policy.batch_manifest(rows, "01-31-2025-10-00", export_type)


@query(
    "batch_manifest_by_type",
    _manifest_sql("type", "CASE WHEN type = 'EQUALITY' THEN 2 ELSE 50 END", "lower(category)"),
)
def _(i: Inputs):
    return _manifest(i)


@query(
    "batch_manifest_by_engine",
    _manifest_sql("engine_type", "50", "lower(replace(replace(replace(category, '(', ''), ')', ''), ' ', '_'))"),
)
def _(i: Inputs):
    return _manifest(i, "engine-types")


@query(
    "batch_summary",
    """SELECT type AS category, count(*) AS policies,
           CAST(ceil(count(*) / CASE WHEN type = 'EQUALITY' THEN 2.0 ELSE 50.0 END) AS BIGINT) AS batches
    FROM $policies WHERE type <> '' GROUP BY type""",
)
def _(i: Inputs):
    return policy.category_summary(_manifest(i))


@query(
    "slugs_and_pages",
    """SELECT page_id, lower(replace(rtrim(regexp_replace(url, '[^\\p{L}\\p{N} _-]', '', 'g')), ' ', '_')) AS slug,
           CAST(ceil(length(html) / 100.0) AS BIGINT) AS page_count FROM $pages""",
)
def _(i: Inputs):
    return i.pages.select(
        "page_id", text.slug(F.col("url")).alias("slug"), text.page_count(F.length("html"), 100).alias("page_count")
    )


@query(
    "numeric_ids",
    """SELECT CAST(o_orderkey AS VARCHAR) AS raw, o_orderkey AS id FROM $orders WHERE o_orderkey % 3 <> 0""",
)
def _(i: Inputs):
    key = F.col("o_orderkey")
    raw = F.when(key % 3 == 0, F.concat(F.lit("r"), key)).otherwise(key.cast("string"))
    rows = i.orders.select(raw.alias("raw"))
    return rows.withColumn("id", text.whole_number(F.col("raw"))).filter(F.col("id").isNotNull())


_ITEMS = """WITH p AS (SELECT id, CASE WHEN id % 2 = 0 THEN 'SCHEMA_DRIFT' ELSE 'DATA_DRIFT' END AS type,
        id % 4 AS n, 1 + (id * 5) % 3 AS a, 1 + (id * 7) % 3 AS b, 1 + (id * 11) % 3 AS c FROM $policies),
    v AS (SELECT id, type, n, 1 AS position, CASE WHEN a = 3 THEN 0 ELSE a END AS version FROM p WHERE n >= 1
          UNION ALL SELECT id, type, n, 2, CASE WHEN b = 3 THEN 0 ELSE b END FROM p WHERE n >= 2
          UNION ALL SELECT id, type, n, 3, CASE WHEN c = 3 THEN 0 ELSE c END FROM p WHERE n >= 3)"""


def _versioned(i: Inputs):
    key = F.col("id")

    def item(position: int, factor: int):
        version = 1 + (key * factor) % 3
        return F.struct(F.lit(position).alias("position"), F.when(version != 3, version).alias("ruleVersion"))

    items = F.slice(F.array(item(1, 5), item(2, 7), item(3, 11)), F.lit(1), (key % 4).cast("int"))
    kind = F.when(key % 2 == 0, "SCHEMA_DRIFT").otherwise("DATA_DRIFT")
    return i.policies.select("id", kind.alias("type"), items.alias("items"))


@query(
    "pruned_versions",
    _ITEMS
    + """ SELECT id, type, position, version FROM v
    QUALIFY type <> 'SCHEMA_DRIFT' OR row_number() OVER (PARTITION BY id ORDER BY version DESC, position) = 1""",
)
def _(i: Inputs):
    pruned = policy.prune_versions(_versioned(i)).select("id", "type", F.explode("items").alias("_i"))
    return pruned.select(
        "id", "type", F.col("_i.position").alias("position"), F.coalesce("_i.ruleVersion", F.lit(0)).alias("version")
    )


@query(
    "version_counts",
    _ITEMS
    + """ SELECT (SELECT count(*) FROM p) AS policies_processed,
        (SELECT CAST(sum(n - 1) AS BIGINT) FROM p WHERE type = 'SCHEMA_DRIFT' AND n > 1) AS versions_removed""",
)
def _(i: Inputs):
    before = _versioned(i)
    return policy.version_counts(before, policy.prune_versions(before))


@query(
    "nested_backing",
    """SELECT id AS policy_id, 0 AS position, o_custkey AS table_asset_id FROM $policies WHERE o_custkey <> 0
    UNION ALL SELECT id, 2, o_custkey + 1 FROM $policies""",
)
def _(i: Inputs):
    def asset(value):
        return F.struct(value.cast("long").alias("table_asset_id"))

    listed = F.array(asset(F.col("o_custkey")), asset(F.lit(0)), asset(F.col("o_custkey") + 1), asset(F.lit(None)))
    return policy.backing_rows(i.policies.select("id", listed.alias("backing_assets")))


@query(
    "import_statistics",
    """WITH u AS (SELECT *, uuid <> '' AS up, uuid <> '' AND applied AS done,
        CAST(json_extract_string(response, '$.totalPolicyCount') AS BIGINT) AS total,
        CAST(json_extract_string(response, '$.conflictingPolicies') AS BIGINT) AS conflicts,
        CAST(json_extract_string(response, '$.totalDataQualityPolicyCount') AS BIGINT) AS quality FROM $uploads)
    SELECT CAST(sum(total) FILTER (done) AS BIGINT) AS "totalPolicyCount",
           CAST(sum(conflicts) FILTER (done) AS BIGINT) AS "conflictingPolicies",
           CAST(sum(quality) FILTER (done) AS BIGINT) AS "totalDataQualityPolicyCount",
           """
    + ", ".join(
        f'CAST(0 AS BIGINT) AS "{n}"'
        for n in imports.COUNTERS
        if n not in ("totalPolicyCount", "conflictingPolicies", "totalDataQualityPolicyCount")
    )
    + """, count(*) FILTER (done) AS files_processed, count(*) FILTER (NOT done) AS files_failed,
           count(*) FILTER (up) AS upload_configs_successful, count(*) FILTER (NOT up) AS upload_configs_failed,
           count(*) FILTER (done) AS apply_configs_successful, count(*) FILTER (up AND NOT done) AS apply_configs_failed
    FROM u""",
)
def _(i: Inputs):
    return imports.import_statistics(i.uploads)


@query("applied_uuids", "SELECT file, uuid FROM $uploads WHERE applied AND uuid <> ''")
def _(i: Inputs):
    return imports.applied_uuids(i.uploads)
