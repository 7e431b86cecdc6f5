"""Queries over asset inventories, mappings, duplicates and tags."""

from __future__ import annotations

from pyspark.sql import functions as F

from metaferry.functions import rename, text
from metaferry.operators import inventory, ranking, tags
from metaferry.plans import assets as jobs
from metaferry.snapshots.registry import Inputs, query

# Renames between the two environments; the last pair must not act on the result of the first.
RENAMES = [("PROD_DB", "DEV_DB"), ("NATION_1", "COUNTRY_1"), ("DEV_DB", "TEST_DB")]

_RENAMED = (
    "regexp_replace(regexp_replace({0}, '\\bPROD_DB\\b', 'DEV_DB', 'g'), '\\bNATION_1\\b', 'COUNTRY_1', 'g')"
)
MERGED = """
    latest AS (SELECT source_uid AS uid, max(source_id) AS target_id FROM $target_inventory GROUP BY source_uid),
    merged AS (
        SELECT CAST(s.source_id AS VARCHAR) AS source_id, s.source_uid, CAST(t.target_id AS VARCHAR) AS target_id,
               t.uid AS target_uid, s.tags, s.asset_type AS source_asset_type
        FROM $source_inventory s JOIN latest t
          ON replace(replace(s.source_uid, 'PROD_DB.', 'DEV_DB.'), '.NATION_1.', '.COUNTRY_1.') = t.uid)"""


def asset_map(i: Inputs):
    return inventory.merge_assets(i.source_inventory, i.target_inventory, RENAMES)


@query("transform_and_merge", f"WITH {MERGED} SELECT * FROM merged")
def _(i: Inputs):
    return asset_map(i)


@query(
    "unmatched_sql_views",
    f"""WITH {MERGED}
    SELECT source_uid, source_id, target_uid, tags, asset_type FROM $source_inventory
    WHERE asset_type = 'SQL_VIEW' AND source_uid NOT IN (SELECT source_uid FROM merged)""",
)
def _(i: Inputs):
    rows = i.source_inventory.select("source_uid", "source_id", "target_uid", "tags", "asset_type")
    return inventory.unmatched_views(rows, asset_map(i))


@query(
    "mapping_coverage",
    f"""WITH {MERGED}
    SELECT count(*) AS source_rows,
           CAST(sum(CASE WHEN source_uid LIKE 'PROD_DB.NATION_1.%' THEN 2 ELSE 1 END) AS BIGINT) AS renames_applied,
           (SELECT count(*) FROM merged) AS matched_rows,
           count(*) - (SELECT count(*) FROM merged) AS unmatched_rows,
           round(100.0 * (SELECT count(*) FROM merged) / count(*), 6) AS match_rate
    FROM source_inventory""",
)
def _(i: Inputs):
    return inventory.mapping_coverage(i.source_inventory, i.target_inventory, RENAMES)


@query(
    "rename_uids",
    f"""SELECT source_id, {_RENAMED.format('target_uid')} AS target_uid,
           regexp_replace({_RENAMED.format('target_uid')}, '\\bDEV_DB\\b', 'TEST_DB', 'g') AS target_uid_in_turn,
           replace(source_uid, 'NATION_1', 'N1') AS replaced_text
    FROM $source_inventory""",
)
def _(i: Inputs):
    uid = F.col("target_uid")
    return i.source_inventory.select(
        "source_id",
        rename.rename_words(uid, RENAMES).alias("target_uid"),
        rename.rename_words_in_turn(uid, RENAMES).alias("target_uid_in_turn"),
        rename.replace_text(F.col("source_uid"), "NATION_1", "N1").alias("replaced_text"),
    )


@query(
    "rename_columns",
    """SELECT source_uid, source_id, replace(replace(target_uid, 'PROD_DB.', 'DEV_DB.'), '.NATION_1.', '.COUNTRY_1.')
           AS target_uid, regexp_replace(tags, '\\bbuilding\\b', 'house', 'g') AS tags
    FROM $source_inventory""",
)
def _(i: Inputs):
    rows = i.source_inventory.select("source_uid", "source_id", "target_uid", "tags")
    return rename.rename_columns(rows, [*RENAMES, ("building", "house")])


@query(
    "rename_statistics",
    """SELECT count(*) AS values_seen, count(*) FILTER (source_uid LIKE '%.NATION_1.%') AS values_changed,
           count(*) FILTER (source_uid NOT LIKE '%.NATION_1.%') AS values_unchanged
    FROM $source_inventory""",
)
def _(i: Inputs):
    rows = rename.rename_target_uid(i.source_inventory, [("NATION_1", "COUNTRY_1")])
    return rename.count_changes(rows, "source_uid", "target_uid")


@query(
    "id_map",
    """WITH e AS (SELECT event_id % 1000 AS source_id, event_id, user_id FROM $events)
    SELECT source_id, max_by(event_id, event_id) AS target_id,
           concat('uid_', max_by(user_id, event_id)) AS target_uid FROM e GROUP BY source_id""",
)
def _(i: Inputs):
    rows = i.events.select(
        (F.col("event_id") % 1000).alias("source_id"),
        F.col("event_id").alias("target_id"),
        F.concat(F.lit("uid_"), "user_id").alias("target_uid"),
        F.col("event_id").alias("ordinal"),
    )
    return inventory.id_map(rows, "ordinal")


@query(
    "migrated_assets",
    f"""WITH {MERGED}
    SELECT source_id, source_uid, target_id, target_uid, trim(tags) AS tags FROM merged
    WHERE trim(tags) <> '' OR lower(source_asset_type) IN ('table', 'sql_view', 'view', 'file', 'kafka_topic')""",
)
def _(i: Inputs):
    return inventory.migrated_assets(asset_map(i))


@query(
    "uid_pairs",
    """SELECT source_uid, trim(tags) AS target_uid FROM $source_inventory WHERE trim(tags) <> ''""",
)
def _(i: Inputs):
    rows = i.source_inventory.select("source_uid", F.col("tags").alias("target_uid"))
    return inventory.uid_pairs(rows).withColumn("target_uid", text.strip(F.col("target_uid")))


@query(
    "environment_pairs",
    """SELECT trim(tags) AS source_env, source_uid AS target_env FROM $source_inventory WHERE trim(tags) <> ''""",
)
def _(i: Inputs):
    rows = i.source_inventory.select(
        F.col("tags").alias("source_env"), F.concat(F.lit("\t"), "source_uid", F.lit(" \n")).alias("target_env")
    )
    return inventory.clean_pairs(rows)


@query("single_column", "SELECT trim(tags) AS uid FROM $source_inventory WHERE trim(tags) <> ''")
def _(i: Inputs):
    return inventory.clean_single(i.source_inventory.select(F.col("tags").alias("uid")))


@query(
    "filtered_inventory",
    """SELECT source_uid, source_id, assembly_id, asset_type FROM $source_inventory
    WHERE asset_type_id IN (0, 3) AND assembly_id IN (1, 5, 9, 13)""",
)
def _(i: Inputs):
    rows = inventory.filter_inventory(i.source_inventory, "0, 3", "1,5,9,13")
    return rows.select("source_uid", "source_id", "assembly_id", "asset_type")


@query(
    "ordered_inventory",
    """SELECT source_uid, source_id, asset_type FROM $source_inventory ORDER BY source_uid, source_id""",
)
def _(i: Inputs):
    return inventory.order_inventory(i.source_inventory).select("source_uid", "source_id", "asset_type")


@query(
    "first_per_asset",
    """WITH o AS (SELECT o_custkey AS asset_id, o_orderkey AS ordinal, o_orderstatus AS label FROM $orders)
    SELECT asset_id, min(ordinal) AS ordinal, min_by(label, ordinal) AS label FROM o GROUP BY asset_id""",
)
def _(i: Inputs):
    return ranking.split_first(_orders(i), "asset_id", "ordinal")[0]


@query(
    "later_duplicates",
    """WITH o AS (SELECT o_custkey AS asset_id, o_orderkey AS ordinal, o_orderstatus AS label FROM $orders)
    SELECT asset_id, ordinal, label, 'Duplicate assetId found in multiple pages/threads' AS duplicate_reason
    FROM o WHERE ordinal <> (SELECT min(ordinal) FROM o AS p WHERE p.asset_id = o.asset_id)""",
)
def _(i: Inputs):
    return ranking.split_first(_orders(i), "asset_id", "ordinal")[1]


def _orders(i: Inputs):
    return i.orders.select(
        F.col("o_custkey").alias("asset_id"), F.col("o_orderkey").alias("ordinal"), F.col("o_orderstatus").alias("label")
    )


@query(
    "last_per_key",
    """SELECT source_uid, max(source_id) AS source_id, arg_max(asset_type, ordinal) AS asset_type,
           max(ordinal) AS ordinal FROM $target_inventory GROUP BY source_uid""",
)
def _(i: Inputs):
    return ranking.last_per_key(i.target_inventory, ["source_uid"], "ordinal")


@query(
    "latest_versions",
    """SELECT policy_id, coalesce(rule_version, 0) AS rule_version, position FROM $versions
    QUALIFY row_number() OVER (PARTITION BY policy_id ORDER BY coalesce(rule_version, 0) DESC, position) = 1""",
)
def _(i: Inputs):
    latest = ranking.latest_version(i.versions, "policy_id", "rule_version", "position")
    return latest.withColumn("rule_version", F.coalesce("rule_version", F.lit(0)))


@query(
    "positions_in_group",
    """SELECT o_orderstatus AS label, o_orderkey AS ordinal,
           row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1 AS position FROM $orders""",
)
def _(i: Inputs):
    return ranking.positions(_orders(i).select("label", "ordinal"), "label", "ordinal")


@query("duplicate_keys", "SELECT o_custkey AS asset_id, count(*) AS copies FROM $orders GROUP BY 1 HAVING count(*) > 1")
def _(i: Inputs):
    return ranking.duplicate_keys(_orders(i), "asset_id")


_CANDIDATES = """numbered AS (
    SELECT o_custkey AS asset_id, o_orderkey AS ordinal, o_orderstatus AS label,
           count(*) OVER (PARTITION BY o_custkey) AS copies,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS option FROM $orders)"""


@query(
    "duplicate_candidates",
    f"WITH {_CANDIDATES} SELECT asset_id, ordinal, label, copies, option FROM numbered WHERE copies > 1",
)
def _(i: Inputs):
    return ranking.candidates(_orders(i), "asset_id", "ordinal")


@query(
    "resolved_duplicates",
    f"""WITH {_CANDIDATES} SELECT n.asset_id, ordinal, label
    FROM numbered n LEFT JOIN $duplicate_choices c ON n.asset_id = c.asset_id
    WHERE copies = 1 OR n.option = c.option OR (c.asset_id IS NULL AND n.option = copies)""",
)
def _(i: Inputs):
    return ranking.resolve_duplicates(_orders(i), "asset_id", "ordinal", i.duplicate_choices, "last")[0]


@query(
    "undecided_duplicates",
    f"""WITH {_CANDIDATES} SELECT asset_id, ordinal, label, option, copies FROM numbered
    WHERE copies > 1 AND asset_id NOT IN (SELECT asset_id FROM $duplicate_choices)""",
)
def _(i: Inputs):
    return ranking.resolve_duplicates(_orders(i), "asset_id", "ordinal", i.duplicate_choices, "error")[1]


@query(
    "manual_tags",
    """SELECT c_custkey AS asset_id, concat_ws(':', CASE WHEN c_custkey % 2 = 0 THEN lower(c_mktsegment) END,
           CASE WHEN c_custkey % 3 = 0 THEN concat('tier', c_custkey % 4) END) AS tags FROM $customer""",
)
def _(i: Inputs):
    listed = F.array(
        F.struct(F.lower("c_mktsegment").alias("name"), (F.col("c_custkey") % 2 != 0).alias("autoTagged")),
        F.struct(
            F.concat(F.lit("tier"), F.col("c_custkey") % 4).alias("name"),
            F.when(F.col("c_custkey") % 3 != 0, F.lit(True)).alias("autoTagged"),
        ),
    )
    return i.customer.select(F.col("c_custkey").alias("asset_id"), inventory.manual_tags(listed).alias("tags"))


@query(
    "child_maps",
    """WITH m AS (SELECT c_custkey AS id, c_mktsegment = 'FURNITURE' AS none FROM $customer),
    kids AS (SELECT id, unnest(range(1, id % 4 + 1)) AS k FROM m WHERE NOT none)
    SELECT CAST(m.id AS VARCHAR) AS source_id, CAST(m.id + 7 AS VARCHAR) AS target_id,
           coalesce((SELECT string_agg(concat(k + id * 10, '=PROD.', k), ',' ORDER BY k) FROM kids WHERE kids.id = m.id),
               CASE WHEN none THEN '-' ELSE '' END) AS source_children,
           coalesce((SELECT string_agg(concat(k + (id - 7) * 10, '=DEV.', k), ',' ORDER BY k)
                     FROM (SELECT id + 7 AS id, k FROM kids) AS t WHERE t.id = m.id + 7),
               CASE WHEN none THEN '-' ELSE '' END) AS target_children
    FROM m""",
)
def _(i: Inputs):
    key = F.col("c_custkey")

    def children(prefix: str, shift: int):
        numbers = F.filter(F.sequence(F.lit(1), F.lit(4)), lambda k: k <= key % 4)
        listed = F.transform(
            numbers,
            lambda k: F.struct((k + key * 10).alias("asset_id"), F.concat(F.lit(prefix), k.cast("string")).alias("uid")),
        )
        known = i.customer.filter("c_mktsegment <> 'FURNITURE'")
        return known.select((key + shift).alias("asset_id"), listed.alias("child_assets"))

    mapping = i.customer.select(key.cast("string").alias("source_id"), (key + 7).cast("string").alias("target_id"))
    both = inventory.child_maps(mapping, children("PROD.", 0), children("DEV.", 7))

    def flat(name: str):
        entries = F.array_sort(F.map_entries(name))
        return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias(name)

    return both.select("source_id", "target_id", flat("source_children"), flat("target_children")).fillna("-")


@query(
    "asset_lookup",
    """SELECT source_uid, CASE WHEN asset_type IN ('FILE', 'VIEW', 'COLUMN', 'TABLE') THEN ''
               ELSE CAST(source_id AS VARCHAR) END AS asset_id,
           CASE asset_type WHEN 'FILE' THEN 'no data field' WHEN 'COLUMN' THEN 'empty data' WHEN 'TABLE' THEN 'no id'
               ELSE '' END AS reason,
           CASE WHEN asset_type IN ('FILE', 'COLUMN', 'TABLE') THEN 'failed' ELSE 'ok' END AS status
    FROM $source_inventory""",
)
def _(i: Inputs):
    kind = F.col("asset_type")
    ids = F.array(F.struct(F.when(kind != "TABLE", F.col("source_id")).alias("id")))
    none = F.filter(ids, lambda _: F.lit(False))
    data = F.when(kind == "COLUMN", none).otherwise(ids).alias("data")
    responses = i.source_inventory.filter(kind != "FILE").select("source_uid", data)
    found = inventory.lookup_asset_ids(i.source_inventory.select("source_uid"), responses, "source_uid")
    return found.withColumn("asset_id", text.or_blank(F.col("asset_id"))).fillna("")


@query(
    "profile_export",
    """WITH m AS (SELECT target_uid FROM $profiles),
    s AS (SELECT target_uid, profile_json FROM $stored_profiles)
    SELECT m.target_uid, coalesce(s.profile_json, '') AS profile_json,
           CASE WHEN s.profile_json IS NULL THEN 'failed' ELSE 'ok' END AS status,
           CASE WHEN s.profile_json IS NULL THEN 'no profile' ELSE '' END AS reason
    FROM m LEFT JOIN s ON m.target_uid = s.target_uid ORDER BY lower(m.target_uid)""",
)
def _(i: Inputs):
    stored = i.stored_profiles.select("target_uid", "profile_json")
    exported = inventory.attach_snapshot(i.profiles.select("target_uid"), stored, "target_uid", "profile_json", "no profile")
    return exported.orderBy(F.lower("target_uid")).fillna("")


_PAGED = """WITH o AS (SELECT *, o_orderkey % 6 AS kind FROM $orders)"""


def _pages(i: Inputs):
    # One page per order, in the layouts a page may have.
    body = """CASE o_orderkey % 6
        WHEN 0 THEN concat('{"assets":[{"assetId":', o_orderkey, ',"assetUid":"a', o_custkey, '"}],"items":[]}')
        WHEN 1 THEN concat('{"asset":[{"assetId":', o_orderkey, ',"assetUid":"a', o_custkey, '"}]}')
        WHEN 2 THEN concat('{"items":[{"assetId":', o_orderkey, ',"assetUid":"a', o_custkey, '"},{"assetId":1}]}')
        WHEN 3 THEN concat('{"results":[{"assetId":', o_orderkey, ',"assetUid":"a', o_custkey, '"}]}')
        WHEN 4 THEN '{"results":[]}' ELSE '{"error":"x"}' END"""
    return i.orders.select(F.col("o_orderkey").alias("page"), F.expr(body).alias("body"))


_ELEMENT = "struct<assetId: bigint, assetUid: string>"


@query(
    "page_assets",
    _PAGED
    + """ SELECT o_orderkey AS page, 0 AS position, o_orderkey AS asset_id, concat('a', o_custkey) AS asset_uid
    FROM o WHERE kind < 4
    UNION ALL SELECT o_orderkey, 1, 1, '' FROM o WHERE kind = 2""",
)
def _(i: Inputs):
    found = inventory.page_assets(_pages(i), "body", _ELEMENT)
    return found.select("page", "position", F.col("asset.assetId").alias("asset_id"), text.or_blank(F.col("asset.assetUid")).alias("asset_uid"))


@query(
    "failed_pages",
    _PAGED + " SELECT count(*) AS pages, count(*) FILTER (kind = 5) AS failed_pages FROM o",
)
def _(i: Inputs):
    return inventory.failed_pages(_pages(i), "body", _ELEMENT)


@query(
    "page_rules",
    """SELECT id, name, status FROM $policies WHERE id % 5 <> 4 AND status IN ('ENABLED', 'ACTIVE')""",
)
def _(i: Inputs):
    body = """CASE WHEN id % 5 = 4 THEN '{"rules":[]}'
        WHEN id % 2 = 0 THEN concat('{"rules":[{"rule":{"id":', id, ',"name":"', name, '","status":"', status, '"}}]}')
        ELSE concat('{"rules":[{"id":', id, ',"name":"', name, '","status":"', status, '"}]}') END"""
    pages = i.policies.select(F.expr(body).alias("body"))
    rules = inventory.page_rules(pages, "body", "id: bigint, name: string, status: string")
    return inventory.with_status(rules, "ENABLED,ACTIVE")


@query(
    "tag_assets",
    """SELECT t.tag_id, t.tag_name, l.asset_id FROM $tags t JOIN $tag_links l ON t.tag_id = l.tag_id""",
)
def _(i: Inputs):
    return tags.tag_assets(i.tags, i.tag_links)


_ENRICHED = """enriched AS (
    SELECT t.tag_id, t.tag_name, l.asset_id, a.assembly_id, a.uid AS asset_uid, a.name AS asset_name,
           b.name AS assembly_name
    FROM $tags t JOIN $tag_links l ON t.tag_id = l.tag_id JOIN $assets a ON l.asset_id = a.id
         JOIN $assemblies b ON a.assembly_id = b.id)"""


@query("enriched_tag_assets", f"WITH {_ENRICHED} SELECT * FROM enriched")
def _(i: Inputs):
    return tags.enrich_tag_assets(tags.tag_assets(i.tags, i.tag_links), i.assets, i.assemblies)


@query("enriched_tag_assets_of_one_source", f"WITH {_ENRICHED} SELECT * FROM enriched WHERE assembly_id = 7")
def _(i: Inputs):
    return tags.enrich_tag_assets(tags.tag_assets(i.tags, i.tag_links), i.assets, i.assemblies, 7)


_TRANSFER = f"""{_ENRICHED}, firsts AS (
    SELECT source_uid AS uid, arg_min(source_id, ordinal) AS id, arg_min(asset_type, ordinal) AS kind
    FROM $target_inventory GROUP BY source_uid),
    moved AS (SELECT e.*, replace(replace(asset_uid, 'PROD_DB.', 'DEV_DB.'), '.NATION_1.', '.COUNTRY_1.') AS new_uid
              FROM enriched e),
    transferred AS (
    SELECT tag_id AS "source_Tag_ID", tag_name AS "Source_Tag_Name", asset_id AS "source_Asset_ID",
           assembly_id AS "source_Assembly_ID", asset_uid AS "source_Asset_UID", new_uid AS "Target_Asset_UID",
           coalesce(CAST(f.id AS VARCHAR), '') AS "Target_Asset_ID", coalesce(f.kind, '') AS "Asset_Type",
           assembly_name AS "source_Assembly_Name"
    FROM moved LEFT JOIN firsts f ON new_uid = f.uid)"""


def _transferred(i: Inputs):
    enriched = tags.enrich_tag_assets(tags.tag_assets(i.tags, i.tag_links), i.assets, i.assemblies)
    return tags.transfer_tag_assets(enriched, i.target_inventory, RENAMES[:2])


@query("transferred_tag_assets", f"WITH {_TRANSFER} SELECT * FROM transferred")
def _(i: Inputs):
    return _transferred(i)


@query(
    "tag_rows_transferred",
    f"""WITH {_TRANSFER} SELECT "Target_Asset_ID" AS target_asset_id, "Target_Asset_UID" AS target_uid,
        "source_Asset_UID" AS source_uid, CAST("source_Asset_ID" AS VARCHAR) AS source_id, "Source_Tag_Name" AS tags
    FROM transferred WHERE "Target_Asset_ID" <> ''""",
)
def _(i: Inputs):
    return tags.tag_rows(_transferred(i)).withColumn("tags", F.array_join("tags", ":"))


@query(
    "tag_rows_import_ready",
    """SELECT '' AS target_asset_id, target_uid, source_uid, CAST(source_id AS VARCHAR) AS source_id,
           concat(split_part(tags, ':', 1), ':', trim(split_part(tags, ':', 2))) AS tags
    FROM $source_inventory WHERE source_id % 4 <> 0 AND tags <> ''""",
)
def _(i: Inputs):
    error = F.when(F.col("source_id") % 4 == 0, "failed").otherwise(" ")
    ready = tags.tag_rows(i.source_inventory.withColumn("error", error))
    return ready.withColumn("tags", F.array_join("tags", ":")).fillna("")


_PLAN = f"""WITH {MERGED},
    firsts AS (SELECT source_uid AS uid, CAST(min(source_id) AS VARCHAR) AS id FROM $target_inventory GROUP BY source_uid),
    exploded AS (SELECT target_uid, source_uid, trim(unnest(string_split(tags, ':'))) AS tag FROM merged)"""


@query(
    "tag_import_plan",
    _PLAN
    + """ SELECT firsts.id AS target_asset_id, target_uid, source_uid, tag, 'ready' AS status
    FROM exploded JOIN firsts ON target_uid = firsts.uid WHERE tag <> ''""",
)
def _(i: Inputs):
    return tags.tag_import_plan(tags.tag_rows(asset_map(i)), i.target_inventory)


_OUTCOME = """WITH r AS (SELECT asset_id, CASE
        WHEN error IS NOT NULL AND (error LIKE '%409%' OR error LIKE '%Conflict%') THEN 'already_exists'
        WHEN error IS NOT NULL THEN 'failed'
        WHEN message ILIKE '%already%' OR status = 'already_exists' OR code = 409 THEN 'already_exists'
        ELSE 'imported' END AS outcome FROM $request_log)"""


@query("tag_response_outcomes", _OUTCOME + " SELECT asset_id, outcome, count(*) AS n FROM r GROUP BY 1, 2")
def _(i: Inputs):
    outcome = tags.response_outcome(*[F.col(c) for c in ("message", "status", "code", "error")])
    return i.request_log.groupBy("asset_id", outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "tag_import_outcome",
    _OUTCOME
    + """, a AS (SELECT asset_id, count(*) FILTER (outcome = 'failed') AS failed FROM r GROUP BY 1)
    SELECT (SELECT count(*) FROM a WHERE failed = 0) AS assets_ok,
           (SELECT count(*) FROM a WHERE failed > 0) AS assets_failed,
           count(*) FILTER (outcome = 'imported') AS tags_imported,
           count(*) FILTER (outcome = 'already_exists') AS tags_already_exist,
           count(*) FILTER (outcome = 'failed') AS tags_failed FROM r""",
)
def _(i: Inputs):
    return tags.import_outcome(i.request_log)


def _rule_tags(i: Inputs):
    first = F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority"))
    second = F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.concat(F.lit("st_"), "o_orderstatus"))
    listed = F.array(F.struct(first.alias("name")), F.struct(second.alias("name")))
    rule_id = F.when(F.col("o_orderkey") % 10 == 9, F.concat(F.lit("x"), "o_orderkey")).otherwise(F.col("o_orderkey").cast("string"))
    return i.orders.select(rule_id.alias("rule_id"), F.when(F.col("o_orderkey") % 25 != 0, listed).alias("rule_tags"))


_RULE_TAGS = """WITH t AS (SELECT o_orderkey AS id,
        CASE WHEN o_orderkey % 25 <> 0 AND o_orderkey % 4 <> 0 THEN o_orderpriority END AS a,
        CASE WHEN o_orderkey % 25 <> 0 AND o_orderkey % 3 <> 0 THEN concat('st_', o_orderstatus) END AS b FROM $orders)"""


@query(
    "rule_tags",
    _RULE_TAGS
    + " SELECT id AS rule_id, concat_ws(',', a, b) AS tags FROM t WHERE id % 10 <> 9 AND (a IS NOT NULL OR b IS NOT NULL)",
)
def _(i: Inputs):
    return tags.rule_tags(_rule_tags(i))


@query(
    "rule_tag_frequency",
    _RULE_TAGS
    + """, u AS (SELECT a AS tag FROM t UNION ALL SELECT b FROM t)
    SELECT tag, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM t), 6) AS share
    FROM u WHERE tag IS NOT NULL GROUP BY tag ORDER BY n DESC, tag LIMIT 10""",
)
def _(i: Inputs):
    return tags.tag_frequency(_rule_tags(i))


@query(
    "rule_tag_coverage",
    _RULE_TAGS
    + """ SELECT count(*) AS rules, count(*) FILTER (a IS NOT NULL OR b IS NOT NULL) AS with_tags,
        count(*) FILTER (a IS NULL AND b IS NULL) AS without_tags, count(*) FILTER (id % 25 <> 0) AS lookups_ok,
        round(100.0 * count(*) FILTER (id % 25 <> 0) / count(*), 6) AS success_rate FROM t""",
)
def _(i: Inputs):
    return tags.tag_coverage(_rule_tags(i))


@query("failed_rule_pages", "SELECT count(*) AS pages, count(*) FILTER (o_orderstatus = 'P') AS failed_pages FROM $orders")
def _(i: Inputs):
    body = F.when(F.col("o_orderstatus") == "P", F.lit('{"error":1}')).otherwise(F.lit('{"rules":[{"id":1}]}'))
    return inventory.failed_rule_pages(i.orders.select(body.alias("body")), "body")


@query("inventory_preview", "SELECT source_uid, source_id FROM $source_inventory ORDER BY source_uid LIMIT 5")
def _(i: Inputs):
    return inventory.preview(i.source_inventory.select("source_uid", "source_id"), 5, "source_uid")


@query(
    "asset_inventory",
    _PAGED
    + """, rows AS (SELECT o_orderkey AS id, concat('a', o_custkey) AS uid FROM o WHERE kind < 4
        UNION ALL SELECT 1, '' FROM o WHERE kind = 2),
    ids AS (SELECT DISTINCT id FROM rows)
    SELECT ids.id AS source_id, CASE WHEN ids.id = 1 THEN (SELECT concat('a', o_custkey) FROM $orders WHERE o_orderkey = 1)
        ELSE (SELECT uid FROM rows WHERE rows.id = ids.id) END AS source_uid FROM ids WHERE ids.id <> 1
    UNION ALL SELECT 1, concat('a', o_custkey) FROM $orders WHERE o_orderkey = 1""",
)
def _(i: Inputs):
    return jobs.asset_inventory(_pages(i)).assets.select("source_id", "source_uid")
