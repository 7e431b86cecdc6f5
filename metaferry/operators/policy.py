"""Policies (rules): inventory, enrichment, statistics, export batches, versions.

``policies`` has one row per policy; its backing assets are a second table
``backing(policy_id, position, table_asset_id)`` (``backing_rows`` makes it
from nested policies), so that no step has to hold a policy with all its assets.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metaferry.functions.text import first_in_list, has_text, or_blank, slug, sort_number, split_list, strip
from metaferry.operators.joins import absent, hot_join
from metaferry.operators.ranking import batches

# Policies per export batch by policy type, 50 where not listed.
BATCH_SIZES = {
    "DATA_QUALITY": 50,
    "DATA_DRIFT": 50,
    "SCHEMA_DRIFT": 50,
    "PROFILE_ANOMALY": 50,
    "DATA_CADENCE": 50,
    "EQUALITY": 2,
}
DEFAULT_BATCH_SIZE = 50

# Columns of the policy list, in order.
POLICY_LIST_COLUMNS = (
    "id",
    "type",
    "engineType",
    "tableAssetIds",
    "assemblyIds",
    "assemblyNames",
    "sourceTypes",
    "subType",
    "policyName",
    "tableAssetIdsTypes",
)


def backing_rows(policies: DataFrame, policy_id: str = "id", assets: str = "backing_assets") -> DataFrame:
    """One row per backing asset of nested policies, in list order."""
    rows = policies.select(F.col(policy_id).alias("policy_id"), F.posexplode(assets).alias("position", "_asset"))
    return usable_backing(
        rows.select("policy_id", "position", F.col("_asset.table_asset_id").alias("table_asset_id"))
    )


def usable_backing(backing: DataFrame) -> DataFrame:
    """Backing assets with an id; null and 0 mean that there is none."""
    return backing.filter(F.col("table_asset_id") != 0)


def policy_class(segmented: Column, engine: Column) -> Column:
    """Kind of a policy by segmentation and engine; null for other segmented engines."""
    is_segmented = F.coalesce(segmented, F.lit(False))
    return (
        F.when(~is_segmented, "non_segmented")
        .when(engine == "SPARK", "segmented_spark")
        .when(engine == "JDBC_SQL", "segmented_jdbc")
    )


def policy_statistics(policies: DataFrame, by: str) -> DataFrame:
    """Policy counts per file (or any other column): all and by class."""
    kind = policy_class(F.col("is_segmented"), F.col("engine_type"))
    return policies.groupBy(by).agg(
        F.count(F.lit(1)).alias("total_policies"),
        F.count_if(kind == "segmented_spark").alias("segmented_spark"),
        F.count_if(kind == "segmented_jdbc").alias("segmented_jdbc"),
        F.count_if(kind == "non_segmented").alias("non_segmented"),
    )


def statistics_by_level(policies: DataFrame, bundle: str = "bundle", member: str = "member") -> DataFrame:
    """Policy counts per member of a bundle, per bundle and over all, in one pass: ``level`` names which."""
    kind = policy_class(F.col("is_segmented"), F.col("engine_type"))
    level = F.get(F.array(F.lit("member"), F.lit("bundle"), F.lit("invalid"), F.lit("total")), F.grouping_id().cast("int"))
    # Nulls among the names must not pass for the rows of a coarser level; grouping_id tells them apart.
    sets = [[F.col(bundle), F.col(member)], [F.col(bundle)], []]
    return policies.groupingSets(sets, F.col(bundle), F.col(member)).agg(
        level.alias("level"),
        F.count(F.lit(1)).alias("total_policies"),
        F.count_if(kind == "segmented_spark").alias("segmented_spark"),
        F.count_if(kind == "segmented_jdbc").alias("segmented_jdbc"),
        F.count_if(kind == "non_segmented").alias("non_segmented"),
    )


def segmented_spark_uids(policies: DataFrame, backing: DataFrame) -> DataFrame:
    """Distinct uids of the backing assets of segmented Spark policies."""
    kept = policies.filter(policy_class(F.col("is_segmented"), F.col("engine_type")) == "segmented_spark")
    return (
        backing.filter(F.col("uid").isNotNull())
        .join(kept.select(F.col("id").alias("policy_id")), "policy_id", "left_semi")
        .select("uid")
        .distinct()
    )


def is_sql_policy(policies: DataFrame) -> DataFrame:
    return policies.filter(F.col("subType") == "SQL")


def references_view(policy_list: DataFrame) -> DataFrame:
    """Policies one of whose backing assets is a SQL view."""
    kinds = F.split("tableAssetIdsTypes", ",")
    return policy_list.filter(F.exists(kinds, lambda kind: strip(kind) == "SQL_VIEW"))


def policies_on_target(policies: DataFrame, backing: DataFrame, known_ids: DataFrame) -> DataFrame:
    """Policies without table assets, or with at least one asset among ``known_ids(table_asset_id)``.

    The backing assets are read once, as ids, and come down to one flag per policy before they meet the policies.
    """
    known = known_ids.select("table_asset_id").distinct().withColumn("_known", F.lit(True))
    assets = usable_backing(backing).select("policy_id", "table_asset_id")
    found = F.coalesce("_known", F.lit(False))
    covered = (
        hot_join(assets, known, "table_asset_id", "left")
        .groupBy(F.col("policy_id").alias("id"))
        .agg(F.max(found).alias("_covered"))
    )
    return policies.join(covered, "id", "left").filter(F.coalesce("_covered", F.lit(True))).select(*policies.columns)


def policies_on_target_or_view(
    policies: DataFrame, backing: DataFrame, known_ids: DataFrame, view_assets: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """As ``policies_on_target``, with unmatched SQL views counted as present too.

    The second table lists those view hits: asset id, source uid, policy id and name.
    """
    views = view_assets.select(F.col("source_id").alias("table_asset_id"), F.col("source_uid").alias("source_asset_uid"))
    ids = known_ids.select("table_asset_id")
    kept = policies_on_target(policies, backing, ids.unionByName(views.select("table_asset_id")))
    view_hits = (
        hot_join(absent(usable_backing(backing), ids, "table_asset_id"), views, "table_asset_id")
        .join(policies.select(F.col("id").alias("policy_id"), F.col("name").alias("policy_name")), "policy_id")
        .select(F.col("table_asset_id").alias("asset_id"), "source_asset_uid", "policy_id", "policy_name")
    )
    return kept, view_hits


def backing_details(backing: DataFrame, assets: DataFrame, assemblies: DataFrame) -> DataFrame:
    """Backing assets with type, assembly and data source type; unknown assets stay with nulls."""
    known = assets.select(
        F.col("id").alias("table_asset_id"), "asset_type", F.nullif("assembly_id", F.lit(0)).alias("_assembly")
    )
    places = assemblies.select(
        F.col("id").alias("assembly_id"),
        F.nullif("name", F.lit("")).alias("assembly_name"),
        F.nullif("source_type", F.lit("")).alias("source_type"),
    )
    return (
        usable_backing(backing)
        .join(known, "table_asset_id", "left")
        .join(places, F.col("_assembly") == F.col("assembly_id"), "left")
        .drop("_assembly")
    )


_SOURCE_SETS = (("assembly_ids", "assembly_id"), ("assembly_names", "assembly_name"), ("source_types", "source_type"))


def _source_sets() -> list[Column]:
    """Sorted distinct data source values of a group."""
    return [F.array_sort(F.collect_set(F.col(column).cast("string"))).alias(name) for name, column in _SOURCE_SETS]


def policy_assets(backing: DataFrame, assets: DataFrame) -> DataFrame:
    """One row per policy and backing asset: policy id, position in the document, asset id and type.

    This is the form for policies of any size; ``policy_list`` holds the same as text cells.
    """
    known = assets.select(F.col("id").alias("table_asset_id"), "asset_type")
    rows = hot_join(usable_backing(backing).select("policy_id", "position", "table_asset_id"), known, "table_asset_id", "left")
    return rows.select("policy_id", "position", "table_asset_id", "asset_type")


def policy_list(policies: DataFrame, backing: DataFrame, assets: DataFrame, assemblies: DataFrame) -> DataFrame:
    """The policy list file: one row per policy with its asset and data source lists as text.

    A cell holds all assets of one policy, in document order, so these must fit
    into one value (Spark's limit is 2 GB). The backing assets are read once.
    """
    ordered = F.array_sort(F.collect_list(F.struct("position", "table_asset_id", "asset_type")))
    listed = (
        backing_details(backing, assets, assemblies)
        .groupBy(F.col("policy_id").alias("id"))
        .agg(ordered.alias("_assets"), *_source_sets())
        .withColumn("ids", F.transform("_assets", lambda e: e["table_asset_id"].cast("string")))
        .withColumn("types", F.transform("_assets", lambda e: or_blank(e["asset_type"])))
    )
    joined = policies.join(listed, "id", "left")

    def text(name: str) -> Column:
        return or_blank(F.array_join(name, ","))

    return joined.select(
        "id",
        or_blank(F.col("type")).alias("type"),
        or_blank(F.col("engine_type")).alias("engineType"),
        text("ids").alias("tableAssetIds"),
        text("assembly_ids").alias("assemblyIds"),
        text("assembly_names").alias("assemblyNames"),
        text("source_types").alias("sourceTypes"),
        or_blank(F.col("sub_type")).alias("subType"),
        or_blank(F.col("name")).alias("policyName"),
        text("types").alias("tableAssetIdsTypes"),
    )


def order_by_id(df: DataFrame, column: str = "id") -> DataFrame:
    """Numeric order of ids; ids that are not whole numbers come as 0."""
    return df.orderBy(sort_number(F.col(column)))


def shares(df: DataFrame, value: Column, name: str = "value") -> DataFrame:
    """Count and percentage of each value, of all counted rows."""
    counts = df.select(value.alias(name)).filter(F.col(name).isNotNull())
    per_value = counts.groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    # The same exchange as the counts themselves, so the rows are read once.
    total = per_value.agg(F.sum("n").alias("total")).scalar()
    return per_value.withColumn("share", F.round(F.lit(100.0) * F.col("n") / total, 6))


def type_shares(policies: DataFrame) -> DataFrame:
    return shares(policies, F.coalesce(F.nullif("type", F.lit("")), F.lit("UNKNOWN")))


def engine_shares(policies: DataFrame) -> DataFrame:
    return shares(policies, F.coalesce(F.nullif("engine_type", F.lit("")), F.lit("UNKNOWN")))


def assembly_shares(details: DataFrame) -> DataFrame:
    """Counted per backing asset, not per policy."""
    return shares(details, F.col("assembly_name"))


def source_type_shares(details: DataFrame) -> DataFrame:
    return shares(details, F.col("source_type"))


def export_category(export_type: str | None) -> Column:
    """Category of a policy list row by export type; null where it has none."""
    if export_type == "engine-types":
        value = strip(F.col("engineType"))
    elif export_type == "assemblies":
        value = first_in_list(F.col("assemblyNames"))
    elif export_type == "source-types":
        value = first_in_list(F.col("sourceTypes"))
    else:
        value = strip(F.col("type"))
    return F.nullif(value, F.lit(""))


def categorised(policies: DataFrame, export_type: str | None = None, only: str | None = None) -> DataFrame:
    """Policies that have an id and a category, optionally of one category only."""
    rows = policies.filter(has_text(F.col("id"))).withColumn("category", export_category(export_type))
    return rows.filter(F.col("category").isNotNull() if not only else F.col("category") == only)


def batch_size(category: Column, sizes: Mapping[str, int] | None = None) -> Column:
    merged = {**BATCH_SIZES, **(sizes or {})}
    default = merged.pop("default", DEFAULT_BATCH_SIZE)
    size = F.lit(default)
    for name, value in merged.items():
        size = F.when(category == name, value).otherwise(size)
    return size


def batch_manifest(
    policies: DataFrame,
    stamp: str,
    export_type: str | None = None,
    only: str | None = None,
    sizes: Mapping[str, int] | None = None,
    ordinal: str = "ordinal",
) -> DataFrame:
    """Export batches: category, first and last position, policy ids, file name.

    A batch never has more rows than its batch size, so collecting its ids is bounded.
    """
    placed = batches(
        categorised(policies, export_type, only).select("category", "id", ordinal),
        "category",
        ordinal,
        batch_size(F.col("category"), sizes),
    )
    listed = F.array_sort(F.collect_list(F.struct("position", F.col("id").cast("string").alias("id"))))
    grouped = placed.groupBy("category", "batch").agg(
        F.min("position").alias("first_position"),
        F.max("position").alias("last_position"),
        F.count(F.lit(1)).alias("policies"),
        F.array_join(F.transform(listed, lambda e: e["id"]), ",").alias("policy_ids"),
    )
    name = F.concat(
        slug(F.col("category")),
        F.lit(f"-{stamp}-"),
        F.col("first_position"),
        F.lit("-"),
        F.col("last_position"),
        F.lit(".zip"),
    )
    return grouped.withColumn("file_name", name)


def category_summary(manifest: DataFrame) -> DataFrame:
    """Policies and batches per category."""
    return manifest.groupBy("category").agg(
        F.sum("policies").alias("policies"), F.count(F.lit(1)).alias("batches")
    )


def prune_versions(policies: DataFrame) -> DataFrame:
    """Keep only the newest item of nested SCHEMA_DRIFT policies; the rest is untouched.

    A missing version counts as 0, and the first of equal versions stays.
    """
    version = lambda item: F.coalesce(item["ruleVersion"], F.lit(0))
    newest = F.array_max(F.transform("items", version))
    latest = F.slice(F.filter("items", lambda item: version(item) == newest), 1, 1)
    prunable = (F.col("type") == "SCHEMA_DRIFT") & (F.size("items") > 1)
    return policies.withColumn("items", F.when(prunable, latest).otherwise(F.col("items")))


def version_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: policies processed and versions removed."""

    def items(df: DataFrame) -> Column:
        return df.agg(F.coalesce(F.sum(F.size("items")), F.lit(0)).alias("n")).scalar()

    return before.agg(F.count(F.lit(1)).alias("policies_processed")).withColumn(
        "versions_removed", (items(before) - items(after)).cast("long")
    )


def sql_policy_counts(policies: DataFrame) -> DataFrame:
    """One row: SQL-based and column-based policies."""
    is_sql = F.coalesce(F.col("sub_type") == "SQL", F.lit(False))
    return policies.agg(
        F.count_if(is_sql).alias("sql_policies"), F.count_if(~is_sql).alias("column_policies")
    )


def data_source_names(policy_rows: DataFrame) -> DataFrame:
    """Distinct data source names in the policy list."""
    names = F.explode(split_list(F.col("assemblyNames"), ","))
    return policy_rows.select(names.alias("name")).distinct()
