"""Tags of assets and rules: export, transfer to the target, import plan and outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metaferry.functions.rename import Renames, rename_words_in_turn
from metaferry.functions.text import has_text, or_blank, split_list, strip
from metaferry.operators.inventory import first_target
from metaferry.operators.joins import hot_join


def tag_assets(tags: DataFrame, links: DataFrame) -> DataFrame:
    """Tag to asset bridge, from ``tags(tag_id, tag_name)`` and ``links(tag_id, asset_id)``."""
    return tags.join(links, "tag_id").select("tag_id", "tag_name", "asset_id")


def enrich_tag_assets(
    bridge: DataFrame, assets: DataFrame, assemblies: DataFrame, assembly_id: int | None = None
) -> DataFrame:
    """Add asset and data source details; assets not found, or outside the wanted data source, are dropped."""
    details = assets.select(
        F.col("id").alias("asset_id"),
        F.col("uid").alias("asset_uid"),
        F.col("name").alias("asset_name"),
        "assembly_id",
    )
    if assembly_id is not None:
        details = details.filter(F.col("assembly_id") == assembly_id)
    places = assemblies.select(F.col("id").alias("assembly_id"), F.col("name").alias("assembly_name"))
    return (
        bridge.join(details, "asset_id")
        .join(places, "assembly_id")
        .select("tag_id", "tag_name", "asset_id", "assembly_id", "asset_uid", "asset_name", "assembly_name")
    )


def transfer_tag_assets(enriched: DataFrame, target: DataFrame, renames: Renames, ordinal: str = "ordinal") -> DataFrame:
    """Rename asset uids one rename after the other and look the result up in the target.

    The first target row of a uid counts; rows without one stay, with blanks.
    """
    renamed = enriched.withColumn("target_uid", rename_words_in_turn(F.col("asset_uid"), renames))
    return hot_join(renamed, first_target(target, ordinal), "target_uid", "left").select(
        F.col("tag_id").alias("source_Tag_ID"),
        F.col("tag_name").alias("Source_Tag_Name"),
        F.col("asset_id").alias("source_Asset_ID"),
        F.col("assembly_id").alias("source_Assembly_ID"),
        F.col("asset_uid").alias("source_Asset_UID"),
        F.col("target_uid").alias("Target_Asset_UID"),
        or_blank(F.col("target_asset_id")).alias("Target_Asset_ID"),
        or_blank(F.col("asset_type")).alias("Asset_Type"),
        F.col("assembly_name").alias("source_Assembly_Name"),
    )


def tag_rows(df: DataFrame) -> DataFrame:
    """One shape for the three tag file layouts, told apart by their columns.

    Result: ``target_asset_id, target_uid, source_uid, source_id, tags``. Rows
    with an error, without tags or (transferred layout) without a target are dropped.
    """
    names = set(df.columns)
    if {"Target_Asset_ID", "Source_Tag_Name"} <= names:
        return df.filter(has_text(F.col("Target_Asset_ID")) & has_text(F.col("Source_Tag_Name"))).select(
            strip(F.col("Target_Asset_ID").cast("string")).alias("target_asset_id"),
            F.col("Target_Asset_UID").alias("target_uid"),
            F.col("source_Asset_UID").alias("source_uid"),
            F.col("source_Asset_ID").cast("string").alias("source_id"),
            F.array(strip(F.col("Source_Tag_Name"))).alias("tags"),
        )
    if not {"source_uid", "target_uid", "tags"} <= names:
        raise ValueError(f"not a tag file: {df.columns}")
    rows = df.filter(~has_text(F.col("error"))) if "error" in names else df
    return (
        rows.withColumn("_tags", split_list(F.col("tags"), ":"))
        .filter(F.size("_tags") > 0)
        .select(
            F.lit(None).cast("string").alias("target_asset_id"),
            "target_uid",
            "source_uid",
            F.col("source_id").cast("string").alias("source_id"),
            F.col("_tags").alias("tags"),
        )
    )


def tag_import_plan(rows: DataFrame, target: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """One row per target asset and tag; assets unknown in the target are marked."""
    known = first_target(target, ordinal).select("target_uid", F.col("target_asset_id").alias("_known"))
    exploded = rows.select("target_asset_id", "target_uid", "source_uid", F.explode("tags").alias("tag"))
    planned = hot_join(exploded, known, "target_uid", "left").select(
        F.coalesce("target_asset_id", "_known").alias("target_asset_id"), "target_uid", "source_uid", "tag"
    )
    return planned.withColumn("status", F.when(F.col("target_asset_id").isNull(), "asset_not_found").otherwise("ready"))


def response_outcome(message: Column, status: Column, code: Column, error: Column) -> Column:
    """Outcome of one tag request: ``imported``, ``already_exists`` or ``failed``.

    An error text that speaks of a conflict means that the tag was there before.
    """
    conflict = error.contains("409") | error.contains("Conflict")
    known = F.lower(message).contains("already") | (status == "already_exists") | (code == 409)
    return (
        F.when(error.isNotNull(), F.when(conflict, "already_exists").otherwise("failed"))
        .when(F.coalesce(known, F.lit(False)), "already_exists")
        .otherwise("imported")
    )


def import_outcome(log: DataFrame) -> DataFrame:
    """One row of totals; an asset is fine only if every one of its tags is.

    ``log`` has one row per request: ``asset_id, message, status, code, error``.
    """
    outcome = response_outcome(F.col("message"), F.col("status"), F.col("code"), F.col("error"))
    per_asset = (
        log.select("asset_id", outcome.alias("outcome"))
        .groupBy("asset_id")
        .agg(
            F.count_if(F.col("outcome") == "imported").alias("imported"),
            F.count_if(F.col("outcome") == "already_exists").alias("existing"),
            F.count_if(F.col("outcome") == "failed").alias("failed"),
        )
    )
    return per_asset.agg(
        F.count_if(F.col("failed") == 0).alias("assets_ok"),
        F.count_if(F.col("failed") > 0).alias("assets_failed"),
        F.sum("imported").alias("tags_imported"),
        F.sum("existing").alias("tags_already_exist"),
        F.sum("failed").alias("tags_failed"),
    )


def rule_tags(rules: DataFrame) -> DataFrame:
    """Rules that have named tags, with their tags joined by commas in list order.

    ``rules`` has ``rule_id`` and ``rule_tags array<struct<name>>``; rows whose id
    is not a whole number are dropped.
    """
    names = F.filter(F.transform("rule_tags", lambda t: t["name"]), lambda n: n.isNotNull() & (n != ""))
    return (
        rules.select(F.col("rule_id").cast("string").try_cast("long").alias("rule_id"), names.alias("names"))
        .filter(F.col("rule_id").isNotNull() & (F.size("names") > 0))
        .select("rule_id", F.array_join("names", ",").alias("tags"))
    )


def tag_frequency(rules: DataFrame, top: int = 10) -> DataFrame:
    """The most common rule tags with their share of all rules; ties go by name."""
    names = F.filter(F.transform("rule_tags", lambda t: t["name"]), lambda n: n.isNotNull() & (n != ""))
    counted = rules.select(F.explode(names).alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n"))
    total = rules.agg(F.count(F.lit(1)).alias("total")).scalar()
    return (
        counted.orderBy(F.desc("n"), "tag").limit(top).withColumn("share", F.round(F.lit(100.0) * F.col("n") / total, 6))
    )


def tag_coverage(rules: DataFrame) -> DataFrame:
    """One row: rules read, with and without tags, lookups that worked and their share.

    A null ``rule_tags`` is a lookup that failed.
    """
    answered = F.col("rule_tags").isNotNull()
    named = F.exists("rule_tags", lambda t: F.coalesce(t["name"], F.lit("")) != "")
    with_tags = F.count_if(F.coalesce(named, F.lit(False)))
    total = F.count(F.lit(1))
    return rules.agg(
        total.alias("rules"),
        with_tags.alias("with_tags"),
        (total - with_tags).alias("without_tags"),
        F.count_if(answered).alias("lookups_ok"),
        F.round(F.lit(100.0) * F.count_if(answered) / total, 6).alias("success_rate"),
    )
