"""Jobs over asset inventories and tags."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaferry.functions.rename import Renames, rename_columns, rename_target_uid
from metaferry.operators import inventory, tags
from metaferry.operators.ranking import split_first


class Inventory(NamedTuple):
    assets: DataFrame
    duplicates: DataFrame
    pages: DataFrame


def asset_inventory(
    pages: DataFrame, body: str = "body", asset_types: str | None = None, assembly_ids: str | None = None
) -> Inventory:
    """Inventory from page snapshots ``(page, body)``: filtered, one row per asset id, in order."""
    element = (
        "struct<assetId: bigint, assetUid: string, assemblyId: bigint, assetTypeId: bigint, assetType: string, "
        "tags: array<struct<name: string, autoTagged: boolean>>>"
    )
    rows = inventory.page_assets(pages, body, element).select(
        F.coalesce("asset.assetUid", F.lit("")).alias("source_uid"),
        F.col("asset.assetId").alias("source_id"),
        F.coalesce("asset.assetUid", F.lit("")).alias("target_uid"),
        F.coalesce(inventory.manual_tags(F.col("asset.tags")), F.lit("")).alias("tags"),
        F.col("asset.assemblyId").alias("assembly_id"),
        F.col("asset.assetTypeId").alias("asset_type_id"),
        F.col("asset.assetType").alias("asset_type"),
        # Page number and position, an array index of 31 bits, make an ordinal without any global numbering.
        (F.col("page") * F.lit(1 << 31) + F.col("position")).alias("ordinal"),
    )
    first, later = split_first(inventory.filter_inventory(rows, asset_types, assembly_ids), "source_id", "ordinal")
    return Inventory(
        inventory.order_inventory(first), later, inventory.failed_pages(pages, body, element)
    )


class Mapping(NamedTuple):
    merged: DataFrame
    unmatched_views: DataFrame
    coverage: DataFrame


def transform_and_merge(source: DataFrame, target: DataFrame, renames: Renames | None) -> Mapping:
    """The asset mapping between the environments and what is left over."""
    merged = inventory.merge_assets(source, target, renames)
    return Mapping(merged, inventory.unmatched_views(source, merged), inventory.mapping_coverage(source, target, renames))


def rewrite_asset_files(inventory_rows: DataFrame, config_rows: DataFrame, renames: Renames) -> tuple[DataFrame, DataFrame]:
    """Inventory with renamed target uids, configurations with renamed target uids and untouched JSON."""
    return rename_target_uid(inventory_rows, renames), rename_target_uid(config_rows, renames)


def rewrite_asset_table(rows: DataFrame, renames: Renames) -> DataFrame:
    """Every text column renamed except the source uid."""
    return rename_columns(rows, renames)


class TagExport(NamedTuple):
    tags: DataFrame
    enriched: DataFrame


def tag_export(
    tag_names: DataFrame, links: DataFrame, assets: DataFrame, assemblies: DataFrame, assembly_id: int | None = None
) -> TagExport:
    bridge = tags.tag_assets(tag_names, links)
    return TagExport(bridge, tags.enrich_tag_assets(bridge, assets, assemblies, assembly_id))


def tag_transfer(enriched: DataFrame, target: DataFrame, renames: Renames) -> DataFrame:
    return tags.transfer_tag_assets(enriched, target, renames)


def tag_plan(tag_file: DataFrame, target: DataFrame) -> DataFrame:
    """Import plan from a tag file in any of its three layouts."""
    return tags.tag_import_plan(tags.tag_rows(tag_file), target)
