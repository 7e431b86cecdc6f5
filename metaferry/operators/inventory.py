"""Asset inventories of the two environments and the mapping between them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metaferry.functions.binding import bind
from metaferry.functions.rename import Renames, rename_words, renames_used
from metaferry.functions.text import has_text, or_blank, sort_number, split_list, strip
from metaferry.operators.joins import absent, hot_join
from metaferry.operators.ranking import first_per_key, last_per_key

# Asset types that take part in a migration without carrying a tag.
MIGRATED_TYPES = ("table", "sql_view", "view", "file", "kafka_topic")
# Spellings of an optional filter that mean "not given".
_NOT_GIVEN = (None, "", "None", "null")


def clean_pairs(df: DataFrame) -> DataFrame:
    """First two columns, stripped; rows with a blank in either are dropped."""
    first, second = (strip(F.col(c)).alias(c) for c in df.columns[:2])
    return df.select(first, second).filter((F.col(df.columns[0]) != "") & (F.col(df.columns[1]) != ""))


def clean_single(df: DataFrame) -> DataFrame:
    """First column, stripped; blank rows are dropped."""
    name = df.columns[0]
    return df.select(strip(F.col(name)).alias(name)).filter(F.col(name) != "")


def is_migrated(tags: Column, asset_type: Column, allowed: Sequence[str] = MIGRATED_TYPES) -> Column:
    """An asset takes part if it has tags or is of an allowed type."""
    typed = F.lower(strip(asset_type)).isin(*allowed)
    return has_text(tags) | F.coalesce(typed, F.lit(False))


def migrated_assets(mapping: DataFrame, allowed: Sequence[str] = MIGRATED_TYPES) -> DataFrame:
    """Rows of an asset mapping that can be migrated; all values stripped."""
    columns = ("source_id", "source_uid", "target_id", "target_uid", "tags")
    return mapping.filter(
        has_text(F.col("source_id"))
        & has_text(F.col("target_uid"))
        & is_migrated(F.col("tags"), F.col("source_asset_type"), allowed)
    ).select(*[strip(F.col(c).cast("string")).alias(c) for c in columns])


def uid_pairs(mapping: DataFrame) -> DataFrame:
    """Source and target uid of rows that have both."""
    return mapping.filter(has_text(F.col("source_uid")) & has_text(F.col("target_uid"))).select(
        "source_uid", "target_uid"
    )


def id_list(text: str | None) -> list[str] | None:
    """Ids of a comma-separated filter, None if the filter is not given."""
    if text in _NOT_GIVEN:
        return None
    return [part.strip() for part in text.split(",") if part.strip()]


def filter_inventory(df: DataFrame, type_ids: str | None = None, assembly_ids: str | None = None) -> DataFrame:
    """Optional filters on asset type and assembly; they reach the scan as pushed-down predicates."""
    for column, text in (("asset_type_id", type_ids), ("assembly_id", assembly_ids)):
        wanted = id_list(text)
        if wanted is not None:
            df = df.filter(F.col(column).isin([int(v) for v in wanted]))
    return df


def manual_tags(tags: Column) -> Column:
    """Names of the tags set by hand, joined by a colon; automatic ones are left out."""
    by_hand = F.filter(tags, lambda t: ~F.coalesce(t["autoTagged"], F.lit(False)))
    return F.array_join(F.transform(by_hand, lambda t: t["name"]), ":")


def order_inventory(df: DataFrame) -> DataFrame:
    return df.orderBy("source_uid", sort_number(F.col("source_id")))


def match_assets(source: DataFrame, target: DataFrame, renames: Renames | None, ordinal: str = "ordinal") -> DataFrame:
    """Rename the target uid of every source row and find the target asset with that uid.

    Source rows all stay; where the target inventory lists a uid twice its last
    row counts. Rows without a match have a null ``target_id``.
    """
    # Blank uids instead of nulls keep Spark from renaming once more for a null test of the join key.
    known = last_per_key(
        target.select(or_blank(F.col("source_uid")).alias("_uid"), F.col("source_id").alias("target_id"), ordinal),
        ["_uid"],
        ordinal,
    ).select("_uid", F.col("target_id").cast("string").alias("target_id"))
    wanted = source.select(
        F.col("source_id").cast("string").alias("source_id"),
        "source_uid",
        rename_words(or_blank(F.col("target_uid")), renames).alias("_uid"),
        "tags",
        F.col("asset_type").alias("source_asset_type"),
    )
    return hot_join(wanted, known, "_uid", "left").select(
        "source_id",
        "source_uid",
        "target_id",
        F.when(F.col("target_id").isNotNull(), F.col("_uid")).alias("target_uid"),
        "tags",
        "source_asset_type",
    )


def merge_assets(source: DataFrame, target: DataFrame, renames: Renames | None, ordinal: str = "ordinal") -> DataFrame:
    """The asset mapping: every source row that has a target asset after renaming."""
    return match_assets(source, target, renames, ordinal).filter(F.col("target_id").isNotNull())


def unmatched_views(source: DataFrame, mapping: DataFrame) -> DataFrame:
    """Source SQL views that did not make it into the mapping."""
    views = source.filter(F.col("asset_type") == "SQL_VIEW")
    return absent(views, mapping, "source_uid")


def mapping_coverage(source: DataFrame, target: DataFrame, renames: Renames | None) -> DataFrame:
    """One row: source rows, rename pairs applied, matched and unmatched rows, match rate."""
    matched = F.col("target_id").isNotNull()
    # The number of renames goes through the match in the place of the tags.
    used = renames_used(F.col("target_uid"), renames).cast("string")
    counts = match_assets(source.withColumn("tags", used), target, renames).agg(
        F.count(F.lit(1)).alias("source_rows"),
        F.sum(F.col("tags").cast("bigint")).alias("renames_applied"),
        F.count_if(matched).alias("matched_rows"),
        F.count_if(~matched).alias("unmatched_rows"),
    )
    return counts.select(
        "source_rows",
        "renames_applied",
        "matched_rows",
        "unmatched_rows",
        F.round(F.lit(100.0) * F.col("matched_rows") / F.col("source_rows"), 6).alias("match_rate"),
    )


def id_map(mapping: DataFrame, ordinal: str) -> DataFrame:
    """Source id to target id and uid; the last row of a source id counts."""
    return last_per_key(mapping.select("source_id", "target_id", "target_uid", ordinal), ["source_id"], ordinal).drop(
        ordinal
    )


def attach_snapshot(
    rows: DataFrame, snapshot: DataFrame, key: str, found: str, missing_reason: str = "not found"
) -> DataFrame:
    """Look up one snapshot row per key; rows without one stay, with status and reason."""
    joined = rows.join(snapshot, key, "left")
    hit = F.col(found).isNotNull()
    return joined.withColumn("status", F.when(hit, "ok").otherwise("failed")).withColumn(
        "reason", F.when(~hit, F.lit(missing_reason))
    )


def lookup_asset_ids(rows: DataFrame, responses: DataFrame, key: str) -> DataFrame:
    """Asset id from lookup responses ``(key, data array<struct<id>>)`` with the reason where there is none."""
    first = F.get(F.col("data"), F.lit(0))
    joined = rows.join(responses, key, "left")
    reason = (
        F.when(F.col("data").isNull(), "no data field")
        .when(F.size("data") == 0, "empty data")
        .when(first["id"].isNull(), "no id")
    )
    return joined.select(*rows.columns, first["id"].alias("asset_id"), reason.alias("reason")).withColumn(
        "status", F.when(F.col("reason").isNull(), "ok").otherwise("failed")
    )


def child_maps(mapping: DataFrame, source_children: DataFrame, target_children: DataFrame) -> DataFrame:
    """Attach id-to-uid maps of the child assets of both sides to each mapping row.

    Children come as an array beside their asset, so the maps are built in place.
    """

    def as_map(children: DataFrame, key: str, name: str) -> DataFrame:
        # The last entry of an id counts, entries without an id none.
        known = F.filter("child_assets", lambda c: c["asset_id"].isNotNull())
        by_id = F.array_sort(F.transform(known, lambda c, k: F.struct(c["asset_id"].alias("id"), k.alias("at"), c["uid"].alias("uid"))))

        def last_ones(entries: Column) -> Column:
            following = F.transform(entries, lambda e, k: F.get(entries, k + 1)["id"])
            return F.filter(entries, lambda e, k: ~e["id"].eqNullSafe(F.get(following, k)))

        in_order = F.array_sort(F.transform(bind(by_id, last_ones), lambda e: F.struct(e["at"], e["id"], e["uid"])))
        entries = F.transform(in_order, lambda e: F.struct(e["id"], e["uid"]))
        return children.select(F.col("asset_id").cast("string").alias(key), F.map_from_entries(entries).alias(name))

    return mapping.join(as_map(source_children, "source_id", "source_children"), "source_id", "left").join(
        as_map(target_children, "target_id", "target_children"), "target_id", "left"
    )


def unwrap_pages(pages: DataFrame, body: str, element: str) -> DataFrame:
    """Assets of page snapshots: the first of the four known list fields that is present."""
    # List fields of an asset page, in order of preference.
    fields = ("assets", "asset", "items", "results")
    schema = "struct<" + ", ".join(f"{name}: array<{element}>" for name in fields) + ">"
    parsed = pages.withColumn("_page", F.from_json(body, schema))
    return parsed.withColumn("_items", F.coalesce(*[F.col(f"_page.{name}") for name in fields]))


def page_assets(pages: DataFrame, body: str, element: str) -> DataFrame:
    return unwrap_pages(pages, body, element).select("page", F.posexplode("_items").alias("position", "asset"))


def failed_pages(pages: DataFrame, body: str, element: str) -> DataFrame:
    """One row: pages read and pages without any asset list."""
    return unwrap_pages(pages, body, element).agg(
        F.count(F.lit(1)).alias("pages"), F.count_if(F.col("_items").isNull()).alias("failed_pages")
    )


def failed_rule_pages(pages: DataFrame, body: str) -> DataFrame:
    """One row: pages read and pages without a rule list."""
    listed = F.try_variant_get(F.try_parse_json(F.col(body)), "$.rules", "variant").isNotNull()
    return pages.agg(F.count(F.lit(1)).alias("pages"), F.count_if(~listed).alias("failed_pages"))


def page_rules(pages: DataFrame, body: str, rule: str) -> DataFrame:
    """Rules of page snapshots; an element is either the rule or an object that wraps it."""
    name, fields = "rules", rule
    schema = f"struct<{name}: array<struct<rule: struct<{fields}>, {fields}>>>"
    exploded = pages.select(F.explode(F.from_json(body, schema)[name]).alias("_r"))
    names = [f.strip().split(":")[0].strip() for f in fields.split(",")]
    bare = F.struct(*[F.col(f"_r.{n}").alias(n) for n in names])
    return exploded.select(F.coalesce(F.col("_r.rule"), bare).alias("rule")).select("rule.*")


def preview(df: DataFrame, rows: int, *order: str | Column) -> DataFrame:
    """The first few rows in a given order, for display."""
    return df.orderBy(*order).limit(rows)


def with_status(df: DataFrame, statuses: str, column: str = "status") -> DataFrame:
    """Keep rows in the listed statuses; ``ALL`` keeps everything."""
    if statuses.strip().upper() == "ALL":
        return df
    return df.filter(F.col(column).isin([s.strip() for s in statuses.split(",")]))


def tag_array(tags: Column) -> Column:
    """Tags of an inventory row: colon-separated text to an array."""
    return split_list(tags, ":")


def first_target(target: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """Target id and type per uid, taken from the first row that lists the uid."""
    return first_per_key(
        target.select(F.col("source_uid").alias("target_uid"), "source_id", "asset_type", ordinal),
        ["target_uid"],
        ordinal,
    ).select("target_uid", F.col("source_id").cast("string").alias("target_asset_id"), "asset_type")
