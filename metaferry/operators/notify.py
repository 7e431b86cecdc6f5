"""Notification groups: use by rules, presence in the target, id mapping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metaferry.functions.text import has_text, normalised_name, or_blank, whole_number
from metaferry.operators.joins import absent, hot_join, present
from metaferry.operators.ranking import last_per_key


def classified_rules(rules: DataFrame) -> DataFrame:
    """Rules with the reason why they use no notification group, null if they use some.

    ``rules`` has ``rule struct<id, name, notificationChannels struct<configuredNotificationGroupIds>>``.
    """
    channels = F.col("rule.notificationChannels")
    ids = channels["configuredNotificationGroupIds"]
    reason = (
        F.when(F.col("rule").isNull(), "Missing 'rule' object")
        .when(channels.isNull(), "Missing 'notificationChannels'")
        .when(ids.isNull() | (F.size(ids) == 0), "No 'configuredNotificationGroupIds'")
    )
    return rules.select(
        F.col("rule.id").alias("rule_id"),
        F.coalesce(F.col("rule.name"), F.lit("Unnamed")).alias("rule_name"),
        ids.alias("group_ids"),
        reason.alias("reject_reason"),
    )


def group_use(classified: DataFrame) -> DataFrame:
    """One row per rule and notification group it uses."""
    return classified.filter(F.col("reject_reason").isNull()).select(
        F.explode("group_ids").alias("group_id"), "rule_id", "rule_name"
    )


def rejected_rules(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("reject_reason").isNotNull()).select("rule_id", "rule_name", "reject_reason")


def channel_types(channels: Column) -> Column:
    """Distinct channel types of a group, sorted and joined."""
    types = F.transform(channels, lambda c: F.coalesce(c["type"], F.lit("N/A")))
    return or_blank(F.array_join(F.array_sort(F.array_distinct(types)), ", "))


def used_groups(groups: DataFrame, use: DataFrame) -> DataFrame:
    """Groups that at least one rule refers to."""
    return present(groups, use.select(F.col("group_id").alias("id")), "id")


def group_rows(groups: DataFrame) -> DataFrame:
    return groups.select(
        F.col("id").alias("notification_id"),
        F.coalesce("name", F.lit("N/A")).alias("notification_name"),
        channel_types(F.col("channels")).alias("notification_type"),
    )


def missing_groups(use: DataFrame, groups: DataFrame) -> DataFrame:
    """Every use of a group that does not exist, with the number of rules that use it.

    One row per use rather than one list per group: a group may be used by very many rules.
    """
    counted = use.groupBy("group_id").agg(F.count(F.lit(1)).alias("referenced_by"))
    lost = absent(counted, groups.select(F.col("id").alias("group_id")), "group_id")
    return hot_join(use, lost, "group_id").select("group_id", "referenced_by", "rule_id", "rule_name")


def missing_group_ids(use: DataFrame, groups: DataFrame) -> DataFrame:
    """Distinct ids that rules use and no group has."""
    return absent(use.select("group_id").distinct(), groups.select(F.col("id").alias("group_id")), "group_id")


def group_usage_counts(use: DataFrame) -> DataFrame:
    return use.groupBy("group_id").agg(F.count(F.lit(1)).alias("rules"))


def compare_groups(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source groups with a yes/no for a target group of the same name."""
    names = target.select(normalised_name(F.col("name")).alias("_key")).distinct().withColumn("_present", F.lit(True))
    present = F.coalesce("_present", F.lit(False))
    keyed = group_rows(source).withColumn("_key", normalised_name(F.col("notification_name")))
    return hot_join(keyed, names, "_key", "left").select(
        "notification_id",
        "notification_name",
        "notification_type",
        F.when(present, "Yes").otherwise("No").alias("present_in_target"),
        F.when(present, "").otherwise("Missing in target environment").alias("comment"),
    )


def map_groups(source: DataFrame, target: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """Source groups with the id of the target group of the same name.

    Target groups without name or id are ignored; the last one of a name counts.
    """
    known = last_per_key(
        target.filter(has_text(F.col("name")) & F.col("id").isNotNull() & (F.col("id") != 0)).select(
            normalised_name(F.col("name")).alias("_key"), F.col("id").alias("_target"), ordinal
        ),
        ["_key"],
        ordinal,
    ).drop(ordinal)
    keyed = source.withColumn("_key", normalised_name(F.col("name")))
    mapped = F.col("_target").isNotNull()
    return hot_join(keyed, known, "_key", "left").select(
        F.col("id").alias("source_notification_id"),
        or_blank(F.col("name")).alias("source_notification_name"),
        channel_types(F.col("channels")).alias("source_notification_type"),
        or_blank(F.col("_target")).alias("target_notification_id"),
        F.when(mapped, or_blank(F.col("name"))).otherwise("").alias("target_notification_name"),
        F.when(mapped, "Mapped").otherwise("Not Found in Target").alias("mapping_status"),
        F.col(ordinal),
    )


def order_mapping(mapping: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """Mapped groups first, each part in source order."""
    return mapping.orderBy((F.col("mapping_status") != "Mapped").cast("int"), ordinal)


def usable_mapping(mapping: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """Id pairs of mapped groups whose ids are both whole numbers; the last row of a source id counts."""
    pairs = mapping.filter(F.col("mapping_status") == "Mapped").select(
        whole_number(F.col("source_notification_id")).alias("source_id"),
        whole_number(F.col("target_notification_id")).alias("target_id"),
        F.col(ordinal),
    )
    pairs = last_per_key(pairs, ["source_id"], ordinal).drop(ordinal)
    return pairs.filter(F.col("source_id").isNotNull() & F.col("target_id").isNotNull())
