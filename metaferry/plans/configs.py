"""Jobs over configurations, profiles, segments, notifications and profiling."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaferry.operators import config, inventory, notify, profiling, verify
from metaferry.operators.ranking import resolve_duplicates


class Export(NamedTuple):
    rows: DataFrame
    failed: DataFrame


def snapshot_export(mapping: DataFrame, snapshot: DataFrame, key: str, document: str) -> Export:
    """Mapping rows with their configuration, profile or segment document, and those without one."""
    joined = inventory.attach_snapshot(mapping, snapshot, key, document, f"no {document} for {key}")
    return Export(
        joined.filter(F.col("status") == "ok").orderBy(F.lower("target_uid")), joined.filter(F.col("status") == "failed")
    )


def config_export(
    mapping: DataFrame, configs: DataFrame, anomalies: DataFrame, source_children: DataFrame, target_children: DataFrame
) -> Export:
    """Six-column configuration export: configuration, anomaly rule and child id maps of both sides.

    ``configs`` and ``anomalies`` are keyed by ``source_id``.
    """
    exported = snapshot_export(mapping, configs, "source_id", "config_json")
    full = inventory.child_maps(exported.rows.join(anomalies, "source_id", "left"), source_children, target_children)
    rows = full.select(
        "target_uid",
        "config_json",
        F.col("anomaly_json").alias("asset_profile_anomaly_config_json"),
        F.to_json("source_children").alias("source_children_json"),
        F.to_json("target_children").alias("target_children_json"),
        "source_uid",
    )
    return Export(rows.orderBy(F.lower("target_uid")), exported.failed)


class ImportPlan(NamedTuple):
    plan: DataFrame
    undecided: DataFrame
    reasons: DataFrame


def config_import(
    rows: DataFrame, target_ids: DataFrame, choices: DataFrame | None = None, default: str = "first"
) -> ImportPlan:
    """Payloads for configurations ``(target_uid, config_json, ordinal)`` after resolving duplicates."""
    kept, undecided = resolve_duplicates(rows, "target_uid", "ordinal", choices, default)
    plan = config.config_import_plan(kept.select("target_uid", "config_json"), target_ids)
    return ImportPlan(plan, undecided, config.skip_counts(plan))


def profile_import(
    rows: DataFrame,
    target_ids: DataFrame,
    mapping: DataFrame | None = None,
    choices: DataFrame | None = None,
    default: str = "first",
) -> ImportPlan:
    """Payloads for profiles ``(target_uid, profile_json, ordinal)`` after resolving duplicates."""
    usable = config.usable_rows(rows, "target_uid", "profile_json")
    kept, undecided = resolve_duplicates(usable, "target_uid", "ordinal", choices, default)
    plan = config.profile_import_plan(kept.select("target_uid", "profile_json"), target_ids, mapping)
    return ImportPlan(plan, undecided, config.reason_counts(plan))


class Verification(NamedTuple):
    results: DataFrame
    report: DataFrame
    statuses: DataFrame
    failures: DataFrame
    fields: DataFrame | None


def verify_configs(expected: DataFrame, target_ids: DataFrame, actual: DataFrame) -> Verification:
    results = verify.verify_configs(expected, target_ids, actual)
    return Verification(
        results,
        verify.config_report(results),
        verify.status_counts(results),
        verify.failure_counts(results),
        verify.mismatch_fields(results),
    )


def verify_profiles(imported: DataFrame, target_ids: DataFrame, profiles: DataFrame) -> Verification:
    results = verify.verify_profiles(imported, target_ids, profiles)
    return Verification(
        results, verify.profile_report(results), verify.status_counts(results), verify.failure_counts(results), None
    )


class SegmentExport(NamedTuple):
    rows: DataFrame
    problems: DataFrame


def segment_export(pairs: DataFrame, responses: DataFrame, documents: DataFrame) -> SegmentExport:
    """Segment documents of environment pairs ``(source_uid, target_uid)``.

    ``responses`` are asset lookups by ``source_uid``, ``documents`` segment documents by ``asset_id``.
    Every pair is in one of the two tables: assets that are not found, have no
    document or no segments are problems with a reason.
    """
    found = inventory.lookup_asset_ids(pairs, responses, "source_uid")
    joined = found.join(documents, "asset_id", "left")
    place = F.concat(F.lit(" for asset ID "), F.col("asset_id").cast("string"), F.lit(" (source-env: "), "source_uid", F.lit(")"))
    # The texts of the reasons.
    reason = (
        F.when(F.col("status") == "failed", F.col("reason"))
        .when(F.col("segments_json").isNull(), F.concat(F.lit("No segments document found"), place))
        .when(~config.has_segments(F.col("segments_json")), F.concat(F.lit("No segments found"), place))
    )
    judged = joined.withColumn("reason", reason)
    rows = judged.filter(F.col("reason").isNull()).select("target_uid", "segments_json")
    return SegmentExport(rows, judged.filter(F.col("reason").isNotNull()).select("source_uid", "reason"))


class NotificationCheck(NamedTuple):
    groups: DataFrame
    rejected: DataFrame
    missing: DataFrame
    comparison: DataFrame


def notification_check(rules: DataFrame, source_groups: DataFrame, target_groups: DataFrame) -> NotificationCheck:
    classified = notify.classified_rules(rules)
    use = notify.group_use(classified)
    used = notify.used_groups(source_groups, use)
    return NotificationCheck(
        notify.group_rows(used),
        notify.rejected_rules(classified),
        notify.missing_groups(use, source_groups),
        notify.compare_groups(used, target_groups),
    )


def notification_mapping(source_groups: DataFrame, target_groups: DataFrame) -> DataFrame:
    return notify.order_mapping(notify.map_groups(source_groups, target_groups))


class ProfileCheck(NamedTuple):
    never_profiled: DataFrame
    decisions: DataFrame


def profile_check(
    policy_rows: DataFrame, policy_types: str, id_map: DataFrame, profile_requests: DataFrame, log: DataFrame
) -> ProfileCheck:
    """Target assets to profile for policies of some types, and the state of each.

    ``policy_rows`` is the policy list, whose ``tableAssetIds`` cell names one
    asset for the policies this applies to.
    """
    wanted = profiling.needs_profiling(policy_rows, policy_types).select(F.col("tableAssetIds").alias("source_id"))
    open_assets = profiling.never_profiled(wanted, id_map, profile_requests)
    assets = profiling.numeric_assets(open_assets).select(F.col("assetId").alias("asset_id"))
    return ProfileCheck(open_assets, profiling.profiling_decision(assets, log))
