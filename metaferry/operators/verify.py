"""Verification after an import: expected against actual state, with reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metaferry.functions.jsondoc import json_text, parsed
from metaferry.functions.truth import is_set, plain, same_value, shown

# Compared configuration fields with their short and long report labels.
COMPARED = (
    ("scheduled", "Schedule", "Schedule"),
    ("timeZone", "Timezone", "Timezone"),
    ("isPatternProfile", "Pattern profile", "Pattern Profile"),
    ("columnLevel", "Column level", "Column Level"),
    ("resourceStrategyType", "Resource strategy", "Resource Strategy"),
    ("isUserMarkedReference", "User marked reference", "User Marked Reference"),
    ("profileAnomalyModelSensitivity", "Profile anomaly sensitivity", "Profile Anomaly Sensitivity"),
    ("cadenceAnomalyTrainingWindowMinimumInDays", "Cadence anomaly training window", "Training Window"),
    ("autoRetryEnabled", "Auto retry enabled", "Auto Retry"),
)

# Feature flags of a configuration and the field behind each.
CONFIG_FLAGS = (
    ("has_schedule", "scheduled"),
    ("has_timezone", "timeZone"),
    ("has_spark_config", "sparkResourceConfig"),
    ("incremental_strategy", "markerConfiguration"),
    ("has_notifications", "notificationChannels"),
    ("is_pattern_profile", "isPatternProfile"),
    ("auto_retry_enabled", "autoRetryEnabled"),
    ("is_user_marked_reference", "isUserMarkedReference"),
    ("is_reference_check_valid", "isReferenceCheckValid"),
    ("has_reference_check_config", "referenceCheckConfiguration"),
)

# Configuration fields shown as they are.
CONFIG_VALUES = (
    ("column_level", "columnLevel"),
    ("resource_strategy", "resourceStrategyType"),
    ("profile_anomaly_sensitivity", "profileAnomalyModelSensitivity"),
    ("cadence_anomaly_training_window", "cadenceAnomalyTrainingWindowMinimumInDays"),
)

# Status labels of the reports.
STATUS_LABELS = {
    "success": "✅ PASSED",
    "mismatch": "⚠️ MISMATCH",
    "asset_not_found": "❌ ASSET_NOT_FOUND",
    "profile_not_found": "❌ PROFILE_NOT_FOUND",
    "config_not_found": "❌ CONFIG_NOT_FOUND",
    "error": "❌ ERROR",
}


_FIELDS = tuple(
    dict.fromkeys([n for n, _, _ in COMPARED] + [n for _, n in CONFIG_FLAGS] + [n for _, n in CONFIG_VALUES])
)


def setting_texts(document: Column) -> Column:
    """The known fields of a parsed configuration (variant) as canonical JSON texts, which all comparisons work on."""
    texts = [F.try_variant_get(document, f"$.assetConfiguration.{name}", "variant") for name in _FIELDS]
    return F.struct(*[json_text(text).alias(name) for text, name in zip(texts, _FIELDS)])


def config_flags(fields: Column) -> list[Column]:
    return [is_set(fields[field]).alias(name) for name, field in CONFIG_FLAGS]


def config_values(fields: Column) -> list[Column]:
    return [plain(fields[field]).alias(name) for name, field in CONFIG_VALUES]


def config_status(document: Column) -> Column:
    """``Config Changed`` if any setting of a parsed configuration holds a value other than null or an empty text."""
    values = F.map_values(F.try_variant_get(document, "$.assetConfiguration", "map<string,variant>"))
    custom = F.exists(values, lambda v: F.coalesce(json_text(v), F.lit('""')) != '""')
    return F.when(F.coalesce(custom, F.lit(False)), "Config Changed").otherwise("Default Config Present")


def mismatches(expected: Column, actual: Column) -> Column:
    """Differing fields as ``array<struct<label, detail>>``, in report order."""

    def difference(name: str, label: str, title: str) -> Column:
        e, a = expected[name], actual[name]
        # Report texts.
        detail = (
            F.when(is_set(e) & ~is_set(a), f"{title}: Default config present in source but missing in target")
            .when(~is_set(e) & is_set(a), f"{title}: Default config missing in source but present in target")
            .otherwise(F.concat(F.lit(f"{title}: Expected="), shown(e), F.lit(", Actual="), shown(a)))
        )
        row = F.struct(F.lit(f"{label} mismatch").alias("label"), detail.alias("detail"))
        return F.when(~same_value(e, a), row)

    return F.filter(F.array(*[difference(*field) for field in COMPARED]), lambda d: d.isNotNull())


def verify_configs(expected: DataFrame, target_ids: DataFrame, actual: DataFrame) -> DataFrame:
    """Compare expected configurations with those found in the target.

    ``expected(target_uid, config_json)``, ``target_ids(target_uid, asset_id)``,
    ``actual(asset_id, actual_json)``; the last two have one row per key.
    """
    joined = expected.join(target_ids, "target_uid", "left").join(actual, "asset_id", "left")
    checked = (
        joined.withColumn("_expected", parsed(F.col("config_json")))
        .withColumn("_actual", parsed(F.col("actual_json")))
        .select(
            "target_uid",
            "asset_id",
            F.coalesce(F.map_contains_key(F.col("_actual").try_cast("map<string,variant>"), "assetConfiguration"), F.lit(False)).alias(
                "_found"
            ),
            F.col("_expected").isNull().alias("_broken"),
            config_status(F.col("_expected")).alias("_status"),
            setting_texts(F.col("_expected")).alias("_want"),
            setting_texts(F.col("_actual")).alias("_have"),
        )
        .withColumn("_diff", mismatches(F.col("_want"), F.col("_have")))
    )
    compared = F.col("_found") & ~F.col("_broken")
    status = (
        F.when(F.col("asset_id").isNull(), "asset_not_found")
        .when(~F.col("_found"), "config_not_found")
        .when(F.col("_broken"), "error")
        .when(F.size("_diff") > 0, "mismatch")
        .otherwise("success")
    )
    labels = F.array_join(F.transform("_diff", lambda d: d["label"]), ", ")
    result = checked.withColumn("status", status)
    # Report texts.
    error = (
        F.when(F.col("status") == "asset_not_found", F.concat(F.lit("No asset found for UID: "), "target_uid"))
        .when(F.col("status") == "config_not_found", F.concat(F.lit("No configuration found for asset ID: "), "asset_id"))
        .when(F.col("status") == "error", F.lit("Invalid expected config JSON"))
        .when(F.col("status") == "mismatch", F.concat(F.lit("Configuration mismatch: "), labels))
    )
    return result.select(
        "target_uid",
        "asset_id",
        "status",
        error.alias("error"),
        F.when(F.col("status") == "success", "All configurations match")
        .when(F.col("status") == "mismatch", labels)
        .alias("verification_details"),
        F.when(compared, F.transform("_diff", lambda d: d["detail"])).alias("mismatch_details"),
        F.when(F.col("status").isin("success", "mismatch"), F.col("_status")).alias("config_status"),
        *config_flags(F.col("_have")),
        *config_values(F.col("_have")),
    )


def _label(status: Column) -> Column:
    text = F.upper(status)
    for name, label in STATUS_LABELS.items():
        text = F.when(status == name, label).otherwise(text)
    return text


def _yes_no(flag: Column) -> Column:
    return F.when(F.coalesce(flag, F.lit(False)), "Yes").otherwise("No")


def config_report(results: DataFrame) -> DataFrame:
    """Configuration verification report with its thirteen columns."""
    passed_over = F.col("status").isin("success", "mismatch")
    return results.select(
        F.col("target_uid").alias("Target_UID"),
        F.coalesce(F.col("asset_id").cast("string"), F.lit("N/A")).alias("Asset_ID"),
        _label(F.col("status")).alias("Verification_Status"),
        F.coalesce("config_status", F.lit("Unknown")).alias("Config_Status"),
        _yes_no(F.col("has_spark_config")).alias("Has_Spark_Config"),
        _yes_no(F.col("incremental_strategy")).alias("Incremental_Strategy"),
        F.when(passed_over, F.coalesce("resource_strategy", F.lit(""))).otherwise("N/A").alias("Resource_Strategy"),
        _yes_no(F.col("auto_retry_enabled")).alias("Auto_Retry_Enabled"),
        _yes_no(F.col("is_user_marked_reference")).alias("Is_User_Marked_Reference"),
        _yes_no(F.col("is_reference_check_valid")).alias("Is_Reference_Check_Valid"),
        _yes_no(F.col("has_reference_check_config")).alias("Has_Reference_Check_Config"),
        F.coalesce("error", F.lit("")).alias("Error_Message"),
        F.coalesce("verification_details", F.lit("")).alias("Verification_Details"),
    )


_PROFILE = (
    "struct<profileSettingsConfigs: struct<enabled: variant, schedule: variant, "
    "profileNotificationChannels: struct<configuredNotificationGroupIds: array<string>>>>"
)


def verify_profiles(imported: DataFrame, target_ids: DataFrame, profiles: DataFrame) -> DataFrame:
    """Check that every imported uid has an asset with a profile configuration in the target.

    ``imported(target_uid)``, ``target_ids(target_uid, asset_id)``, ``profiles(asset_id, profile_json)``.
    """
    joined = imported.join(target_ids, "target_uid", "left").join(profiles, "asset_id", "left")
    profile = F.from_json("profile_json", _PROFILE)["profileSettingsConfigs"]
    ids = profile["profileNotificationChannels"]["configuredNotificationGroupIds"]
    status = (
        F.when(F.col("asset_id").isNull(), "asset_not_found")
        .when(F.trim(F.coalesce("profile_json", F.lit("null"))).isin("null", "{}", "[]"), "profile_not_found")
        .when(parsed(F.col("profile_json")).isNull(), "error")
        .otherwise("success")
    )
    error = (
        F.when(status == "asset_not_found", F.concat(F.lit("Asset not found for UID: "), "target_uid"))
        .when(status == "profile_not_found", F.concat(F.lit("Profile configuration not found for asset ID: "), "asset_id"))
        .when(status == "error", F.concat(F.lit("Error verifying "), "target_uid"))
    )
    passed = status == "success"
    return joined.select(
        "target_uid",
        "asset_id",
        status.alias("status"),
        error.alias("error"),
        (passed & F.coalesce(F.size(ids) > 0, F.lit(False))).alias("has_notifications"),
        (passed & is_set(json_text(profile["schedule"]))).alias("has_schedule"),
        (passed & is_set(json_text(profile["enabled"]))).alias("is_enabled"),
        F.when(passed, F.coalesce(ids, F.array().cast("array<string>"))).alias("notification_ids"),
    )


def profile_report(results: DataFrame) -> DataFrame:
    """Profile verification report with its nine columns."""
    asset = F.coalesce(F.col("asset_id").cast("string"), F.lit("N/A"))
    has_ids = F.coalesce(F.size("notification_ids") > 0, F.lit(False))
    ids = F.when(has_ids, F.array_join("notification_ids", ", ")).otherwise("None")
    notified, scheduled, enabled = (_yes_no(F.col(c)) for c in ("has_notifications", "has_schedule", "is_enabled"))
    details = F.concat_ws(
        " | ",
        F.concat(F.lit("Asset ID: "), asset),
        F.concat(F.lit("Notifications: "), notified),
        F.concat(F.lit("Schedule: "), scheduled),
        F.concat(F.lit("Enabled: "), enabled),
        F.when(has_ids, F.concat(F.lit("Notification IDs: "), ids)),
    )
    error = F.coalesce("error", F.lit(""))
    return results.select(
        F.col("target_uid").alias("Target_UID"),
        asset.alias("Asset_ID"),
        _label(F.col("status")).alias("Verification_Status"),
        notified.alias("Has_Notifications"),
        scheduled.alias("Has_Schedule"),
        enabled.alias("Profiling_Enabled"),
        ids.alias("Notification_Group_IDs"),
        error.alias("Error_Message"),
        F.when(F.col("status") == "success", details).otherwise(F.concat(F.lit("Error: "), error)).alias(
            "Verification_Details"
        ),
    )


def status_counts(results: DataFrame) -> DataFrame:
    """Rows per status with their share in percent."""
    counted = results.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    total = counted.agg(F.sum("n").alias("total")).scalar()
    return counted.withColumn("share", F.round(F.lit(100.0) * F.col("n") / total, 6))


def failure_counts(results: DataFrame) -> DataFrame:
    """Rows per error text among those that did not succeed."""
    text = F.coalesce("error", F.lit("Unknown error"))
    return results.filter(F.col("status") != "success").groupBy(text.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def mismatch_counts(results: DataFrame) -> DataFrame:
    """Mismatches per detail text."""
    return _details(results).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def mismatch_fields(results: DataFrame) -> DataFrame:
    """Mismatches per field, the part of the detail text before its colon."""
    name = F.split_part(F.col("reason"), F.lit(":"), F.lit(1))
    return _details(results).groupBy(name.alias("field")).agg(F.count(F.lit(1)).alias("n"))


def _details(results: DataFrame) -> DataFrame:
    # The outer form keeps Spark from testing the list, and so comparing all fields, a second time below the joins.
    rows = results.select(F.explode_outer("mismatch_details").alias("reason"))
    return rows.filter(F.col("reason").isNotNull())
