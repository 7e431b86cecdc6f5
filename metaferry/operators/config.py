"""Asset and profile configurations: validation and import payloads.

Configurations are JSON text with an open set of fields. Payloads are edited as
``map<string, variant>``, so fields that are not named here are carried along.
The payload table is what would be sent; it is the dry run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metaferry.functions.jsondoc import as_object, field, is_json, json_problem, json_text, parsed, set_field
from metaferry.functions.text import has_text, strip
from metaferry.functions.truth import is_set, plain
from metaferry.operators.ranking import last_per_key

# Settings of an apply request that a caller may override.
APPLY_DEFAULTS = (
    ("assemblyMap", "{}"),
    ("policyOverride", "true"),
    ("sqlViewOverride", "true"),
    ("visualViewOverride", "false"),
)


def usable_rows(df: DataFrame, key: str, document: str) -> DataFrame:
    """Rows with a key and a document, both stripped."""
    return (
        df.withColumn(key, strip(F.col(key)))
        .withColumn(document, strip(F.col(document)))
        .filter((F.col(key) != "") & (F.col(document) != ""))
    )


def config_rows(df: DataFrame) -> DataFrame:
    """One shape for the configuration file layouts: 2, 3 or 6 columns.

    Result: ``target_uid, config_json, source_uid, anomaly_json``; a missing
    source uid is ``Unknown``.
    """
    names = df.columns
    if len(names) < 2:
        raise ValueError(f"not a configuration file: {names}")
    source = "source_uid" if "source_uid" in names else None
    anomaly = next((n for n in names if "anomaly" in n), None)
    rows = df.select(
        F.col(names[0]).alias("target_uid"),
        F.col(names[1]).alias("config_json"),
        (F.coalesce(F.nullif(strip(F.col(source)), F.lit("")), F.lit("Unknown")) if source else F.lit("Unknown")).alias(
            "source_uid"
        ),
        (F.col(anomaly) if anomaly else F.lit(None).cast("string")).alias("anomaly_json"),
    )
    return usable_rows(rows, "target_uid", "config_json")


def config_problems(df: DataFrame, key: str, document: str) -> DataFrame:
    """One row per problem: blank keys and documents that are blank, no JSON, no object or empty."""
    problems = F.array(F.when(~has_text(F.col(key)), "blank_key"), json_problem(F.col(document)))
    return df.select(key, F.explode(problems).alias("problem")).filter(F.col("problem").isNotNull())


def _object_or_null(value: Column) -> Column:
    return value.try_cast("map<string,variant>")


def config_class(document: Column) -> Column:
    """``with_config``, ``null_config``, ``missing_field``, ``invalid_format``, ``unparsable``, or ``beyond_variant``
    for valid JSON that no payload can be built from."""
    value = field(as_object(document), "assetConfiguration")
    return (
        F.when(parsed(document).isNull(), F.when(is_json(document), "beyond_variant").otherwise("unparsable"))
        .when(value.isNull(), "missing_field")
        .when(json_text(value).isNull(), "null_config")
        .when(_object_or_null(value).isNull(), "invalid_format")
        .otherwise("with_config")
    )


def config_census(configs: DataFrame, document: str = "config_json") -> DataFrame:
    """One row: documents with a configuration of any form, with null, without the field, without valid JSON."""
    kind = F.col("kind")
    return configs.select(config_class(F.col(document)).alias("kind")).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(kind.isin("with_config", "invalid_format")).alias("with_config"),
        F.count_if(kind == "null_config").alias("null_config"),
        F.count_if(kind == "missing_field").alias("missing_field"),
        F.count_if(kind.isin("unparsable", "beyond_variant")).alias("unparsable"),
    )


def with_asset_id(document: Column, asset_id: Column) -> Column:
    """The document with the target asset id set in ``assetConfiguration`` and, if it
    has one, in its ``freshnessColumnInfo``."""
    fields = as_object(document)
    number = asset_id.cast("variant")
    settings = set_field(_object_or_null(field(fields, "assetConfiguration")), "assetId", number)
    freshness = _object_or_null(field(settings, "freshnessColumnInfo"))
    dated = set_field(settings, "freshnessColumnInfo", F.to_variant_object(set_field(freshness, "assetId", number)))
    has_date = F.coalesce(F.map_contains_key(freshness, "assetId"), F.lit(False))
    edited = F.when(has_date, dated).otherwise(settings)
    return F.to_json(set_field(fields, "assetConfiguration", F.to_variant_object(edited)))


def config_import_plan(configs: DataFrame, target_ids: DataFrame) -> DataFrame:
    """Payload, or status and reason, for every configuration.

    Status is ``importable``, ``skipped`` (there is nothing to import) or
    ``failed``. ``target_ids(target_uid, asset_id)`` has one row per uid.
    """
    joined = configs.join(target_ids, "target_uid", "left").withColumn("_kind", config_class(F.col("config_json")))
    unknown, kind = F.col("asset_id").isNull(), F.col("_kind")
    status = (
        F.when(unknown | kind.isin("unparsable", "invalid_format", "beyond_variant"), "failed")
        .when(kind == "with_config", "importable")
        .otherwise("skipped")
    )
    # Report texts, here and below.
    reason = (
        F.when(unknown, "Asset not found in target")
        .when(kind.isin("unparsable", "invalid_format", "beyond_variant"), "Exception occurred")
        .when(kind == "missing_field", "No assetConfiguration field in config")
        .when(kind == "null_config", "assetConfiguration is null (default config)")
    )
    error = (
        F.when(unknown, F.concat(F.lit("No asset found for UID: "), "target_uid"))
        .when(kind == "unparsable", "Invalid JSON in config_json")
        .when(kind == "invalid_format", "assetConfiguration is not an object")
        .when(kind == "beyond_variant", "config_json is too large or repeats a key")
    )
    payload = F.when(~unknown & (kind == "with_config"), with_asset_id(F.col("config_json"), F.col("asset_id")))
    return joined.select(
        "target_uid",
        "asset_id",
        status.alias("status"),
        reason.alias("reason"),
        error.alias("error"),
        payload.alias("payload"),
    )


def skip_counts(plan: DataFrame) -> DataFrame:
    """Rows per reason among those that were skipped."""
    return reason_counts(plan.filter(F.col("status") == "skipped"))


def reason_counts(df: DataFrame, column: str = "reason") -> DataFrame:
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def anomaly_importable(document: Column) -> Column:
    return ~strip(F.coalesce(document, F.lit(""))).isin("", "{}", "null")


def one_target(mapping: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """One ``target_id`` per ``source_id``: that of the last row, or the largest where rows have no order."""
    if ordinal in mapping.columns:
        return last_per_key(mapping.select("source_id", "target_id", ordinal), ["source_id"], ordinal).drop(ordinal)
    return mapping.groupBy("source_id").agg(F.max("target_id").alias("target_id"))


def monitor_columns(anomalies: DataFrame, id_map: DataFrame) -> DataFrame:
    """Monitored columns of all items of an anomaly configuration as target ids, in item order.

    Columns without a target are dropped. ``anomalies`` has ``target_uid`` and
    ``anomaly_json``, one row per uid; ``id_map`` has ``source_id`` and ``target_id``.
    """
    schema = "struct<details: struct<items: array<struct<monitorColumns: array<string>>>>>"
    columns = F.flatten(
        F.transform(
            F.from_json("anomaly_json", schema)["details"]["items"],
            lambda item: F.coalesce(item["monitorColumns"], F.array().cast("array<string>")),
        )
    )
    wanted = anomalies.filter(anomaly_importable(F.col("anomaly_json")))
    exploded = wanted.select("target_uid", F.posexplode(columns).alias("position", "source_id"))
    mapped = exploded.join(one_target(id_map), "source_id").groupBy("target_uid")
    return mapped.agg(F.array_sort(F.collect_list(F.struct("position", "target_id"))).alias("_ids")).select(
        "target_uid", F.transform("_ids", lambda e: e["target_id"].cast("long")).alias("monitor_columns")
    )


def anomaly_import_plan(anomalies: DataFrame, id_map: DataFrame, target_rules: DataFrame) -> DataFrame:
    """Payload per anomaly configuration: the document of the target rule without ``details``,
    with the mapped columns set in every one of its items.

    Every configuration has a row. One without content is ``skipped``, one whose uid
    has no target rule, or a rule that is no JSON object, is ``failed``; both have
    a reason and no payload. ``target_rules`` has ``target_uid`` and ``rule_json``,
    one row per uid.
    """
    given = anomalies.select("target_uid", anomaly_importable(F.col("anomaly_json")).alias("_given"))
    rules = target_rules.select("target_uid", "rule_json", F.lit(True).alias("_known"))
    joined = given.join(rules, "target_uid", "left").join(monitor_columns(anomalies, id_map), "target_uid", "left")
    fields = as_object(F.col("rule_json"))
    # The texts of the reasons.
    reason = (
        F.when(~F.col("_given"), "Empty anomaly configuration")
        .when(F.col("_known").isNull(), F.concat(F.lit("No asset found for UID: "), "target_uid"))
        .when(fields.isNull(), F.concat(F.lit("No anomaly rule for UID: "), "target_uid"))
    )
    status = F.when(reason.isNull(), "importable").when(F.col("_given"), "failed").otherwise("skipped")
    items = _object_or_null(field(fields, "details"))
    ids = F.coalesce("monitor_columns", F.array().cast("array<bigint>")).try_cast("array<variant>")
    listed = F.transform(
        field(items, "items").try_cast("array<map<string,variant>>"),
        lambda item: F.to_variant_object(set_field(item, "monitorColumns", F.to_variant_object(ids))),
    )
    rest = F.map_filter(fields, lambda key, _: key != "details")
    payload = F.to_json(set_field(rest, "items", F.to_variant_object(listed)))
    return joined.select(
        "target_uid", status.alias("status"), reason.alias("reason"), F.when(reason.isNull(), payload).alias("payload")
    )


_PROFILE = (
    "struct<profileSettingsConfigs: struct<profileNotificationChannels: "
    "struct<configuredNotificationGroupIds: array<string>>>>"
)


def notification_ids(document: Column) -> Column:
    """Notification group ids of a profile configuration, null if there is no list; entries that are no number are null."""
    profile = F.from_json(document, _PROFILE)
    listed = profile["profileSettingsConfigs"]["profileNotificationChannels"]["configuredNotificationGroupIds"]
    return F.transform(listed, lambda entry: entry.try_cast("bigint"))


def map_notification_ids(configs: DataFrame, mapping: DataFrame, key: str = "target_uid") -> DataFrame:
    """Group ids of each configuration mapped to the target: kept in order, unmapped ones apart.

    ``configs`` has one row per key; ``mapping`` has ``source_id`` and ``target_id``.
    """
    exploded = configs.select(
        key, F.posexplode_outer(notification_ids(F.col("profile_json"))).alias("position", "source_id")
    )
    ids = F.array_sort(F.collect_list(F.struct("position", "source_id", "target_id")))
    grouped = exploded.join(one_target(mapping), "source_id", "left").groupBy(key).agg(ids.alias("_ids"))
    present = F.filter("_ids", lambda e: e["source_id"].isNotNull())
    return grouped.select(
        key,
        F.transform(F.filter(present, lambda e: e["target_id"].isNotNull()), lambda e: e["target_id"]).alias("mapped_ids"),
        F.transform(F.filter(present, lambda e: e["target_id"].isNull()), lambda e: e["source_id"]).alias("unmapped_ids"),
    )


def with_notification_ids(document: Column, ids: Column) -> Column:
    """The profile configuration with its notification group ids replaced."""
    fields = as_object(document)
    settings = _object_or_null(field(fields, "profileSettingsConfigs"))
    channels = _object_or_null(field(settings, "profileNotificationChannels"))
    new_channels = set_field(channels, "configuredNotificationGroupIds", F.to_variant_object(ids.cast("array<variant>")))
    new_settings = set_field(settings, "profileNotificationChannels", F.to_variant_object(new_channels))
    return F.to_json(set_field(fields, "profileSettingsConfigs", F.to_variant_object(new_settings)))


def profile_import_plan(configs: DataFrame, target_ids: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """Payload, or the reason of failure, for every profile configuration (one row per uid).

    With a notification mapping the group ids are mapped to the target.
    """
    joined = configs.join(target_ids, "target_uid", "left")
    document = F.col("profile_json")
    if mapping is not None:
        joined = joined.join(map_notification_ids(configs, mapping), "target_uid", "left")
        # An empty mapping means that none was made, and leaves the ids as they are.
        mapped = (mapping.agg(F.count(F.lit(1)).alias("n")).scalar() > 0) & notification_ids(document).isNotNull()
        document = F.when(mapped, with_notification_ids(document, F.col("mapped_ids"))).otherwise(document)
    # Report texts.
    reason = F.when(F.col("asset_id").isNull(), F.concat(F.lit("No asset found for UID: "), "target_uid")).when(
        parsed(F.col("profile_json")).isNull(),
        F.concat(
            F.when(is_json(F.col("profile_json")), "Too large or repeated keys").otherwise("Invalid JSON"),
            F.lit(" in profile_json for UID "),
            "target_uid",
        ),
    )
    return joined.select(
        "target_uid",
        "asset_id",
        F.when(reason.isNull(), "importable").otherwise("failed").alias("status"),
        reason.alias("reason"),
        F.when(reason.isNull(), document).alias("payload"),
    )


def profile_options(rows: DataFrame, source_uid: str | None = None) -> DataFrame:
    """What there is to choose from among duplicated profiles: notifications, schedule, state, source.

    ``rows`` are numbered candidates with ``target_uid``, ``profile_json`` and
    ``option``. The source is the given column, else ``sourceUid`` of the
    profile, else the number of the option.
    """
    document = parsed(F.col("profile_json"))

    def part(path: str) -> Column:
        return json_text(F.try_variant_get(document, "$." + path, "variant"))

    settings = "profileSettingsConfigs."
    given = F.nullif(strip(F.col(source_uid)), F.lit("")) if source_uid else F.lit(None).cast("string")
    return rows.select(
        "target_uid",
        "option",
        is_set(part(settings + "profileNotificationChannels.configuredNotificationGroupIds")).alias("has_notifications"),
        is_set(part(settings + "schedule")).alias("has_schedule"),
        is_set(part(settings + "enabled")).alias("is_enabled"),
        F.coalesce(
            F.nullif(given, F.lit("Unknown")),
            F.try_variant_get(document, "$.sourceUid", "string"),
            F.concat(F.lit("Config #"), "option", F.lit(" (no source UID)")),
        ).alias("source"),
    )


def config_options(rows: DataFrame) -> DataFrame:
    """What there is to choose from among duplicated configurations.

    ``rows`` are numbered candidates with ``target_uid``, ``config_json``, ``source_uid`` and ``option``.
    """
    document = parsed(F.col("config_json"))

    def part(name: str) -> Column:
        return json_text(F.try_variant_get(document, f"$.assetConfiguration.{name}", "variant"))

    known = has_text(F.col("source_uid")) & (F.col("source_uid") != "Unknown")
    return rows.select(
        "target_uid",
        "option",
        F.when(known, F.concat(F.lit("Source UID: "), "source_uid"))
        .otherwise("Source UID: Not available (from legacy export)")
        .alias("source"),
        F.coalesce(plain(part("resourceStrategyType")), F.lit("N/A")).alias("resource_strategy"),
        is_set(part("autoRetryEnabled")).alias("auto_retry_enabled"),
        is_set(part("isUserMarkedReference")).alias("is_user_marked_reference"),
        document.isNull().alias("invalid_json"),
    )


_CONDITIONS = "array<struct<columnId: variant, condition: variant, value: variant>>"
_SEGMENTS = f"array<struct<name: variant, conditions: {_CONDITIONS}>>"
_SEGMENT_DOC = f"struct<assetSegments: struct<segments: {_SEGMENTS}>, segments: {_SEGMENTS}>"


def segments(document: Column) -> Column:
    """Segments of a segment document in either layout; null or empty means none."""
    given = F.from_json(document, _SEGMENT_DOC)
    return F.coalesce(given["assetSegments"]["segments"], given["segments"])


def has_segments(document: Column) -> Column:
    """Whether a segment document has at least one segment; never null."""
    return F.coalesce(F.size(segments(document)) > 0, F.lit(False))


def with_segments(df: DataFrame, document: str = "segments_json") -> DataFrame:
    """Rows whose document has at least one segment."""
    return df.filter(has_segments(F.col(document)))


def segment_payload(found: Column) -> Column:
    """JSON text of ``segments(document)`` as they are created in the target: ids cleared, defaults filled in."""
    no_id = F.lit(None).cast("long").alias("id")

    def text(value: str) -> Column:
        return F.lit(value).cast("variant")

    def condition(c: Column) -> Column:
        return F.struct(
            no_id,
            c["columnId"].alias("columnId"),
            F.coalesce(c["condition"], text("CUSTOM")).alias("condition"),
            F.coalesce(c["value"], text("")).alias("value"),
        )

    def segment(s: Column) -> Column:
        given = F.coalesce(s["conditions"], F.array().cast(_CONDITIONS))
        return F.struct(
            no_id,
            F.coalesce(s["name"], text("")).alias("name"),
            F.transform(given, condition).alias("conditions"),
        )

    return F.to_json(F.transform(found, segment), {"ignoreNullFields": "false"})


def segment_import_plan(rows: DataFrame, target_ids: DataFrame) -> DataFrame:
    """Payload, or the reason of failure, for every segment document."""
    joined = usable_rows(rows, "target_uid", "segments_json").join(target_ids, "target_uid", "left")
    found = F.col("_segments")
    reason = (
        F.when(parsed(F.col("segments_json")).isNull(), "Invalid JSON")
        .when(found.isNull(), "No segments array")
        .when(F.col("asset_id").isNull(), "No asset found")
    )
    rows = joined.withColumn("_segments", segments(F.col("segments_json"))).withColumn("reason", reason)
    ready = F.col("reason").isNull()
    return rows.select(
        "target_uid",
        "asset_id",
        "reason",
        F.when(ready, F.size(found)).alias("segments"),
        F.when(ready, segment_payload(found)).alias("payload"),
    )


def apply_payload(uuid: Column, overrides: Column | None = None) -> Column:
    """Body of an apply request: defaults, overlaid by ``overrides`` (JSON object text), uuid always set."""
    body = F.create_map(*[x for name, text in APPLY_DEFAULTS for x in (F.lit(name), F.parse_json(F.lit(text)))])
    if overrides is not None:
        custom = F.coalesce(as_object(overrides), F.create_map().cast("map<string,variant>"))
        defaults = F.map_filter(body, lambda key, _: ~F.map_contains_key(custom, key))
        body = F.map_concat(defaults, custom)
    return F.to_json(set_field(body, "uuid", uuid.cast("variant")))
