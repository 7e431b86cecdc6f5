"""Outcome of policy imports, from tables of upload and apply responses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Counters of an upload response.
COUNTERS = (
    "conflictingAssemblies",
    "conflictingPolicies",
    "conflictingSqlViews",
    "conflictingVisualViews",
    "preChecks",
    "totalAssetUDFVariablesPerAsset",
    "totalBusinessRules",
    "totalDataCadencePolicyCount",
    "totalDataDriftPolicyCount",
    "totalDataQualityPolicyCount",
    "totalDataSourceCount",
    "totalPolicyCount",
    "totalProfileAnomalyPolicyCount",
    "totalReconciliationPolicyCount",
    "totalReferenceAssets",
    "totalSchemaDriftPolicyCount",
    "totalUDFPackages",
    "totalUDFTemplates",
)


def import_statistics(uploads: DataFrame) -> DataFrame:
    """One row of totals over ``uploads(file, uuid, response, applied)``.

    ``response`` is the JSON text of the upload response, ``applied`` whether
    the apply request worked; counters are summed over applied files only.
    """
    schema = "struct<" + ", ".join(f"{name}: double" for name in COUNTERS) + ">"
    parsed = uploads.withColumn("_r", F.from_json("response", schema))
    uploaded = F.coalesce(F.col("uuid") != "", F.lit(False))
    done = uploaded & F.coalesce(F.col("applied"), F.lit(False))
    return parsed.agg(
        *[F.coalesce(F.sum(F.when(done, F.col(f"_r.{name}"))).cast("bigint"), F.lit(0)).alias(name) for name in COUNTERS],
        F.count_if(done).alias("files_processed"),
        F.count_if(~done).alias("files_failed"),
        F.count_if(uploaded).alias("upload_configs_successful"),
        F.count_if(~uploaded).alias("upload_configs_failed"),
        F.count_if(done).alias("apply_configs_successful"),
        F.count_if(uploaded & ~done).alias("apply_configs_failed"),
    )


def applied_uuids(uploads: DataFrame) -> DataFrame:
    """Identifiers of the applied uploads, one per row."""
    return uploads.filter(F.col("applied") & (F.col("uuid") != "")).select("file", "uuid")
