"""Jobs over policies, policy bundles and rule tags."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaferry.functions.rename import Renames
from metaferry.operators import documents, imports, policy, sqlrefs, tags
from metaferry.operators.inventory import with_status
from metaferry.sources import bundles
from metaferry.sources.staging import staged


class PolicyInventory(NamedTuple):
    policies: DataFrame
    sql_policies: DataFrame
    view_policies: DataFrame
    view_hits: DataFrame | None
    types: DataFrame
    engines: DataFrame
    assemblies: DataFrame
    source_types: DataFrame
    sql_counts: DataFrame


def policy_inventory(
    policies: DataFrame,
    backing: DataFrame,
    assets: DataFrame,
    assemblies: DataFrame,
    statuses: str = "ALL",
    known_ids: DataFrame | None = None,
    view_assets: DataFrame | None = None,
) -> PolicyInventory:
    """The policy list with its extracts and statistics.

    With ``known_ids`` only policies that can work in the target are listed;
    with ``view_assets`` unmatched SQL views count as known and are reported.
    """
    kept, view_hits = with_status(policies, statuses), None
    if known_ids is not None and view_assets is not None:
        kept, view_hits = policy.policies_on_target_or_view(kept, backing, known_ids, view_assets)
    elif known_ids is not None:
        kept = policy.policies_on_target(kept, backing, known_ids)
    rows = policy.policy_list(kept, backing, assets, assemblies)
    of_kept = backing.join(kept.select(F.col("id").alias("policy_id")), "policy_id", "left_semi")
    details = policy.backing_details(of_kept, assets, assemblies)
    return PolicyInventory(
        policy.order_by_id(rows),
        policy.order_by_id(policy.is_sql_policy(rows)),
        policy.order_by_id(policy.references_view(rows)),
        view_hits,
        policy.type_shares(kept),
        policy.engine_shares(kept),
        policy.assembly_shares(details),
        policy.source_type_shares(details),
        policy.sql_policy_counts(kept),
    )


class Batches(NamedTuple):
    manifest: DataFrame
    summary: DataFrame


def policy_batches(
    policy_rows: DataFrame,
    stamp: str,
    export_type: str | None = None,
    only: str | None = None,
    sizes: Mapping[str, int] | None = None,
) -> Batches:
    """Export batches of a policy list that carries an ``ordinal``."""
    manifest = policy.batch_manifest(policy_rows, stamp, export_type, only, sizes)
    return Batches(manifest, policy.category_summary(manifest))


class BundleRewrite(NamedTuple):
    members: DataFrame
    all_uids: DataFrame
    segmented_uids: DataFrame
    policy_statistics: DataFrame
    changes: DataFrame
    reconciliation: DataFrame


_POLICY = (
    "struct<name: string, isSegmented: boolean, engineType: string, backingAssets: array<struct<uid: string>>>"
)


def bundle_rewrite(
    members: DataFrame, renames: Renames, only_members: str | None = None, staging: bool = False
) -> BundleRewrite:
    """Rewrite the JSON members of bundles and collect what they mention.

    ``only_members`` limits uid extraction to members whose name starts with it.
    With ``staging`` unpacked and rewritten members are written once each and all
    results are computed from those tables; otherwise nothing runs yet.
    """
    if staging:
        members = staged(members)
    texts = members.filter(F.col("text").isNotNull())
    rewritten = documents.rewrite_documents(members, renames, compact=True)
    if staging:
        rewritten = staged(rewritten)
    parsed = bundles.objects_of(texts.select("bundle", "member", "text"), _POLICY).select(
        "bundle",
        "member",
        F.col("isSegmented").alias("is_segmented"),
        F.col("engineType").alias("engine_type"),
        F.col("backingAssets").alias("backing_assets"),
    )
    kind = policy.policy_class(F.col("is_segmented"), F.col("engine_type"))
    segmented = (
        parsed.filter(kind == "segmented_spark").select(F.explode("backing_assets.uid").alias("uid")).filter("uid IS NOT NULL")
    )
    return BundleRewrite(
        rewritten,
        documents.uid_table(documents.document_uids(texts, only_members=only_members), renames),
        documents.uid_table(segmented.distinct(), renames),
        policy.statistics_by_level(parsed),
        documents.change_statistics(rewritten),
        bundles.reconcile_bundles(members, rewritten.filter(F.col("status") != "error")),
    )


class ImportSummary(NamedTuple):
    statistics: DataFrame
    uuids: DataFrame
    data_sources: DataFrame


def policy_import_summary(uploads: DataFrame, policy_rows: DataFrame) -> ImportSummary:
    return ImportSummary(
        imports.import_statistics(uploads), imports.applied_uuids(uploads), policy.data_source_names(policy_rows)
    )


class RuleTags(NamedTuple):
    tags: DataFrame
    frequency: DataFrame
    coverage: DataFrame


def rule_tag_export(rules: DataFrame) -> RuleTags:
    return RuleTags(
        policy.order_by_id(tags.rule_tags(rules), "rule_id"), tags.tag_frequency(rules), tags.tag_coverage(rules)
    )


class SqlDiff(NamedTuple):
    mapping: DataFrame
    unchanged: DataFrame
    report: DataFrame


def custom_sql_diff(source_members: DataFrame, sink_members: DataFrame) -> SqlDiff:
    """Table references of the custom SQL policies in two sets of bundles."""

    def references(members: DataFrame) -> DataFrame:
        policies = members.filter(bundles.is_policy_member(F.col("member")))
        return sqlrefs.policy_references(sqlrefs.policy_sql(policies))

    source, sink = references(source_members), references(sink_members)
    return SqlDiff(
        sqlrefs.reference_mapping(source, sink),
        sqlrefs.unchanged_references(source, sink),
        sqlrefs.reference_report(source, sink),
    )
