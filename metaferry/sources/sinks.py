"""Writers. Each writes a folder of part files; row order within is the caller's ``orderBy``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaferry.functions.text import or_blank

# Column order of the tag files.
TAG_COLUMNS = ("Tag_ID", "Tag_Name")
ENRICHED_TAG_COLUMNS = ("Tag_ID", "Tag_Name", "Asset_ID", "Assembly_ID", "Asset_UID", "Assembly_Name")
TRANSFERRED_TAG_COLUMNS = (
    "source_Tag_ID",
    "Source_Tag_Name",
    "source_Asset_ID",
    "source_Assembly_ID",
    "source_Asset_UID",
    "Target_Asset_UID",
    "Target_Asset_ID",
    "Asset_Type",
    "source_Assembly_Name",
)


QUOTED_OPTIONS = {"quoteAll": "true", "escape": '"', "emptyValue": ""}
PLAIN_OPTIONS = {"escape": '"', "emptyValue": ""}


def as_text(df: DataFrame, columns: list[str] | tuple[str, ...] | None = None) -> DataFrame:
    """All columns as text, blanks for nulls, in a fixed order."""
    return df.select(*[or_blank(F.col(c)).alias(c) for c in (columns or df.columns)])


def write_quoted_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with header and every field quoted."""
    as_text(df).write.mode(mode).option("header", "true").options(**QUOTED_OPTIONS).csv(path)


def write_csv(df: DataFrame, path: str, columns: tuple[str, ...] | None = None, mode: str = "errorifexists") -> None:
    """CSV with header, fields quoted where they need it."""
    as_text(df, columns).write.mode(mode).option("header", "true").options(**PLAIN_OPTIONS).csv(path)


def tag_list(bridge: DataFrame) -> DataFrame:
    return bridge.select(F.col("tag_id").alias("Tag_ID"), F.col("tag_name").alias("Tag_Name")).distinct()


def enriched_tags(enriched: DataFrame) -> DataFrame:
    names = ("tag_id", "tag_name", "asset_id", "assembly_id", "asset_uid", "assembly_name")
    return enriched.select(*[F.col(c).alias(n) for c, n in zip(names, ENRICHED_TAG_COLUMNS)])


def write_documents(documents: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Rewritten documents (member, text) as a table, one folder per bundle."""
    documents.select("bundle", "member", "text").write.mode(mode).partitionBy("bundle").parquet(path)


def import_ready(members: DataFrame) -> DataFrame:
    """Bundle names for the rewritten members."""
    stem = F.regexp_replace("bundle", r"(?i)\.zip$", "")
    return members.withColumn("bundle", F.concat(stem, F.lit("-import-ready")))


def write_members(members: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """All members, rewritten JSON and others alike, as a table partitioned by bundle."""
    import_ready(members).select("bundle", "member", "text", "content").write.mode(mode).partitionBy("bundle").parquet(
        path
    )
