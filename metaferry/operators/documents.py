"""Policy documents: renaming, uid extraction and statistics over whole bundles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metaferry.functions.jsondoc import find_uids, is_json, rewrite_strings
from metaferry.functions.rename import Renames, rename_words


def rewrite_documents(documents: DataFrame, renames: Renames, text: str = "text", compact: bool = False) -> DataFrame:
    """Documents with all string values renamed, the number of changed values and a status.

    Texts that are not JSON keep their content and get status ``error``; rows
    without text (other bundle members) pass through.
    """
    document, valid = F.col(text), F.col("_valid")
    edited = F.when(valid, rewrite_strings(document, renames, compact))
    status = F.when(document.isNull(), "copied").when(valid, "rewritten").otherwise("error")
    return (
        documents.withColumn("_valid", is_json(document))
        .withColumns({"_edited": edited, "status": status})
        .withColumn(text, F.coalesce("_edited.text", text))
        .withColumn("changes", F.coalesce("_edited.changes", F.lit(0)))
        .drop("_edited", "_valid")
    )


def document_uids(documents: DataFrame, text: str = "text", only_members: str | None = None) -> DataFrame:
    """Distinct uids mentioned anywhere in the documents; texts that are not JSON mention none.

    ``only_members`` limits the scan to members whose name starts with it.
    """
    if only_members is not None:
        documents = documents.filter(F.col("member").startswith(only_members))
    document = F.col(text)
    return documents.select(F.explode(F.when(is_json(document), find_uids(document))).alias("uid")).distinct()


def uid_table(uids: DataFrame, renames: Renames) -> DataFrame:
    """Sorted source uids with their renamed counterpart."""
    return uids.select(F.col("uid").alias("source_env"), rename_words(F.col("uid"), renames).alias("target_env")).orderBy(
        "source_env"
    )


def change_statistics(rewritten: DataFrame) -> DataFrame:
    """One row: documents seen, rewritten, failed, copied, documents and values changed."""
    status = F.col("status")
    return rewritten.agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if(status == "rewritten").alias("successful"),
        F.count_if(status == "error").alias("failed"),
        F.count_if(status == "copied").alias("copied"),
        F.count_if(F.col("changes") > 0).alias("documents_changed"),
        F.coalesce(F.sum("changes"), F.lit(0)).alias("values_changed"),
    )
