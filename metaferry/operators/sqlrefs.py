"""Table references in custom SQL policies, and how they differ between two sets of policies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metaferry.functions.text import strip
from metaferry.operators.joins import hot_join

# Fixed value: a reference of the form database.schema.table.
TABLE_REFERENCE = r"([A-Za-z0-9_]+)\.([A-Za-z0-9_]+)\.([A-Za-z0-9_]+)"


def references(sql: Column) -> Column:
    """All non-overlapping ``db.schema.table`` references of a text."""
    return F.regexp_extract_all(sql, F.lit(TABLE_REFERENCE), F.lit(0))


def schema_table(reference: Column) -> Column:
    return F.substring_index(reference, ".", -2)


def policy_sql(documents: DataFrame, document: str = "text") -> DataFrame:
    """Policy name and SQL text from policy documents.

    A document is a policy or a list of policies, ``customSqlConfig`` an object
    or a list of objects.
    """
    parsed = F.from_json(document, "array<struct<name: string, customSqlConfig: variant>>")
    config = F.col("_p.customSqlConfig")

    def expression(value: Column) -> Column:
        return F.try_variant_get(value, "$.sqlExpression", "string")

    listed = F.transform(config.try_cast("array<variant>"), expression)
    texts = F.coalesce(listed, F.array(expression(config)))
    return (
        documents.select(F.explode(parsed).alias("_p"))
        .select(strip(F.col("_p.name")).alias("policy"), F.explode(F.array_distinct(texts)).alias("sql"))
        .filter((F.coalesce("policy", F.lit("")) != "") & (F.coalesce("sql", F.lit("")) != ""))
    )


def policy_references(policy_sql_rows: DataFrame) -> DataFrame:
    """Distinct references per policy."""
    return policy_sql_rows.select("policy", F.explode(references(F.col("sql"))).alias("reference")).distinct()


def reference_mapping(source: DataFrame, sink: DataFrame) -> DataFrame:
    """One row per policy and reference of either side, with what it has on the other.

    Source and sink references correspond if they have the same policy and
    ``schema_table``, whatever the database. That key stands in every row, so
    the references that correspond to one are the rows of its key; no list and
    no pair is formed, and the result is as long as the input.
    """

    def side(rows: DataFrame, is_source: bool) -> DataFrame:
        return rows.select(
            "policy",
            schema_table(F.col("reference")).alias("schema_table"),
            "reference",
            F.lit(is_source).alias("in_source"),
            F.lit(not is_source).alias("in_sink"),
        )

    both = side(source, True).unionByName(side(sink, False))
    rows = both.groupBy("policy", "schema_table", "reference").agg(
        F.max("in_source").alias("in_source"), F.max("in_sink").alias("in_sink")
    )
    keys = both.groupBy("policy", "schema_table").agg(
        F.max("in_source").alias("_any_source"), F.max("in_sink").alias("_any_sink")
    )
    return hot_join(rows, keys, ["policy", "schema_table"]).select(
        "policy",
        "schema_table",
        "reference",
        "in_source",
        "in_sink",
        (F.col("_any_source") & F.col("_any_sink")).alias("matched"),
        (F.col("in_source") & F.col("in_sink")).alias("unchanged"),
    )


def all_policies(source: DataFrame, sink: DataFrame) -> DataFrame:
    return source.select("policy").union(sink.select("policy")).distinct()


def unchanged_references(source: DataFrame, sink: DataFrame) -> DataFrame:
    """References a policy has on both sides."""
    return source.select("policy", "reference").intersect(sink.select("policy", "reference"))


def reference_report(source: DataFrame, sink: DataFrame) -> DataFrame:
    """One row per policy: references on each side, those that correspond to one of the other side, unchanged ones."""
    mapped = reference_mapping(source, sink)
    return mapped.groupBy("policy").agg(
        F.count_if("in_source").alias("source_tables"),
        F.count_if("in_sink").alias("sink_tables"),
        F.count_if(F.col("in_source") & F.col("matched")).alias("source_tables_matched"),
        F.count_if(F.col("in_source") & ~F.col("matched")).alias("source_tables_without_match"),
        F.count_if("unchanged").alias("unchanged_tables"),
    )
