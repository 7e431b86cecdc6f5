"""Queries over JSON documents, bundles and SQL table references."""

from __future__ import annotations

import struct
import uuid
import zlib

import pandas as pd
from pyspark.sql import functions as F

from metaferry.functions import jsondoc, rename
from metaferry.operators import documents, sqlrefs
from metaferry.snapshots.registry import Inputs, query
from metaferry.sources import bundles, ordered, sinks, tables
from metaferry.sources.staging import staging_folder

# Frequent words of the text tables, with a cascade and a pair that must not touch its neighbours.
WORD_RENAMES = [("the", "THE_T"), ("and", "the"), ("de", "DE.T"), ("le", "$1")]


def _words_sql(column: str) -> str:
    """The word renames in RE2, whose word edge knows only ASCII: edges are spelled out
    and each pass runs twice, since neighbours share an edge character."""
    text = column
    for number, (source, _) in enumerate(WORD_RENAMES):
        step = f"'(^|[^\\p{{L}}\\p{{N}}_]){source}($|[^\\p{{L}}\\p{{N}}_])', '\\1_ph{number}ph_\\2', 'g'"
        text = f"regexp_replace(regexp_replace({text}, {step}), {step})"
    for number, (_, target) in enumerate(WORD_RENAMES):
        text = f"replace({text}, '_ph{number}ph_', '{target}')"
    return text


@query("rename_words_in_text", f"SELECT doc_id, {_words_sql('text')} AS text FROM $documents")
def _(i: Inputs):
    return i.documents.select("doc_id", rename.rename_words(F.col("text"), WORD_RENAMES).alias("text"))


@query(
    "rename_words_in_turns",
    f"SELECT conv_id, turn, {_words_sql('text')} AS text FROM $conversations",
)
def _(i: Inputs):
    return i.conversations.select("conv_id", "turn", rename.rename_words(F.col("text"), WORD_RENAMES).alias("text"))


# A thousand words by rule: one or two small letters, and the numbers below 298, each of which becomes the next one.
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
THOUSAND_RENAMES = [
    *((word, f"W_{word.upper()}") for word in [*_LETTERS, *(a + b for a in _LETTERS for b in _LETTERS)]),
    *((str(number), str(number + 1)) for number in range(298)),
]


@query(
    "rename_thousand_words",
    """SELECT doc_id, array_to_string(list_transform(regexp_extract_all(text, '[\\p{L}\\p{N}_]+|[^\\p{L}\\p{N}_]+'), lambda w:
        CASE WHEN regexp_full_match(w, '[a-z]{1,2}') THEN concat('W_', upper(w))
             WHEN regexp_full_match(w, '0|[1-9][0-9]{0,2}') AND CAST(w AS INTEGER) < 298 THEN CAST(CAST(w AS INTEGER) + 1 AS VARCHAR)
             ELSE w END), '') AS text
    FROM $documents""",
)
def _(i: Inputs):
    return i.documents.select("doc_id", rename.rename_words(F.col("text"), THOUSAND_RENAMES).alias("text"))


def _text_documents(i: Inputs):
    """One JSON document per text, nested, with the text as value, key-like value and list element."""
    body = F.to_json(
        F.struct(
            F.col("doc_id").alias("the"),
            F.struct(F.col("text").alias("and"), F.array(F.col("lang"), F.col("text")).alias("list")).alias("de"),
            F.lit('x "the":').alias("le"),
        )
    )
    return i.documents.select("doc_id", body.alias("text"))


@query(
    "rewrite_documents",
    f"""WITH d AS (SELECT doc_id, lang, text AS old, {_words_sql('text')} AS new,
        {_words_sql('lang')} AS new_lang FROM $documents)
    SELECT doc_id, new AS "value", concat(new_lang, '|', new) AS list, 'x "THE_T":' AS label,
           CAST(CASE WHEN new <> old THEN 2 ELSE 0 END + CASE WHEN new_lang <> lang THEN 1 ELSE 0 END + 1 AS BIGINT)
               AS changes, 'rewritten' AS status
    FROM d""",
)
def _(i: Inputs):
    done = documents.rewrite_documents(_text_documents(i), WORD_RENAMES)
    schema = "struct<the: bigint, de: struct<`and`: string, list: array<string>>, le: string>"
    parsed = done.withColumn("_d", F.from_json("text", schema))
    return parsed.select(
        F.col("_d.the").alias("doc_id"),
        F.col("_d.de.and").alias("value"),
        F.array_join("_d.de.list", "|").alias("list"),
        F.col("_d.le").alias("label"),
        F.col("changes").cast("long").alias("changes"),
        "status",
    )


_POLICY_DOC = """CASE WHEN o_orderkey % 97 = 5 THEN concat('{"broken":', o_orderkey)
    WHEN o_orderkey % 97 = 6 THEN NULL
    ELSE concat('[{"name":"policy_', o_orderkey, '","uid":" PROD_DB.T', o_custkey,
        ' ","meta":{"parentAssetUid":"PROD_DB.P', o_orderkey % 500, '","GUID":"","note":"PROD_DB_X PROD_DB",',
        '"deep":[[{"backingAssetId":"B', o_orderkey % 300, '"}]],"uid":', o_orderkey, '}},',
        '{"value":"uid","backingAssets":[{"assetUid":"PROD_DB.T', o_custkey, '"}]}]') END"""


def _policy_documents(i: Inputs):
    member = """CASE o_orderkey % 4 WHEN 0 THEN 'data_quality_policy_definitions.json'
        WHEN 1 THEN 'data_sources.json' WHEN 2 THEN 'sub/business_rules_1.json' ELSE 'notes.txt' END"""
    return i.orders.selectExpr(
        "concat('bundle_', o_custkey) AS bundle", f"{member} AS member", f"{_POLICY_DOC} AS text", "o_orderkey", "o_custkey"
    )


@query(
    "document_uids",
    """WITH ok AS (SELECT * FROM $orders WHERE o_orderkey % 97 NOT IN (5, 6)),
    u AS (SELECT concat('PROD_DB.T', o_custkey) AS uid FROM ok
          UNION SELECT concat('PROD_DB.P', o_orderkey % 500) FROM ok
          UNION SELECT concat('B', o_orderkey % 300) FROM ok)
    SELECT uid AS source_env, replace(uid, 'PROD_DB.', 'DEV_DB.') AS target_env FROM u ORDER BY uid""",
)
def _(i: Inputs):
    return documents.uid_table(documents.document_uids(_policy_documents(i)), [("PROD_DB", "DEV_DB")])


@query(
    "change_statistics",
    """SELECT count(*) AS documents, count(*) FILTER (o_orderkey % 97 NOT IN (5, 6)) AS successful,
        count(*) FILTER (o_orderkey % 97 = 5) AS failed, count(*) FILTER (o_orderkey % 97 = 6) AS copied,
        count(*) FILTER (o_orderkey % 97 NOT IN (5, 6)) AS documents_changed,
        4 * count(*) FILTER (o_orderkey % 97 NOT IN (5, 6)) AS values_changed
    FROM $orders""",
)
def _(i: Inputs):
    done = documents.rewrite_documents(_policy_documents(i), [("PROD_DB", "DEV_DB")])
    return documents.change_statistics(done)


@query(
    "rewritten_policy_text",
    f"""WITH d AS (SELECT o_orderkey, {_POLICY_DOC} AS text FROM $orders)
    SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 5 THEN text ELSE
        regexp_replace(text, '\\bPROD_DB\\b', 'DEV_DB', 'g') END AS text
    FROM d WHERE text IS NOT NULL""",
)
def _(i: Inputs):
    texts = _policy_documents(i).filter(F.col("text").isNotNull())
    return documents.rewrite_documents(texts, [("PROD_DB", "DEV_DB")], compact=True).select("o_orderkey", "text")


@query(
    "json_problems",
    """WITH d AS (SELECT o_orderkey, o_orderkey % 6 AS k FROM $orders)
    SELECT o_orderkey, CASE k WHEN 0 THEN 'blank' WHEN 1 THEN 'invalid_json' WHEN 2 THEN 'not_an_object'
        WHEN 3 THEN 'empty_object' END AS problem FROM d WHERE k < 4""",
)
def _(i: Inputs):
    text = F.expr("""CASE o_orderkey % 6 WHEN 0 THEN ' ' WHEN 1 THEN '{"a":' WHEN 2 THEN '[1]' WHEN 3 THEN '{ }'
        ELSE concat('{"a":', o_orderkey, '}') END""")
    rows = i.orders.select("o_orderkey", jsondoc.json_problem(text).alias("problem"))
    return rows.filter(F.col("problem").isNotNull())


def _stored_archive(members: list[tuple[str, str]]) -> bytes:
    """A ZIP archive as the library writes it of members that are stored, all of 1980-01-01."""
    body, directory, offset = [], [], 0
    for member, text in members:
        name, data = member.encode("ascii"), text.encode()
        facts = struct.pack("<HHHHHLLLHH", 20, 0, 0, 0, 33, zlib.crc32(data), len(data), len(data), len(name), 0)
        body += [b"PK\x03\x04", facts, name, data]
        directory += [b"PK\x01\x02\x14\x03", facts, struct.pack("<HHHLL", 0, 0, 0, 0o600 << 16, offset), name]
        offset += 30 + len(name) + len(data)
    listed = b"".join(directory)
    end = struct.pack("<4s4HLLH", b"PK\x05\x06", 0, 0, len(members), len(members), len(listed), offset, 0)
    return b"".join([*body, listed, end])


def _zip_documents(batches):
    for batch in batches:
        archives = []
        for key, member, text in zip(batch["o_orderkey"], batch["member"], batch["text"]):
            content = _stored_archive([(member, text or ""), ("readme.txt", "é")] if key % 10 != 9 else [])
            archives.append((f"b{key}.zip", content[:9] if key % 10 == 8 else content))
        yield pd.DataFrame(archives, columns=["bundle", "content"])


def _members(i: Inputs):
    archives = _policy_documents(i).select("o_orderkey", "member", "text")
    return bundles.open_bundles(archives.mapInPandas(_zip_documents, "bundle string, content binary"))


_BUNDLES = f"""WITH d AS (SELECT o_orderkey AS k, {_POLICY_DOC} AS text,
        CASE o_orderkey % 4 WHEN 0 THEN 'data_quality_policy_definitions.json' WHEN 1 THEN 'data_sources.json'
            WHEN 2 THEN 'sub/business_rules_1.json' ELSE 'notes.txt' END AS member FROM $orders)"""


@query(
    "bundle_members",
    _BUNDLES
    + """ SELECT concat('b', k, '.zip') AS bundle, member,
        CASE k % 4 WHEN 0 THEN 'Data Quality Policy Definitions' WHEN 1 THEN 'Data Sources'
            WHEN 2 THEN 'Business Rules' ELSE 'Other/Unknown' END AS kind,
        CASE WHEN k % 4 = 3 THEN '' ELSE coalesce(text, '') END AS text, k % 4 = 0 AS is_policy
    FROM d WHERE k % 10 < 8
    UNION ALL SELECT concat('b', k, '.zip'), 'readme.txt', 'Other/Unknown', '', false FROM d WHERE k % 10 < 8
    UNION ALL SELECT concat('b', k, '.zip'), '', 'Other/Unknown', '', false FROM d WHERE k % 10 >= 8""",
)
def _(i: Inputs):
    member = F.coalesce("member", F.lit(""))
    return _members(i).select(
        "bundle",
        member.alias("member"),
        "kind",
        F.coalesce("text", F.lit("")).alias("text"),
        bundles.is_policy_member(member).alias("is_policy"),
    )


@query(
    "usable_bundles",
    "SELECT concat('b', o_orderkey, '.zip') AS bundle, 2 AS members FROM $orders WHERE o_orderkey % 10 < 8",
)
def _(i: Inputs):
    return bundles.usable_bundles(_members(i))


@query("csv_round_trip", "SELECT doc_id, text, lang FROM $documents")
def _(i: Inputs):
    # Each row as a line of a quoted file, read back with the options of the reader.
    line = F.to_csv(F.struct(F.col("doc_id").cast("string"), "text", "lang"), sinks.QUOTED_OPTIONS)
    back = F.from_csv(line, "doc_id string, text string, lang string", tables.READ_OPTIONS)
    return i.documents.select(back.alias("r")).select(F.col("r.doc_id").cast("long").alias("doc_id"), "r.text", "r.lang")


@query(
    "merged_in_order",
    """SELECT source_uid, source_id, row_number() OVER (ORDER BY lower(source_uid), source_id) - 1 AS position
    FROM $source_inventory""",
)
def _(i: Inputs):
    # Partial outputs as several workers leave them, merged into one order over 20 files.
    rows = i.source_inventory.select(F.lower("source_uid").alias("sorted_by"), "source_uid", "source_id")
    partial = [rows.filter(F.col("source_id") % 3 == k) for k in (2, 0, 1)]
    path = f"{staging_folder(i.spark)}/ordered-{uuid.uuid4().hex}"
    ordered.write_in_order(partial[0].unionByName(partial[1]).unionByName(partial[2]), ["sorted_by", "source_id"], path, 20)
    return ordered.read_in_order(i.spark, path).select("source_uid", "source_id", "position")


@query("decoded_text", "SELECT doc_id, text FROM $documents")
def _(i: Inputs):
    # Latin-1 bytes wherever the text can be written in them, else UTF-8.
    fits = F.col("text").rlike(r"\A[\x00-\xff]*+\z")
    content = F.when(fits, F.encode("text", "ISO-8859-1")).otherwise(F.encode("text", "UTF-8"))
    return i.documents.filter(F.col("text").isNotNull()).select("doc_id", bundles.text_of(content).alias("text"))


@query(
    "bundle_reconciliation",
    """SELECT concat('bundle_', o_custkey) AS bundle, count(*) AS members_in,
        count(*) FILTER (o_orderkey % 97 <> 5) AS members_out,
        CASE WHEN count(*) = count(*) FILTER (o_orderkey % 97 <> 5) THEN 'ok' ELSE 'count_mismatch' END AS status
    FROM $orders GROUP BY o_custkey""",
)
def _(i: Inputs):
    before = _policy_documents(i)
    after = documents.rewrite_documents(before, [("PROD_DB", "DEV_DB")])
    return bundles.reconcile_bundles(before, after.filter(F.col("status") != "error"))


@query(
    "document_objects",
    """SELECT o_orderkey, concat('policy_', o_orderkey) AS name FROM $orders WHERE o_orderkey % 97 NOT IN (5, 6)
    UNION ALL SELECT o_orderkey, '-' FROM $orders WHERE o_orderkey % 97 NOT IN (5, 6)""",
)
def _(i: Inputs):
    rows = bundles.objects_of(_policy_documents(i).select("o_orderkey", "text"), "struct<name: string>")
    return rows.select("o_orderkey", F.coalesce("name", F.lit("-")).alias("name"))


_REFS = """refs AS (
    SELECT DISTINCT 'source' AS side, policy,
           unnest(regexp_extract_all(sql, '([A-Za-z0-9_]+)\\.([A-Za-z0-9_]+)\\.([A-Za-z0-9_]+)')) AS reference
    FROM $source_sql
    UNION SELECT DISTINCT 'sink', policy,
           unnest(regexp_extract_all(sql, '([A-Za-z0-9_]+)\\.([A-Za-z0-9_]+)\\.([A-Za-z0-9_]+)')) FROM $sink_sql),
    keyed AS (SELECT *, concat(split_part(reference, '.', 2), '.', split_part(reference, '.', 3)) AS schema_table FROM refs),
    sided AS (SELECT policy, schema_table, reference, bool_or(side = 'source') AS in_source,
                  bool_or(side = 'sink') AS in_sink FROM keyed GROUP BY ALL),
    mapped AS (SELECT *, bool_or(in_source) OVER k AND bool_or(in_sink) OVER k AS matched,
                  in_source AND in_sink AS unchanged
               FROM sided WINDOW k AS (PARTITION BY policy, schema_table))"""


def _sql_documents(rows):
    """Policy documents in the two layouts a custom SQL configuration may have."""
    single = F.to_json(F.struct(F.col("policy").alias("name"), F.struct(F.col("sql").alias("sqlExpression")).alias("customSqlConfig")))
    listed = F.to_json(
        F.struct(F.col("policy").alias("name"), F.array(F.struct(F.col("sql").alias("sqlExpression"))).alias("customSqlConfig"))
    )
    text = F.when(F.length("sql") % 2 == 0, single).otherwise(F.concat(F.lit("["), listed, F.lit("]")))
    return rows.select(text.alias("text"))


def _sides(i: Inputs):
    return tuple(
        sqlrefs.policy_references(sqlrefs.policy_sql(_sql_documents(rows))) for rows in (i.source_sql, i.sink_sql)
    )


@query("sql_references", f"WITH {_REFS} SELECT policy, reference, schema_table FROM keyed WHERE side = 'source'")
def _(i: Inputs):
    return _sides(i)[0].withColumn("schema_table", sqlrefs.schema_table(F.col("reference")))


@query("sql_reference_mapping", f"WITH {_REFS} SELECT * FROM mapped")
def _(i: Inputs):
    return sqlrefs.reference_mapping(*_sides(i))


@query("sql_all_policies", f"WITH {_REFS} SELECT DISTINCT policy FROM refs")
def _(i: Inputs):
    return sqlrefs.all_policies(*_sides(i))


@query(
    "sql_unchanged_references",
    f"""WITH {_REFS} SELECT policy, reference FROM refs WHERE side = 'source'
    INTERSECT SELECT policy, reference FROM refs WHERE side = 'sink'""",
)
def _(i: Inputs):
    return sqlrefs.unchanged_references(*_sides(i))


@query(
    "sql_reference_report",
    f"""WITH {_REFS} SELECT policy, count(*) FILTER (in_source) AS source_tables, count(*) FILTER (in_sink) AS sink_tables,
        count(*) FILTER (in_source AND matched) AS source_tables_matched,
        count(*) FILTER (in_source AND NOT matched) AS source_tables_without_match,
        count(*) FILTER (unchanged) AS unchanged_tables
    FROM mapped GROUP BY policy""",
)
def _(i: Inputs):
    return sqlrefs.reference_report(*_sides(i))
