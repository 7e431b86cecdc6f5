"""The registered queries of this folder, each over its whole table, and their SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metaferry.llm import (
    block_labeller,
    bpe,
    hamming_search,
    importance,
    language_id,
    lexical_search,
    line_dedup,
    mixing,
    near_dedup,
    quality_rules,
    substring_dedup,
    token_alignment,
    token_counts,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
# Words as in metaferry.llm.columns.words.
WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def query(sql: str | None = None):
    """Register a function under its name, with SQL where SQL can express it."""

    def register(build):
        QUERIES[build.__name__] = build
        if sql:
            ORACLES[build.__name__] = sql
        return build

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query(
    rf"""
    WITH sizes AS (SELECT doc_id, source, CAST(len({WORDS_SQL}) AS BIGINT) AS size,
                          md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
    totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n_documents,
                      row_number() OVER (ORDER BY source NULLS LAST) AS sid FROM sizes GROUP BY source),
    weighted AS (SELECT *, [5, 2, 1][(sid - 1) % 3 + 1] AS weight FROM totals),
    levels AS (SELECT *, row_number() OVER o AS place,
                      CAST(sum(source_size) OVER () - coalesce(3 * sum(source_size) OVER b, 0) AS BIGINT) AS rest,
                      CAST(sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS BIGINT) AS weights
               FROM weighted
               WINDOW o AS (ORDER BY source_size / weight, sid),
                      b AS (ORDER BY source_size / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    filled AS (SELECT *, 3 * source_size / weight < rest / weights AS is_full FROM levels),
    opened AS (SELECT rest AS r, weights AS w FROM filled WHERE NOT is_full ORDER BY place LIMIT 1),
    targets AS (SELECT sid, source, source_size, n_documents,
                       CASE WHEN is_full THEN CAST(3 * source_size AS DOUBLE)
                            ELSE least(r / w * weight, CAST(3 * source_size AS DOUBLE)) END AS target
                FROM filled, opened),
    blocks AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(greatest(1, round(source_size / greatest(1,
                             ceil((SELECT sum(source_size) FROM targets)
                                  / greatest((SELECT sum(n_documents) FROM targets), 131072)))))
                             AS BIGINT) ELSE 0 END AS n_blocks FROM targets),
    based AS (SELECT *, CASE WHEN n_blocks > 0 THEN source_size // n_blocks ELSE 0 END AS base,
                     CASE WHEN n_blocks > 0 THEN target / source_size * n_blocks ELSE 0.0 END AS slots FROM blocks),
    sized AS (SELECT *, source_size - n_blocks * base AS larger FROM based),
    bounds AS (SELECT *, CAST(floor(sum(slots) OVER (ORDER BY sid ROWS UNBOUNDED PRECEDING)
                                    / (SELECT sum(slots) FROM (SELECT slots FROM sized ORDER BY sid)) * 2147483648) AS BIGINT)
                             AS upper_point FROM sized WHERE slots > 0),
    owners AS (SELECT *, coalesce(lag(upper_point) OVER (ORDER BY sid), 0) AS lower_point FROM bounds),
    slots AS (SELECT slot, (slot % 2147483648 * 1327217885) % 2147483648 AS point
              FROM (SELECT unnest(range(CAST((SELECT round(sum(slots)) FROM (SELECT slots FROM sized ORDER BY sid))
                                             AS BIGINT))) AS slot) AS s),
    ranked AS (SELECT sid, n_blocks, row_number() OVER (PARTITION BY sid ORDER BY slot) - 1 AS k
               FROM slots JOIN owners ON point >= lower_point AND point < upper_point),
    times AS (SELECT sid, k % n_blocks AS block, count(*) AS times FROM ranked WHERE k < 3 * n_blocks GROUP BY 1, 2),
    placed AS (SELECT doc_id, size, t.*, sum(size) OVER (PARTITION BY sid ORDER BY h, doc_id, size
                                                         ROWS UNBOUNDED PRECEDING) - size AS first_word
               FROM sizes s JOIN sized t ON s.source IS NOT DISTINCT FROM t.source),
    starts AS (SELECT t.sid, block, times, block * base + least(block, larger) AS b0,
                      (block + 1) * base + least(block + 1, larger) AS b1
               FROM times JOIN sized t USING (sid)),
    taken AS (SELECT p.doc_id, p.sid, p.first_word, sum((least(first_word + size, b1) - greatest(first_word, b0)) * times) AS n
              FROM placed p JOIN starts b ON p.sid = b.sid AND b0 < first_word + size AND b1 > first_word AND size > 0
              GROUP BY ALL)
    SELECT p.doc_id, size, source_size, target, CAST(coalesce(n, 0) AS BIGINT) AS taken
    FROM placed p LEFT JOIN taken t ON p.doc_id = t.doc_id AND p.sid = t.sid AND p.first_word = t.first_word AND size > 0"""
)
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


@query(
    r"""
    WITH found AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
                          generate_subscripts(string_split(text, chr(10)), 1) AS place FROM documents),
    totals AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
    counts AS (SELECT source, line, count(DISTINCT doc_id) AS n_pages FROM found
               WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY source, line),
    cut AS (SELECT c.source, line FROM counts c JOIN totals t ON c.source IS NOT DISTINCT FROM t.source
            WHERE n_pages >= 3 AND 100 * n_pages > n),
    marked AS (SELECT f.*, c.line IS NOT NULL AS is_cut FROM found f
               LEFT JOIN cut c ON f.source IS NOT DISTINCT FROM c.source AND f.line = c.line),
    texts AS (SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT is_cut), '') AS t,
                     count(*) FILTER (is_cut) AS n_cut,
                     count(*) FILTER (regexp_matches(line, '[^\x20\x09-\x0D]')) AS n_lines
              FROM marked GROUP BY doc_id)
    SELECT doc_id, n_lines, n_cut, CAST(length(t) AS BIGINT) AS n_chars, sha256(t) AS text_sha256 FROM texts"""
)
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return line_dedup.with_cut_lines(docs).select("doc_id", *line_dedup.cut_columns()).select(
        "doc_id",
        "n_lines",
        "n_cut",
        F.length("cut_text").cast("bigint").alias("n_chars"),
        F.sha2("cut_text", 256).alias("text_sha256"),
    )


@query()
def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir))


@query(
    rf"""
    WITH d AS (SELECT doc_id, text, {WORDS_SQL} AS w FROM documents),
    windows AS (SELECT doc_id, w[p] AS a, w[p + 1] AS b, w[p + 2] AS c, p
                FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM d) AS places),
    repeated AS (SELECT doc_id, p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM windows) AS x
                 WHERE n > 1),
    covered AS (SELECT doc_id, count(DISTINCT q) AS n
                FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM repeated) AS x GROUP BY doc_id),
    found AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
    lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
              FROM found WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
    m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
                 CAST(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                 coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
                 coalesce(n, 0) AS n_repeat_words
          FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
    b AS (SELECT *, CASE WHEN n_words < 50 THEN 1 ELSE 0 END
                    + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
                    + CASE WHEN 10 * n_symbols > 3 * n_words THEN 4 ELSE 0 END
                    + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
                    + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END
                    + CASE WHEN word_chars > 15 * n_words THEN 32 ELSE 0 END AS failed_bits FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, CAST(failed_bits AS BIGINT) AS failed_bits,
           failed_bits % 4 <> 0 AS base_failed, failed_bits = 0 AS kept
    FROM b"""
)
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    bits = F.col("failed_bits")
    return quality_rules.ledger(documents(spark, sf_dir)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "failed_bits",
        (~quality_rules.passes(bits, "base")).alias("base_failed"),
        quality_rules.passes(bits, quality_rules.CURRENT).alias("kept"),
    )


@query()
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(documents(spark, sf_dir).select("doc_id", "text"), decoded="decoded")
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op1_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return importance.resampled(documents(spark, sf_dir), labels)


@query(
    """
    WITH codes AS (SELECT vec_id, list_transform(embedding, lambda x: x > 0) AS bits FROM embeddings),
    pairs AS (SELECT q.vec_id AS query_id, v.vec_id AS neighbour_id,
                     CAST(len(list_filter(list_zip(q.bits, v.bits), lambda p: p[1] <> p[2])) AS INTEGER) AS distance
              FROM codes q JOIN codes v ON q.vec_id % 20 = 0 AND q.vec_id <> v.vec_id),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS INTEGER) AS rank
               FROM pairs)
    SELECT * FROM ranked WHERE rank <= 10"""
)
def op4_hamming_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return hamming_search.search(vectors, vectors.filter("vec_id % 20 = 0"))


@query()
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(documents(spark, sf_dir))


@query()
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), lone_mark=True)


@query()
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return block_labeller.main_text(pages).withColumn("n_chars", F.length("text").cast("bigint"))


# Terms as in metaferry.llm.lexical_search.TERM.
TERMS_SQL = (
    "regexp_extract_all(translate(coalesce(text, ''), '" + lexical_search.CAPITALS + "', '" + lexical_search.SMALL + "'), '"
    + lexical_search.TERM + "')"
)


@query(
    rf"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {TERMS_SQL} AS w FROM documents),
    totals AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
    items AS (SELECT DISTINCT item_id, unnest({TERMS_SQL}) AS term FROM benchmark),
    found AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(w) AS term FROM d) AS t
              WHERE term IN (SELECT term FROM items) GROUP BY rid, term),
    weights AS (SELECT term, CAST(floor(1000 * ln((2 * CAST(n_docs AS DOUBLE) + 2) / (2 * CAST(df AS DOUBLE) + 1))) AS BIGINT) AS w
                FROM (SELECT term, count(*) AS df FROM found GROUP BY term) AS f, totals),
    lengths AS (SELECT rid, doc_id, 100 - 90 + (90 * len(w) * n_docs) // n_terms AS m FROM d, totals WHERE len(w) > 0),
    scores AS (SELECT item_id, doc_id, rid, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
               FROM found JOIN weights USING (term) JOIN lengths USING (rid) JOIN items USING (term)
               GROUP BY item_id, doc_id, rid),
    ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
                      doc_id, score FROM scores WHERE score > 0)
    SELECT * FROM ranked WHERE rank <= 10"""
)
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return lexical_search.search(documents(spark, sf_dir), items)


@query(
    rf"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS_SQL} AS w FROM documents),
    windows AS (SELECT rid, p, list_slice(w, p, p + 34) AS words
                FROM (SELECT rid, w, unnest(range(1, len(w) - 33)) AS p FROM d WHERE len(w) >= 35) AS x),
    known AS (SELECT rid, p, count(*) OVER (PARTITION BY sha256(array_to_string(words, ' '))) AS n FROM windows),
    covered AS (SELECT DISTINCT rid, p + k AS q FROM known, range(35) AS r(k) WHERE n > 1),
    gone AS (SELECT rid, list(q) AS q FROM covered GROUP BY rid),
    kept AS (SELECT rid, array_to_string(list(word ORDER BY place), ' ') AS t
             FROM (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM d) AS x
             WHERE NOT EXISTS (SELECT 1 FROM covered c WHERE c.rid = x.rid AND c.q = x.place) GROUP BY rid)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(q), 0) AS BIGINT) AS n_removed,
           sha256(coalesce(t, '')) AS kept_sha256
    FROM d LEFT JOIN gone USING (rid) LEFT JOIN kept USING (rid)"""
)
def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.without_repeats(documents(spark, sf_dir))


@query()
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment(documents(spark, sf_dir))
