"""Boilerplate lines by their frequency within a site.

A line is boilerplate on a site if more than a share of the site's pages hold
it, and at least ``min_pages`` pages do. Such lines are cut from every page of
that site and stay on other sites.

The first pass counts (site, line hash) with sums per task before the shuffle.
What it finds is small by definition: a site has fewer boilerplate lines than
its mean number of lines per page divided by the share. It is written to the
shared folder as one array per site; Spark sees the size of that table, sends it
to all tasks where it is below the broadcast threshold, and otherwise joins by
site, with the parts of a large site split at run time. No text is grouped.

Defined results: lines are separated by line feeds and compared as they are;
lines without a word are neither counted nor cut. A line counts once per page,
however often it stands there. A null text stays null, a page whose lines all
go becomes an empty text. A null site is a site of its own. Repeated rows count
as pages of their own. Column names of the input don't matter: added columns
have a reserved prefix. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metaferry.llm.columns import BLANKS, bound, lines_with_words
from metaferry.operators.joins import hot_join
from metaferry.sources.staging import staged

# Measured: of the lines of a source 1,026 stand on two pages of sf0.1 and up to 0.5 % of its pages, 526 on up to 1 %,
# 319 on more (36 different lines, at most 13.2 %); of check_s 10,347, 437 and 294 (27 lines, at most 13.4 %).
PERCENT, MIN_PAGES = 1, 3
_SITE, _CUT = "_line_dedup_site", "_line_dedup_cut"


def _hash(line: Column) -> Column:
    """128 bits of a line."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(7), line).alias("b"))


def _site(site: str) -> Column:
    """The site as a value that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(site).cast("string")), F.lit("none"))


def boilerplate(
    docs: DataFrame, site: str = "source", text: str = "text", percent: int = PERCENT, min_pages: int = MIN_PAGES
) -> DataFrame:
    """(site key, line hash, n_pages, n_site_pages) of lines on more than ``percent`` % of a site's pages."""
    pages = docs.select(_site(site).alias(_SITE), F.col(text).alias("_text"))
    totals = pages.groupBy(_SITE).agg(F.count("*").alias("n_site_pages"))
    counts = (
        pages.select(_SITE, F.explode(F.array_distinct(F.transform(lines_with_words(F.col("_text")), _hash))).alias("line"))
        .groupBy(_SITE, "line")
        .agg(F.count("*").alias("n_pages"))
        .filter(F.col("n_pages") >= min_pages)
    )
    return hot_join(counts, totals, _SITE).filter(100 * F.col("n_pages") > percent * F.col("n_site_pages"))


def with_cut_lines(
    docs: DataFrame, site: str = "source", text: str = "text", percent: int = PERCENT, min_pages: int = MIN_PAGES
) -> DataFrame:
    """``docs`` with a struct (text, n_lines, n_cut) under a reserved name: the text without boilerplate lines.

    Runs the counting pass and writes its result.
    """
    found = boilerplate(docs, site, text, percent, min_pages)
    sites = staged(found.groupBy(_SITE).agg(F.collect_list("line").alias("_line_dedup_lines")))
    value, lines = F.coalesce(F.col(text), F.lit("")), F.col("_line_dedup_lines")

    def kept(line: Column) -> Column:
        return (F.btrim(line, F.lit(BLANKS)) == "") | ~F.array_contains(lines, _hash(line))

    cut = bound(
        F.split(value, "\n"),
        lambda all_lines: bound(
            F.filter(all_lines, kept),
            lambda left: F.struct(
                F.array_join(left, "\n").alias("text"), (F.size(all_lines) - F.size(left)).cast("bigint").alias("n_cut")
            ),
        ),
    )
    untouched = F.struct(value.alias("text"), F.lit(0).cast("bigint").alias("n_cut"))
    joined = docs.withColumn(_SITE, _site(site)).join(sites, _SITE, "left")
    return joined.withColumn(_CUT, F.when(lines.isNull(), untouched).otherwise(cut)).drop(_SITE, "_line_dedup_lines")


def cut_columns(text: str = "text") -> list[Column]:
    """The results of ``with_cut_lines`` as columns: new text, lines with words before, lines cut."""
    return [
        F.when(F.col(text).isNotNull(), F.col(_CUT)["text"]).alias("cut_text"),
        F.size(lines_with_words(F.col(text))).cast("bigint").alias("n_lines"),
        F.col(_CUT)["n_cut"].alias("n_cut"),
    ]


def without_boilerplate(docs: DataFrame, site: str = "source", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with boilerplate lines cut from the text; a column of text lengths follows it."""
    new_text = F.when(F.col(text).isNotNull(), F.col(_CUT)["text"])
    changed = F.col(_CUT)["n_cut"] > 0
    columns = {text: new_text.alias(text)}
    if n_chars in docs.columns:
        length = F.when(changed, F.length(new_text)).otherwise(F.col(n_chars))
        columns[n_chars] = length.cast(dict(docs.dtypes)[n_chars]).alias(n_chars)
    return with_cut_lines(docs, site, text).select(*[columns.get(name, F.col(f"`{name}`")) for name in docs.columns])
