"""Column expressions that several operators share: words, lines, values bound once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space between words is space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often the body uses it.

    Spark may copy the expression of a projected column into a lambda function,
    where it would run for every element. A lambda variable can't be copied.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Runs of other characters than ASCII white space; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK_RUN), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def lines_with_words(text: Column) -> Column:
    """The lines of a text (split at line feeds) that hold a word."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.filter(lines, lambda line: F.btrim(line, F.lit(BLANKS)) != "")

