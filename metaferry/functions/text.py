"""Small text expressions, all built from Spark functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space at the ends of a value.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(value: Column) -> Column:
    """Remove all white space at both ends (``trim`` alone removes only spaces)."""
    return F.trim(value, F.lit(WHITESPACE))


def or_blank(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def has_text(value: Column) -> Column:
    """True when the value holds something besides white space; never null."""
    return strip(or_blank(value)) != ""


def split_list(value: Column, separator: str) -> Column:
    """Split on a literal separator, strip each element, drop blank ones."""
    parts = F.split(or_blank(value), "\\Q" + separator + "\\E")
    return F.filter(F.transform(parts, strip), lambda part: part != "")


def first_in_list(value: Column, separator: str = ",") -> Column:
    """First non-blank element of a separated list, null if there is none."""
    return F.get(split_list(value, separator), F.lit(0))


def normalised_name(value: Column) -> Column:
    """Key for matching names regardless of case and surrounding white space."""
    return F.lower(strip(or_blank(value)))


def slug(value: Column) -> Column:
    """File-name form of a label: letters, digits, ``-`` and ``_``, lower case."""
    kept = F.regexp_replace(value, r"[^\p{L}\p{N} _-]", "")
    return F.lower(F.replace(F.rtrim(kept), F.lit(" "), F.lit("_")))


def whole_number(value: Column) -> Column:
    """The value as a long, null unless it is written as a whole number."""
    return strip(value.cast("string")).try_cast("long")


def sort_number(value: Column) -> Column:
    """Numeric sort key of an id; ids that are not whole numbers sort as 0."""
    return F.coalesce(whole_number(value), F.lit(0))


def is_digits(value: Column) -> Column:
    return F.coalesce(strip(value.cast("string")).rlike("^[0-9]+$"), F.lit(False))


def page_count(total: Column, page_size: int) -> Column:
    return F.ceil(total / F.lit(page_size)).cast("long")
