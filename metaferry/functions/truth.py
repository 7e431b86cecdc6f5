"""Truth and equality of JSON values as the catalog tools see them.

Values are canonical JSON texts, see ``jsondoc.json_text``. Absent, null, false,
zero and empty values all count as "not set"; two values are equal when they
are the same JSON value, and numbers compare by value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# JSON texts of values that count as not set.
_UNSET = ["false", "0", "0.0", "-0", "-0.0", '""', "[]", "{}"]

# Whole numbers are compared exactly, others as doubles.
_WHOLE = r"^-?[0-9]{1,38}$"


def is_set(text: Column) -> Column:
    """True for a set value; never null."""
    return F.coalesce(~text.isin(_UNSET), F.lit(False))


def same_value(left: Column, right: Column) -> Column:
    """Null-safe equality; 1, 1.0 and true are the same value."""
    whole = left.rlike(_WHOLE) & right.rlike(_WHOLE)
    equal = F.when(whole, left.try_cast("decimal(38,0)") == right.try_cast("decimal(38,0)")).otherwise(
        _number(left) == _number(right)
    )
    return left.eqNullSafe(right) | F.coalesce(equal, F.lit(False))


def _number(text: Column) -> Column:
    return F.when(text == "true", F.lit(1.0)).when(text == "false", F.lit(0.0)).otherwise(text.try_cast("double"))


def plain(text: Column) -> Column:
    """Content of a JSON text: strings without quotes and escapes, null for JSON null."""
    unquoted = F.get(F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>"), F.lit(0))
    return F.when(text.startswith('"'), unquoted).otherwise(text)


def shown(text: Column) -> Column:
    """Display form of a value in reports."""
    return (
        F.when(text.isNull(), F.lit("None"))
        .when(text == "true", F.lit("True"))
        .when(text == "false", F.lit("False"))
        .otherwise(plain(text))
    )
