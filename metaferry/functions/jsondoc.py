"""Edits and scans of JSON text whose schema is not known.

The text is cut into tokens (keys, string values and what lies between them) by
one linear regex, and the tokens are worked on with Spark's array functions. No
parse tree, no recursion and no Python: nesting depth does not matter, and a
document comes back byte for byte except for the values that changed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from metaferry.functions.binding import bind
from metaferry.functions.rename import Renames, as_pairs, mentions_any, rename_words, rename_words_in_json, single_words
from metaferry.functions.text import WHITESPACE, strip

# The possessive quantifiers keep the match linear and off the call stack on long strings.
_TOKEN = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"(?:\s*:\s*)?|[^"]++'
_AFTER_KEY = ": \t\r\n"


def tokens(document: Column) -> Column:
    return F.regexp_extract_all(document, F.lit(_TOKEN), F.lit(0))


def _is_string(token: Column) -> Column:
    return token.startswith('"') & token.endswith('"')


def _is_key(token: Column) -> Column:
    return token.startswith('"') & ~token.endswith('"')


def _quoted_key(token: Column) -> Column:
    return F.rtrim(token, F.lit(_AFTER_KEY))


def _decode(token: Column) -> Column:
    """Text of a quoted token; only tokens with an escape need a JSON parser."""
    plain = F.substring(token, F.lit(2), F.length(token) - 2)
    parsed = F.get(F.from_json(F.concat(F.lit("["), token, F.lit("]")), "array<string>"), F.lit(0))
    return F.when(token.contains("\\"), parsed).otherwise(plain)


def _encode(text: Column) -> Column:
    listed = F.to_json(F.array(text))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def compacted(document: Column) -> Column:
    """The text without white space outside strings."""
    return F.regexp_replace(document, "(" + _TOKEN.split("(?:\\s")[0] + r")|[ \t\r\n]++", "$1")


def rewrite_strings(document: Column, renames: Renames | None, compact: bool = False) -> Column:
    """Rename words in every string value of a JSON text: ``struct<text, changes>``.

    Keys, numbers, booleans and nulls stay. ``changes`` counts changed values.
    With ``compact`` the white space outside strings is removed as well.
    """
    pairs = as_pairs(renames)
    if compact:
        document = compacted(document)
    untouched = F.struct(document.alias("text"), F.lit(0).alias("changes"))
    if not pairs:
        return untouched

    def edit(token: Column) -> Column:
        return bind(
            _decode(token),
            lambda old: bind(rename_words(old, pairs), lambda new: F.when(old == new, token).otherwise(_encode(new))),
        )

    plain = single_words(pairs)
    # A word can hide behind escapes, so escaped values are always looked at; single words only behind those of letters.
    hiding = "\\u" if plain else "\\"

    def affected(text: Column) -> Column:
        return mentions_any(text, pairs) | text.contains(hiding)

    # Single words are renamed in the text as it is written, unless it has escapes that Spark would write otherwise.
    def edit_affected(token: Column) -> Column:
        if not plain:
            return edit(token)
        return F.when(token.contains("\\u") | token.contains("\\/"), edit(token)).otherwise(rename_words_in_json(token, pairs))

    def edited(all_tokens: Column) -> Column:
        return F.transform(all_tokens, lambda t: F.when(_is_string(t) & affected(t), edit_affected(t)).otherwise(t))

    def result(before: Column, after: Column) -> Column:
        differs = F.zip_with(before, after, lambda a, b: a != b)
        changes = F.size(F.filter(differs, lambda d: d))
        return F.struct(F.array_join(after, "").alias("text"), changes.alias("changes"))

    rewritten = bind(tokens(document), lambda before: bind(edited(before), lambda after: result(before, after)))
    return F.when(affected(document), rewritten).otherwise(untouched)


# A key that is wanted with its string value, or any other string, so that a match never begins inside one.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_UID_PAIR = r'"(?:(?=[^"\\]*(?i:uid))|(?=backingAssetId"))[^"\\]*+"\s*+:\s*+(' + _STRING + ")|" + _STRING
# Whatever may be a key with an escape in it.
_ESCAPED_KEY = r'\\.[^"\\]*+"\s*+:'


def find_uids(document: Column) -> Column:
    """Distinct non-blank string values, at any depth, under a key that holds
    ``uid`` in any case or equals ``backingAssetId``."""
    listed = F.regexp_extract_all(document, F.lit(_UID_PAIR), F.lit(1))
    values = F.transform(F.array_distinct(F.filter(listed, lambda v: v != "")), lambda v: strip(_decode(v)))
    plain = F.array_distinct(F.filter(values, lambda v: v.isNotNull() & (v != "")))
    # A document without the letters can still hide them behind escapes.
    possible = F.lower(document).contains("uid") | document.contains("backingAssetId")
    return F.when(document.rlike(_ESCAPED_KEY), _uids_of_tokens(document)).when(possible, plain)


def _uids_of_tokens(document: Column) -> Column:
    """As ``find_uids``, with every key decoded."""

    def value_of(all_tokens: Column, position: Column) -> Column:
        following = F.get(all_tokens, position + 1)
        name = _decode(_quoted_key(F.get(all_tokens, position)))
        wanted = bind(name, lambda n: F.lower(n).contains("uid") | (n == "backingAssetId"))
        return F.when(_is_string(following) & wanted, strip(_decode(following)))

    def scan(all_tokens: Column) -> Column:
        return F.transform(all_tokens, lambda token, at: F.when(_is_key(token), value_of(all_tokens, at)))

    return F.array_distinct(F.filter(bind(tokens(document), scan), lambda v: v.isNotNull() & (v != "")))


# No limit on the length of a value or on nesting; a field behind the document shows that it ended where it should.
_UNLIMITED = {"maxStringLen": str(2**31 - 1), "maxNestingDepth": str(2**31 - 1), "maxNumLen": str(2**31 - 1)}
_END = "_end_of_the_document_"


def is_json(document: Column) -> Column:
    """Whether a text is one JSON value and nothing else, of any size; null for a null text.

    The value is not built, so the limits of variants don't count, nor does
    whether the session allows repeated keys.
    """
    framed = F.concat(F.lit('{"value":'), document, F.lit(f',"{_END}":1}}'))
    # The value is no field of the schema: the parser checks it and copies nothing.
    found = F.from_json(framed, f"struct<{_END}: int>", _UNLIMITED)
    # Cut at one end only: whatever is blank is gone, and another text is left alone from its first character.
    blank = F.ltrim(document, F.lit(WHITESPACE)) == ""
    return F.when(document.isNotNull(), F.coalesce(~blank & (found[_END] == 1), F.lit(False)))


def parsed(document: Column) -> Column:
    """The text as a variant, null unless it is one JSON value and nothing else.

    Spark's parser stops after the first value; inside brackets whatever follows
    shows as an error or as a second element.
    """
    wrapped = F.try_parse_json(F.concat(F.lit("["), document, F.lit("]"))).try_cast("array<variant>")
    return bind(wrapped, lambda values: F.when(F.size(values) == 1, F.get(values, F.lit(0))))


def as_object(document: Column) -> Column:
    """Top-level fields as ``map<string, variant>``; null unless the text is a JSON object."""
    return parsed(document).try_cast("map<string,variant>")


def set_field(fields: Column, name: str, value: Column) -> Column:
    """Copy of a ``map<string, variant>`` with one field set to a variant value."""
    others = F.map_filter(fields, lambda key, _: key != name)
    return F.map_concat(others, F.create_map(F.lit(name), value))


def field(fields: Column, name: str) -> Column:
    return F.element_at(fields, F.lit(name))


def json_text(value: Column) -> Column:
    """Canonical JSON text of a variant (sorted keys); JSON null and absence are both null."""
    return F.nullif(F.to_json(value), F.lit("null"))


def json_problem(document: Column) -> Column:
    """Why a text cannot serve as a JSON object, null if it can.

    ``beyond_variant`` is valid JSON that the values payloads are built from can't
    hold: over 128 MB, or with repeated keys where the session forbids them.
    """

    def problem(value: Column) -> Column:
        return (
            F.when(value.isNull(), F.when(is_json(document), F.lit("beyond_variant")).otherwise(F.lit("invalid_json")))
            .when(~F.schema_of_variant(value).startswith("OBJECT"), F.lit("not_an_object"))
            .when(F.size(value.try_cast("map<string,variant>")) == 0, F.lit("empty_object"))
        )

    blank = strip(F.coalesce(document, F.lit(""))) == ""
    return F.when(blank, F.lit("blank")).otherwise(bind(parsed(document), problem))
