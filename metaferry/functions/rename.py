"""Whole-word renames of environment names inside identifiers and free text.

A rename list is ordered. In the *atomic* form no rename ever feeds another and
earlier pairs win where two overlap. A text is cut into tokens once, words and
single other characters, and the source words, cut likewise, form a trie over
tokens. The trie is constant data of the plan, a hash table from (node, token) to
the next node, so a text is walked once, whatever the number of pairs. Matches
that touch each other are settled in the order of the pairs, within their cluster.

Single words never touch. For them one regex marks the places where a source word
stands, and the text is cut at the marks, so what lies between two of them is one piece.
"""

from __future__ import annotations

import json
import os.path
import re
import zlib
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metaferry.functions.binding import bind

Renames = Mapping[str, str] | Sequence[tuple[str, str]]

# A word character is a letter or number of any script, or an underscore.
_WORD = r"\p{L}\p{N}_"


def as_pairs(renames: Renames | None) -> list[tuple[str, str]]:
    """Ordered rename pairs; identity pairs are dropped, a repeated source keeps its last target."""
    items = dict(renames or {})
    if any(source == "" for source in items):
        raise ValueError("a rename needs a non-empty source word")
    return [(source, target) for source, target in items.items() if source != target]


def _is_word(character: str) -> bool:
    return character == "_" or character.isalnum()


def whole_word(source: str) -> str:
    """Regex for ``source`` where a word starts and ends, aware of all scripts.

    The edges are spelled out as look-arounds, since what ``\\b`` takes for a word
    character differs between Java versions and flags. The literal comes first:
    the regex engine then skips ahead to it and rarely tests an edge.
    """
    literal = re.escape(source)
    before = f"(?<![{_WORD}]{literal})" if _is_word(source[0]) else f"(?<=[{_WORD}]{literal})"
    after = f"(?![{_WORD}])" if _is_word(source[-1]) else f"(?=[{_WORD}])"
    return literal + after + before


def cut(source: str) -> list[str]:
    """The tokens of a source: words, and single characters that are none."""
    tokens = [""]
    for before, character in zip(" " + source, source):
        if _is_word(before) and _is_word(character):
            tokens[-1] += character
        else:
            tokens.append(character)
    return tokens[1:]


def tokens_of(value: Column, single: str = "") -> Column:
    """Words, each of the ``single`` characters, and runs of other characters."""
    alone = "".join(f"\\x{{{ord(character):x}}}" for character in single)
    return F.regexp_extract_all(value, F.lit(f"[{_WORD}]++|" + (f"[{alone}]|" if alone else "") + f"[^{_WORD}{alone}]++"), F.lit(0))


# Deeper than this, words are listed one after the other: compiling a regex takes stack for each nested group.
_DEEPEST = 60


def any_of(words: Sequence[str], depth: int = 0) -> str:
    """Regex for one of some words, sorted and distinct: common beginnings are tested once, what follows is found by halves."""
    if depth == _DEEPEST:
        return "|".join(re.escape(word) for word in words)
    common = os.path.commonprefix(list(words))
    rest = [word[len(common) :] for word in words]
    if rest == [""]:
        return re.escape(common)
    optional = rest[0] == ""
    rest = rest[optional:]
    firsts = sorted({word[0] for word in rest})
    if len(firsts) <= 8:
        groups = [[word for word in rest if word[0] == first] for first in firsts]
        body = "|".join(any_of(group, depth + 1) for group in groups)
    else:
        half = len(firsts) // 2
        low = [word for word in rest if word[0] < firsts[half]]
        body = (
            f"(?=[\\x{{{ord(firsts[0]):x}}}-\\x{{{ord(firsts[half - 1]):x}}}])(?:{any_of(low, depth + 1)})|"
            + any_of(rest[len(low) :], depth + 1)
        )
    return f"{re.escape(common)}(?:{body}){'?' if optional else ''}"


# Stands around the words that are found; doubled, it stands for itself.
_MARK = "\x01"


def cut_at(value: Column, words: Sequence[str], escaped: bool = False) -> Column:
    """What lies between the ``words`` that stand as whole words, and those words, in turn; an empty word is a mark.

    With ``escaped`` the value is JSON text: a backslash and the character after it belong together, and a mark after
    a backslash ends what is no escape.
    """
    firsts = "".join(f"\\x{{{ord(first):x}}}" for first in sorted({word[0] for word in words}))
    # What rules out most places comes first: the letter a word begins with, then a plain letter before it.
    if escaped:
        before = rf"(?<![ac-eg-mo-qsu-zA-Z0-9_])(?:(?<![{_WORD}\\])|(?<=\\[bfnrt]))"
    else:
        before = f"(?<![a-zA-Z0-9_])(?<![{_WORD}])"
    found = f"(?=[{firsts}]){before}(?:{any_of(sorted(set(words)))})(?![{_WORD}])"
    if escaped:
        # Only behind an escaped backslash a letter can look like part of an escape.
        value = F.replace(value, F.lit(r"\\"), F.lit(rf"\\{_MARK}{_MARK}"))
    else:
        value = F.replace(value, F.lit(_MARK), F.lit(_MARK * 2))
    return F.split(F.regexp_replace(value, F.lit(found), F.lit(f"{_MARK}$0{_MARK}")), _MARK)


class _HashTable:
    """Constant values of texts, as an array of small maps; a few texts are one map."""

    def __init__(self, values: Mapping[str, int | str], kind: str = "int"):
        self.size = 1 if len(values) <= 8 else 2 * len(values)
        slots: list[dict[str, int | str]] = [{} for _ in range(self.size)]
        for key, value in values.items():
            slots[zlib.crc32(key.encode()) % self.size][key] = value
        self.slots = _constant(slots if self.size > 1 else slots[0], f"array<map<string,{kind}>>" if self.size > 1 else f"map<string,{kind}>")

    def get(self, key: Column) -> Column:
        if self.size == 1:
            return F.try_element_at(self.slots, key)
        return F.try_element_at(F.get(self.slots, F.pmod(F.crc32(key), F.lit(self.size)).cast("int")), key)


class Trie:
    """Source words as a trie over tokens, whose tables are constants of the plan.

    A match is a ``struct<start, end, pair>`` of token places and the pair's number.
    """

    def __init__(self, pairs: Sequence[tuple[str, str]]):
        firsts: dict[str, int] = {}
        later: dict[str, int] = {}
        ends = [-1]
        sources = [cut(source) for source, _ in pairs]
        for number, source in enumerate(sources):
            node = 0
            for token in source:
                steps, key = (later, f"{node}/{token}") if node else (firsts, token)
                if key not in steps:
                    steps[key] = len(ends)
                    ends.append(-1)
                node = steps[key]
            ends[node] = number
        self.longest = max(map(len, sources))
        self.firsts, self.later = _HashTable(firsts), _HashTable(later)
        self.single = "".join(sorted({c for source in sources for c in source if not _is_word(c[0])}))
        self.ends = _constant(ends, "array<int>")
        self.targets = _constant([target for _, target in pairs], "array<string>")
        # Whether a source begins and ends with a letter.
        self.edges = _constant(
            [{"first": _is_word(source[0]), "last": _is_word(source[-1])} for source, _ in pairs],
            "array<struct<first: boolean, last: boolean>>",
        )
        self.plain = all(len(source) == 1 and _is_word(source[0]) for source in sources)

    def tokens(self, value: Column) -> Column:
        return tokens_of(value, self.single)

    def _match(self, start: Column, end: Column, node: Column) -> Column:
        return F.struct(
            start.cast("int").alias("start"), end.cast("int").alias("end"), F.get(self.ends, node).alias("pair")
        )

    def _beginning(self, tokens: Column, start: Column, token: Column) -> Column:
        """The matches that begin at a place."""
        first = self.firsts.get(token)
        if self.longest == 1:
            return bind(first, lambda node: F.when(node.isNotNull(), F.array(self._match(start, start, node))))

        def walk(state: Column, following: Column) -> Column:
            at = state["at"] + 1
            return bind(
                self.later.get(F.concat(state["node"].cast("string"), F.lit("/"), following)),
                lambda node: F.struct(
                    node.alias("node"),
                    at.alias("at"),
                    F.when(F.get(self.ends, node) >= 0, F.array_append(state["found"], self._match(start, at, node)))
                    .otherwise(state["found"])
                    .alias("found"),
                ),
            )

        none = F.array().cast("array<struct<start: int, end: int, pair: int>>")
        window = F.slice(tokens, start + 2, self.longest - 1)

        def walked(node: Column) -> Column:
            found = F.when(F.get(self.ends, node) >= 0, F.array(self._match(start, start, node))).otherwise(none)
            begin = F.struct(node.alias("node"), start.alias("at"), found.alias("found"))
            return F.when(node.isNotNull(), F.reduce(window, begin, walk, lambda state: state["found"]))

        return bind(first, walked)

    def matches(self, tokens: Column) -> Column:
        """All places where a source's tokens stand, by start."""
        found = F.transform(tokens, lambda token, start: self._beginning(tokens, start, token))
        return F.flatten(F.filter(found, lambda some: some.isNotNull()))

    def _fits(self, match: Column, taken: Column, tokens: Column) -> Column:
        """Whether a match overlaps nothing taken and stands where words begin and end; what is taken counts as letters."""
        overlaps = F.exists(taken, lambda other: (other["start"] <= match["end"]) & (match["start"] <= other["end"]))
        edges = F.get(self.edges, match["pair"])

        def edge(is_word: Column, place: Column, beside) -> Column:
            joined = F.exists(taken, lambda other: (other["pair"] != match["pair"]) & beside(other))
            letter = joined | F.coalesce(F.get(tokens, place).rlike(f"^[{_WORD}]"), F.lit(False))
            return is_word != letter

        return (
            ~overlaps
            & edge(edges["first"], match["start"] - 1, lambda other: other["end"] == match["start"] - 1)
            & edge(edges["last"], match["end"] + 1, lambda other: other["start"] == match["end"] + 1)
        )

    def settled(self, tokens: Column) -> Column:
        """The matches that count, by start: in a cluster of neighbours those of earlier pairs first."""
        if self.plain:
            return self.matches(tokens)
        # Every place before has at most ``longest`` matches, none longer than that.
        reach = self.longest * (self.longest + 1)

        def begins(found: Column) -> Column:
            def alone(place: Column) -> Column:
                start = F.get(found, place)["start"]
                before = F.slice(found, F.greatest(place - reach, F.lit(0)) + 1, F.least(place, F.lit(reach)))
                return ~F.exists(before, lambda other: other["end"] + 1 >= start)

            places = F.sequence(F.lit(0), F.size(found) - 1)
            return F.filter(places, alone)

        def settle(cluster: Column) -> Column:
            by_pair = F.array_sort(
                F.transform(cluster, lambda m: F.struct(m["pair"].alias("pair"), m["start"].alias("start"), m["end"].alias("end")))
            )
            none = F.array().cast("array<struct<start: int, end: int, pair: int>>")
            taken = F.reduce(
                by_pair,
                none,
                lambda taken, m: bind(
                    F.struct(m["start"].alias("start"), m["end"].alias("end"), m["pair"].alias("pair")),
                    lambda match: F.when(self._fits(match, taken, tokens), F.array_append(taken, match)).otherwise(taken),
                ),
            )
            return F.array_sort(taken)

        def clusters(found: Column) -> Column:
            return bind(
                begins(found),
                lambda starts: F.transform(
                    starts,
                    lambda begin, k: settle(
                        F.slice(found, begin + 1, F.coalesce(F.get(starts, k + 1), F.size(found)) - begin)
                    ),
                ),
            )

        return bind(self.matches(tokens), lambda found: F.when(F.size(found) > 0, F.flatten(clusters(found))).otherwise(found))

    def renamed(self, value: Column, tokens: Column, found: Column) -> Column:
        """The text with the targets in the places of the matches."""

        def piece(match: Column, k: Column) -> Column:
            begin = F.when(k > 0, F.get(found, k - 1)["end"] + 1).otherwise(0)
            before = F.array_join(F.slice(tokens, begin + 1, match["start"] - begin), "")
            return F.concat(before, F.get(self.targets, match["pair"]))

        last = F.get(found, F.size(found) - 1)["end"] + 1
        rest = F.array_join(F.slice(tokens, last + 1, F.size(tokens) - last), "")
        return F.when(F.size(found) > 0, F.concat(F.array_join(F.transform(found, piece), ""), rest)).otherwise(value)


def _constant(value: object, kind: str) -> Column:
    """A constant as JSON text that Spark parses once, when it plans."""
    return F.from_json(F.lit(json.dumps(value, ensure_ascii=False)), kind)


def rename_words(value: Column, renames: Renames | None) -> Column:
    """Atomic whole-word renames; targets are literal text."""
    pairs = as_pairs(renames)
    if not pairs:
        return value
    if single_words(pairs):
        return F.when(mentions_any(value, pairs), _rename_single_words(value, pairs)).otherwise(value)
    trie = Trie(pairs)
    renamed = bind(trie.tokens(value), lambda tokens: bind(trie.settled(tokens), lambda found: trie.renamed(value, tokens, found)))
    return F.when(mentions_any(value, pairs), renamed).otherwise(value)


def single_words(pairs: Sequence[tuple[str, str]]) -> bool:
    """Whether every source is one word, so that matches never touch."""
    return all(_is_word(c) for source, _ in pairs for c in source)


def _rename_single_words(value: Column, pairs: Sequence[tuple[str, str]], escaped: bool = False) -> Column:
    targets = _HashTable(dict(pairs), "string")
    mark = F.lit("" if escaped else _MARK)
    pieces = F.transform(
        cut_at(value, [source for source, _ in pairs], escaped),
        lambda piece, k: F.when(k % 2 == 1, F.coalesce(targets.get(piece), mark)).otherwise(piece),
    )
    return F.array_join(pieces, "")


def rename_words_in_json(token: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Renames of single words in a quoted JSON string, as it is written; it must not hold ``\\u`` escapes."""
    return _rename_single_words(token, [(source, _escaped(target)) for source, target in pairs], escaped=True)


def _escaped(text: str) -> str:
    """The text as Spark writes it inside a JSON string."""
    return "".join(
        f"\\u{ord(c):04X}" if ord(c) < 32 and c not in "\b\t\n\f\r" else json.dumps(c, ensure_ascii=False)[1:-1] for c in text
    )


def renames_used(value: Column, renames: Renames | None) -> Column:
    """How many of the rename pairs apply to a value."""
    pairs = as_pairs(renames)
    if not pairs:
        return F.lit(0)
    trie = Trie(pairs)
    used = bind(trie.tokens(value), lambda tokens: F.size(F.array_distinct(F.transform(trie.settled(tokens), lambda m: m["pair"]))))
    return F.coalesce(used, F.lit(0))


def mentions_any(value: Column, renames: Renames) -> Column:
    """True when a value may hold a source word; a cheap test that spares other values the walk."""
    firsts = sorted({cut(source)[0] for source, _ in as_pairs(renames)})
    if len(firsts) <= 8:
        return reduce(lambda a, b: a | b, [value.contains(first) for first in firsts])
    return F.arrays_overlap(tokens_of(value), _constant(firsts, "array<string>"))


def rename_words_in_turn(value: Column, renames: Renames | None) -> Column:
    """Whole-word renames applied one after the other, so that they may cascade."""
    for source, target in as_pairs(renames):
        value = rename_word(value, source, target)
    return value


def rename_word(value: Column, source: str, target: str) -> Column:
    """One whole-word rename with a literal target."""
    if not as_pairs([(source, target)]):
        return value
    literal = target.replace("\\", "\\\\").replace("$", "\\$")
    return F.regexp_replace(value, F.lit(whole_word(source)), F.lit(literal))


def replace_text(value: Column, source: str, target: str) -> Column:
    """Literal substring replacement, without regard to word edges."""
    return F.replace(value, F.lit(source), F.lit(target))


def rename_columns(df: DataFrame, renames: Renames, keep: Sequence[str] = ("source_uid",)) -> DataFrame:
    """Rename words in every string column except those in ``keep``."""
    text_columns = {name for name, kind in df.dtypes if kind == "string"} - set(keep)
    return df.select(
        *[rename_words(F.col(c), renames).alias(c) if c in text_columns else F.col(c) for c in df.columns]
    )


def rename_target_uid(df: DataFrame, renames: Renames, column: str = "target_uid") -> DataFrame:
    """Rename words in the target identifier only."""
    return df.withColumn(column, rename_words(F.col(column), renames))


def count_changes(df: DataFrame, before: str, after: str) -> DataFrame:
    """One row: values seen, values changed, values left alone."""
    changed = ~F.col(before).eqNullSafe(F.col(after))
    return df.agg(
        F.count(F.lit(1)).alias("values_seen"),
        F.count_if(changed).alias("values_changed"),
        F.count_if(~changed).alias("values_unchanged"),
    )
