"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document. The ledger keeps what was measured
and one bit per failed rule; a policy is a versioned set of rules, so applying
another version, or asking what a rule changes, reads bits and no text.

Only DataFrame functions are used and nothing is shuffled: measuring works row
by row inside the text's own row, with arrays no longer than its words.

Defined results: a null or empty text has no words and lines, all measurements
are 0, and it fails the rules on the number and length of words. Rows are
independent: repeated ids give repeated rows, an empty table gives an empty one.
The ledger carries the id column and its own columns only, so other columns of
the input may have any name.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metaferry.llm.columns import bound, lines_with_words, words

SYMBOL = r"[#*$%&|<>]"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``failed`` is a condition on the measurements; ``bit`` never changes its meaning once used."""

    name: str
    bit: int
    failed: Callable[[Mapping[str, Column]], Column]


RULES = (
    Rule("few_words", 0, lambda m: m["n_words"] < 50),
    Rule("repeated_windows", 1, lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"]),
    Rule("symbols", 2, lambda m: 10 * m["n_symbols"] > 3 * m["n_words"]),
    Rule("repeated_lines", 3, lambda m: 2 * m["n_dup_lines"] > m["n_lines"]),
    Rule("short_words", 4, lambda m: m["word_chars"] < 2 * m["n_words"]),
    Rule("long_words", 5, lambda m: m["word_chars"] > 15 * m["n_words"]),
)
# A version is never changed; a new one is added.
POLICIES: Mapping[str, Sequence[str]] = {
    "base": ("few_words", "repeated_windows"),
    "2026-1": ("few_words", "repeated_windows", "symbols", "repeated_lines", "short_words", "long_words"),
}
CURRENT = "2026-1"


def _repeated_window_words(tokens: Column, width: int = 3) -> Column:
    """Words that lie in a window of ``width`` words found twice or more.

    A window's hash and position are one number, so windows that may be equal
    are neighbours once the numbers are sorted. Only those are then compared as
    text. A repeated window covers ``width`` words, less what the next one
    covers too.
    """
    starts = F.slice(tokens, 1, F.greatest(F.size(tokens) - (width - 1), F.lit(0)))

    def rest(place: Column) -> list[Column]:
        return [F.get(tokens, place + k) for k in range(1, width)]

    def numbered(first: Column, place: Column) -> Column:
        return F.shiftleft(F.xxhash64(first, *rest(place)), 32).bitwiseOR(place.cast("bigint"))

    def alike(ordered: Column, of: Callable[[Column], Column]) -> Column:
        """The entries that have an equal neighbour."""
        return F.filter(
            ordered,
            lambda entry, rank: of(entry).eqNullSafe(of(F.get(ordered, rank - 1)))
            | of(entry).eqNullSafe(of(F.get(ordered, rank + 1))),
        )

    def window(number: Column) -> Column:
        place = number.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")
        return F.struct(F.concat_ws(" ", F.get(tokens, place), *rest(place)).alias("w"), place.alias("p"))

    def covered(places: Column) -> Column:
        step = F.transform(
            places, lambda place, k: F.least(F.coalesce(F.get(places, k + 1) - place, F.lit(width)), F.lit(width))
        )
        return F.aggregate(step, F.lit(0).cast("bigint"), lambda total, one: total + one)

    numbers = F.sort_array(F.transform(starts, numbered))
    candidates = bound(numbers, lambda ordered: alike(ordered, lambda number: F.shiftright(number, 32)))
    equal = bound(F.sort_array(F.transform(candidates, window)), lambda ordered: alike(ordered, lambda e: e["w"]))
    return bound(F.sort_array(F.transform(equal, lambda entry: entry["p"])), covered)


def measurements(text: Column) -> Column:
    """All measurements of a text as one struct."""

    def of_words(found: Column) -> Column:
        return F.struct(
            F.size(found).cast("bigint").alias("n_words"),
            F.length(F.array_join(found, "")).cast("bigint").alias("word_chars"),
            _repeated_window_words(found).alias("n_repeat_words"),
        )

    def of_lines(found: Column) -> Column:
        return F.struct(
            F.size(found).cast("bigint").alias("n_lines"),
            (F.size(found) - F.size(F.array_distinct(found))).cast("bigint").alias("n_dup_lines"),
        )

    parts = F.struct(
        bound(words(text), of_words).alias("w"),
        bound(lines_with_words(text), of_lines).alias("l"),
        (F.size(F.split(F.coalesce(text, F.lit("")), SYMBOL)) - 1).cast("bigint").alias("n_symbols"),
    )
    return bound(
        parts,
        lambda p: F.struct(
            p["w"]["n_words"].alias("n_words"),
            p["w"]["word_chars"].alias("word_chars"),
            p["n_symbols"].alias("n_symbols"),
            p["l"]["n_lines"].alias("n_lines"),
            p["l"]["n_dup_lines"].alias("n_dup_lines"),
            p["w"]["n_repeat_words"].alias("n_repeat_words"),
        ),
    )


def failed_bits(measured: Column, rules: Sequence[Rule] = RULES) -> Column:
    """One bit per failed rule, from a struct of measurements."""
    values = {name: measured[name] for name in MEASURES}
    bits = F.lit(0).cast("bigint")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(rule.failed(values), 1 << rule.bit).otherwise(0).cast("bigint"))
    return bits


def mask(policy: str, rules: Sequence[Rule] = RULES, policies: Mapping[str, Sequence[str]] = POLICIES) -> int:
    """The bits of a policy's rules."""
    bit = {rule.name: 1 << rule.bit for rule in rules}
    return sum(bit[name] for name in set(policies[policy]))


def passes(bits: Column, policy: str, **known) -> Column:
    return bits.bitwiseAND(F.lit(mask(policy, **known)).cast("bigint")) == 0


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """(key, measurements, failed_bits): one row per row of ``docs``."""
    entry = bound(measurements(F.col(text)), lambda m: F.struct(m.alias("m"), failed_bits(m, rules).alias("bits")))
    return docs.select(key, entry.alias("_entry")).select(
        key, *(F.col("_entry.m")[name].alias(name) for name in MEASURES), F.col("_entry.bits").alias("failed_bits")
    )


def ablation(
    entries: DataFrame, rules: Sequence[Rule] = RULES, policies: Mapping[str, Sequence[str]] = POLICIES
) -> DataFrame:
    """Per policy and rule: documents, rejected ones, those that fail the rule, and those that fail only this one.

    The ledger is first counted by its bits, at most two to the number of rules
    rows; policies and rules are applied to these counts.
    """
    counts = entries.groupBy("failed_bits").agg(F.count("*").alias("n"))
    cases = [
        F.struct(
            F.lit(policy).alias("policy"),
            F.lit(rule.name).alias("rule"),
            F.lit(mask(policy, rules, policies)).cast("bigint").alias("mask"),
            F.lit(1 << rule.bit).cast("bigint").alias("bit"),
        )
        for policy, names in policies.items()
        for rule in rules
        if rule.name in names
    ]
    failed = F.col("failed_bits").bitwiseAND(F.col("case.mask"))
    total = lambda when, name: F.sum(F.when(when, F.col("n")).otherwise(0)).alias(name)
    return (
        counts.withColumn("case", F.explode(F.array(*cases)))
        .groupBy(F.col("case.policy").alias("policy"), F.col("case.rule").alias("rule"))
        .agg(
            F.sum("n").alias("n_documents"),
            total(failed != 0, "n_rejected"),
            total(failed.bitwiseAND(F.col("case.bit")) != 0, "n_failing"),
            total(failed == F.col("case.bit"), "n_only_failing"),
        )
    )


def accepted(docs: DataFrame, text: str = "text", policy: str = CURRENT) -> DataFrame:
    """The rows of ``docs`` that pass a policy, with all their columns."""
    return docs.filter(bound(measurements(F.col(text)), lambda m: passes(failed_bits(m), policy)))
