"""Rule bitmask ledger (operator 1): DataFrame functions only.

Every rule is evaluated once per document. The ledger keeps the measurements and one failure bit
per rule; policies and ablations are bit operations on the stored ledger and never see a text.

Words are maximal runs of characters other than 0x20 and 0x09-0x0D. Defined results: a null text
counts as empty and fails ``few_words`` only among the rules on words; ratios over no words or no
lines are 0; repeated rows and null ids give one ledger row per input row; an empty table gives an
empty ledger; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import BLANKS, Workspace

SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """A named failure test on the measurements; ``bit`` is its place in the ledger for good."""

    bit: int
    name: str
    fails: str


#: Rules are only ever added, with a new bit, so that stored ledgers stay readable.
RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "many_symbols", "10 * n_symbols > 3 * n_words"),
    Rule(3, "repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule(4, "short_words", "word_chars < 2 * n_words"),
    Rule(5, "long_words", "word_chars > 15 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    """A version of the set of rules that reject a document."""

    version: str
    rules: tuple[str, ...]

    def mask(self, rules: Sequence[Rule] = RULES) -> int:
        bits = {r.name: 1 << r.bit for r in rules}
        return sum(bits[name] for name in self.rules)


BASE = Policy("base-1", ("few_words", "repeated_words"))
FULL = Policy("full-1", tuple(r.name for r in RULES))


def _chars_without(text: Column, dropped: str) -> Column:
    return F.length(F.translate(text, dropped, "")).cast("long")


def _sorted_windows(words: Column) -> Column:
    """(hash, position) of every three-word window, equal hashes side by side."""
    windows = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.struct(
            F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")
        ),
    )
    return F.sort_array(windows)


def _next(array: Column) -> Column:
    return F.slice(array, 2, F.greatest(F.size(array), F.lit(1)))


def _repeated_starts(windows: Column) -> Column:
    """Positions of the windows that have an equal one, in order."""
    pairs = F.zip_with(
        windows, _next(windows), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"]))
    )
    return F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull()))))


def _covered(starts: Column) -> Column:
    """Words in three-word windows at the given positions, each word counted once."""
    gaps = F.zip_with(
        starts, _next(starts), lambda a, b: F.least(F.coalesce(b - a, F.lit(3)), F.lit(3))
    )
    return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap)


def measure(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the measurements of every document."""
    text = F.coalesce(df[text_col], F.lit(""))
    blank_to_space = F.translate(text, BLANKS, " " * len(BLANKS))
    df = df.select(
        df[id_col].alias("doc_id"),
        text.alias("text"),
        F.array_remove(F.split(blank_to_space, " ", -1), "").alias("words"),
        F.filter(
            F.split(text, "\n", -1), lambda line: F.length(F.translate(line, BLANKS, "")) > 0
        ).alias("lines"),
    )
    # One projection for each array that is read twice, so that each is made once.
    df = df.withColumn("windows", _sorted_windows(F.col("words")))
    df = df.withColumn("starts", _repeated_starts(F.col("windows")))
    n_lines = F.size("lines").cast("long")
    return df.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        _chars_without(F.col("text"), BLANKS).alias("word_chars"),
        (F.length("text") - _chars_without(F.col("text"), SYMBOLS)).alias("n_symbols"),
        n_lines.alias("n_lines"),
        (n_lines - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        _covered(F.col("starts")).alias("n_repeat_words"),
    )


def ledger(
    df: DataFrame,
    rules: Sequence[Rule] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id``, the measurements and ``failures``, in which bit n is set if rule n fails."""
    bits = [F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(0).cast("long") for r in rules]
    total = F.lit(0).cast("long")
    for bit in bits:
        total = total.bitwiseOR(bit)
    return measure(df, id_col, text_col).withColumn("failures", total)


def store_ledger(entries: DataFrame, workspace: Workspace) -> DataFrame:
    """Write the ledger once; everything after reads the written rows."""
    return workspace.store(entries, "quality-ledger")


def apply_policy(entries: DataFrame, policy: Policy, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The ledger with ``policy`` (its version) and ``kept``: no rule of the policy fails."""
    return entries.withColumns(
        {
            "policy": F.lit(policy.version),
            "kept": F.col("failures").bitwiseAND(F.lit(policy.mask(rules))) == 0,
        }
    )


def ablations(
    entries: DataFrame, policies: Iterable[Policy], rules: Sequence[Rule] = RULES
) -> DataFrame:
    """For each policy and rule: documents that fail it, that only it rejects, and that are kept.

    The ledger is reduced to one row per failure pattern (at most 2^rules) before anything else.
    """
    patterns = entries.groupBy("failures").agg(F.count("*").alias("n"))
    cases = [
        F.struct(
            F.lit(p.version).alias("policy"),
            F.lit(r.name).alias("rule"),
            F.lit(p.mask(rules)).cast("long").alias("mask"),
            F.lit(1 << r.bit).cast("long").alias("bit"),
        )
        for p in policies
        for r in rules
        if r.name in p.rules
    ]
    failures, mask, bit = F.col("failures"), F.col("c.mask"), F.col("c.bit")
    hit = failures.bitwiseAND(mask)

    def count(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("long")

    return (
        patterns.select("failures", "n", F.explode(F.array(*cases)).alias("c"))
        .groupBy(F.col("c.policy").alias("policy"), F.col("c.rule").alias("rule"))
        .agg(
            count(failures.bitwiseAND(bit) != 0).alias("n_failing"),
            count(hit == bit).alias("n_only_this_rule"),
            count(hit == 0).alias("n_kept"),
            count(hit.bitwiseAND(F.bitwise_not(bit)) == 0).alias("n_kept_without_it"),
        )
    )
