"""Quality rules as a ledger of failure bits.

Each rule is evaluated once per document and leaves one bit, beside the measurements it read. What
to do with the bits is decided later and as often as needed: a policy is a named mask of fatal rules, and an
ablation counts what a policy would keep without one of its rules, both without reading a text again.

Edge cases: null and empty texts measure zero everywhere and fail ``few_words``; repeated rows are measured
one by one; ids are passed through, null ids too; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import SPACE, SPACE_CLASS, text_of

POSITION_BITS = 31  # an array has fewer than 2**31 elements


@dataclass(frozen=True)
class Rule:
    name: str
    failed: str  # SQL over the measurements


#: Bit i belongs to rule i; new rules go to the end, so that stored ledgers keep their meaning.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("duplicate_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule("short_or_long_words", "word_chars < 2 * n_words OR word_chars > 16 * n_words"),
    Rule("capitals", "2 * n_capitals > word_chars"),
    Rule("many_words", "n_words > 100000"),
    Rule("duplicate_text", "10 * n_dup_chars > 3 * n_line_chars"),
)
BIT = {rule.name: 1 << at for at, rule in enumerate(RULES)}
BASE_MASK = BIT["few_words"] | BIT["repeated_windows"]

#: Versioned policies: a document is dropped if it fails one of these rules.
POLICIES = {
    "base-1": BASE_MASK,
    "prose-1": BASE_MASK | BIT["symbols"] | BIT["duplicate_lines"] | BIT["short_or_long_words"] | BIT["capitals"],
    # repeated lines by their share of the text: one short line repeated in a text of three lines is no reason to drop it
    "prose-2": BASE_MASK | BIT["symbols"] | BIT["duplicate_text"] | BIT["short_or_long_words"] | BIT["capitals"],
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_dup_chars", "n_line_chars")


def _without(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, characters, ""))


def _blank(text: Column) -> Column:
    return F.length(F.btrim(text, F.lit(SPACE))) == 0


def measure(docs: DataFrame) -> DataFrame:
    """Columns of ``docs`` named ``doc_id`` and the measurements, one row per row of ``docs``."""
    return measured(docs.select("doc_id", "text")).select("doc_id", *MEASURES)


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` (columns that start with ``__q_`` apart) with the measurements of ``text``."""
    text, trimmed = text_of(), F.btrim(text_of(), F.lit(SPACE))
    none = F.array().cast("array<string>")
    df = docs.withColumns({
        "__q_words": F.when(F.length(trimmed) == 0, none).otherwise(F.split(trimmed, f"{SPACE_CLASS}+")),
        "__q_lines": F.filter(F.split(text, "\n"), lambda line: ~_blank(line)),
        "n_symbols": _without(text, r"[#*$%&|<>]").cast("bigint"),
        "n_capitals": _without(text, r"\p{Lu}").cast("bigint"),
    })
    df = df.withColumns({
        "n_words": F.size("__q_words").cast("bigint"),
        "word_chars": F.length(F.array_join("__q_words", "")).cast("bigint"),
        "n_lines": F.size("__q_lines").cast("bigint"),
        "n_dup_lines": (F.size("__q_lines") - F.size(F.array_distinct("__q_lines"))).cast("bigint"),
        "n_line_chars": F.length(F.array_join("__q_lines", "")).cast("bigint"),
        "n_dup_chars": (F.length(F.array_join("__q_lines", "")) - F.length(F.array_join(F.array_distinct("__q_lines"), ""))).cast("bigint"),
    })
    return repeated_windows(df).drop("__q_words", "__q_lines")


def repeated_windows(df: DataFrame) -> DataFrame:
    """Add ``n_repeat_words``: words inside a 3-word window that the text has twice or more.

    Windows are first sorted as longs, hash above position, where repeated ones become neighbours; only
    neighbours with equal hashes are then compared word by word. Time is n log n in a text's words.
    """
    words = F.col("__q_words")
    firsts = F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0)))
    hashed = F.transform(
        firsts,
        lambda word, at: F.shiftleft(F.xxhash64(word, F.get(words, at + 1), F.get(words, at + 2)), POSITION_BITS)
        + at.cast("bigint"),
    )
    df = df.withColumn("__q_sorted", F.sort_array(hashed))

    def near(column: str, at: Column, same) -> Column:
        other = lambda step: F.get(F.col(column), at + step)
        return F.coalesce(same(other(-1)), F.lit(False)) | F.coalesce(same(other(1)), F.lit(False))

    top = lambda packed: F.shiftright(packed, POSITION_BITS)
    df = df.withColumn("__q_maybe", F.filter(
        "__q_sorted", lambda packed, at: near("__q_sorted", at, lambda other: top(other) == top(packed))
    ))
    place = lambda packed: packed.bitwiseAND(F.lit((1 << POSITION_BITS) - 1)).cast("int")
    window = lambda at: F.struct(
        F.get(words, at).alias("a"), F.get(words, at + 1).alias("b"), F.get(words, at + 2).alias("c"), at.alias("at")
    )
    same = lambda one, other: (one["a"] == other["a"]) & (one["b"] == other["b"]) & (one["c"] == other["c"])
    df = df.withColumn("__q_windows", F.sort_array(F.transform("__q_maybe", lambda packed: window(place(packed)))))
    df = df.withColumn("__q_at", F.array_sort(F.transform(
        F.filter("__q_windows", lambda one, at: near("__q_windows", at, lambda other: same(one, other))),
        lambda one: one["at"],
    )))
    # a window covers three words, fewer if the next repeated window begins earlier
    covered = F.aggregate(
        F.transform("__q_at", lambda at, i: F.least(F.lit(3), F.coalesce(F.get("__q_at", i + 1) - at, F.lit(3)))),
        F.lit(0).cast("bigint"),
        lambda total, words: total + words,
    )
    return df.withColumn("n_repeat_words", covered).drop("__q_sorted", "__q_maybe", "__q_windows", "__q_at")


def failure_bits() -> Column:
    """The ledger's mask: the bits of the rules that a row of measurements fails."""
    mask = F.lit(0).cast("bigint")
    for rule in RULES:
        mask = mask + F.when(F.expr(rule.failed), F.lit(BIT[rule.name])).otherwise(F.lit(0))
    return mask


def ledger(docs: DataFrame) -> DataFrame:
    """``doc_id``, the measurements and ``failed``, the bits of the failed rules."""
    return measure(docs).withColumn("failed", failure_bits())


def passes(policy: str, failed: str = "failed") -> Column:
    return F.col(failed).bitwiseAND(F.lit(POLICIES[policy])) == 0


def kept_rows(docs: DataFrame, policy: str) -> DataFrame:
    """The rows of ``docs`` that pass ``policy``, with their columns, whatever these are called."""
    rows = measured(docs.select(F.struct(*docs.columns).alias("__q_row"), F.col("text").alias("text")))
    # one bit mask per row by way of explode: a filter is not pushed below it, and so the measurements are not
    # copied into its condition over and over
    return rows.withColumn("failed", F.explode(F.array(failure_bits()))).where(passes(policy)).select("__q_row.*")


def ablations(entries: DataFrame, policies: dict[str, int] | None = None) -> DataFrame:
    """Per policy and rule in it: documents kept with all rules, kept without this rule, failing it, failing only it.

    Documents are first counted per mask, so everything after that reads one row per distinct mask. Both masks of
    what a policy's rejects have in common and have in any document come from bitwise aggregates.
    """
    spark = entries.sparkSession
    rows = [(name, mask, rule.name, BIT[rule.name]) for name, mask in (policies or POLICIES).items()
            for rule in RULES if mask & BIT[rule.name]]
    chosen = spark.createDataFrame(rows, "policy string, fatal long, rule string, bit long")
    masks = entries.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    fatal = F.col("failed").bitwiseAND(F.col("fatal"))
    # one row per mask (at most 2**rules) meets one row per policy and rule
    met = masks.select("*", F.explode(F.array(*[
        F.struct(F.lit(p).alias("policy"), F.lit(m).cast("bigint").alias("fatal"), F.lit(r).alias("rule"),
                 F.lit(b).cast("bigint").alias("bit")) for p, m, r, b in rows])).alias("x")).select("failed", "n", "x.*")
    total = lambda which: F.sum(F.when(which, F.col("n")).otherwise(0))
    counted = met.groupBy("policy", "rule", "bit").agg(
        total(fatal == 0).alias("kept"),
        total(fatal.bitwiseAND(F.bitwise_not("bit")) == 0).alias("kept_without"),
        total(fatal.bitwiseAND(F.col("bit")) != 0).alias("failing"),
        total(fatal == F.col("bit")).alias("failing_only_this"),
        F.coalesce(F.bit_or(F.when(fatal.bitwiseAND(F.col("bit")) != 0, fatal)), F.lit(0)).alias("failed_with"),
        F.coalesce(F.bit_and(F.when(fatal.bitwiseAND(F.col("bit")) != 0, fatal)), F.lit(0)).alias("always_with"),
    )
    return chosen.join(counted, ["policy", "rule", "bit"], "left").drop("fatal", "bit").fillna(
        0, ["kept", "kept_without", "failing", "failing_only_this", "failed_with", "always_with"])
