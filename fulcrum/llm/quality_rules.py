"""Quality rules as a bitmask ledger.

``rule_ledger`` reads every text once and stores, per document, the measurements and one
failure bit per rule.  Policies are versioned sets of rules, i.e. bit masks: applying one is
``failed_bits & mask``, and an ablation ("what would this policy reject without rule r?")
is a bitwise aggregate over the few distinct masks, so neither reads a text again.

Everything is a built-in expression on one row: no shuffle, no Python.  Repeated word
windows are found inside the row: 64-bit window hashes only rule out texts without any
repeat (equal windows have equal hashes); the others sort their exact windows.

Defined results: a null text counts as empty (no words, fails the minimum length);
repeated rows each get their own ledger row; very long texts are measured whole; a measurement that equals its
limit passes; further columns are ignored; an empty table gives an empty ledger.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fulcrum.llm.words import BLANK, count_chars, text_or_empty, words

WINDOW = 5
#: Characters counted as symbols (fixed value).
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    name: str
    failed: str  # SQL condition over the measurements; never null


#: A rule's bit is its place in this list; rules are appended, never moved.
RULES = (
    Rule("too_few_words", "n_words < 10"),
    Rule("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", "100 * n_symbols > 30 * n_words"),
    Rule("duplicate_lines", "100 * n_dup_lines > 40 * n_lines"),
    Rule("shouting", "100 * n_upper > 40 * word_chars"),
    Rule("word_length", "word_chars > 14 * n_words OR word_chars < 2 * n_words"),
)

#: Versioned policies: name -> rules.  ``base`` is the fixed part of every later one.
POLICIES = {
    "base": ("too_few_words", "repeated_windows"),
    "v1": ("too_few_words", "repeated_windows", "symbols"),
    "v2": ("too_few_words", "repeated_windows", "symbols", "duplicate_lines", "shouting", "word_length"),
}
CURRENT = "v2"

MEASUREMENTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper")


def policy_mask(policy: str) -> int:
    place = {r.name: i for i, r in enumerate(RULES)}
    return sum(1 << place[name] for name in POLICIES[policy])


def rule_ledger(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, the measurements (long) and ``failed_bits`` (long)."""
    carried = [F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)]
    names = [f"_k{i}" for i in range(len(keep))]
    measured = _repeat_words(
        docs.select(*carried, text_or_empty("text").alias("_text"))
        .withColumn("_words", words(F.col("_text")))
        .withColumn("_lines", F.filter(F.split(F.col("_text"), "\n", -1), lambda line: line.rlike(f"[^{BLANK[1:]}"))),
    ).select(
        *names,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        count_chars(F.col("_text"), SYMBOLS).alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        count_chars(F.col("_text"), r"\p{Lu}").alias("n_upper"),
    )
    bits = sum(
        (F.when(F.expr(rule.failed), F.lit(1 << i)).otherwise(F.lit(0)) for i, rule in enumerate(RULES)),
        start=F.lit(0),
    )
    ledger = measured.withColumn("failed_bits", bits.cast("long"))
    return ledger.select(
        *[F.col(n).alias(c) for n, c in zip(names, keep)], *MEASUREMENTS, "failed_bits")


def _repeat_words(df: DataFrame) -> DataFrame:
    """Add ``n_repeat_words``: words inside a window of WINDOW words that occurs at least
    twice in the text.  Steps are columns of their own so that each is computed once."""
    w = F.col("_words")
    starts = F.when(F.size(w) >= WINDOW, F.sequence(F.lit(0), F.size(w) - F.lit(WINDOW)))
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + F.lit(k)) for k in range(WINDOW)]))
    exact = F.sort_array(F.transform(
        starts, lambda i: F.struct(F.concat_ws(" ", F.slice(w, i + F.lit(1), WINDOW)).alias("window"), i.alias("at"))))
    at = F.col("_sorted")

    def twin(j: Column) -> Column:
        here = F.get(at, j)["window"]
        before = (j > 0) & (F.get(at, j - F.lit(1))["window"] == here)
        after = (j + F.lit(1) < F.size(at)) & (F.get(at, j + F.lit(1))["window"] == here)
        return F.when(before | after, F.get(at, j)["at"])

    repeated = F.sort_array(F.array_compact(
        F.transform(F.sequence(F.lit(0), F.size(at) - F.lit(1)), twin)))
    # covered words: each start adds up to WINDOW words, fewer where the next one follows closely
    starts_of = F.col("_starts")
    gaps = F.transform(
        F.sequence(F.lit(1), F.size(starts_of) - F.lit(1)),
        lambda k: F.least(F.lit(WINDOW), F.get(starts_of, k) - F.get(starts_of, k - F.lit(1))))
    covered = F.lit(WINDOW) + F.when(
        F.size(starts_of) > 1, F.aggregate(gaps, F.lit(0), lambda acc, x: acc + x)).otherwise(F.lit(0))
    return (
        df.withColumn("_hashes", hashes)
        .withColumn("_sorted", F.when(F.size(F.array_distinct("_hashes")) < F.size("_hashes"), exact))
        .withColumn("_starts", F.when(F.col("_sorted").isNotNull(), repeated))
        .withColumn("n_repeat_words",
                    F.when(F.size(F.coalesce(starts_of, F.array().cast("array<int>"))) > 0, covered)
                    .otherwise(F.lit(0)).cast("long"))
    )


def passes(policy: str = CURRENT) -> Column:
    """Whether a ledger row passes a policy."""
    return F.col("failed_bits").bitwiseAND(F.lit(policy_mask(policy))) == F.lit(0)


def apply_policies(ledger: DataFrame, policies: tuple[str, ...] = tuple(POLICIES)) -> DataFrame:
    """The ledger with one ``kept_<policy>`` column per policy."""
    return ledger.withColumns({f"kept_{p}": passes(p) for p in policies})


def ablations(ledger: DataFrame, policies: tuple[str, ...] = tuple(POLICIES)) -> DataFrame:
    """Per policy and rule: documents, documents rejected by the policy, those only this rule
    rejects, and those still rejected without it.  The ledger is first aggregated to its
    distinct masks (at most 2^rules rows, map-side), so the rest is tiny."""
    by_mask = ledger.groupBy("failed_bits").agg(F.count(F.lit(1)).alias("n"))
    place = {r.name: i for i, r in enumerate(RULES)}
    cases = F.array(*[
        F.struct(F.lit(p).alias("policy"), F.lit(name).alias("rule"),
                 F.lit(policy_mask(p)).cast("long").alias("mask"), F.lit(1 << place[name]).cast("long").alias("bit"))
        for p in policies for name in POLICIES[p]])
    per = by_mask.select("n", "failed_bits", F.explode(cases).alias("c")).select("n", "failed_bits", "c.*")
    hit = F.col("failed_bits").bitwiseAND(F.col("mask"))
    without = F.col("failed_bits").bitwiseAND(F.col("mask").bitwiseXOR(F.col("bit")))
    count_if = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(F.lit(0)))
    return per.groupBy("policy", "rule").agg(
        F.sum("n").alias("documents"),
        count_if(hit != 0).alias("rejected"),
        count_if(hit == F.col("bit")).alias("only_this_rule"),
        count_if(without != 0).alias("rejected_without"),
    )


def reject(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """``docs`` without the documents that a policy rejects, in their own columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    ledger = rule_ledger(docs.select(row, F.col("text")), keep=("_row",))
    # the id keeps the optimiser from pushing the condition below the measurements, where it
    # would hold every rule with all expressions that it rests on, many times over
    fixed = ledger.withColumn("_at", F.monotonically_increasing_id())
    return fixed.where((F.col("_at") >= 0) & passes(policy)).select("_row.*")
