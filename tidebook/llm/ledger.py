"""Quality rules as a ledger: every rule is evaluated once, policies are masks over the stored failure bits.

``rule_ledger`` measures each text and sets bit ``RULES[i].bit`` where rule i fails.  A policy is a
version number with the mask of the rules that it enforces, so a verdict, a new policy or an ablation
reads the ledger and never a text.  Ablations aggregate by bit pattern first: there are at most
2**len(RULES) patterns, whatever the number of documents.

Rows: a null text counts as empty and fails ``few_words``; null ids stay null; repeated rows repeat;
extra columns are not read; an empty table gives no rows (and ablations with counts of zero).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.llm.common import whole_text

SYMBOLS = "#*$%&|<>"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """``fails`` is SQL over the measurements; integers only, so that every engine agrees."""

    bit: int
    name: str
    fails: str


# Bits are never reused: a stored ledger stays readable when rules are added.
RULES = [
    Rule(0, "few_words", "n_words < 10"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule(2, "word_length", "n_words > 0 and (word_chars < 3 * n_words or word_chars > 12 * n_words)"),
    Rule(3, "symbols", "10 * n_symbols > n_words"),
    Rule(4, "repeated_lines", "10 * n_dup_lines > 4 * n_lines"),
    Rule(5, "letterless_words", "10 * n_letter_words < 7 * n_words"),
]
BASE = 0b000011
# Version of a policy and the rules that it enforces; versions are never edited, only added.
POLICIES = {1: BASE, 2: 0b001111, 3: 0b111111}
CURRENT = 3
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letter_words"]


def _pinned(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``value`` computed once: the optimizer does not copy an expression through a generator."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _covered_words(starts: Column) -> Column:
    """Words in windows that begin at the sorted places ``starts``; overlaps count once."""
    step = lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - p, F.lit(WINDOW)))
    return F.aggregate(F.transform(starts, step), F.lit(0), lambda total, n: total + n)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and ``MEASURES`` of every whole text, without a shuffle.

    Windows are compared by 64-bit hashes of their words; only texts in which a hash repeats sort them.
    """
    text = whole_text(F.col("text"))
    one = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    one = _pinned(one, "words", F.filter(F.split("text", r"[\x20\x09-\x0D]+", -1), lambda w: w != ""))
    one = _pinned(one, "lines", F.filter(F.split("text", "\n", -1), lambda s: s.rlike(r"[^\x20\x09-\x0D]")))
    one = _pinned(one, "solid", F.array_join("words", "")).drop("text")
    # All symbols are ASCII, so bytes count them.
    without = [F.octet_length(F.replace("solid", F.lit(symbol), F.lit(""))) for symbol in SYMBOLS]
    one = one.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length("solid").cast("long").alias("word_chars"),
        sum((F.octet_length("solid") - left for left in without), F.lit(0)).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("words", lambda w: w.rlike(r"\p{L}"))).cast("long").alias("n_letter_words"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    one = _pinned(one, "h", F.col("hashes")).drop("hashes")
    inner = F.greatest(F.size("h") - (WINDOW - 1), F.lit(0))
    steps = F.arrays_zip(*[F.slice("h", F.lit(k + 1), inner).alias(f"w{k}") for k in range(WINDOW)])
    one = _pinned(one, "windows", F.transform(steps, lambda words: F.xxhash64(words))).drop("h")
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = F.expr("cast(array() as array<struct<h:bigint,i:int>>)")
    one = _pinned(one, "placed", F.when(repeats, placed).otherwise(none)).drop("windows")
    twice = F.filter(
        "placed",
        lambda w, j: F.coalesce(F.get("placed", j - 1)["h"] == w["h"], F.lit(False))
        | F.coalesce(F.get("placed", j + 1)["h"] == w["h"], F.lit(False)),
    )
    one = _pinned(one, "starts", F.sort_array(F.transform(twice, lambda w: w["i"]))).drop("placed")
    one = one.withColumn("n_repeat_words", _covered_words(F.col("starts")).cast("long"))
    return one.select("doc_id", *MEASURES)


def rule_ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements and ``failures``: bit i is set where the rule with that bit fails."""
    bits = F.lit(0).cast("long")
    for rule in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long"))
    return measured(docs).withColumn("failures", bits)


def policy_table(spark: SparkSession) -> DataFrame:
    """policy, bit, rule of every rule that a policy enforces: the stored form of ``POLICIES``."""
    rows = [(v, r.bit, r.name) for v, mask in POLICIES.items() for r in RULES if mask >> r.bit & 1]
    return spark.createDataFrame(rows, "policy int, bit int, rule string")


def _mask(policy: int) -> int:
    if policy not in POLICIES:
        raise ValueError(f"no policy {policy}; known are {sorted(POLICIES)}")
    return POLICIES[policy]


def apply_policy(ledger: DataFrame, policy: int = CURRENT) -> DataFrame:
    """The ledger with ``policy`` and ``kept``: no enforced rule fails."""
    failing = F.col("failures").bitwiseAND(F.lit(_mask(policy)).cast("long"))
    return ledger.withColumns({"policy": F.lit(policy), "kept": failing == 0})


def bit_patterns(ledger: DataFrame) -> DataFrame:
    """failures and n_docs; combined before the shuffle to at most one row a pattern and task."""
    return ledger.groupBy("failures").agg(F.count(F.lit(1)).alias("n_docs"))


def ablations(ledger: DataFrame, policy: int = CURRENT) -> DataFrame:
    """What each rule of a policy does, one row a rule.

    ``n_failing`` documents fail the rule, ``n_only`` fail no other enforced rule and would come back
    without it, ``n_kept_without`` is what the policy keeps then, ``n_kept_alone`` what the rule keeps by
    itself; ``fails_with`` is the bitwise union of the other enforced rules that fail beside it.
    """
    mask = _mask(policy)
    enforced = [r for r in RULES if mask >> r.bit & 1]
    rules = F.array(*[F.struct(F.lit(r.bit).alias("bit"), F.lit(r.name).alias("rule")) for r in enforced])
    # A pattern without documents keeps every rule in the result when the ledger is empty.
    nothing = ledger.sparkSession.range(1).select(
        F.lit(0).cast("long").alias("failures"), F.lit(0).cast("long").alias("n_docs")
    )
    rows = (
        bit_patterns(ledger)
        .unionByName(nothing)
        .select(F.col("failures").bitwiseAND(F.lit(mask).cast("long")).alias("found"), "n_docs", F.inline(rules))
        .withColumn("own", F.expr("shiftleft(1L, bit)"))
        .withColumn("others", F.col("found").bitwiseAND(F.bitwise_not("own")))
    )
    fails = F.col("found").bitwiseAND(F.col("own")) != 0
    total = lambda when: F.coalesce(F.sum(F.when(when, F.col("n_docs"))), F.lit(0)).cast("long")
    return rows.groupBy("bit", "rule").agg(
        total(fails).alias("n_failing"),
        total(F.col("found") == F.col("own")).alias("n_only"),
        total(F.col("others") == 0).alias("n_kept_without"),
        total(~fails).alias("n_kept_alone"),
        F.coalesce(F.bit_or(F.when(fails, F.col("others"))), F.lit(0).cast("long")).alias("fails_with"),
    )


def quality_digest(ledger: DataFrame, policy: int = CURRENT) -> DataFrame:
    """The columns of the contract, from the ledger and a policy's verdict."""
    return apply_policy(ledger, policy).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (F.col("failures").bitwiseAND(F.lit(BASE).cast("long")) != 0).alias("base_failed"),
        (F.col("kept") & (F.col("failures").bitwiseAND(F.lit(BASE).cast("long")) == 0)).alias("kept"),
        "failures",
        "policy",
    )
