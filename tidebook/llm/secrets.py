"""Secrets: fixed patterns, and tokens that look random to two character Markov models."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebook.llm.common import apart, count_kind, located, named_spans, span_string, whole_text

# The kinds that are always reported, in report order.
BASE = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{12,}+",
    "hex": r"(?<![0-9a-f])[0-9a-f]{32,}+",
}
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}+"
PLAIN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z][A-Za-z0-9_-]{6,}+"
MIN_RATIO = 8.0
MIN_RATIO_PER_STEP = 0.6


def base_spans(text: Column) -> Column:
    """Sorted spans of the base kinds."""
    raw = {k: located(text, p) for k, p in BASE.items()}
    raw["assign"] = F.filter(
        raw["assign"], lambda s: F.length(F.regexp_extract(s["value"], BASE["assign"], 1)) >= 8
    )
    return F.array_sort(F.concat(*[named_spans(raw[k], k, i) for i, k in enumerate(BASE)]))


def _steps(value: Column) -> Column:
    """Index of each pair of neighbours in a table of ``len(ALPHABET)`` squared; linear in the length."""
    n = len(ALPHABET)
    codes = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    rest = F.greatest(F.length(value) - 1, F.lit(0))
    return F.zip_with(F.slice(codes, F.lit(1), rest), F.slice(codes, F.lit(2), rest), lambda a, b: a * n + b)


def train_ratio(docs: DataFrame, text_col: str = "text") -> list[float]:
    """Log-likelihood ratio, random over ordinary, of each step between two characters.

    All documents supply labelled values: what a base pattern found is a random string, words and identifiers
    outside such spans are ordinary.  A value that occurs n times counts as often as n has binary digits, so
    copies of a text don't outweigh the rest.  Each model is a first-order chain with one added to every
    count, so an empty table gives zeros.  Only the counts, at most two tables of steps, reach the driver.
    """
    text = F.col("_text")
    rows = docs.select(whole_text(F.col(text_col)).alias("_text"))
    # A generator of one row keeps the optimizer from searching the text again for each of its words.
    rows = rows.select(F.inline(F.array(F.struct(text, base_spans(text).alias("base")))))
    secret = F.transform(
        "base",
        lambda s: F.struct(
            F.lit(1).alias("random"),
            F.when(s["kind"] == "assign", F.regexp_extract(s["value"], BASE["assign"], 1))
            .otherwise(s["value"])
            .alias("value"),
        ),
    )
    # Positions of the words matter only where there are spans to keep clear of.
    words = F.when(F.size("base") == 0, F.regexp_extract_all(text, F.lit(PLAIN), F.lit(0))).otherwise(
        F.transform(apart(located(text, PLAIN), F.col("base")), lambda s: s["value"])
    )
    plain = F.transform(words, lambda w: F.struct(F.lit(0).alias("random"), w.alias("value")))
    # Of the characters that a value can have only the full stop is outside the alphabet.
    labelled = rows.select(F.explode(F.concat(secret, plain)).alias("s")).select(
        "s.random", F.translate("s.value", ".", "").alias("value")
    )
    counts = (
        labelled.where(F.length("value") > 1)
        .groupBy("random", "value")
        .count()
        .select("random", F.length(F.bin("count")).alias("weight"), F.explode(_steps(F.col("value"))).alias("step"))
        .groupBy("random", "step")
        .agg(F.sum("weight").alias("count"))
    )
    n = len(ALPHABET)
    tables = {0: [1] * (n * n), 1: [1] * (n * n)}
    for random, step, count in counts.toLocalIterator():
        tables[random][step] += count
    ratio = []
    for a in range(n):
        row = {k: t[a * n : (a + 1) * n] for k, t in tables.items()}
        total = {k: sum(r) for k, r in row.items()}
        ratio += [
            round(math.log(row[1][b] / total[1]) - math.log(row[0][b] / total[0]), 6) for b in range(n)
        ]
    return ratio


def find_secrets(docs: DataFrame, ratio: list[float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``spans`` (array of start, rank, end, kind, value), sorted by start and kind.

    Base kinds stay; a token of 16 characters or more outside them is added as ``random`` when its summed
    log-likelihood ratio and its mean for each step reach fixed levels.  One row for each input row,
    repeated rows included; other columns are not read.  Null and empty texts have no spans; a null id
    stays null; an empty table gives no rows.  Nothing moves between tasks.
    """
    rows = docs.select(F.col(id_col), whole_text(F.col(text_col)).alias("_text"))
    return _with_spans(rows, ratio).select(id_col, "spans")


def _with_spans(rows: DataFrame, ratio: list[float]) -> DataFrame:
    """Adds ``spans`` to rows that have ``_text``."""
    text = F.col("_text")
    table = F.split(F.lit(",".join(map(str, ratio))), ",").cast("array<double>")  # one folded constant
    rows = rows.withColumn("_base", base_spans(text)).withColumn("_tokens", located(text, CANDIDATE))

    def looks_random(s: Column) -> Column:
        gained = F.aggregate(
            _steps(s["value"]), F.lit(0.0), lambda total, step: total + F.element_at(table, step + 1)
        )
        return (gained >= MIN_RATIO) & (gained >= (s["end"] - s["start"] - 1) * MIN_RATIO_PER_STEP)

    added = F.filter(apart(F.col("_tokens"), F.col("_base")), looks_random)
    return rows.withColumn(
        "spans", F.array_sort(F.concat("_base", named_spans(added, "random", len(BASE))))
    ).drop("_base", "_tokens")


def redact_documents(docs: DataFrame, ratio: list[float]) -> DataFrame:
    """``doc_id``, ``text``, ``lang``, ``source`` and ``n_chars`` with secrets replaced; null texts stay null."""
    rows = docs.select(
        "doc_id", "text", "lang", "source", "n_chars", whole_text(F.col("text")).alias("_text")
    )
    rows = _with_spans(rows, ratio)
    return rows.select(
        "doc_id", redact(F.col("text"), F.col("spans")).alias("text"), "lang", "source", "n_chars", "spans"
    ).select(
        "doc_id",
        "text",
        "lang",
        "source",
        F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def secret_digest(found: DataFrame) -> DataFrame:
    """Counts and digests of the base spans, and all spans as text."""
    base = F.filter("spans", lambda s: s["kind"].isin(list(BASE)))
    return found.select(
        "doc_id",
        *[count_kind("spans", k).alias(f"n_{k}") for k in BASE],
        F.sha2(span_string(base), 256).alias("base_sha256"),
        span_string(F.col("spans")).alias("spans"),
    )


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span replaced; overlapping spans become one mark."""

    def step(done: Column, s: Column) -> Column:
        kept = F.substring(text, done["at"] + 1, F.greatest(s["start"] - done["at"], F.lit(0)))
        return F.struct(
            F.greatest(s["end"], done["at"]).alias("at"),
            F.when((s["start"] < done["at"]) & (done["at"] > 0), done["out"])
            .otherwise(F.concat(done["out"], kept, F.lit(mark)))
            .alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = F.aggregate(
        spans,
        start,
        step,
        lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))),
    )
    return F.when(F.size(spans) > 0, rest).otherwise(text)
