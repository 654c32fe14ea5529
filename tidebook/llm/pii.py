"""Personal data: patterns propose spans, checksums confirm them, context words adjust their score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebook.llm.common import apart, count_kind, located, named_spans, span_string, whole_text

# The kinds that are always reported, in report order, with patterns that find the same
# spans as the plain definitions but scan every run of characters once.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){13,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Kinds that the method adds: account numbers by their checksum, other phone numbers by their context.
ADDED = {
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
    "local_phone": r"(?<![0-9A-Za-z+.-])\(?[0-9]{3,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9A-Za-z.-]*[0-9A-Za-z])",
}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
CONTEXT = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write to)\b",
    "ip": r"(?i)\b(?:ip|address|host|server|login)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|credit|debit|pay|payment)\b",
    "phone": r"(?i)\b(?:tel|phone|call|fax|mobile|cell)\b",
    "iban": r"(?i)\b(?:iban|account|bank|transfer|konto|cuenta|compte)\b",
    "local_phone": r"(?i)\b(?:tel|phone|call|fax|mobile|cell)\b",
}
DOUBT = r"(?i)\b(?:version|order|invoice|serial|part no|isbn|sample|test)\b"
# Score of a span: what its pattern alone is worth, what a checksum adds, what context words add or take.
PATTERN_SCORE = {"email": 0.7, "ip": 0.5, "card": 0.3, "phone": 0.6, "iban": 0.3, "local_phone": 0.3}
CHECKSUM_SCORE, CONTEXT_SCORE, DOUBT_SCORE = 0.4, 0.2, -0.2


def luhn(value: Column) -> Column:
    """Whether the digits of ``value`` pass the Luhn check."""
    digits = F.split(F.reverse(F.regexp_replace(value, "[^0-9]", "")), "")
    doubled = F.transform(
        digits,
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def mod97(value: Column) -> Column:
    """Whether an account number leaves 1 modulo 97, its first four characters last and letters as 10 to 35."""
    plain = F.regexp_replace(value, " ", "")
    symbols = F.split(F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4)), "")

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return F.aggregate(symbols, F.lit(0), step) == 1


def _n_digits(value: Column) -> Column:
    return F.length(F.regexp_replace(value, "[^0-9]", ""))


def _confirmed(kind: str, spans: Column) -> Column:
    """Spans that meet what their kind demands besides its pattern."""
    if kind == "ip":
        return F.filter(spans, lambda s: s["value"].rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"))
    if kind == "card":
        return F.filter(spans, lambda s: luhn(s["value"]))
    if kind == "phone":
        return F.filter(spans, lambda s: _n_digits(s["value"]).between(10, 15))
    if kind == "iban":
        return F.filter(spans, lambda s: mod97(s["value"]))
    return spans


def _scored(text: Column, spans: Column, reach: int) -> Column:
    """Adds ``score``: the pattern's worth, the checksum's, and that of words up to ``reach`` characters before."""

    def score(s: Column) -> Column:
        before = F.substring(text, F.greatest(s["start"] - reach, F.lit(0)) + 1, F.least(s["start"], F.lit(reach)))
        worth = F.lit(0.0)
        for kind, base in PATTERN_SCORE.items():
            checked = CHECKSUM_SCORE if kind in ("card", "iban") else 0.0
            near = F.when(before.rlike(CONTEXT[kind]), CONTEXT_SCORE).otherwise(0.0)
            worth = F.when(s["kind"] == kind, F.lit(base + checked) + near).otherwise(worth)
        worth = worth + F.when(before.rlike(DOUBT), DOUBT_SCORE).otherwise(0.0)
        return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), worth)), 3)

    return F.transform(spans, lambda s: s.withField("score", score(s)))


def find_pii(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = 40, accept: float = 0.5
) -> DataFrame:
    """``id_col`` and ``spans`` (array of start, rank, end, kind, value, score), sorted by start and kind.

    One row for each input row, repeated rows included; other columns are not read.  Base kinds stay
    whatever their score; added kinds stay when their score is at least ``accept`` and they overlap no
    base span.  A null or empty text has no spans, a null id stays null, an empty table gives no rows.
    Offsets count code points.  Nothing moves between tasks.
    """
    text = F.col("_text")
    rows = docs.select(F.col(id_col), whole_text(F.col(text_col)).alias("_text"))
    names = list(BASE) + list(ADDED)
    rows = rows.select(
        id_col, "_text", *[located(text, p).alias(f"_raw_{k}") for k, p in {**BASE, **ADDED}.items()]
    )
    rows = rows.select(
        id_col,
        "_text",
        F.array_sort(
            F.concat(*[named_spans(_confirmed(k, F.col(f"_raw_{k}")), k, i) for i, k in enumerate(names[: len(BASE)])])
        ).alias("_base"),
        F.concat(
            *[
                named_spans(_confirmed(k, F.col(f"_raw_{k}")), k, len(BASE) + i)
                for i, k in enumerate(names[len(BASE) :])
            ]
        ).alias("_added"),
    )
    rows = rows.select(
        id_col,
        _scored(text, F.col("_base"), reach).alias("_base"),
        F.filter(_scored(text, apart(F.col("_added"), F.col("_base")), reach), lambda s: s["score"] >= accept).alias("_added"),
    )
    return rows.select(id_col, F.array_sort(F.concat("_base", "_added")).alias("spans"))


def pii_digest(found: DataFrame) -> DataFrame:
    """Counts and digests of the base spans, and all spans as text."""
    base = F.filter("spans", lambda s: s["kind"].isin(list(BASE)))
    return found.select(
        "doc_id",
        *[count_kind("spans", k).alias(f"n_{k}") for k in BASE],
        F.sha2(span_string(base), 256).alias("base_sha256"),
        span_string(F.col("spans")).alias("spans"),
        F.array_join(F.transform("spans", lambda s: F.format_string("%.2f", s["score"])), ",").alias("scores"),
    )
