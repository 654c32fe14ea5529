"""Plain-Python versions of the operators' contracts, and rows with awkward values."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")

PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SECRETS = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


KEEP = {
    "email": lambda m: True,
    "ip": lambda m: all(int(x) <= 255 for x in m.group(0).split(".")),
    "card": lambda m: 14 <= len(digits(m.group(0))) <= 19 and luhn(digits(m.group(0))),
    "phone": lambda m: 10 <= len(digits(m.group(0))) <= 15,
    "assign": lambda m: len(m.group(1)) >= 8,
    "access": lambda m: len(m.group(0)) >= 16,
    "hex": lambda m: len(m.group(0)) >= 32,
}


def base_spans(text: str | None, kinds: dict[str, str]) -> list[tuple[int, int, str, int]]:
    """(start, rank, kind, end) in report order."""
    out = []
    for rank, (kind, pattern) in enumerate(kinds.items()):
        out += [(m.start(), rank, kind, m.end()) for m in re.finditer(pattern, text or "") if KEEP[kind](m)]
    return sorted(out)


def span_text(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in spans)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words(text: str | None) -> list[str]:
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lowered)


def shingles(text: str | None, k: int) -> set[tuple[str, ...]]:
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or {tuple(w)}


AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "one"),
    (5, "one two"),
    (5, "one two"),
    (None, "no id here password=abcdefgh99 and a@b.cd"),
    (6, "Ünï 🙂 a@b.co_x@y.zz c@d@e.f.g 1.2.3.4.5.6.7.8 999.1.1.1 0001.002.3.4 a@b..c"),
    (7, "+1 (514) 555-8389 +12 4111 1111 1111 1111 4111-1111-1111-1111-1 40128888 88881881 5500 0000 0000 0004"),
    (8, "secret: token:abcdefghijk password==abcdefghi API_KEY = 'zzzzzzzz' token='x' apikey=\"1234567\""),
    (9, "AKIAAKIAAKIA AKIA0123456789AB AKIAQQQQQQQQQQQ " + "0123456789abcdef" * 2 + "g" + "ab" * 15),
    (10, "x" * 50_000 + " " + "1" * 3_000 + "@" + "a." * 6_000 + "b"),
    (11, "iban GB82 WEST 1234 5698 7654 32 and GB82WEST12345698765433 call 514-555-0199"),
]
AWKWARD_SCHEMA = "doc_id long, text string, lang string, spans string, start int, shard string"


def awkward(spark):
    """Rows with nulls, empty and long texts, repeats and columns whose names clash with results."""
    return spark.createDataFrame([(i, t, None, "clash", 7, "clash") for i, t in AWKWARD], AWKWARD_SCHEMA)
