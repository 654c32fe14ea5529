from __future__ import annotations

import itertools
import math
import random
import re
import time
from collections import Counter

import pytest
from llm import helpers as h

from tidebook.llm import pii, secrets
from tidebook.llm.queries import op5_pii, op6_secret_scan

SF = "/root/testdata/sf0.01"


def test_pii_equals_plain_search(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op5_pii(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = h.base_spans(docs[r.doc_id], h.PII)
        assert r.base_sha256 == h.sha(h.span_text(want)), (r, want)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[2] == k for s in want) for k in h.PII]


def test_pii_awkward(spark):
    rows = pii.pii_digest(pii.find_pii(h.awkward(spark))).collect()
    assert len(rows) == len(h.AWKWARD)
    got = sorted((str(r.doc_id), r.base_sha256) for r in rows)
    assert got == sorted((str(i), h.sha(h.span_text(h.base_spans(t, h.PII)))) for i, t in h.AWKWARD)
    added = {r.doc_id: r.spans for r in rows}
    assert added[11] == "iban:5:32,local_phone:65:77"


def test_pii_empty_table(spark):
    assert pii.find_pii(h.awkward(spark).limit(0)).count() == 0


@pytest.mark.parametrize("value,ok", [("GB82 WEST 1234 5698 7654 32", True), ("GB82WEST12345698765433", False)])
def test_mod97(spark, value, ok):
    from pyspark.sql import functions as F

    assert spark.range(1).select(pii.mod97(F.lit(value)).alias("x")).first().x is ok


def test_secrets_equal_plain_search(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op6_secret_scan(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = h.base_spans(docs[r.doc_id], h.SECRETS)
        assert r.base_sha256 == h.sha(h.span_text(want)), (r, want)
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[2] == k for s in want) for k in h.SECRETS]


def test_secrets_awkward(spark):
    docs = h.awkward(spark)
    ratio = secrets.train_ratio(docs)
    rows = secrets.secret_digest(secrets.find_secrets(docs, ratio)).collect()
    got = sorted((str(r.doc_id), r.base_sha256) for r in rows)
    assert got == sorted((str(i), h.sha(h.span_text(h.base_spans(t, h.SECRETS)))) for i, t in h.AWKWARD)
    empty = docs.limit(0)
    assert set(secrets.train_ratio(empty)) == {0.0}
    assert secrets.find_secrets(empty, ratio).count() == 0


def test_models_tell_random_from_ordinary(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ratio = secrets.train_ratio(docs)
    made = spark.createDataFrame(
        [(1, "see 9f3c1d7ab04e62c58d1f here"), (2, "the enonthandingofthestand word here")], "doc_id long, text string"
    )
    found = {r.doc_id: [s.kind for s in r.spans] for r in secrets.find_secrets(made, ratio).collect()}
    assert found == {1: ["random"], 2: []}


def test_redaction(spark):
    docs = spark.createDataFrame([(1, "a password=abcdefgh99 b"), (2, "nothing")], "doc_id long, text string")
    spans = secrets.find_secrets(docs, [0.0] * len(secrets.ALPHABET) ** 2)
    from pyspark.sql import functions as F

    rows = docs.join(spans, "doc_id").select("doc_id", secrets.redact(F.col("text"), F.col("spans")).alias("t")).collect()
    assert {r.doc_id: r.t for r in rows} == {1: "a [SECRET] b", 2: "nothing"}


def _plain_secrets(texts):
    """Spans of every text by plain loops: base kinds, two chains of characters, and tokens that look random."""
    alphabet, n = secrets.ALPHABET, len(secrets.ALPHABET)
    counts, base = Counter(), [h.base_spans(t, h.SECRETS) for t in texts]

    def outside(m, spans):
        return all(m.end() <= s[0] or s[3] <= m.start() for s in spans)

    for text, spans in zip(texts, base, strict=True):
        for start, _, kind, end in spans:
            value = text[start:end]
            counts[1, re.search(h.SECRETS["assign"], value)[1] if kind == "assign" else value] += 1
        for m in re.finditer(secrets.PLAIN, text or ""):
            if outside(m, spans):
                counts[0, m[0]] += 1
    cleaned = Counter()
    for (random, value), times in counts.items():
        cleaned[random, "".join(c for c in value if c in alphabet)] += times
    steps = {0: [[1] * n for _ in alphabet], 1: [[1] * n for _ in alphabet]}
    for (random, value), times in cleaned.items():
        for a, b in itertools.pairwise(value):
            steps[random][alphabet.index(a)][alphabet.index(b)] += times.bit_length()
    ratio = [
        round(math.log(steps[1][a][b] / sum(steps[1][a])) - math.log(steps[0][a][b] / sum(steps[0][a])), 6)
        for a in range(n)
        for b in range(n)
    ]
    found = []
    for text, spans in zip(texts, base, strict=True):
        added = []
        for m in re.finditer(secrets.CANDIDATE, text or ""):
            gained = sum(ratio[alphabet.index(a) * n + alphabet.index(b)] for a, b in itertools.pairwise(m[0]))
            enough = gained >= secrets.MIN_RATIO and gained >= (len(m[0]) - 1) * secrets.MIN_RATIO_PER_STEP
            if outside(m, spans) and enough:
                added.append((m.start(), len(secrets.BASE), "random", m.end()))
        found.append(h.span_text(sorted(spans + added)))
    return ratio, found


def test_models_and_random_spans_equal_plain_loops(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    docs = [tuple(r) for r in docs] + [(i, t) for i, t in h.AWKWARD if t is None or len(t) < 2_000]
    docs += [(10**6 + i, "key 9f3c1d7ab04e62c58d1f and kQ7xZp0VtR2mW9sLbY4c " * (i + 1)) for i in range(3)]
    rows = spark.createDataFrame([(n, t) for n, (_, t) in enumerate(docs)], "doc_id long, text string")
    ratio, want = _plain_secrets([t for _, t in docs])
    got = secrets.train_ratio(rows)
    assert got == pytest.approx(ratio, abs=2e-6)
    spans = {r.doc_id: r.spans for r in secrets.secret_digest(secrets.find_secrets(rows, got)).collect()}
    assert [spans[n] for n in range(len(docs))] == want
    assert sum("random" in s for s in want) >= 3


def test_many_matches_in_one_text_take_seconds(spark):
    from pyspark.sql import functions as F

    from tidebook.llm.common import located

    n = 100_000
    keys = " ".join(f"AKIA{i:012d} wörd{i:07d}" for i in range(n))
    docs = spark.createDataFrame([(keys,), ("none",), ("AKIA1 x AKIA22",), (None,)], "text string")
    start = time.monotonic()
    pattern = "AKIA[A-Z0-9]+"
    rows = docs.select("text", located(F.col("text"), pattern).alias("found")).collect()
    for r in rows:
        want = [(m.start(), m.end(), m[0]) for m in re.finditer(pattern, r.text or "")]
        assert [tuple(s) for s in r.found] == want
    assert time.monotonic() - start < 30


def test_spans_apart(spark):
    from pyspark.sql import functions as F

    from tidebook.llm.common import apart

    rng = random.Random(5)

    def some(n):
        return sorted((a, a + rng.randint(1, 9)) for a in (rng.randint(0, 400) for _ in range(n)))

    rows = [(some(rng.randint(0, 30)), some(rng.choice([0, 1, 2, 40]))) for _ in range(60)]
    kind = "array<struct<start:int,end:int>>"
    got = spark.createDataFrame(rows, f"a {kind}, b {kind}").select("a", "b", apart(F.col("a"), F.col("b")).alias("c"))
    for r in got.collect():
        assert r.c == [s for s in r.a if all(s.end <= o.start or o.end <= s.start for o in r.b)]
