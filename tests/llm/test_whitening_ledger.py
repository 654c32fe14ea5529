from __future__ import annotations

import math
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from llm import helpers as h
from pyspark.sql import functions as F

from tidebook.llm import ledger, whitening
from tidebook.llm.queries import op12_polarised_whitening, op13_rule_ledger

SF = "/root/testdata/sf0.01"


def _integers(vectors):
    return [[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors]


def _exact_covariance(x):
    """Covariance by the definition, in fractions."""
    n, d = len(x), len(x[0])
    mean = [Fraction(sum(row[i] for row in x), n) for i in range(d)]
    centred = [[c - m for c, m in zip(row, mean, strict=True)] for row in x]
    return [[sum(r[i] * r[j] for r in centred) / n for j in range(d)] for i in range(d)]


def test_polarised_covariance_is_exact(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", F.slice("embedding", 1, 6).alias("embedding"))
    rows = whitening.integer_vectors(df)
    fit = whitening.fit_sums(rows)
    got = whitening.covariance(fit, whitening.square_sums(rows, fit))
    want = _exact_covariance(_integers([r.embedding for r in df.collect()]))
    assert got.tolist() == [[float(c) for c in row] for row in want]


@pytest.mark.parametrize("size", [20, 41, 60, 70])
def test_squares_are_exact_at_any_size(size):
    rnd = np.random.default_rng(size)
    values = [[int(rnd.integers(-(1 << 30), 1 << 30)) << max(0, size - 30) >> max(0, 30 - size) for _ in range(3)] for _ in range(50)]
    bound = max(abs(v) for row in values for v in row)
    z = np.array(values, object if bound >= 1 << 62 else np.int64)
    assert whitening.squared(z, bound).tolist() == [sum(row[c] ** 2 for row in values) for c in range(3)]


def test_whitened_table(spark):
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    x = np.array(_integers(vectors.values()), dtype=np.int64)
    n, y = len(x), len(x) * x - x.sum(axis=0)
    rows = op12_polarised_whitening(spark, SF).collect()
    assert Counter(r.vec_id for r in rows) == dict.fromkeys(vectors, 8)
    away = dict(zip(vectors, (y * y).sum(axis=1).tolist(), strict=True))
    assert all(r.deviation == away[r.vec_id] and r.n == n for r in rows)
    place = {v: k for k, v in enumerate(vectors)}
    w = np.zeros((n, 8))
    for r in rows:
        w[place[r.vec_id], r.component - 1] = r.whitened
    values, axes = np.linalg.eigh(np.cov(x.T.astype(float), bias=True))
    want = (y / n) @ axes[:, ::-1][:, :8] / np.sqrt(values[::-1][:8])
    assert np.abs(np.abs(w) - np.abs(want)).max() < 1e-6
    shares = {r.component: r.explained for r in rows}
    assert np.allclose([shares[k] for k in range(1, 9)], values[::-1][:8] / values.sum(), rtol=1e-9)
    measured = np.abs(np.cov(w.T, bias=True) - np.eye(8)).max()
    assert measured < 1e-9 and {r.identity_error for r in rows} == {rows[0].identity_error}
    assert abs(rows[0].identity_error - measured) < 1e-9


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.5, 2.0]), (1, [0.5, 2.0]), (2, [1.0]), (3, None), (4, [None, 1.0]), (5, [nan, 0.0]), (6, [0.0, inf]),
        (None, []), (7, [-0.25, 1.5]), (8, [3.0, -1.0]),
    ]
    df = spark.createDataFrame([(i, v, 9, 1.0) for i, v in rows], "vec_id long, embedding array<float>, n int, whitened double")
    got = whitening.whiten_embeddings(df).collect()
    x = _integers([v + [0.0] * (2 - len(v)) for i, v in rows if v is not None and i not in (4, 5, 6)])
    n, sums = len(x), np.sum(x, axis=0)
    away = Counter(sum((n * c - s) ** 2 for c, s in zip(row, sums.tolist(), strict=True)) for row in x)
    assert Counter(r.deviation for r in got if r.component == 1) == away
    assert Counter(r.vec_id for r in got) == {1: 4, 2: 2, None: 2, 7: 2, 8: 2}
    assert got[0].identity_error < 1e-9 and got[0].n == 6
    assert whitening.whiten_embeddings(df.limit(0)).count() == 0
    assert whitening.whiten_embeddings(df.where("vec_id is null")).count() == 0
    one = whitening.whiten_embeddings(df.where("vec_id = 2")).collect()
    assert [(r.whitened, r.deviation, r.explained) for r in one] == [(0.0, 0, 0.0)]


def test_huge_entries_stay_exact(spark):
    df = spark.createDataFrame([(1, [1e30, 1.0]), (2, [-1e38, 2.0]), (3, [0.0, 0.0])], "vec_id long, embedding array<float>")
    rows = whitening.integer_vectors(df)
    fit = whitening.fit_sums(rows)
    x = [[r.x[0], r.x[1]] for r in rows.collect()]
    got = whitening.covariance(fit, whitening.square_sums(rows, fit))
    assert got.tolist() == [[float(c) for c in row] for row in _exact_covariance(x)]
    sums = np.sum(np.array(x, object), axis=0)
    away = [int(sum((3 * c - s) ** 2 for c, s in zip(row, sums, strict=True))) for row in x]
    want = Counter(a if a < 1 << 63 else None for a in away)
    assert Counter(r.deviation for r in whitening.whiten_embeddings(df).collect() if r.component == 1) == want


def measures(text):
    """The contract's measurements by plain Python."""
    text = text or ""
    w = h.WORD.findall(text)
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    count, covered = Counter(grams), set()
    for i, gram in enumerate(grams):
        if count[gram] > 1:
            covered |= set(range(i, i + 5))
    lines = [line for line in text.split("\n") if h.WORD.search(line)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


@pytest.fixture(scope="module")
def table_ledger(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return {r.doc_id: r.text for r in docs.collect()}, op13_rule_ledger(spark, SF).collect()


def test_measurements_and_verdicts(table_ledger):
    texts, rows = table_ledger
    assert len(rows) == len(texts)
    for r in rows:
        n, *rest = measures(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, *rest)
        assert r.base_failed == (n < 10 or 100 * r.n_repeat_words > 20 * n)
        assert r.kept == (r.failures == 0) and not (r.kept and r.base_failed)


def test_good_documents_stay(spark, table_ledger):
    """Labels are not read by the rules; most good texts stay and most bad ones go."""
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = [r for r in table_ledger[1] if r.doc_id in quality and not r.base_failed]
    good, bad = ([r.kept for r in rows if quality[r.doc_id] == q] for q in (1, 0))
    assert sum(good) > 0.98 * len(good) and sum(bad) < 0.6 * len(bad)


def test_awkward_texts(spark):
    repeated = [(20, "a b c d e a b c d e f"), (21, "x y\nx y\n \n x y\n\n"), (22, "p q r s t " * 40_000), (23, "=" * 200_000)]
    docs = h.awkward(spark).select("doc_id", "text", F.lit(1).alias("n_words"), F.lit("clash").alias("failures"))
    docs = docs.unionByName(
        spark.createDataFrame([(i, t, 1, "clash") for i, t in repeated], "doc_id long, text string, n_words int, failures string")
    )
    rows = ledger.quality_digest(ledger.rule_ledger(docs)).collect()
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows)
    assert got == Counter((i, *measures(t)) for i, t in [*h.AWKWARD, *repeated])
    assert ledger.rule_ledger(docs.limit(0)).count() == 0


def test_policies_and_ablations(spark, table_ledger):
    bits = [r.failures for r in table_ledger[1]]
    stored = spark.createDataFrame([(b,) for b in bits], "failures long")
    for policy, mask in ledger.POLICIES.items():
        kept = [r.kept for r in ledger.apply_policy(stored, policy).select("kept").collect()]
        assert kept == [not b & mask for b in bits]
        rows = {r.bit: r for r in ledger.ablations(stored, policy).collect()}
        assert sorted(rows) == [r.bit for r in ledger.RULES if mask >> r.bit & 1]
        for bit, r in rows.items():
            own, failing = 1 << bit, [b & mask for b in bits if b >> bit & 1]
            union = 0
            for b in failing:
                union |= b & ~own
            assert (r.n_failing, r.n_only, r.n_kept_without, r.n_kept_alone, r.fails_with) == (
                len(failing),
                sum(b & mask == own for b in bits),
                sum(not b & mask & ~own for b in bits),
                len(bits) - len(failing),
                union,
            )
    assert {r.n_failing for r in ledger.ablations(stored.limit(0)).collect()} == {0}
    assert ledger.policy_table(spark).where("policy = 1").count() == 2
    with pytest.raises(ValueError):
        ledger.apply_policy(stored, 99)
