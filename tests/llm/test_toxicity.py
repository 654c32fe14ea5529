from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from llm import helpers as h

from tidebook.llm import toxicity
from tidebook.llm.queries import op1_factorization_machine

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = op1_factorization_machine(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    kept = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    hit = sum(a and b for a, b in kept)
    assert hit / sum(a for a, _ in kept) > 0.6 and hit / max(1, sum(b for _, b in kept)) > 0.9


def test_pair_score_equals_sum_over_pairs():
    rng = np.random.default_rng(1)
    machine = toxicity.Machine(np.arange(10, 20), rng.normal(size=10), rng.normal(size=(10, 3)), 0.2)
    texts = [[10, 12, 17, 99], [], [13]]
    flat = np.array([t for x in texts for t in x])
    got = machine.score(flat, np.repeat(np.arange(3), [len(x) for x in texts]), 3)
    for text, score in zip(texts, got, strict=True):
        known = [t - 10 for t in text if t < 20]
        z = 0.2 + sum(machine.linear[i] for i in known)
        z += sum(machine.factors[a] @ machine.factors[b] for n, a in enumerate(known) for b in known[n + 1 :])
        assert abs(score - 1 / (1 + np.exp(-z))) < 1e-9


def test_learns_a_pair_that_no_single_term_shows():
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(4000):
        a, b = rng.random(2) < 0.35
        noise = list(rng.integers(1000, 1050, 5))
        rows.append({"terms": [1] * int(a) + [2] * int(b) + noise, "toxic": int(a and b)})
    machine = toxicity.train(pd.DataFrame(rows))
    score = machine.score(np.array([1, 2, 1, 2]), np.array([0, 0, 1, 2]), 3)
    assert score[0] > 0.5 > max(score[1], score[2])


def test_learns_pairs_of_terms_without_a_ratio_of_their_own():
    for seed in range(3):
        rng = np.random.default_rng(seed)
        rows = []
        for _ in range(4000):
            a, b = rng.random(2) < 0.5
            noise = list(rng.integers(1000, 1050, 5))
            rows.append({"terms": [1] * int(a) + [2] * int(b) + noise, "toxic": int(a != b)})
        machine = toxicity.train(pd.DataFrame(rows))
        score = machine.score(np.array([1, 2, 1, 2]), np.array([0, 0, 1, 2]), 4)
        assert min(score[1], score[2]) > 0.5 > max(score[0], score[3])


def test_fit_keeps_terms_of_equal_share(spark):
    rows = [(i, ("alpha " if i % 2 else "") + ("beta " if i // 2 % 2 else "") + f"w{i % 7}", i % 2 ^ i // 2 % 2) for i in range(2000)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    scored = {r.doc_id: r.predicted for r in toxicity.score_documents(docs, toxicity.fit(docs, labels)).collect()}
    assert np.mean([scored[i] == y for i, _, y in rows]) > 0.95


def test_awkward_rows_and_missing_labels(spark):
    docs = h.awkward(spark)
    labels = spark.createDataFrame(
        [(None, None, 1), (4, 1, 1), (4, 1, 0), (5, 0, None)], "doc_id long, quality int, toxic int"
    )
    for known in (labels, labels.limit(0)):
        rows = toxicity.score_documents(docs, toxicity.fit(docs, known)).collect()
        assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in h.AWKWARD)
        assert all(0 <= r.score <= 1 for r in rows)
    machine = toxicity.fit(docs, labels)
    assert toxicity.score_documents(docs.limit(0), machine).count() == 0


def test_the_driver_gets_the_machine_only(spark, monkeypatch):
    """Training runs in a task, on the rows in the order of their ids; no row of the sample reaches the driver."""
    docs = spark.createDataFrame([(i, f"{'alpha' if i % 2 else 'beta'} w{i % 7}") for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(400)], "doc_id long, quality int, toxic int")
    rows = toxicity.training_rows(docs, labels).orderBy("doc_id").select("toxic", "terms").toPandas()
    rows["terms"] = [np.sort(np.asarray(t, dtype=np.int64)) for t in rows["terms"]]
    wanted, got = toxicity.train(rows), []
    to_arrow = type(docs).toArrow
    monkeypatch.setattr(type(docs), "toArrow", lambda df: got.append(to_arrow(df)) or got[-1])
    machine = toxicity.fit(docs, labels)
    assert [t.num_rows for t in got] == [len(wanted.keys) + 1]
    assert np.array_equal(machine.keys, wanted.keys) and machine.bias == wanted.bias
    assert np.array_equal(machine.linear, wanted.linear) and np.array_equal(machine.factors, wanted.factors)
