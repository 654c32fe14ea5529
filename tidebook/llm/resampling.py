"""Quality classifier: importance resampling by hashed n-gram models, sampled by Gumbel top-k."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebook.llm.common import bounded_batches, hash_sample, whole_text
from tidebook.session import settle

BUCKETS = 10_000
SAMPLE_TARGETS = 20_000
SHARE = 0.8
_COLLECT = 10_000


def _tokens(text: Column) -> Column:
    """Hashes of lower-case words and of single punctuation marks."""
    found = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"), F.lit(0))
    return F.transform(found, lambda w: F.xxhash64(w))


def _grams(lists: list[np.ndarray], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every unigram and bigram of all texts, and the text of each."""
    sizes = np.array([len(t) for t in lists], dtype=np.int64)
    flat = np.concatenate(lists).astype(np.int64).view(np.uint64) if sizes.sum() else np.zeros(0, np.uint64)
    text = np.repeat(np.arange(len(lists)), sizes)
    pair = (flat[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ flat[1:]
    inner = text[:-1] == text[1:]
    both = np.concatenate([flat, pair[inner] ^ (pair[inner] >> np.uint64(29))])
    return (both % np.uint64(buckets)).astype(np.int64), np.concatenate([text, text[:-1][inner]])


def log_ratio_model(docs: DataFrame, targets: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """log p(target) - log p(raw) of each bucket; raw counts come from all documents.

    ``targets`` is a bounded set of ids (see ``target_sample``).  One is added to every count, so without
    targets or documents the model is near zero.  The driver gets one row a bucket.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _tokens(whole_text(F.col("text"))).alias("tokens"))
    rows = rows.join(F.broadcast(targets.withColumn("target", F.lit(True))), "doc_id", "left").select(
        "tokens", F.coalesce("target", F.lit(False)).alias("target")
    )

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for part in batches:
            grams, text = _grams(part["tokens"].tolist(), buckets)
            raw += np.bincount(grams, minlength=buckets)
            target += np.bincount(grams[part["target"].to_numpy()[text]], minlength=buckets)
        yield pd.DataFrame({"bucket": np.arange(buckets), "raw": raw, "target": target})

    summed = rows.mapInPandas(count, "bucket long, raw long, target long").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target")
    )
    raw, target = np.ones(buckets), np.ones(buckets)
    for r in summed.toLocalIterator():
        raw[r["bucket"]] += r["raw"]
        target[r["bucket"]] += r["target"]
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def target_sample(labels: DataFrame, bound: int = SAMPLE_TARGETS) -> DataFrame:
    """Ids of about ``bound`` rows at most that are labelled as good, chosen by hash."""
    good = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    return hash_sample(good, F.col("doc_id"), bound)


def importance(docs: DataFrame, model: np.ndarray, seed: int = 11) -> DataFrame:
    """doc_id, log_ratio (mean of a text's n-grams), n_grams and key: log weight of the text plus Gumbel noise.

    The noise follows from doc_id, text and seed alone, so a run that is repeated draws the same sample.
    A text without n-grams has the ratio 0.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text = whole_text(F.col("text"))
    noise = F.xxhash64("doc_id", text, F.lit(seed))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _tokens(text).alias("tokens"), noise.alias("noise"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weight = shared.value
        for part in batches:
            grams, at = _grams(part["tokens"].tolist(), len(weight))
            n = np.bincount(at, minlength=len(part))
            total = np.bincount(at, weight[grams], len(part))
            uniform = ((part["noise"].to_numpy(np.int64).view(np.uint64) >> np.uint64(11)) + np.uint64(1)) / (2.0**53 + 2)
            yield pd.DataFrame(
                {
                    "doc_id": part["doc_id"].astype("Int64"),
                    "log_ratio": total / np.maximum(n, 1),
                    "n_grams": n,
                    "key": total - np.log(-np.log(uniform)),
                }
            )

    return rows.mapInPandas(run, "doc_id long, log_ratio double, n_grams long, key double")


def top_k(rows: DataFrame, key: str, k: int) -> DataFrame:
    """The ``k`` rows with the largest ``key``, and any rows that tie with the last of them.

    Histograms narrow down the k-th value; only counts, and at the end a few values, reach the driver.
    """
    if k <= 0:
        return rows.limit(0)
    span = rows.agg(F.count(key).alias("n"), F.min(key).alias("low"), F.max(key).alias("high")).first()
    if span["n"] <= k:
        return rows
    low, high, left = span["low"], span["high"], k
    while True:
        inside = rows.where(F.col(key).between(low, high)).select(key)
        if low == high:
            return rows.where(F.col(key) >= low)
        width = (high - low) / 1024
        cell = F.least(F.floor((F.col(key) - low) / width), F.lit(1023)) if width > 0 else F.lit(0)
        cells = inside.groupBy(cell.alias("cell")).agg(
            F.count(F.lit(1)).alias("n"), F.min(key).alias("low"), F.max(key).alias("high")
        )
        for c in sorted(cells.collect(), key=lambda c: -c["high"]):
            if left <= c["n"]:
                low, high = c["low"], c["high"]
                break
            left -= c["n"]
        if c["n"] <= _COLLECT:
            values = sorted((r[0] for r in rows.where(F.col(key).between(low, high)).select(key).collect()), reverse=True)
            return rows.where(F.col(key) >= values[left - 1])


def resample(docs: DataFrame, labels: DataFrame, share: float = SHARE, seed: int = 11) -> DataFrame:
    """doc_id, log_ratio, n_grams and key of the sampled rows, ``share`` of all rows.

    Drawn without replacement with probability in proportion to the importance weights (Gumbel top-k).
    Null and empty texts weigh one; null ids stay null; repeated rows are drawn alike and may exceed the
    share as ties; an empty table gives no rows; without labels all n-grams weigh nearly alike.
    """
    model = log_ratio_model(docs, target_sample(labels))
    keyed = settle(importance(docs, model, seed), "importance")
    return top_k(keyed, "key", int(np.ceil(share * keyed.count())))
