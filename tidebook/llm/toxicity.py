"""Toxicity: a factorization machine over hashed terms learns weights of terms and of their pairs."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebook.llm.common import bounded_batches, hash_sample, whole_text
from tidebook.session import settle

SAMPLE_ROWS = 10_000
FACTORS = 4
EPOCHS = 10
MIN_STEPS = 800
MIN_ROWS = 3
# Terms of a smaller class log-ratio take part with values that don't depend on it.
STRONG_RATIO = 0.7
PREFIXES = (4, 5)


@dataclass(frozen=True)
class Machine:
    """Terms by ascending hash, the weight and the factors of each, and the bias."""

    keys: np.ndarray
    linear: np.ndarray
    factors: np.ndarray
    bias: float

    def score(self, terms: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        """Probabilities of ``rows`` texts; ``terms`` are all their term hashes, ``row`` tells whose they are."""
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, terms), len(self.keys) - 1)
            known = self.keys[at] == terms
            at, row = at[known], row[known]
        else:
            at = row = np.zeros(0, dtype=np.int64)
        total = np.bincount(row, self.linear[at], rows) + self.bias
        for f in range(self.factors.shape[1]):
            v = self.factors[at, f]
            total += 0.5 * (np.bincount(row, v, rows) ** 2 - np.bincount(row, v * v, rows))
        return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def held_out(doc_id: Column) -> Column:
    """Rows that labels are never learned from; a row without an id is one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def terms(text: Column) -> Column:
    """Distinct 64-bit hashes of a text's lower-case words and of their first 4 and 5 characters."""
    tokens = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), lambda w: w != "")
    hashed = F.transform(
        tokens,
        lambda w: F.array(
            F.xxhash64(w, F.lit(0)), *[F.xxhash64(F.substring(w, 1, n), F.lit(n)) for n in PREFIXES]
        ),
    )
    return F.array_distinct(F.flatten(hashed))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, ``terms`` and ``toxic`` of about ``sample`` labelled rows at most, chosen by the hash of their id.

    A document that is labelled more than once counts as toxic if any label says so.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    chosen = hash_sample(known, F.col("doc_id"), sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(F.col("text")).alias("text"))
    # At most about `sample` pairs of numbers.
    return texts.join(F.broadcast(chosen), "doc_id").select("doc_id", terms(F.col("text")).alias("terms"), "toxic")


def train(rows: pd.DataFrame, factors: int = FACTORS, epochs: int = EPOCHS, seed: int = 7) -> Machine:
    """Fit a machine by adaptive gradient steps on the logistic loss, at least ``MIN_STEPS`` of 256 rows.

    All terms of at least ``MIN_ROWS`` rows take part.  A term's value is its class log-ratio or, if that
    is below ``STRONG_RATIO``, the spread of its presence over the rows (half of it in the sum of single
    terms, whose weight starts at zero), so pairs of terms that tell nothing alone are learned too.
    Without both classes the machine is the smoothed share of toxic rows.
    """
    y = rows["toxic"].to_numpy(np.float64)
    positive, n = y.sum(), len(y)
    bias = float(np.log((positive + 1) / (n - positive + 1)))
    if positive in (0, n):
        return Machine(np.zeros(0, np.int64), np.zeros(0), np.zeros((0, factors)), bias)
    sizes, flat = [len(t) for t in rows["terms"]], np.concatenate([np.asarray(t, dtype=np.int64) for t in rows["terms"]])
    del rows  # the driver holds each list of terms once
    row = np.repeat(np.arange(n, dtype=np.int32), sizes)
    keys = np.unique(flat)
    at = np.concatenate([np.searchsorted(keys, part).astype(np.int32) for part in np.array_split(flat, 64)])
    del flat
    seen, toxic = np.bincount(at, minlength=len(keys)), np.bincount(at[y[row] == 1], minlength=len(keys))
    ratio = np.log((toxic + 0.5) / (positive + 1)) - np.log((seen - toxic + 0.5) / (n - positive + 1))
    useful = seen >= MIN_ROWS
    position = (np.cumsum(useful) - 1).astype(np.int32)
    row, at = row[useful[at]], position[at[useful[at]]]
    keys, ratio, seen = keys[useful], ratio[useful], seen[useful]
    share, strong = seen / (n + 1), np.abs(ratio) >= STRONG_RATIO
    spread = 2 * np.sqrt(share * (1 - share))
    x_of, pair_of = np.where(strong, ratio, 0.5 * spread), np.where(strong, ratio, spread)
    starts = np.searchsorted(row, np.arange(n + 1))

    rng = np.random.default_rng(seed)
    w, v = np.where(strong, 0.1, 0.0), rng.normal(0, 0.02, (len(keys), factors))
    gw, gv, gb = np.full(len(keys), 1e-2), np.full(v.shape, 1e-2), 1e-2
    for _ in range(max(epochs, MIN_STEPS * 256 // n)):
        order = rng.permutation(n)
        for batch in np.array_split(order, max(1, n // 256)):
            parts = [np.arange(starts[i], starts[i + 1]) for i in batch]
            mine, j = np.repeat(np.arange(len(batch)), [len(p) for p in parts]), at[np.concatenate(parts)]
            x, pair, b = x_of[j], pair_of[j], len(batch)
            vx = v[j] * pair[:, None]
            q = np.stack([np.bincount(mine, vx[:, f], b) for f in range(factors)], axis=1)
            square = np.bincount(mine, (vx * vx).sum(axis=1), b)
            z = bias + np.bincount(mine, w[j] * x, b) + 0.5 * ((q * q).sum(axis=1) - square)
            g = 1 / (1 + np.exp(-np.clip(z, -35, 35))) - y[batch]
            touched, inverse = np.unique(j, return_inverse=True)
            dw = np.bincount(inverse, g[mine] * x, len(touched)) / b + 1e-5 * w[touched]
            dv = np.stack(
                [
                    np.bincount(inverse, g[mine] * pair * (q[mine, f] - vx[:, f]), len(touched)) / b
                    for f in range(factors)
                ],
                axis=1,
            ) + 1e-4 * v[touched]
            db = g.mean()
            gw[touched] += dw * dw
            gv[touched] += dv * dv
            gb += db * db
            w[touched] -= 0.1 * dw / np.sqrt(gw[touched])
            v[touched] -= 0.02 * dv / np.sqrt(gv[touched])
            bias -= 0.1 * db / np.sqrt(gb)
    return Machine(keys, w * x_of, v * pair_of[:, None], float(bias))


def _training_frame(batches: Iterator[pa.RecordBatch]) -> pd.DataFrame:
    """``toxic`` and ``terms``; the lists are views of the batches, no Python numbers."""
    lists, toxic = [], []
    for batch in batches:
        held = batch.column("terms")
        values, ends = held.values.to_numpy(zero_copy_only=False), held.offsets.to_numpy()
        lists += [values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        toxic += batch.column("toxic").to_pylist()
    return pd.DataFrame({"toxic": pd.Series(toxic, dtype="int32"), "terms": pd.Series(lists, dtype=object)})


def _learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The machine as rows: a key with its weight and factors, and the bias as the weight of a row without key."""
    machine = train(_training_frame(batches))
    n = len(machine.keys)
    keys = pa.array(np.append(machine.keys, 0), pa.int64(), mask=np.arange(n + 1) == n)
    linear = np.append(machine.linear, machine.bias)
    factors = pa.array(np.append(machine.factors, np.zeros((1, machine.factors.shape[1])), axis=0).ravel())
    starts = np.arange(n + 2, dtype=np.int32) * machine.factors.shape[1]
    yield pa.RecordBatch.from_arrays(
        [keys, pa.array(linear), pa.ListArray.from_arrays(pa.array(starts), factors)], ["key", "linear", "factors"]
    )


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> Machine:
    """Train on a bounded sample of labelled rows.

    Spark counts the sample's terms; one task gets its rows with those terms only that ``train`` uses.  The
    driver gets the machine alone, so that its memory does not hold the sample.
    """
    rows = training_rows(docs, labels, sample).withColumn("row", F.monotonically_increasing_id())
    rows = settle(rows, "training")
    each = rows.select("row", "toxic", F.explode("terms").alias("term"))
    useful = each.groupBy("term").agg(F.count(F.lit(1)).alias("seen")).where(F.col("seen") >= MIN_ROWS)
    kept = each.join(useful.select("term"), "term", "left_semi").groupBy("row").agg(
        F.sort_array(F.collect_set("term")).alias("terms")
    )
    none = F.expr("cast(array() as array<bigint>)")
    chosen = rows.select("row", "doc_id", "toxic").join(kept, "row", "left")
    chosen = chosen.select("doc_id", "row", "toxic", F.coalesce("terms", none).alias("terms"))
    # At most about `sample` rows; their order decides the steps of the training.
    ordered = chosen.repartition(1).sortWithinPartitions("doc_id", "row").select("toxic", "terms")
    got = ordered.mapInArrow(_learned, "key long, linear double, factors array<double>").toArrow()
    if not got.num_rows:  # no task ran
        return train(_training_frame(iter(())))
    known, weights = got["key"].is_valid().to_numpy(), got["linear"].to_numpy()
    factors = got["factors"].combine_chunks().flatten().to_numpy().reshape(got.num_rows, -1)
    return Machine(got["key"].drop_null().to_numpy(), weights[known], factors[known], float(weights[~known][0]))


def with_score(docs: DataFrame, machine: Machine) -> DataFrame:
    """Adds ``_score`` to rows that have ``text``; only hashed terms go to Python, other columns stay."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    @F.pandas_udf("double")
    def score(hashed: pd.Series) -> pd.Series:
        lists = hashed.tolist()
        sizes = [len(t) for t in lists]
        flat = np.concatenate(lists).astype(np.int64) if sum(sizes) else np.zeros(0, np.int64)
        return pd.Series(shared.value.score(flat, np.repeat(np.arange(len(lists)), sizes), len(lists)))

    return docs.withColumn("_terms", terms(whole_text(F.col("text")))).withColumn("_score", score("_terms")).drop("_terms")


def score_documents(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, held_out, score and predicted of every row, whole texts.

    A null or empty text has no terms and scores by the bias; a null id stays null and counts as held
    out; repeated rows score alike; other columns are not read; an empty table gives no rows.
    """
    scored = with_score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), machine)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= 0.5).cast("int").alias("predicted"),
    )
