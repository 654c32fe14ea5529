"""Embedding whitening with a covariance by polarisation.

With y = n*x - S, the centred integers, one pass sums the exact squares of every y_i and of every pair sum
y_i + y_j.  Half the difference of those sums of squares is the cross product of i and j, so the whole
covariance comes from sums of squares alone.  Sums are integers of any size, kept as 60-bit parts on the way;
only the finished d x d matrix becomes doubles for ``eigh``.  The driver gets d*(d+1)/2 sums, never vectors.

Rows: a null vector, or one with a null or non-finite entry, is dropped.  The dimension is that of the longest
remaining vector; entries that a shorter one lacks count as 0.0.  Entries beyond 2**61 in size after scaling
are held there.  Repeated rows and ids repeat, null ids stay null, extra columns are not read; an empty table
(or one of empty vectors) gives no rows.  A direction without variance has whitened value 0.0, which leaves
``identity_error`` at 1.  ``deviation`` is null where it is beyond 64 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebook.session import settle

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
_EDGE = float(1 << 61)
_PART = 60
_LIMB = 21
_SLICE = 1 << 14
_SUMS = "i int, j int, part int, value long"


def _finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id and ``x``, the integer vector, of the rows that remain."""
    scaled = lambda c: F.greatest(F.least(c.cast("double") * SCALE, F.lit(_EDGE)), F.lit(-_EDGE))
    return vectors.where(F.col("embedding").isNotNull() & F.forall("embedding", _finite)).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda c: F.floor(scaled(c)) + F.lit(SHIFT).cast("long")).alias("x"),
    )


@dataclass(frozen=True)
class Fit:
    """Count, exact sums and a bound on the size of the centred integers."""

    n: int
    sums: tuple[int, ...]
    bound: int

    def centred(self, x: pa.ListArray) -> np.ndarray:
        """n*x - S, as 64-bit integers where they fit, else as Python integers."""
        sizes = np.diff(x.offsets.to_numpy())
        wide = np.full((len(x), len(self.sums)), SHIFT, np.int64)
        wide[np.arange(len(self.sums)) < sizes[:, None]] = x.flatten().to_numpy()
        if self.bound < 1 << 61:
            return wide * np.int64(self.n) - np.array(self.sums, np.int64)
        return wide.astype(object) * self.n - np.array(self.sums, object)


def fit_sums(rows: DataFrame) -> Fit:
    """One row a dimension reaches the driver."""
    size = F.abs(F.col("value").cast("decimal(20,0)"))
    found = (
        rows.select(F.posexplode_outer("x").alias("at", "value"))
        .groupBy("at")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(F.col("value").cast("decimal(20,0)")).alias("total"),
            F.max(size).alias("size"),
        )
        .collect()
    )
    n = sum(r["rows"] for r in found if not r["at"])
    held = {r["at"]: r for r in found if r["at"] is not None}
    sums = tuple(int(held[k]["total"]) + (n - held[k]["rows"]) * SHIFT for k in sorted(held))
    largest = max((int(r["size"]) for r in held.values()), default=0)
    return Fit(n, sums, n * max(largest, SHIFT) + max(map(abs, sums), default=0))


def squared(z: np.ndarray, bound: int) -> np.ndarray:
    """Exact sum of squares of each column; 64-bit columns are multiplied in parts of 21 bits."""
    if z.dtype == object:
        return (z * z).sum(axis=0) if len(z) else np.zeros(z.shape[1], object)
    parts, mask = [], (1 << _LIMB) - 1
    while bound >> _LIMB * (len(parts) + 1):
        parts.append(z & mask)
        z = z >> _LIMB
    parts.append(z)
    total = np.zeros(z.shape[1], object)
    for a, p in enumerate(parts):
        for b in range(a, len(parts)):
            product = np.einsum("rc,rc->c", p, parts[b]).astype(object)
            total += (product << _LIMB * (a + b)) * (1 if a == b else 2)
    return total


def square_sums(rows: DataFrame, fit: Fit) -> dict[tuple[int, int], int]:
    """Sums of squares of y_i under (i, i) and of y_i + y_j under (i, j), i < j."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(fit.sums)
        own = np.zeros(d, object)
        pairs = [np.zeros(d - i - 1, object) for i in range(d)]
        for batch in batches:
            for start in range(0, batch.num_rows, _SLICE):
                y = fit.centred(batch.column(0).slice(start, _SLICE))
                own += squared(y, fit.bound)
                for i in range(d - 1):
                    pairs[i] += squared(y[:, i : i + 1] + y[:, i + 1 :], 2 * fit.bound)
        out = []
        for i in range(d):
            for j, total in [(i, own[i]), *enumerate(pairs[i], start=i + 1)]:
                part = 0
                while total:
                    out.append((i, j, part, int(total & ((1 << _PART) - 1))))
                    total, part = total >> _PART, part + 1
        columns = list(zip(*out, strict=True)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, [pa.int32(), pa.int32(), pa.int32(), pa.int64()], strict=True)],
            ["i", "j", "part", "value"],
        )

    summed = rows.select("x").mapInArrow(run, _SUMS).groupBy("i", "j", "part").agg(
        F.sum(F.col("value").cast("decimal(38,0)")).alias("value")
    )
    out: dict[tuple[int, int], int] = {}
    for r in summed.collect():
        out[r["i"], r["j"]] = out.get((r["i"], r["j"]), 0) + (int(r["value"]) << _PART * r["part"])
    return out


def covariance(fit: Fit, squares: dict[tuple[int, int], int]) -> np.ndarray:
    """Covariance of x with divisor n; each entry is one correctly rounded quotient of integers."""
    d, scale = len(fit.sums), 2 * fit.n**3
    v = np.zeros((d, d))
    for i in range(d):
        own = squares.get((i, i), 0)
        v[i, i] = 2 * own / scale
        for j in range(i + 1, d):
            v[i, j] = v[j, i] = (squares.get((i, j), 0) - own - squares.get((j, j), 0)) / scale
    return v


@dataclass(frozen=True)
class Whitening:
    """``axes`` holds a unit eigenvector a column; ``scale`` is 1/sqrt(e), or 0 without variance."""

    fit: Fit
    axes: np.ndarray
    scale: np.ndarray
    explained: tuple[float, ...]


def fit_whitening(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of integer vectors; None without vectors or dimensions."""
    fit = fit_sums(rows)
    if not fit.sums:
        return None
    v = covariance(fit, square_sums(rows, fit))
    values, vectors = np.linalg.eigh(v)
    first = np.argsort(-values, kind="stable")[:components]
    e, trace = values[first], float(np.trace(v))
    real = e > trace * len(v) * np.finfo(float).eps
    scale = np.where(real, 1 / np.sqrt(np.where(real, e, 1.0)), 0.0)
    explained = tuple(float(x) / trace if trace else 0.0 for x in e)
    return Whitening(fit, vectors[:, first], scale, explained)


def whitened_vectors(rows: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation and the whitened coordinates ``w`` of every integer vector."""
    limit = (1 << 63) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit, k = model.fit, len(model.scale)
        for batch in batches:
            for start in range(0, batch.num_rows, _SLICE):
                part = batch.slice(start, _SLICE)
                y = fit.centred(part.column(1))
                exact = y if len(fit.sums) * fit.bound**2 <= limit else y.astype(object)
                away = [a if a <= limit else None for a in (exact * exact).sum(axis=1).tolist()]
                w = (y / fit.n).astype(np.float64) @ model.axes * model.scale
                offsets = pa.array(np.arange(0, k * len(w) + 1, k), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(away, pa.int64()), pa.ListArray.from_arrays(offsets, w.reshape(-1))],
                    ["vec_id", "deviation", "w"],
                )

    return rows.select("vec_id", "x").mapInArrow(run, "vec_id long, deviation long, w array<double>")


def identity_error(white: DataFrame, k: int) -> float:
    """Largest absolute entry of the covariance of ``w`` minus the identity."""
    pairs = [(a, b) for a in range(k) for b in range(a, k)]
    at = lambda a: F.get("w", F.lit(a))
    sums = white.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(at(a)).alias(f"s{a}") for a in range(k)],
        *[F.sum(at(a) * at(b)).alias(f"p{a}_{b}") for a, b in pairs],
    ).first()
    n = sums["n"]
    cov = lambda a, b: sums[f"p{a}_{b}"] / n - sums[f"s{a}"] / n * (sums[f"s{b}"] / n)
    return max(math.fabs(cov(a, b) - (a == b)) for a, b in pairs)


def whiten_embeddings(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row for each remaining vector and component: see the contract of the query."""
    rows = integer_vectors(vectors)
    model = fit_whitening(rows, components)
    if model is None:
        empty = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return vectors.sparkSession.createDataFrame([], empty)
    white = settle(whitened_vectors(rows, model), "whitened")
    error = identity_error(white, len(model.scale))
    return white.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.fit.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(F.array(*[F.lit(x) for x in model.explained]), F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
