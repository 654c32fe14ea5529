"""Micro-batches in order of arrival, so that a stateful processor takes an instrument in pieces of any number."""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_CHECK = "spark.sql.streaming.unsupportedOperationCheck"


def in_order(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Rows of each key together, sorted within the micro-batch; Spark sorts on disk where memory is short.

    The keys pass a one-row generator: a key that the optimizer knows as a constant leaves the sort order, and
    the stateful operator would then sort once more, by the keys only.
    """
    rest = [c for c in rows.columns if c not in keys]
    whole = rows.select(F.inline(F.array(F.struct(*keys))), *rest)
    return whole.repartition(*keys).sortWithinPartitions(*keys, *order)


@contextmanager
def local_sorts(spark: SparkSession):
    """Lets a stream start that sorts within its partitions.

    Spark's check of streaming plans refuses every sort, although one within the partitions of a micro-batch
    needs no row of another.  The setting is read when the query starts.
    """
    before = spark.conf.get(_CHECK, "true")
    spark.conf.set(_CHECK, "false")
    try:
        yield
    finally:
        spark.conf.set(_CHECK, before)


class Arrival:
    """Checks that the pieces of one key come in order; a fold over unordered rows would drop some as old."""

    def __init__(self):
        self.last = None

    def check(self, rows: pd.DataFrame) -> None:
        at = rows[["kafka_partition", "kafka_offset"]].astype("float64").fillna(np.inf).to_numpy()
        if self.last is not None:
            at = np.vstack([self.last, at])
        (partition, offset), (partition_after, offset_after) = at[:-1].T, at[1:].T
        if ((partition > partition_after) | ((partition == partition_after) & (offset > offset_after))).any():
            raise RuntimeError("rows of an instrument did not come in order of arrival")
        self.last = at[-1:]
