"""Latest row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` per key.

    Ranked and limited to one row inside each task before the shuffle (window group limit),
    so what moves is one row per key and task however skewed the keys are.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rn", F.row_number().over(newest)).where(F.col("_rn") == 1).drop("_rn")
