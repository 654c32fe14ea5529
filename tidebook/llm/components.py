"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidebook.session import settle


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` (smallest node of its component) of every node in ``edges`` (a, b).

    Each round hangs every node below its smallest neighbour, follows those links to their ends and
    contracts the edges, so the nodes that remain at least halve.  Rounds are written to the shared
    folder; only one flag a round reaches the driver.
    """
    left = settle(edges.where("a <> b").select("a", "b").distinct(), "edges")
    labels = left.select(F.col("a").alias("node")).union(left.select("b")).distinct()
    labels = settle(labels.withColumn("label", F.col("node")), "labels")
    while not left.isEmpty():
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = both.groupBy("a").agg(F.min("b").alias("parent")).select(
            F.col("a").alias("node"), F.least("a", "parent").alias("parent")
        )
        parents = settle(parents, "parents")
        while True:
            up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
            jumped = settle(parents.join(up, "parent").select("node", "parent", "above"), "parents")
            moved = not jumped.where("parent <> above").isEmpty()
            parents = jumped.select("node", F.col("above").alias("parent"))
            if not moved:
                break
        labels = settle(
            labels.join(parents.withColumnRenamed("node", "label"), "label", "left").select(
                "node", F.coalesce("parent", "label").alias("label")
            ),
            "labels",
        )
        a, b = (parents.select(F.col("node").alias(c), F.col("parent").alias(f"{c}_up")) for c in "ab")
        left = settle(
            left.join(a, "a").join(b, "b").where("a_up <> b_up").select(
                F.least("a_up", "b_up").alias("a"), F.greatest("a_up", "b_up").alias("b")
            ).distinct(),
            "edges",
        )
    return labels
