"""Native array expressions over ``[[price, qty], ...]`` levels of one row.

For full book images (snapshots).  Price and quantity are text on the wire and
become numbers here; ties in price keep list order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidebook.functions.market import TOP_DEPTH, imbalance


_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def well_formed(levels: Column) -> Column:
    """True when every level is a pair of numbers, or the list is absent."""
    return F.coalesce(
        F.forall(
            levels,
            lambda x: F.coalesce(
                (F.size(x) == 2) & x.getItem(0).rlike(_NUMBER) & x.getItem(1).rlike(_NUMBER),
                F.lit(False),
            ),
        ),
        F.lit(True),
    )


def prices(levels: Column) -> Column:
    """Price texts in list order."""
    return F.transform(_present(levels), lambda x: F.element_at(x, 1))


def quantities(levels: Column) -> Column:
    return F.transform(_present(levels), lambda x: F.element_at(x, 2).cast("double"))


def top_levels(levels: Column, side: str, depth: int = TOP_DEPTH) -> Column:
    """Best ``depth`` live levels: highest bids or lowest asks, as ``array<struct<rank,pos,price,qty>>``."""
    sign = -1.0 if side == "bid" else 1.0
    typed = F.transform(
        _present(levels),
        lambda x, i: F.struct(
            (F.element_at(x, 1).cast("double") * F.lit(sign)).alias("rank"),
            i.alias("pos"),
            F.element_at(x, 1).cast("double").alias("price"),
            F.element_at(x, 2).cast("double").alias("qty"),
        ),
    )
    return F.slice(F.array_sort(F.filter(typed, lambda x: x["qty"] != 0)), 1, depth)


def volume(top: Column) -> Column:
    return F.aggregate(top, F.lit(0.0), lambda acc, x: acc + x["qty"])


def best(top: Column) -> Column:
    """First of the sorted levels, or null when the side is empty."""
    return F.try_element_at(top, F.lit(1))


def _present(levels: Column) -> Column:
    return F.coalesce(levels, F.array().cast("array<array<string>>"))
