"""Running values along a long ordered group without putting the group in one task.

An instrument may own a third of all rows, so a window over the whole key would run
in one task.  The key's sequence is cut into blocks instead:

1. one partial aggregate per (key, block), combined on the map side;
2. a running aggregate over the block summaries - one small row per block;
3. a window inside each (key, block), shifted by the carry of step 2.

A block covers a fixed span of offsets (or update ids).  Offsets are unique in a topic
partition, so no group is larger than the span whatever the skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Offsets per block: bounds the rows of a task group.
BLOCK_SPAN = 65_536
# Rows after which a fold of consecutive blocks is closed.  A fold has fewer than this and one block's rows; a key
# has at most one fold for so many rows, so what folds hand on grows with rows, not with offsets.
FOLD_ROWS = 65_536

KEYS = ["exchange", "symbol"]
BLOCK = "_block"

_COMBINE = {"max": F.max, "min": F.min, "sum": F.sum}


def with_block(df: DataFrame, sequence: str, span: int = BLOCK_SPAN) -> DataFrame:
    return df.withColumn(BLOCK, F.expr(f"`{sequence}` div {span}L"))


def _merge(how: str, carry: Column, inside: Column) -> Column:
    if how == "max":
        return F.greatest(carry, inside)
    if how == "min":
        return F.least(carry, inside)
    return F.coalesce(carry, F.lit(0)) + F.coalesce(inside, F.lit(0))


def running(
    df: DataFrame,
    values: dict[str, tuple[str, Column]],
    keys: list[str],
    lane: list[str],
    order: list[str],
    inclusive: bool = False,
    folds: int | None = None,
) -> DataFrame:
    """Add, per row, aggregates of the rows before it in its key (``inclusive``: up to it).

    ``values`` maps an output column to ``("max"|"min"|"sum", expression)``.  ``lane`` are the
    columns that order the blocks of a key, the last one being the block number; ``order``
    orders rows inside a block.  ``folds``, a number of rows, also adds the columns of ``with_folds``.
    """
    summary = df.groupBy(*keys, *lane).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[_COMBINE[how](expr).alias(f"_c_{name}") for name, (how, expr) in values.items()],
    )
    if folds:
        summary = with_folds(summary, keys, lane, folds)
    per_key = Window.partitionBy(*keys).orderBy(*lane)
    before = per_key.rowsBetween(Window.unboundedPreceding, -1)
    position = FOLD if folds else []
    carry = summary.select(
        *keys,
        *lane,
        *[_COMBINE[how](F.col(f"_c_{name}")).over(before).alias(f"_c_{name}") for name, (how, _) in values.items()],
        *position,
    )
    inside = (
        Window.partitionBy(*keys, *lane)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    )
    joined = df.join(carry, [*keys, *lane])
    return joined.select(
        *df.columns,
        *[
            _merge(how, F.col(f"_c_{name}"), _COMBINE[how](expr).over(inside)).alias(name)
            for name, (how, expr) in values.items()
        ],
        *position,
    )


# Number of the fold in its key (from 1), number of folds of the key, number of the block in its fold (from 0).
FOLD = ["_ord", "_folds", "_step"]


def with_folds(summary: DataFrame, keys: list[str], lane: list[str], rows: int = FOLD_ROWS) -> DataFrame:
    """Block summaries (with ``_rows``) with ``FOLD``: consecutive blocks until they hold ``rows`` rows.

    Windows run over one row a block.
    """
    per_key = Window.partitionBy(*keys)
    ordered = per_key.orderBy(*lane)
    before = F.coalesce(F.sum("_rows").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = summary.withColumn("_cut", F.floor(before / F.lit(rows)))
    placed = cut.withColumns(
        {
            "_ord": F.dense_rank().over(per_key.orderBy("_cut")).cast("long"),
            "_step": F.row_number().over(Window.partitionBy(*keys, "_cut").orderBy(*lane)).cast("long") - 1,
        }
    )
    return placed.withColumn("_folds", F.max("_ord").over(per_key)).drop("_cut")


def fold_index(df: DataFrame, keys: list[str], lane: list[str], rows: int = FOLD_ROWS) -> DataFrame:
    """The blocks of every key with ``FOLD``; reads only the key columns."""
    summary = df.groupBy(*keys, *lane).agg(F.count(F.lit(1)).alias("_rows"))
    return with_folds(summary, keys, lane, rows).drop("_rows")
