"""Depth diffs to book tickers in batch.

The book of an instrument is a long sequential state, but a level's value is simply its last
write.  So the rows of an instrument are cut into folds of about equal row counts, the state at the
start of every fold is computed with windows over per-fold level summaries, and the folds then run
independently - the hottest instrument is spread over as many tasks as it has folds, and a quiet one
is a single fold that carries nothing, however far its offsets reach.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebook.functions import levels as lv
from tidebook.functions import market
from tidebook.operators.blocks import BLOCK, BLOCK_SPAN, FOLD_ROWS, KEYS, fold_index, running, with_block
from tidebook.operators.book import Book
from tidebook.operators.sequence import deduped_blocks, is_late
from tidebook.schemas import BOOK_TICKER, names
from tidebook.session import settle

BID, ASK = 0, 1
QUOTE = [
    "best_bid_price",
    "best_bid_qty",
    "best_ask_price",
    "best_ask_qty",
    "bid_volume",
    "ask_volume",
]
_SLICE = 4096
_COARSE = 4096


def book_ticker(
    diffs: DataFrame,
    late_seconds: float | None = market.LATE_SECONDS,
    depth: int = market.TOP_DEPTH,
    span: int = BLOCK_SPAN,
    fold_rows: int = FOLD_ROWS,
) -> DataFrame:
    """One ticker per accepted, on-time diff once both sides of the book have a level."""
    kept = deduped_blocks(diffs, span, fold_rows)
    if late_seconds is not None:
        kept = kept.where(~is_late(late_seconds))
    place = F.col("_step") * F.lit(span) + F.col("kafka_offset") - F.col(BLOCK) * F.lit(span)
    kept = kept.withColumn("_pos", place).drop("_last_seen", BLOCK, "_step")
    return finish_ticker(fold_books(kept, KEYS, depth))


def finish_ticker(quotes: DataFrame) -> DataFrame:
    """Derived metrics of a quote, in the ticker schema."""
    bid, ask = F.col("best_bid_price"), F.col("best_ask_price")
    return (
        quotes.withColumn("spread", market.spread(bid, ask))
        .withColumn("mid_price", market.mid_price(bid, ask))
        .withColumn("imbalance", market.imbalance(F.col("bid_volume"), F.col("ask_volume")))
        .select(*names(BOOK_TICKER))
    )


def fold_books(diffs: DataFrame, keys: list[str], depth: int = market.TOP_DEPTH) -> DataFrame:
    """Fold ordered diffs into quotes.

    ``diffs`` is cut into groups ``keys`` and ``_ord``, the fold's place among the ``_folds`` of its key;
    ``_pos`` (below 2^39) orders a group.
    """
    carried = levels_at_start(diffs, keys)
    plain = [c for c in diffs.columns if c not in ("bids", "asks", "_ord", "_folds")]
    events = diffs.select(*plain, "_ord", F.flatten("bids").alias("_bids"), F.flatten("asks").alias("_asks"))
    schema = T.StructType(
        [diffs.schema[c] for c in plain] + [T.StructField(c, T.DoubleType()) for c in QUOTE]
    )
    group = [*keys, "_ord"]
    # Both sides come from the same rows, so the right one needs names of its own.
    renamed = carried.select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(group)],
        *[c for c in carried.columns if c not in group],
    )
    return (
        events.groupBy(*group)
        .cogroup(renamed.groupBy(*[f"_k{i}" for i in range(len(group))]))
        .applyInArrow(_folder(plain, depth), schema)
    )


def levels_at_start(diffs: DataFrame, keys: list[str]) -> DataFrame:
    """Levels alive when each fold starts: ``keys, _ord, _side, _px, _qty, _born_ord, _born_seq``."""
    # The last fold of a key hands nothing on; a key with one fold costs nothing here.
    sides = F.array(
        *[F.struct(F.lit(n).alias("_side"), F.col(c).alias("_levels")) for n, c in ((BID, "bids"), (ASK, "asks"))]
    )
    place = [*keys, "_ord", "_folds"]
    updates = (
        diffs.where(F.col("_ord") < F.col("_folds"))
        .select(*place, "_pos", F.inline(sides))
        .select(*place, "_side", "_pos", F.posexplode("_levels").alias("_idx", "_level"))
        .select(
            *place,
            "_side",
            F.col("_level")[0].alias("_px"),
            F.col("_level")[1].cast("double").alias("_qty"),
            (F.shiftleft("_pos", 24) + F.col("_idx")).alias("_seq"),
        )
    )
    # What a fold leaves behind per level: last quantity, whether it was deleted on the way,
    # and where its current life began.
    level = [*keys, "_ord", "_side", "_px"]
    previous = F.lag("_qty").over(Window.partitionBy(*level).orderBy("_seq"))
    born = (F.col("_qty") != 0) & (previous.isNull() | (previous == 0))
    left_behind = (
        updates.withColumn("_birth", F.when(born, F.col("_seq")))
        .groupBy(*level)
        .agg(
            F.max_by("_qty", "_seq").alias("_qty"),
            F.max((F.col("_qty") == 0).cast("int")).alias("_deleted"),
            F.max("_birth").alias("_birth"),
            F.max("_folds").alias("_folds"),
        )
    )
    history = Window.partitionBy(*keys, "_side", "_px").orderBy("_ord")
    alive = F.col("_qty") != 0
    starts = alive & ((F.col("_deleted") == 1) | ~F.coalesce(F.lag(alive).over(history), F.lit(False)))
    lives = (
        left_behind.select(
            *keys,
            "_side",
            "_px",
            "_qty",
            "_ord",
            "_birth",
            starts.alias("_starts"),
            (F.col("_ord") + 1).alias("_from"),
            F.coalesce(F.lead("_ord").over(history), F.col("_folds")).alias("_to"),
        )
        .withColumn("_born_ord", F.last(F.when(F.col("_starts"), F.col("_ord")), ignorenulls=True).over(history))
        .withColumn("_born_seq", F.last(F.when(F.col("_starts"), F.col("_birth")), ignorenulls=True).over(history))
        .where(alive & (F.col("_from") <= F.col("_to")))
    )
    # A level lives through the folds up to its next change.  Two steps keep the arrays short.
    coarse = lives.withColumn(
        "_c",
        F.explode(F.sequence(F.floor(F.col("_from") / _COARSE), F.floor(F.col("_to") / _COARSE))),
    )
    return coarse.select(
        *keys,
        "_side",
        "_px",
        "_qty",
        "_born_ord",
        "_born_seq",
        F.explode(
            F.sequence(
                F.greatest(F.col("_from"), F.col("_c") * _COARSE),
                F.least(F.col("_to"), F.col("_c") * _COARSE + (_COARSE - 1)),
            )
        ).alias("_ord"),
    )


def _folder(plain: list[str], depth: int):
    def fold(events: pa.Table, carried: pa.Table) -> pa.Table:
        book = Book()
        if carried.num_rows and events.num_rows:
            carried = carried.sort_by([("_born_ord", "ascending"), ("_born_seq", "ascending")])
            for side, price, qty in zip(
                carried["_side"].to_pylist(), carried["_px"].to_pylist(), carried["_qty"].to_pylist()
            ):
                (book.bids if side == BID else book.asks).put(price, qty)
        events = events.sort_by("_pos")
        rows, quotes = [], []
        for start in range(0, events.num_rows, _SLICE):
            part = events.slice(start, _SLICE)
            for offset, (bids, asks) in enumerate(zip(_updates(part["_bids"]), _updates(part["_asks"]))):
                book.apply(*bids, *asks)
                quote = book.quote(depth)
                if quote is not None:
                    rows.append(start + offset)
                    quotes.append(quote)
        out = events.select(plain).take(pa.array(rows, pa.int64()))
        by_column = list(zip(*quotes)) if quotes else [()] * len(QUOTE)
        for name, values in zip(QUOTE, by_column):
            out = out.append_column(name, pa.array(values, pa.float64()))
        return out

    return fold


def _updates(column: pa.ChunkedArray):
    """Per row the price texts and quantities of ``[price, qty, price, qty, ...]``, cut from flat buffers."""
    lists = column.chunk(0) if column.num_chunks == 1 else column.combine_chunks()
    ends = lists.offsets.to_numpy()
    ends = ((ends - ends[0]) // 2).tolist()
    flat = lists.flatten()
    texts = flat.take(pa.array(np.arange(0, len(flat), 2))).dictionary_encode()
    known = texts.dictionary.to_pylist()
    prices = [known[i] for i in texts.indices.to_numpy().tolist()]
    quantities = pc.cast(flat.take(pa.array(np.arange(1, len(flat), 2))), pa.float64()).to_numpy().tolist()
    for a, b in zip(ends, ends[1:]):
        yield prices[a:b], quantities[a:b]


def book_from_snapshots(
    snapshots: DataFrame,
    diffs: DataFrame,
    depth: int = market.TOP_DEPTH,
    span: int = BLOCK_SPAN,
    fold_rows: int = FOLD_ROWS,
) -> DataFrame:
    """Tickers of books started from full snapshots.

    Diffs at or below a snapshot's id are dropped, the rest apply in id order until the first
    gap; after a gap the book is unusable until the instrument's next snapshot.  Snapshots
    themselves emit no ticker.  Adds ``snapshot_id``, the snapshot the book started from.
    """
    keys = [*KEYS, "snapshot_id"]
    sessions = settle(_sessions(snapshots, diffs, span), "sessions")
    rows = sessions.join(fold_index(sessions, keys, [BLOCK], fold_rows), [*keys, BLOCK])
    rows = rows.withColumn("_pos", F.col("_step") * F.lit(2 * span) + F.col("_pos")).drop(BLOCK, "_step")
    folded = fold_books(rows, keys, depth).where(~F.col("_is_snapshot"))
    ticker = folded.select(
        "*",
        market.spread(F.col("best_bid_price"), F.col("best_ask_price")).alias("spread"),
        market.mid_price(F.col("best_bid_price"), F.col("best_ask_price")).alias("mid_price"),
        market.imbalance(F.col("bid_volume"), F.col("ask_volume")).alias("imbalance"),
    )
    return ticker.select(*names(BOOK_TICKER), "snapshot_id")


def _sessions(snapshots: DataFrame, diffs: DataFrame, span: int) -> DataFrame:
    """Snapshots and the diffs usable after them, with ``snapshot_id``, ``_block`` and ``_pos``."""
    kept = deduped_blocks(diffs, span).drop(BLOCK)
    starts = snapshots.withColumns(
        {
            "first_update_id": F.col("last_update_id"),
            "_last_seen": F.lit(None).cast("long"),
            "_is_snapshot": F.lit(True),
        }
    )
    both = kept.withColumn("_is_snapshot", F.lit(False)).unionByName(starts, allowMissingColumns=True)
    # Offsets no longer matter: ids are unique and rising, so they order and cut the sequence.
    # Every step below reads its input twice, so the input is written once.
    both = settle(with_block(both, "last_update_id", span), "sequence")
    lane, order = [BLOCK], ["last_update_id", "_is_snapshot"]
    snapshot_id = {"snapshot_id": ("max", F.when(F.col("_is_snapshot"), F.col("last_update_id")))}
    both = running(both, snapshot_id, KEYS, lane, order, inclusive=True)
    # The id before a diff is the last accepted diff's or the snapshot's, whichever is higher.
    before = F.greatest("_last_seen", "snapshot_id")
    gap = ~F.col("_is_snapshot") & (F.col("first_update_id") > before + 1)
    gap_id = {"_gap_id": ("max", F.when(gap, F.col("last_update_id")))}
    both = running(both, gap_id, KEYS, lane, order, inclusive=True)
    usable = F.col("snapshot_id").isNotNull() & (
        F.col("_gap_id").isNull() | (F.col("_gap_id") <= F.col("snapshot_id"))
    )
    # A snapshot shares its id with at most one diff, hence the factor two.
    position = (F.col("last_update_id") - F.col(BLOCK) * F.lit(span)) * 2 + F.col("_is_snapshot").cast("long")
    return both.where(usable).withColumn("_pos", position).drop("_last_seen", "_gap_id")


def image_metrics(snapshots: DataFrame, depth: int = market.TOP_DEPTH) -> DataFrame:
    """Best levels, top volumes and imbalance of full book images, without any state."""
    tops = snapshots.withColumn("_bids", lv.top_levels(F.col("bids"), "bid", depth)).withColumn(
        "_asks", lv.top_levels(F.col("asks"), "ask", depth)
    )
    bid_volume, ask_volume = lv.volume(F.col("_bids")), lv.volume(F.col("_asks"))
    return tops.select(
        *[c for c in snapshots.columns if c not in ("bids", "asks")],
        lv.best(F.col("_bids"))["price"].alias("best_bid_price"),
        lv.best(F.col("_bids"))["qty"].alias("best_bid_qty"),
        lv.best(F.col("_asks"))["price"].alias("best_ask_price"),
        lv.best(F.col("_asks"))["qty"].alias("best_ask_qty"),
        bid_volume.alias("bid_volume"),
        ask_volume.alias("ask_volume"),
        market.imbalance(bid_volume, ask_volume).alias("imbalance"),
    )
