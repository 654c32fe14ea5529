"""Order books that start from snapshots, as a stream: hold diffs, start, go live, break on a gap, wait again.

Each instrument is ``waiting`` (no snapshot yet), ``live`` or ``broken`` (an id was missed).  Diffs that come
while it is not live are held in blocks of state; a snapshot drops those it already covers and replays the rest
up to the next gap.  A live book restarts from a snapshot that is not behind it and ignores an older one.
Gaps of the arriving sequence go to a side output whatever the state.  Given snapshots no later than the
diffs that a live book has used, the result equals the batch form, however rows are cut into micro-batches.

Of a micro-batch, memory holds the snapshots of an instrument, one piece (an Arrow batch) of its diffs, one block
of held diffs and the book.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidebook.functions import levels as lv
from tidebook.functions import market
from tidebook.operators.book import Book, Side
from tidebook.operators.orderbook import QUOTE
from tidebook.schemas import BOOK_TICKER, DIFF, names
from tidebook.streaming.arrival import Arrival, in_order

WAITING, LIVE, BROKEN = "waiting", "live", "broken"
TICKER, GAP = "ticker", "gap"
_LEVELS = {"bid_px": "string", "bid_qty": "double", "ask_px": "string", "ask_qty": "double"}
_PLAIN = [c for c in names(DIFF) if c not in ("bids", "asks")]
_TIMES = [f.name for f in DIFF.fields if isinstance(f.dataType, T.TimestampType)]
# Times travel as microseconds: the state store gets plain numbers.
_FIELDS = [T.StructField(c, T.LongType() if c in _TIMES else DIFF[c].dataType) for c in _PLAIN]
_ARRAYS = [T.StructField(c, T.ArrayType(T.StringType() if t == "string" else T.DoubleType())) for c, t in _LEVELS.items()]
_HELD = T.StructType([*_FIELDS, *_ARRAYS, T.StructField("before_id", T.LongType())])
_META = "last_id long, status string, snapshot_id long, applied_id long, first_block long, end_block long"
_BLOCK = T.StructType([T.StructField("rows", T.ArrayType(_HELD))])
BLOCK_ROWS = 1000  # held diffs of a block
PIECE_ROWS = 10_000  # rows of an output frame
OUTPUT = T.StructType(
    [T.StructField("kind", T.StringType()), *_FIELDS]
    + [T.StructField(c, T.DoubleType()) for c in QUOTE]
    + [T.StructField(c, T.LongType()) for c in ("snapshot_id", "expected_update_id")]
    + [T.StructField("status", T.StringType())]
)
_AT = {c: i for i, c in enumerate(_HELD.names)}


class Held(list):
    """Diffs that wait, oldest first: blocks ``first`` to ``end`` of a map state, then the rows of the list itself.

    Without a state all are in the list.
    """

    def __init__(self, state=None, first: int = 0, end: int = 0):
        super().__init__()
        self.state, self.first, self.end = state, first, end

    def append(self, row: tuple) -> None:
        super().append(row)
        if self.state is not None and len(self) >= BLOCK_ROWS:
            self.store()

    def store(self) -> None:
        if self:
            self.state.updateValue((self.end,), (list(self),))
            self.end += 1
            self.clear()

    def drain(self) -> Iterator[tuple]:
        """All that wait now; a block leaves the state as it is read, and rows appended meanwhile stay."""
        blocks, rows = range(self.first, self.end), list(self)
        self.clear()
        self.first = self.end
        for block in blocks:
            (stored,) = self.state.getValue((block,))
            self.state.removeKey((block,))
            yield from map(tuple, stored)  # the state takes no Row back
        yield from rows


class Sync:
    """The state machine of one instrument.  Diffs are tuples in the order of ``_HELD``."""

    def __init__(
        self,
        depth: int,
        status: str = WAITING,
        snapshot_id: int | None = None,
        applied_id: int | None = None,
        held: Held | None = None,
    ):
        self.depth, self.status, self.snapshot_id, self.applied_id = depth, status, snapshot_id, applied_id
        self.book, self.held = Book(), Held() if held is None else held

    def diff(self, row: tuple) -> tuple | None:
        """The quote after a diff, or None when it was held, is covered by the snapshot, or a side is empty."""
        if self.status != LIVE:
            self.held.append(row)
            return None
        if row[_AT["last_update_id"]] <= self.snapshot_id:
            return None
        before = row[_AT["before_id"]]
        known = self.snapshot_id if before is None else max(before, self.snapshot_id)
        if row[_AT["first_update_id"]] > known + 1:
            self.status = BROKEN  # a live book holds nothing, or is just replaying what it held
            self.held.append(row)
            return None
        self.book.apply(*[row[_AT[c]] or () for c in _LEVELS])
        self.applied_id = row[_AT["last_update_id"]]
        return self.book.quote(self.depth)

    def snapshot(self, update_id: int, levels: list) -> Iterator[tuple[tuple, tuple]]:
        """Start from a full image; yields the held diffs that now have quotes."""
        if self.status == LIVE and update_id < self.applied_id:
            return
        self.book = Book()
        self.book.apply(*[part if part is not None else () for part in levels])
        self.status, self.snapshot_id, self.applied_id = LIVE, update_id, update_id
        for row in self.held.drain():
            quote = self.diff(row)
            if quote is not None:
                yield row, quote


class SyncedBookProcessor(StatefulProcessor):
    """Keeps status, held diffs and, level by level, the book of one instrument."""

    def __init__(self, depth: int = market.TOP_DEPTH):
        self.depth = depth

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.meta = handle.getValueState("meta", _META)
        self.waiting = handle.getMapState("held", "block long", _BLOCK)
        self.sides = [handle.getMapState(name, "price string", "qty double, age long") for name in ("bids", "asks")]

    def handleInputRows(self, key, rows, timerValues):
        """``synced_rows`` brings the snapshots first, by id, then the diffs in order of arrival."""
        out = []
        for row in self._results(rows):
            out.append(row)
            if len(out) == PIECE_ROWS:
                yield self._frame(out)
                out = []
        if out:
            yield self._frame(out)

    def _results(self, rows: Iterable[pd.DataFrame]) -> Iterator[tuple]:
        stored = self.meta.get() if self.meta.exists() else (None, WAITING, None, None, 0, 0)
        last_id, status, snapshot_id, applied_id, first, end = stored
        sync = Sync(self.depth, status, snapshot_id, applied_id, Held(self.waiting, first, end))
        before_levels = self._load(sync) if status == LIVE else [{}, {}]
        images, arrival = deque(), Arrival()
        for batch in rows:
            is_image = batch["is_snapshot"]
            images.extend(zip(*[batch.loc[is_image, c].tolist() for c in ("last_update_id", *_LEVELS)], strict=True))
            diffs = batch[~is_image]
            arrival.check(diffs)
            last_id, accepted = self._accepted(diffs, last_id)
            for row in accepted:
                # A snapshot follows the diff of its own id.
                while images and images[0][0] < row[_AT["last_update_id"]]:
                    yield from self._start(sync, images.popleft())
                quote = sync.diff(row)
                before = row[_AT["before_id"]]
                if before is not None and row[_AT["first_update_id"]] > before + 1:
                    yield (GAP, *row[: len(_PLAIN)], *[None] * len(QUOTE), None, before + 1, sync.status)
                if quote is not None:
                    yield self._ticker(row, quote, sync)
        while images:
            yield from self._start(sync, images.popleft())
        self._save(sync, before_levels, last_id)

    def _start(self, sync: Sync, image: tuple) -> Iterator[tuple]:
        update_id, *levels = image
        for row, quote in sync.snapshot(update_id, levels):
            yield self._ticker(row, quote, sync)

    @staticmethod
    def _frame(out: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(out, columns=OUTPUT.names).astype({c: "float64" for c in QUOTE}).astype(
            {c: "Int64" for c in ("snapshot_id", "expected_update_id")}
        )

    def close(self) -> None:
        pass

    @staticmethod
    def _ticker(row: tuple, quote: tuple, sync: Sync) -> tuple:
        return (TICKER, *row[: len(_PLAIN)], *quote, sync.snapshot_id, None, sync.status)

    @staticmethod
    def _accepted(diffs: pd.DataFrame, last_id: int | None) -> tuple[int | None, list[tuple]]:
        """Those of a piece whose ids rise, each with the id before it."""
        rows = []
        columns = [diffs[c].tolist() for c in (*_PLAIN, *_LEVELS)]
        for *plain, bid_px, bid_qty, ask_px, ask_qty in zip(*columns, strict=True):
            update_id = plain[_AT["last_update_id"]]
            if last_id is None or update_id > last_id:
                levels = [list(part) if part is not None else [] for part in (bid_px, bid_qty, ask_px, ask_qty)]
                rows.append((*plain, *levels, last_id))
                last_id = update_id
        return last_id, rows

    def _load(self, sync: Sync) -> list[dict]:
        """Fill the book from the state, oldest level first; returns what is stored."""
        found = []
        for state, side in zip(self.sides, (sync.book.bids, sync.book.asks), strict=True):
            levels = {price: (qty, age) for (price,), (qty, age) in state.iterator()}
            for price, (qty, age) in sorted(levels.items(), key=lambda kv: kv[1][1]):
                side.births = age - 1
                side.put(price, qty)
            found.append(levels)
        return found

    def _save(self, sync: Sync, before: list[dict], last_id: int | None) -> None:
        for state, side, old in zip(self.sides, (sync.book.bids, sync.book.asks), before, strict=True):
            write_levels(state, side if sync.status == LIVE else Side(side.sign), old)
        sync.held.store()
        self.meta.update((last_id, sync.status, sync.snapshot_id, sync.applied_id, sync.held.first, sync.held.end))


def write_levels(state, side: Side, old: dict[str, tuple[float, int]]) -> int:
    """Bring a side's stored levels up to date; returns how many were written or removed."""
    new = {price: (level[2], level[1]) for price, level in side.live.items()}
    changed = [price for price, level in new.items() if old.get(price) != level]
    gone = [price for price in old if price not in new]
    for price in changed:
        state.updateValue((price,), new[price])
    for price in gone:
        state.removeKey((price,))
    return len(changed) + len(gone)


def _inputs(rows: DataFrame, is_snapshot: bool) -> DataFrame:
    """Columns of the processor; what a snapshot lacks is 0 or null."""
    plain = []
    for field in _FIELDS:
        value = F.col(field.name) if field.name in rows.columns else F.lit(None)
        if field.name in _TIMES and field.name in rows.columns:
            value = F.unix_micros(value)
        value = value.cast(field.dataType)
        numeric = isinstance(field.dataType, (T.LongType, T.IntegerType))
        plain.append((F.coalesce(value, F.lit(0).cast(field.dataType)) if numeric else value).alias(field.name))
    sides = [("bids", "bid"), ("asks", "ask")]
    parts = [part for column, short in sides for part in (lv.prices(F.col(column)).alias(f"{short}_px"), lv.quantities(F.col(column)).alias(f"{short}_qty"))]
    return rows.select(*plain, *parts, F.lit(is_snapshot).alias("is_snapshot"))


def synced_rows(diffs: DataFrame, snapshots: DataFrame, depth: int = market.TOP_DEPTH) -> DataFrame:
    """Tickers and gaps of a stream of diffs and a stream of snapshots; see ``synced_tickers`` and ``gaps``.

    Start the query within ``arrival.local_sorts``.
    """
    both = _inputs(diffs, False).unionByName(_inputs(snapshots, True))
    order = [F.col("is_snapshot").desc(), *[F.col(c).asc() for c in ("kafka_partition", "kafka_offset", "last_update_id")]]
    rows = in_order(both, ["exchange", "symbol"], order).groupBy("exchange", "symbol").transformWithStateInPandas(
        statefulProcessor=SyncedBookProcessor(depth),
        outputStructType=OUTPUT,
        outputMode="Append",
        timeMode="None",
    )
    return rows.withColumns({c: F.timestamp_micros(c) for c in _TIMES})


def synced_tickers(rows: DataFrame) -> DataFrame:
    bid, ask = F.col("best_bid_price"), F.col("best_ask_price")
    whole = rows.where(F.col("kind") == TICKER).withColumns(
        {
            "spread": market.spread(bid, ask),
            "mid_price": market.mid_price(bid, ask),
            "imbalance": market.imbalance(F.col("bid_volume"), F.col("ask_volume")),
        }
    )
    return whole.select(*names(BOOK_TICKER), "snapshot_id")


def gaps(rows: DataFrame) -> DataFrame:
    """One row for each gap with ``status``, the state of the instrument after it."""
    expected = F.col("expected_update_id")
    return rows.where(F.col("kind") == GAP).select(
        "exchange",
        "symbol",
        "kafka_partition",
        "kafka_offset",
        expected,
        "first_update_id",
        "last_update_id",
        (F.col("first_update_id") - expected).alias("missing_ids"),
        "status",
    )
