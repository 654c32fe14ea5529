"""One side of an order book, and the fold that turns ordered diffs into best prices.

Small state helper used inside tasks by the batch fold and by the streaming processor.
"""

from __future__ import annotations

from bisect import bisect_left, insort


class Side:
    """Live levels of one side, kept sorted from the best price outward.

    A level is identified by its price text.  Equal prices under different texts rank by age:
    overwriting keeps a level's age, deleting and re-adding makes it the youngest.
    """

    __slots__ = ("sign", "live", "ranked", "births")

    def __init__(self, sign: float):
        self.sign = sign
        self.live: dict[str, list] = {}
        self.ranked: list[list] = []
        self.births = 0

    def put(self, price: str, qty: float) -> None:
        level = self.live.get(price)
        if qty == 0.0:
            if level is not None:
                del self.live[price]
                del self.ranked[bisect_left(self.ranked, level)]
        elif level is not None:
            level[2] = qty
        else:
            self.births += 1
            level = [self.sign * float(price), self.births, qty]
            self.live[price] = level
            insort(self.ranked, level)

    def put_all(self, prices, quantities) -> None:
        for price, qty in zip(prices, quantities):
            self.put(price, qty)

    def best(self) -> tuple[float, float]:
        rank, _, qty = self.ranked[0]
        return self.sign * rank, qty

    def volume(self, depth: int) -> float:
        return sum([level[2] for level in self.ranked[:depth]])

    def by_age(self) -> list[tuple[str, float]]:
        """Levels oldest first: putting them in this order into a new side restores the state."""
        return [(p, level[2]) for p, level in sorted(self.live.items(), key=lambda kv: kv[1][1])]


class Book:
    __slots__ = ("bids", "asks")

    def __init__(self):
        self.bids = Side(-1.0)
        self.asks = Side(1.0)

    def apply(self, bid_prices, bid_qtys, ask_prices, ask_qtys) -> None:
        self.bids.put_all(bid_prices, bid_qtys)
        self.asks.put_all(ask_prices, ask_qtys)

    def quote(self, depth: int) -> tuple | None:
        """Best bid, best ask and top volumes, or ``None`` while a side is empty."""
        if not self.bids.ranked or not self.asks.ranked:
            return None
        return (*self.bids.best(), *self.asks.best(), self.bids.volume(depth), self.asks.volume(depth))
