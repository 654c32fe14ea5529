"""Order-book market data on Spark: depth diffs, tickers, bars, marts, replay and quality."""

__version__ = "0.1.0"
