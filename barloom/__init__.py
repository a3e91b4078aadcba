"""barloom: OHLCV bar panels on Spark - features, labels, model evaluation, backtests."""

from barloom.schema import BAR_SCHEMA, Layout

__all__ = ["BAR_SCHEMA", "Layout"]
