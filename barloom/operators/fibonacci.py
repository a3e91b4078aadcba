"""Retracement levels of the trailing high-low range."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions import long_extreme, ratio
from barloom.operators.panel import block_window
from barloom.operators.step import Step
from barloom.schema import FIB_INNER, FIB_NAMES, FIB_RATIOS


def fibonacci(window: int = 100, anchor: str = "high") -> Step:
    """Range, levels, distances to the inner levels and the position of the close in the range.

    The position is measured from the rolling high (values in [-1, 0]) or from the low ([0, 1]).
    """
    if anchor not in ("high", "low"):
        raise ValueError("anchor is 'high' or 'low'")

    def stages(framed: DataFrame):
        order = block_window(framed)
        first_high, rolling_high = long_extreme(order, "high", "max", window)
        first_low, rolling_low = long_extreme(order, "low", "min", window)
        high, low, width = F.col("rolling_high"), F.col("rolling_low"), F.col("price_range")
        close = F.col("close")
        return [
            {**first_high, **first_low},
            {"rolling_high": rolling_high, "rolling_low": rolling_low},
            {"price_range": high - low},
            {n: high - r * width for n, r in zip(FIB_NAMES, FIB_RATIOS)},
            {
                **{f"dist_to_{n}": ratio(close - F.col(n), width) for n in FIB_INNER},
                "fib_position": ratio(close - F.col(f"rolling_{anchor}"), width),
            },
        ]

    return Step(stages, back=window)
