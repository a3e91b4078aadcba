"""Market-structure flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions import flag, full, long_extreme, prior, trailing
from barloom.operators.panel import block_window
from barloom.operators.step import Step


def _extremes(frame, k: int):
    """Highest high and lowest low of a frame that must hold k bars."""
    return full(F.max("high").over(frame), "high", frame, k), full(F.min("low").over(frame), "low", frame, k)


def swings(half: int = 5) -> Step:
    """Extremes of a centred window. Looks ``half`` bars ahead, so never a model input."""

    def stages(framed: DataFrame):
        top, bottom = _extremes(block_window(framed).rowsBetween(-half, half), 2 * half + 1)
        return [{"swing_high": flag(F.col("high") == top), "swing_low": flag(F.col("low") == bottom)}]

    return Step(stages, back=half, ahead=half)


def trend_flags(k: int = 10) -> Step:
    """Highs and lows against the extremes of the k bars before; a reversal (change of character)
    is a higher high right after a lower low, or the other way round."""

    def stages(framed: DataFrame):
        order = block_window(framed)
        high, low = F.col("high"), F.col("low")
        top, bottom = _extremes(prior(order, k), k)
        rose, fell = (F.lag(c, 1, 0).over(order) == 1 for c in ("higher_high", "lower_low"))
        rises, falls = (F.col(c) == 1 for c in ("higher_high", "lower_low"))
        return [
            {
                "higher_high": flag(high > top),
                "lower_low": flag(low < bottom),
                "higher_low": flag(low > bottom),
                "lower_high": flag(high < top),
            },
            {"choch": flag((rose & falls) | (fell & rises))},
        ]

    return Step(stages, back=k + 1)


def breaks(k: int = 20) -> Step:
    """Break of structure: the close leaves the range of k bars that ends two bars earlier."""

    def stages(framed: DataFrame):
        top, bottom = _extremes(prior(block_window(framed), k, skip=1), k)
        close = F.col("close")
        return [{"bos_bullish": flag(close > top), "bos_bearish": flag(close < bottom)}]

    return Step(stages, back=k + 1)


def liquidity(window: int = 50, near: float = 0.005) -> Step:
    """Support and resistance, closeness to them, and sweeps through the previous level."""

    def stages(framed: DataFrame):
        order = block_window(framed)
        first_high, highest = long_extreme(order, "high", "max", window)
        first_low, lowest = long_extreme(order, "low", "min", window)
        close, resistance, support = F.col("close"), F.col("_resistance"), F.col("_support")
        return [
            {**first_high, **first_low},
            {
                "resistance_level": highest,
                "support_level": lowest,
                "_resistance": long_extreme(order, "high", "max", window, skip=1)[1],
                "_support": long_extreme(order, "low", "min", window, skip=1)[1],
            },
            {
                "near_resistance": flag(close > F.col("resistance_level") * (1 - near)),
                "near_support": flag(close < F.col("support_level") * (1 + near)),
                "liquidity_sweep_up": flag((F.col("high") > resistance) & (close < resistance)),
                "liquidity_sweep_down": flag((F.col("low") < support) & (close > support)),
            },
        ]

    return Step(stages, back=window)


def order_blocks(share: float = 0.5, window: int | None = None) -> Step:
    """Candles whose body exceeds a share of the deviation of the close.

    By default the deviation is that of the whole series, which includes later bars; a ``window``
    takes the trailing one instead.
    """

    def stages(framed: DataFrame):
        body, large = F.col("close") - F.col("open"), F.col("_large_body")
        if window is None:
            deviation = F.col("_close_std")
        else:
            deviation = F.stddev_samp("close").over(trailing(block_window(framed), window))
        return [
            {"_large_body": deviation * share},
            {
                "bullish_ob": flag((body > 0) & (body > large)),
                "bearish_ob": flag((body < 0) & (-body > large)),
            },
        ]

    if window is None:
        return Step(stages, series=("close_std",))
    return Step(stages, back=window - 1)


def fair_value_gaps() -> Step:
    def stages(framed: DataFrame):
        order = block_window(framed)
        return [
            {
                "fvg_bullish": flag(F.col("low") > F.lag("high", 2).over(order)),
                "fvg_bearish": flag(F.col("high") < F.lag("low", 2).over(order)),
            }
        ]

    return Step(stages, back=2)
