"""Trend, momentum and volatility indicators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions import EPSILON, change, flag, long_mean, ratio, trailing
from barloom.operators.panel import block_window, ewm, warm_up
from barloom.operators.step import Step
from barloom.schema import AVERAGE_SPANS, MOMENTUM_LAGS


def _means(framed: DataFrame, periods: Sequence[int]) -> list[dict[str, Column]]:
    order = block_window(framed)
    first, means = {}, {}
    for k in periods:
        parts, mean = long_mean(order, "close", k)
        first |= parts
        means[f"sma_{k}"] = mean
    return [first, means]


def sma(periods: Sequence[int] = AVERAGE_SPANS) -> Step:
    return Step(lambda framed: _means(framed, periods), back=max(periods))


def ema(spans: Sequence[float] = AVERAGE_SPANS) -> Step:
    def stages(framed: DataFrame):
        local, final = {}, {}
        for span in spans:
            first, average = ewm(framed, f"ema_{span}", F.col("close"), span)
            local |= first
            final[f"ema_{span}"] = average
        return [local, final]

    return Step(stages, back=warm_up(max(spans)), spans=tuple(spans))


def average_flags() -> Step:
    """Close above its mean, and shorter mean above longer mean (a state, not the crossing)."""

    def stages(framed: DataFrame):
        return [
            *_means(framed, (10, 20, 50)),
            {
                "price_above_sma20": flag(F.col("close") > F.col("sma_20")),
                "price_above_sma50": flag(F.col("close") > F.col("sma_50")),
                "ma_cross_10_20": flag(F.col("sma_10") > F.col("sma_20")),
                "ma_cross_20_50": flag(F.col("sma_20") > F.col("sma_50")),
            },
        ]

    return Step(stages, back=50)


def rsi(window: int = 14) -> Step:
    """Relative strength from simple means of gains and losses; the first bar of a series has 0."""

    def stages(framed: DataFrame):
        order = block_window(framed)
        frame = trailing(order, window)
        delta = F.col("_delta")
        gain = F.avg(F.when(delta > 0, delta).otherwise(0.0)).over(frame)
        loss = F.avg(F.when(delta < 0, -delta).otherwise(0.0)).over(frame)
        return [
            {"_delta": F.col("close") - F.lag("close").over(order)},
            {"rsi": 100 - 100 / (1 + gain / (loss + EPSILON))},
            {"rsi_overbought": flag(F.col("rsi") > 70), "rsi_oversold": flag(F.col("rsi") < 30)},
        ]

    return Step(stages, back=window)


def macd(fast: int = 12, slow: int = 26, signal: int = 9) -> Step:
    def stages(framed: DataFrame):
        fast_local, fast_average = ewm(framed, "macd_fast", F.col("close"), fast)
        slow_local, slow_average = ewm(framed, "macd_slow", F.col("close"), slow)
        signal_local, signal_average = ewm(framed, "macd_signal", F.col("macd"), signal)
        line, smoothed = F.col("macd"), F.col("macd_signal")
        return [
            {**fast_local, **slow_local},
            {"macd": fast_average - slow_average},
            signal_local,
            {"macd_signal": signal_average},
            {"macd_histogram": line - smoothed, "macd_bullish": flag(line > smoothed)},
        ]

    return Step(stages, back=warm_up(slow) + warm_up(signal), spans=(fast, slow, signal))


def bollinger(window: int = 20, width: float = 2.0, squeeze: int = 50) -> Step:
    def stages(framed: DataFrame):
        order = block_window(framed)
        first, means = _means(framed, (window,))
        middle, deviation = F.col(f"sma_{window}"), F.col("_deviation")
        upper, lower = middle + width * deviation, middle - width * deviation
        parts, usual = long_mean(order, "bb_width", squeeze)
        return [
            first,
            {**means, "_deviation": F.stddev_samp("close").over(trailing(order, window))},
            {
                "bb_middle": middle,
                "bb_upper": upper,
                "bb_lower": lower,
                "bb_width": ratio(upper - lower, middle),
                "bb_position": (F.col("close") - lower) / (upper - lower + EPSILON),
            },
            parts,
            {"bb_squeeze": flag(F.col("bb_width") < usual * 0.8)},
        ]

    return Step(stages, back=window + squeeze - 1)


def atr(window: int = 14, true_range: bool = True) -> Step:
    """Mean of the true range, or of high - low when ``true_range`` is off."""

    def stages(framed: DataFrame):
        order = block_window(framed)
        high, low = F.col("high"), F.col("low")
        span = high - low
        if true_range:
            before = F.lag("close").over(order)
            span = F.greatest(span, F.abs(high - before), F.abs(low - before))
        return [
            {"true_range": span},
            {"atr": F.avg("true_range").over(trailing(order, window))},
            {"atr_ratio": ratio("atr", "close")},
        ]

    return Step(stages, back=window)


def stochastic(window: int = 14, smooth: int = 3) -> Step:
    def stages(framed: DataFrame):
        order = block_window(framed)
        frame = trailing(order, window)
        low, high = F.min("low").over(frame), F.max("high").over(frame)
        return [
            {"stoch_k": 100 * (F.col("close") - low) / (high - low + EPSILON)},
            {"stoch_d": F.avg("stoch_k").over(trailing(order, smooth))},
        ]

    return Step(stages, back=window + smooth - 2)


def momentum(lags: Sequence[int] = MOMENTUM_LAGS) -> Step:
    def stages(framed: DataFrame):
        order = block_window(framed)
        return [{f"momentum_{n}": change("close", n, order) for n in lags}]

    return Step(stages, back=max(lags))


def volatility(window: int = 20) -> Step:
    def stages(framed: DataFrame):
        order = block_window(framed)
        deviation = F.stddev_samp("price_change").over(trailing(order, window))
        return [{"price_change": change("close", 1, order)}, {f"volatility_{window}": deviation}]

    return Step(stages, back=window)


def candle_shape() -> Step:
    """Body and shadows; row-local."""

    def stages(framed: DataFrame):
        top, bottom = F.greatest("open", "close"), F.least("open", "close")
        return [
            {
                "body": F.col("close") - F.col("open"),
                "upper_shadow": F.col("high") - top,
                "lower_shadow": bottom - F.col("low"),
            }
        ]

    return Step(stages)
