"""The named feature sets as lists of steps."""

from __future__ import annotations

from pyspark.sql import DataFrame

from barloom.operators import fibonacci, label, structure, technical, volume
from barloom.operators.step import Step, compute
from barloom.schema import Layout


def full77_steps() -> list[Step]:
    return [
        fibonacci.fibonacci(anchor="high"),
        structure.swings(),
        structure.trend_flags(),
        structure.breaks(),
        structure.liquidity(),
        structure.order_blocks(),
        structure.fair_value_gaps(),
        volume.volume_average(),
        volume.price_volume_correlation(),
        volume.on_balance_volume(),
        volume.vwap(),
        technical.sma(),
        technical.ema(),
        technical.average_flags(),
        technical.rsi(),
        technical.macd(),
        technical.bollinger(),
        technical.atr(),
        technical.stochastic(),
        technical.momentum(),
        technical.volatility(),
    ]


def _core_steps(periods, spans, true_range: bool, lags) -> list[Step]:
    return [
        fibonacci.fibonacci(anchor="low"),
        structure.trend_flags(),
        structure.breaks(),
        volume.volume_average(),
        technical.sma(periods),
        technical.ema(spans),
        technical.rsi(),
        technical.macd(),
        technical.bollinger(),
        technical.atr(true_range=true_range),
        technical.momentum(lags),
    ]


def core24_steps() -> list[Step]:
    return _core_steps((20, 50), (20,), False, (5, 10))


def core35_steps() -> list[Step]:
    spans = (5, 10, 20, 50)
    return [*_core_steps(spans, spans, True, (5, 10, 20)), technical.candle_shape()]


def mini8_steps() -> list[Step]:
    return [technical.sma((20,)), technical.rsi(), volume.volume_average()]


STEPS = {"full77": full77_steps, "core24": core24_steps, "core35": core35_steps, "mini8": mini8_steps}


def feature_panel(bars: DataFrame, layout: Layout, name: str = "full77", drop_unlabelled: bool = False) -> DataFrame:
    """Bars with the features of a named set (and their intermediates) and the label."""
    steps = [*STEPS[name](), label.target(drop_unlabelled=drop_unlabelled)]
    panel = compute(bars, layout, *steps)
    return label.labelled(panel) if drop_unlabelled else panel
