"""Vectorised backtest: hold while the previous prediction was up."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions import change, full, ratio, trailing
from barloom.operators.panel import BLOCK, SYMBOL, block_window
from barloom.operators.step import Step, compute
from barloom.schema import Layout

PERIODS_15M = 252 * 24 * 4  # bars per year used for annualisation
_START = Window.unboundedPreceding
_LARGEST = 709.0  # beyond this exp() is infinite


def returns() -> Step:
    """Position taken from the previous prediction, and the return earned with it."""

    def stages(framed: DataFrame):
        order = block_window(framed)
        return [
            {"position": F.lag("prediction").over(order), "bar_return": change("close", 1, order)},
            {"strategy_return": F.col("position") * F.col("bar_return")},
        ]

    return Step(stages, back=1)


def rolling_sharpe(window: int = 50, periods: int = PERIODS_15M) -> Step:
    def stages(framed: DataFrame):
        frame = trailing(block_window(framed), window)
        earned = F.col("strategy_return")
        sharpe = ratio(F.avg(earned).over(frame), F.stddev_samp(earned).over(frame)) * math.sqrt(periods)
        return [*returns().stages(framed), {"rolling_sharpe": full(sharpe, "strategy_return", frame, window)}]

    return Step(stages, back=window + 1)


def match(pred: DataFrame, bars: DataFrame) -> DataFrame:
    """Predictions with the bars they belong to, by key."""
    return pred.select("symbol", "bar_ts", "prediction").join(
        bars.select("symbol", "bar_ts", "close"), ["symbol", "bar_ts"]
    )


def _sign(zero: Column, odd: Column) -> Column:
    return F.when(zero > 0, 0).when(odd % 2 == 1, -1).otherwise(1)


def _value(sign: Column, log: Column) -> Column:
    """sign * exp(log); null where a double cannot hold it."""
    return F.when(sign == 0, F.lit(0.0)).when(log < _LARGEST, sign * F.exp(log))


def equity(pred: DataFrame, bars: DataFrame, layout: Layout, window: int = 50, periods: int = PERIODS_15M) -> DataFrame:
    """Equity of the strategy and of holding, running maximum, drawdown, rolling Sharpe ratio.

    Growth is kept as the logarithm of its size and its sign (a return below -1 turns it, one of -1 ends it at zero),
    so that long series do not overflow: ``log_return``, ``sign``, ``log_hold``, ``hold_sign``, ``log_max``. The plain values are
    null where a double cannot hold them.
    """
    rows = compute(match(pred, bars), layout, rolling_sharpe(window, periods), keep_blocks=True)
    inside = Window.partitionBy(SYMBOL, BLOCK).orderBy("bar_no").rowsBetween(_START, 0)
    rates = {"s": "strategy_return", "h": "bar_return"}
    parts, running = {}, {}
    for k, rate in rates.items():
        factor = 1 + F.col(rate)
        parts |= {
            f"_l{k}": F.when(factor != 0, F.ln(F.abs(factor))),
            f"_o{k}": (factor < 0).cast("int"),
            f"_z{k}": (factor == 0).cast("int"),
        }
        running |= {
            f"_log_{k}": F.sum(f"_l{k}").over(inside),
            f"_odd_{k}": F.sum(f"_o{k}").over(inside),
            f"_zero_{k}": F.max(f"_z{k}").over(inside),
        }
    grown = rows.withColumns(parts).withColumns(running)
    known = F.col("_zero_s").isNotNull()
    log, zero, odd = F.coalesce("_log_s", F.lit(0.0)), F.coalesce("_zero_s", F.lit(0)), F.coalesce("_odd_s", F.lit(0))
    grown = grown.withColumns({"_size": log, "_sign": _sign(zero, odd)})
    up, down = known & (F.col("_sign") > 0), known & (F.col("_sign") < 0)
    # Within a block growth has the sign of its start or the other one: both may turn out to be the positive side.
    sides = {
        "_top_up": (F.max, F.when(up, F.col("_size"))), "_top_down": (F.max, F.when(down, F.col("_size"))),
        "_low_up": (F.min, F.when(up, F.col("_size"))), "_low_down": (F.min, F.when(down, F.col("_size"))),
        "_none": (F.max, F.when(known, (F.col("_sign") == 0).cast("int"))),
    }
    local = grown.withColumns({n: how(value).over(inside) for n, (how, value) in sides.items()})

    def extremes(start_sign: Column, start: Column) -> tuple[Column, Column, Column]:
        """Log of the highest positive value, whether zero was met, log of the smallest negative value."""
        high = F.when(start_sign > 0, start + F.col("_top_up")).when(start_sign < 0, start + F.col("_top_down"))
        low = F.when(start_sign > 0, start + F.col("_low_down")).when(start_sign < 0, start + F.col("_low_up"))
        met = F.when(start_sign == 0, 1).otherwise(F.col("_none"))
        return high, met, low

    # One row per block: growth over it and its extremes, carried over the earlier blocks.
    earlier = Window.partitionBy(SYMBOL).orderBy(BLOCK).rowsBetween(_START, -1)
    blocks = grown.groupBy(SYMBOL, BLOCK).agg(
        *(F.sum(f"_l{k}").alias(f"_gain_{k}") for k in rates),
        *(F.sum(f"_o{k}").alias(f"_odds_{k}") for k in rates),
        *(F.max(f"_z{k}").alias(f"_zeros_{k}") for k in rates),
        *(how(value).alias(n) for n, (how, value) in sides.items()),
    )
    start = {}
    for k in rates:
        start[f"_start_{k}"] = F.coalesce(F.sum(f"_gain_{k}").over(earlier), F.lit(0.0))
        ends, turns = F.max(f"_zeros_{k}").over(earlier), F.sum(f"_odds_{k}").over(earlier)
        start[f"_from_{k}"] = _sign(F.coalesce(ends, F.lit(0)), F.coalesce(turns, F.lit(0)))
        start[f"_began_{k}"] = ends.isNotNull()
    blocks = blocks.withColumns(start)
    high, met, low = extremes(F.col("_from_s"), F.col("_start_s"))
    blocks = blocks.withColumns({"_high": high, "_met": met, "_low": low})
    state = blocks.select(
        SYMBOL, BLOCK, *start, F.max("_high").over(earlier).alias("_high_before"),
        F.max("_met").over(earlier).alias("_met_before"), F.min("_low").over(earlier).alias("_low_before"),
    )
    joined = local.join(state, [SYMBOL, BLOCK])

    def position(k: str) -> tuple[Column, Column]:
        own = F.col(f"_zero_{k}").isNotNull()
        sign = F.col(f"_from_{k}") * _sign(F.coalesce(f"_zero_{k}", F.lit(0)), F.coalesce(f"_odd_{k}", F.lit(0)))
        some = F.col(f"_began_{k}") | own
        size = F.col(f"_start_{k}") + F.coalesce(f"_log_{k}", F.lit(0.0))
        return F.when(some, sign), F.when(some & (sign != 0), size)

    sign, size = position("s")
    hold_sign, hold = position("h")
    high, met, low = extremes(F.col("_from_s"), F.col("_start_s"))
    high, met, low = F.greatest("_high_before", high), F.greatest("_met_before", met), F.least("_low_before", low)
    top_sign = F.when(high.isNotNull(), 1).when(met > 0, 0).when(low.isNotNull(), -1)
    measured = joined.withColumns(
        {"sign": sign, "log_return": size, "hold_sign": hold_sign, "log_hold": hold,
         "_top_sign": top_sign, "log_max": F.coalesce(high, F.when(top_sign < 0, low))}
    )
    gap = F.col("log_return") - F.col("log_max")
    fall = F.when(F.col("sign") == 0, F.lit(0.0)).when(gap < _LARGEST, F.col("sign") * F.col("_top_sign") * F.exp(gap))
    return measured.select(
        "symbol", "bar_ts", "bar_no", "close", "position", "strategy_return", "rolling_sharpe",
        _value(F.col("sign"), F.col("log_return")).alias("cumulative_return"),
        _value(F.col("hold_sign"), F.col("log_hold")).alias("buy_hold_return"),
        _value(F.col("_top_sign"), F.col("log_max")).alias("running_max"),
        F.when(F.col("_top_sign") != 0, fall - 1).alias("drawdown"),
        "sign", "log_return", "hold_sign", "log_hold", F.when(F.col("_top_sign") > 0, F.col("log_max")).alias("log_max"),
    )


def summary(curve: DataFrame, periods: int = PERIODS_15M) -> DataFrame:
    """Total returns, Sharpe ratio and maximum drawdown per symbol; growth also as sign and logarithm."""
    earned = F.col("strategy_return")
    return curve.groupBy("symbol").agg(
        (F.max_by("cumulative_return", "bar_no") - 1).alias("total_return"),
        (F.max_by("buy_hold_return", "bar_no") - 1).alias("buy_hold_return"),
        (ratio(F.avg(earned), F.stddev_samp(earned)) * math.sqrt(periods)).alias("sharpe"),
        F.min("drawdown").alias("max_drawdown"),
        *(F.max_by(c, "bar_no").alias(c) for c in ("sign", "log_return", "hold_sign", "log_hold")),
    )
