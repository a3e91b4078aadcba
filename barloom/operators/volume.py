"""Volume features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions import change, flag, ratio, trailing
from barloom.operators.panel import CHUNK, SYMBOL, TS, block_window, with_chunk
from barloom.operators.scan import Running, prefix_scan
from barloom.operators.step import Step, obv_step, running_sum
from barloom.schema import Layout


def volume_average() -> Step:
    def stages(framed: DataFrame):
        order = block_window(framed)
        return [
            {f"volume_ma_{k}": F.avg("volume").over(trailing(order, k)) for k in (10, 20)},
            {
                "volume_ratio": ratio("volume", "volume_ma_20"),
                "volume_trend": flag(F.col("volume") > F.col("volume_ma_10")),
            },
        ]

    return Step(stages, back=19)


def price_volume_correlation(window: int = 20) -> Step:
    """One-bar change, and the trailing correlation of its size with volume (undefined counts as 0)."""

    def stages(framed: DataFrame):
        order = block_window(framed)
        frame = trailing(order, window)
        size = F.abs("price_change")
        volume = F.when(size.isNotNull(), F.col("volume").cast("double"))
        both = F.stddev_samp(size).over(frame) * F.stddev_samp(volume).over(frame)
        together = F.covar_samp(volume, size).over(frame)
        return [
            {"price_change": change("close", 1, order)},
            {"volume_price_corr": F.coalesce(ratio(together, both), F.lit(0.0))},
        ]

    return Step(stages, back=window)


def on_balance_volume(window: int = 20) -> Step:
    def stages(framed: DataFrame):
        order = block_window(framed)
        return [
            {"_obv": obv_step(order)},
            {"obv": running_sum(framed, F.col("_obv"), "_base_obv")},
            {"obv_ma": F.avg("obv").over(trailing(order, window))},
            {"obv_trend": flag(F.col("obv") > F.col("obv_ma"))},
        ]

    return Step(stages, back=window + 1, series=("obv",))


def vwap() -> Step:
    """Volume-weighted average price since the first bar of the series."""

    def stages(framed: DataFrame):
        close, volume = F.col("close"), F.col("volume").cast("double")
        value = running_sum(framed, close * volume, "_base_pv")
        return [
            {"vwap": ratio(value, running_sum(framed, volume, "_base_volume"))},
            {"dist_to_vwap": ratio(close - F.col("vwap"), "vwap")},
        ]

    return Step(stages, series=("pv", "volume"))


def session_vwap(bars: DataFrame, layout: Layout) -> DataFrame:
    """Volume-weighted average price that starts anew every calendar day."""
    dated = with_chunk(bars, layout).withColumn("_day", F.to_date(TS))
    volume = F.col("volume").cast("double")
    sums = {"_pv": Running("sum", F.col("close") * volume), "_v": Running("sum", volume)}
    summed = prefix_scan(dated, (SYMBOL, "_day"), CHUNK, TS, sums)
    return summed.withColumn("session_vwap", ratio("_pv", "_v")).drop("_day", "_pv", "_v", CHUNK)
