"""Bars from a stream of ticks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.sources.ticks import position_of


def bar_stream(
    ticks: DataFrame,
    symbol: Column | str,
    ts: str,
    price: str,
    order: Sequence[str],
    every: str,
    late: str = "10 minutes",
) -> DataFrame:
    """Tumbling bars, emitted once the watermark has passed their end.

    A watermark needs an instant, so zone-less stamps are read in the session time zone (use UTC) and
    turned back on the way out.
    """
    key = F.col(symbol) if isinstance(symbol, str) else symbol
    timed = ticks.withColumn("_instant", F.col(ts).cast("timestamp")).withWatermark("_instant", late)
    position = position_of(ticks, order)
    bars = timed.groupBy(key.alias("symbol"), F.window("_instant", every).alias("_window")).agg(
        F.min_by(price, position).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, position).alias("close"),
        F.count("*").alias("volume"),
    )
    start = F.col("_window.start").cast("timestamp_ntz")
    return bars.select("symbol", start.alias("bar_ts"), "open", "high", "low", "close", "volume")
