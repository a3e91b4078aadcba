"""Bars from single trades or events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.scalar import epoch_micros


def position_of(df: DataFrame, order: Sequence[str]) -> Column:
    """One sortable value for the order columns.

    A single column, or a time stamp with a 64-bit tie-break packed into one decimal, keeps the
    aggregation hash-based; a struct would make Spark sort the ticks first.
    """
    if len(order) == 1:
        return F.col(order[0])
    kinds = [df.schema[c].dataType for c in order]
    stamp = isinstance(kinds[0], (T.TimestampNTZType, T.TimestampType))
    if len(order) == 2 and stamp and isinstance(kinds[1], (T.LongType, T.IntegerType)):
        # Microseconds times 2**64: any signed 64-bit tie-break stays within its microsecond.
        shifted = epoch_micros(order[0]).cast("decimal(18,0)") * F.expr("18446744073709551616BD")
        return shifted.cast("decimal(37,0)") + F.col(order[1]).cast("decimal(19,0)")
    return F.struct(*order)


def bars_from_ticks(
    ticks: DataFrame,
    symbol: Column | str,
    ts: str,
    price: str,
    order: Sequence[str],
    every: str,
    volume: Column | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Tumbling bars. ``order`` decides open and close; ``volume`` defaults to the tick count.

    ``start`` and ``end`` keep the bars that begin in [start, end); both must be multiples of ``every``, so
    that they can be compared with the ticks themselves and reach the file scan.

    Everything is combined before the shuffle, so a dominant symbol ships one row per bar and task.
    """
    kind = ticks.schema[ts].dataType.simpleString()
    for bound, keep in ((start, F.col(ts).__ge__), (end, F.col(ts).__lt__)):
        if bound is not None:
            ticks = ticks.filter(keep(F.lit(bound).cast(kind)))
    position = position_of(ticks, order)
    key = F.col(symbol) if isinstance(symbol, str) else symbol
    begin = F.window(ts, every)["start"]
    return ticks.groupBy(key.alias("symbol"), begin.alias("bar_ts")).agg(
        F.min_by(price, position).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, position).alias("close"),
        (F.count("*") if volume is None else F.sum(volume)).alias("volume"),
    )
