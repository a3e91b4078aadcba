"""Cleaning: missing values, price outliers, bars without trades."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators.panel import CHUNK, SYMBOL, TS, with_chunk
from barloom.operators.scan import fill_scan
from barloom.schema import PRICES, Layout
from barloom.session import materialize


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns or df.columns))


def fill_gaps(bars: DataFrame, layout: Layout, columns: Sequence[str] | None = None) -> DataFrame:
    """Carry the last known value forward; values missing at the head take the first known one."""
    columns = columns or [c for c in bars.columns if c not in (SYMBOL, TS)]
    return fill_scan(with_chunk(bars, layout), (SYMBOL,), CHUNK, TS, columns).drop(CHUNK)


def attach_series(df: DataFrame, per_series: DataFrame, layout: Layout) -> DataFrame:
    """Join one row per symbol onto the rows of the symbol.

    The join runs on (symbol, chunk): the small side is repeated per chunk, so that a symbol with
    most of the rows is spread over tasks. Catalyst may still broadcast it when it is small.
    """
    chunked = with_chunk(df, layout)
    pieces = chunked.select(SYMBOL, CHUNK).distinct().join(per_series, SYMBOL)
    return chunked.join(pieces, [SYMBOL, CHUNK]).drop(CHUNK)


def sigma_bounds(
    bars: DataFrame, layout: Layout, columns: Sequence[str] = PRICES, width: float = 3.0
) -> DataFrame:
    """Bounds mean +- ``width`` deviations per symbol, column after column.

    The bounds of a column come from the rows inside the bounds of the columns before it. Each
    round is one pass over the bars; its result has a row per symbol and is written out, because
    the next round and the final filter both build on it.
    """
    bounds, done = None, []
    for c in columns:
        rows = bars.select(SYMBOL, TS, *done, c)
        if bounds is not None:
            rows = _inside(attach_series(rows, bounds, layout), done)
        mean, deviation, lowest, highest = F.avg(c), F.stddev_samp(c), F.min(c), F.max(c)
        constant = (lowest == highest) & deviation.isNotNull()  # its mean may be off by rounding
        found = rows.groupBy(SYMBOL).agg(
            F.when(constant, lowest).otherwise(mean - width * deviation).alias(f"_low_{c}"),
            F.when(constant, highest).otherwise(mean + width * deviation).alias(f"_high_{c}"),
        )
        bounds = materialize(found if bounds is None else bounds.join(found, SYMBOL))
        done.append(c)
    return bounds


def _inside(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    for c in columns:
        rows = rows.filter(F.col(c).between(F.col(f"_low_{c}"), F.col(f"_high_{c}")))
    return rows


def sigma_filter(
    bars: DataFrame,
    layout: Layout,
    columns: Sequence[str] = PRICES,
    width: float = 3.0,
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """Drop bars with a price outside its bounds; ``fit_on`` takes the bounds from other bars."""
    if fit_on is None:
        bars = fit_on = materialize(bars)  # read once for each column and once more for the result
    bounds = sigma_bounds(fit_on, layout, columns, width)
    return _inside(attach_series(bars, bounds, layout), columns).select(*bars.columns)


def traded(bars: DataFrame) -> DataFrame:
    return bars.filter(F.col("volume") > 0)
