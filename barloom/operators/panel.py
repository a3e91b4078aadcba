"""Numbering bars and cutting series into blocks with overlap.

``number_bars`` gives each bar its position in the series. ``spread`` cuts a numbered series into
blocks of consecutive bars and copies into each block the few bars before (and after) it that
row-based windows reach for; the copies are found by arithmetic on the position, without a join.
Windows over ``block_window`` then equal windows over the whole series for every home row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barloom.functions import time_bucket
from barloom.operators.scan import Running, prefix_scan
from barloom.schema import Layout

SYMBOL, TS, BAR_NO = "symbol", "bar_ts", "bar_no"
BLOCK, HOME, LEAD, CHUNK = "_block", "_home", "_lead", "_chunk"


def with_chunk(bars: DataFrame, layout: Layout) -> DataFrame:
    return bars.withColumn(CHUNK, time_bucket(TS, layout.chunk_seconds))


def number_bars(bars: DataFrame, layout: Layout, keys: Sequence[str] = (SYMBOL,)) -> DataFrame:
    """Add ``bar_no``, the zero-based position of a bar in its series. A no-op if present."""
    if BAR_NO in bars.columns:
        return bars
    counted = prefix_scan(
        with_chunk(bars, layout), keys, CHUNK, TS, {BAR_NO: Running("sum", F.lit(1).cast("bigint"))}
    )
    return counted.withColumn(BAR_NO, F.col(BAR_NO) - 1).drop(CHUNK)


def measured_layout(bars: DataFrame, every: int, rows: int = 50_000) -> Layout:
    """A layout whose chunks hold at most ``rows`` bars, for series that are not on a grid.

    Each round counts the rows of the fullest chunk; only that number reaches the driver.
    """
    seconds = every * rows
    while True:
        counts = bars.groupBy(SYMBOL, time_bucket(TS, seconds).alias(CHUNK)).count()
        fullest = counts.agg(F.max("count")).first()[0] or 0
        if fullest <= rows or seconds == 1:
            return Layout(every=1, chunk_rows=seconds, block_rows=rows)
        seconds = max(1, seconds // math.ceil(fullest / rows))


def last_bars(bars: DataFrame, n: int, layout: Layout) -> DataFrame:
    """The latest n bars of each series, without sorting a series."""
    chunked = with_chunk(bars, layout)
    if BAR_NO in bars.columns:
        ends = chunked.groupBy(SYMBOL, CHUNK).agg(F.max(BAR_NO).alias("_end"))
        latest = F.max("_end").over(Window.partitionBy(SYMBOL))  # over a row per chunk
        ends = ends.select(SYMBOL, CHUNK, "_end", latest.alias("_latest")).filter(F.col("_end") > F.col("_latest") - n)
        kept = chunked.join(ends, [SYMBOL, CHUNK]).filter(F.col(BAR_NO) > F.col("_latest") - n)
        return kept.select(*bars.columns)
    one = F.lit(1).cast("bigint")
    ranked = prefix_scan(chunked, (SYMBOL,), CHUNK, TS, {"_from_end": Running("sum", one)}, ascending=False)
    return ranked.filter(F.col("_from_end") <= n).drop("_from_end", CHUNK)


def tile_plan(spans: Sequence[float]) -> list[tuple[int, tuple[float, ...]]]:
    """Nested tile lengths for exponential averages (see ``ewm``), each with the spans it serves.

    With decay r, a tile of S rows needs r**S below double precision, so that one earlier tile is
    memory enough, and r**-S far from overflow. Each length is a multiple of the one before.
    """
    plan: list[tuple[int, list[float]]] = []
    for span in sorted(set(spans)):
        digits = -math.log10(1 - 2 / (span + 1))
        need, limit = math.ceil(17 / digits), math.floor(250 / digits)
        if plan:
            size, members = plan[-1]
            widest = min(math.floor(250 / -math.log10(1 - 2 / (s + 1))) for s in members)
            base = plan[-2][0] if len(plan) > 1 else 1
            grown = max(size, base * math.ceil(need / base))
            if grown <= widest:
                plan[-1] = (grown, [*members, span])
                continue
            size = size * math.ceil(need / size)
        else:
            size = need
        if size > limit:
            raise ValueError(f"no tile length for span {span}")
        plan.append((size, [span]))
    return [(size, tuple(members)) for size, members in plan]


def warm_up(span: float) -> int:
    """Bars after which an exponential average has forgotten its start to double precision."""
    return math.ceil(-17 / math.log10(1 - 2 / (span + 1)))


def spread(
    numbered: DataFrame, layout: Layout, back: int, ahead: int = 0, tiles: Sequence[int] = ()
) -> DataFrame:
    """Cut into blocks; each block also receives ``back`` bars before and ``ahead`` bars after it."""
    size = layout.block_rows
    first = F.greatest(F.floor((F.col(BAR_NO) - ahead) / size), F.lit(0).cast("bigint"))
    last = F.floor((F.col(BAR_NO) + back) / size)
    home = F.floor(F.col(BAR_NO) / size)
    copied = numbered.select("*", home.alias("_own"), F.explode(F.sequence(first, last)).alias(BLOCK))
    framed = copied.select(
        *numbered.columns,
        BLOCK,
        (F.col("_own") == F.col(BLOCK)).alias(HOME),
        (F.col("_own") < F.col(BLOCK)).alias(LEAD),
        *(F.floor(F.col(BAR_NO) / s).alias(tile_column(s)) for s in tiles),
    )
    return framed.repartition(SYMBOL, BLOCK)


def tile_column(size: int) -> str:
    return f"_tile_{size}"


def tiles_of(framed: DataFrame) -> list[str]:
    """Tile columns, longest tile first."""
    found = [c for c in framed.columns if c.startswith("_tile_")]
    return sorted(found, key=lambda c: -int(c.removeprefix("_tile_")))


def block_window(framed: DataFrame) -> WindowSpec:
    """Bars of a block in order. Naming the tiles in the order lets one sort serve tile windows too."""
    return Window.partitionBy(SYMBOL, BLOCK).orderBy(*tiles_of(framed), BAR_NO)


def tile_window(framed: DataFrame, tile: str) -> WindowSpec:
    nested = tiles_of(framed)
    cut = nested.index(tile) + 1
    return Window.partitionBy(SYMBOL, BLOCK, *nested[:cut]).orderBy(*nested[cut:], BAR_NO)


def trim(framed: DataFrame, keep_blocks: bool = False) -> DataFrame:
    """Back to one row per bar."""
    helpers = [c for c in framed.columns if c.startswith("_") and not (keep_blocks and c == BLOCK)]
    return framed.filter(HOME).drop(*helpers)


def ewm(framed: DataFrame, name: str, value: Column, span: float) -> tuple[dict[str, Column], Column]:
    """Exponential average e[t] = a x[t] + (1 - a) e[t-1], a = 2 / (span + 1), e[0] = x[0].

    Inside a tile the recurrence is a running sum of a x[i] r**-i scaled by r**i (r = 1 - a, i counted
    from the start of the tile). The state at the end of the previous tile comes in with r**(i + 1);
    what lies further back has decayed below double precision, which is also why a block of bars
    preceded by ``warm_up(span)`` copies needs nothing from earlier blocks. Input must not be null.

    Returns the columns of the first level and the average itself, an expression for the next level.
    """
    alpha = 2 / (span + 1)
    lengths = sorted(int(c.removeprefix("_tile_")) for c in tiles_of(framed))
    size = next(s for s in lengths if s >= warm_up(span))
    decay, offset = F.lit(1 - alpha), F.col(BAR_NO) % size
    weighted = F.when(F.col(BAR_NO) == 0, value).otherwise(alpha * value)
    in_tile = tile_window(framed, tile_column(size)).rowsBetween(Window.unboundedPreceding, 0)
    local = F.sum(weighted * F.pow(decay, -offset)).over(in_tile) * F.pow(decay, offset)
    earlier = block_window(framed).rowsBetween(Window.unboundedPreceding, -1)
    tile_end = F.when(offset == size - 1, F.col(f"_local_{name}"))
    carried = F.last(tile_end, ignorenulls=True).over(earlier) * F.pow(decay, offset + 1)
    return {f"_local_{name}": local}, F.col(f"_local_{name}") + F.coalesce(carried, F.lit(0.0))
