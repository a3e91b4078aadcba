"""Feature steps and their evaluation over a panel.

A step adds columns to a framed panel (see ``panel.spread``) and declares what it reaches for: bars
before and after the current one, exponential spans, and values that depend on the whole series.
``compute`` frames the panel once for all steps: one shuffle by (symbol, block) and one sort.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators import panel
from barloom.operators.scan import pooled
from barloom.schema import Layout

SERIES_SUMS = ("obv", "pv", "volume")


Stages = Callable[[DataFrame], list[dict[str, Column]]]


@dataclass(frozen=True)
class Step:
    """``stages`` lists columns level by level; a level may use the columns of the step's levels before
    it, but not those of another step."""

    stages: Stages
    back: int = 0
    ahead: int = 0
    spans: tuple[float, ...] = ()
    series: tuple[str, ...] = ()  # of SERIES_SUMS, or "close_std"


def compute(
    bars: DataFrame, layout: Layout, *steps: Step, keep_blocks: bool = False, parts: DataFrame | None = None
) -> DataFrame:
    """Apply steps to a panel of bars; one output row per bar.

    Levels of all steps are merged, so that Spark plans one window pass per level and not one per
    indicator. Steps end together: those with one level run in the last pass, which keeps the rows of
    the passes before it narrow. A column that several steps need (the 20-bar mean, say) is computed
    once. With ``keep_blocks`` the block number stays, for scans that go on within blocks. ``parts`` are the stored
    ``block_parts`` of numbered bars; without them they are derived from the bars where a step asks for them.
    """
    numbered = panel.number_bars(bars, layout)
    tiles = [size for size, _ in panel.tile_plan([s for step in steps for s in step.spans])]
    framed = panel.spread(
        numbered,
        layout,
        back=max((step.back for step in steps), default=0),
        ahead=max((step.ahead for step in steps), default=0),
        tiles=tiles,
    )
    series = {name for step in steps for name in step.series}
    if series:
        state = series_state(block_parts(numbered, layout, series) if parts is None else parts, series)
        framed = framed.join(state, [panel.SYMBOL, panel.BLOCK], "left")
    plans = [step.stages(framed) for step in steps]
    depth = max((len(plan) for plan in plans), default=0)
    present = set(framed.columns)
    for level in range(depth):
        merged: dict[str, Column] = {}
        for plan in plans:
            stage = level - (depth - len(plan))
            if stage >= 0:
                merged |= {n: c for n, c in plan[stage].items() if n not in present}
        if merged:
            framed = framed.withColumns(merged)
            present |= merged.keys()
    return panel.trim(framed, keep_blocks)


def obv_step(order) -> Column:
    """Volume signed by the direction of the close; null on the first bar of a series."""
    return F.signum(F.col("close") - F.lag("close").over(order)) * F.col("volume")


EVERY_PART = (*SERIES_SUMS, "close_std")


def block_parts(numbered: DataFrame, layout: Layout, wanted: Iterable[str] = EVERY_PART) -> DataFrame:
    """One row per (symbol, block): rows, sums of the block, and count, mean and squared deviation of its closes.

    A bar whose predecessor is not among ``numbered`` has no direction and adds nothing to ``_obv``. Rows marked in a column ``_known``
    only serve as predecessors.
    """
    known = F.col("_known") if "_known" in numbered.columns else F.lit(False)
    narrow = numbered.select(panel.SYMBOL, panel.BAR_NO, "close", "volume", known.alias("_known"))
    if "obv" in wanted:
        framed = panel.spread(narrow, layout, back=1)
        framed = framed.withColumn("_obv", obv_step(panel.block_window(framed))).filter(panel.HOME)
    else:
        framed = narrow.withColumn(panel.BLOCK, F.floor(F.col(panel.BAR_NO) / layout.block_rows))
    framed = framed.filter(~F.col("_known"))
    close, volume = F.col("close"), F.col("volume").cast("double")
    totals = {"obv": F.sum("_obv") if "obv" in wanted else None, "pv": F.sum(close * volume), "volume": F.sum(volume)}
    aggregates = [totals[name].alias(f"_{name}") for name in SERIES_SUMS if name in wanted]
    if "close_std" in wanted:
        aggregates += [
            F.count(close).alias("_n_close"),
            F.avg(close).alias("_mean_close"),
            (F.var_pop(close) * F.count(close)).alias("_m2_close"),
        ]
    return framed.groupBy(panel.SYMBOL, panel.BLOCK).agg(F.count(F.lit(1)).alias("_rows"), *aggregates)


def series_state(parts: DataFrame, wanted: set[str]) -> DataFrame:
    """One row per (symbol, block): sums over all earlier blocks, deviation over the series."""
    keys = (panel.SYMBOL,)
    sums = [name for name in SERIES_SUMS if name in wanted]
    earlier = Window.partitionBy(*keys).orderBy(panel.BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    base = [f"_base_{n}" for n in sums]
    state = parts.withColumns({f"_base_{n}": F.sum(f"_{n}").over(earlier) for n in sums})
    if "close_std" not in wanted:
        return state.select(*keys, panel.BLOCK, *base)
    return pooled(state, keys, panel.BLOCK, ("close",), keep=base).select(
        *keys, panel.BLOCK, *base, F.col("close_std").alias("_close_std")
    )


def running_sum(framed: DataFrame, value: Column, base: str) -> Column:
    """Sum of ``value`` since the first bar of the series, valid on home and copied rows alike."""
    local = F.sum(value).over(panel.block_window(framed).rowsBetween(Window.unboundedPreceding, 0))
    everything = panel.block_window(framed).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    copied = F.sum(F.when(F.col(panel.LEAD), value)).over(everything)
    return F.coalesce(F.col(base), F.lit(0.0)) + local - F.coalesce(copied, F.lit(0.0))
