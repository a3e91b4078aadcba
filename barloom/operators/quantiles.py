"""Exact quantiles without sorting the data.

One pass takes a mergeable sketch of every column, from which each wanted rank gets a bracket: two values between which it must lie and
between which no more than a known share of the rows does. A second pass counts rows below and at the ends of the brackets and
gathers what lies strictly between them; the wanted value is one of the ends or of the gathered values. Where that share of a very long column is more than
``HELD`` values, brackets are narrowed by a sketch of their inside first. Equal values at the ends are counted, not
gathered, so crowded values do no harm. Everything the driver sees is two numbers per column and probability.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators.panel import SYMBOL
from barloom.operators.scan import Running, prefix_scan

_INF = float("inf")
PIECES = 128  # parts into which the values of a key are cut for ranking
#: Values inside a bracket that one row of aggregates may hold.
HELD = 4_096


@dataclass
class _Slot:
    """One wanted place of a column: its two neighbouring ranks from 0, and what is known to lie around them."""

    column: str
    prob: float
    rows: int = 0
    low: float | None = None  # None: open to this side
    high: float | None = None
    most: int = 0  # rows strictly inside, at most

    def __post_init__(self):
        self.ends: tuple[float, float] | None = None

    @property
    def place(self) -> float:
        return self.prob * (self.rows - 1)

    @property
    def ranks(self) -> tuple[int, int]:
        return math.floor(self.place), math.ceil(self.place)

    def value(self) -> Column:
        return F.col(self.column).cast("double")

    def inside(self) -> Column:
        x, conditions = self.value(), F.lit(True)
        if self.low is not None:
            conditions &= x > F.lit(self.low)
        if self.high is not None:
            conditions &= x < F.lit(self.high)
        return F.when(conditions, x)

    def below(self) -> Column:
        """Rows up to and including the low end."""
        return F.lit(0) if self.low is None else F.count_if(self.value() <= F.lit(self.low))


def _offsets(accuracy: int) -> list[float]:
    """Distances from a wanted probability at which a sketch is asked, in growing steps."""
    return [6 / accuracy * 4**j for j in range(20) if 6 / accuracy * 4**j < 1]


def _sketch(df: DataFrame, slots: Sequence[_Slot], accuracy: int) -> None:
    """Brackets of the slots (all of whole columns) from one pass."""
    offsets = _offsets(accuracy)
    columns = list(dict.fromkeys(s.column for s in slots))
    probes = {s.prob: [s.prob - d for d in offsets] + [s.prob + d for d in offsets] for s in slots}
    asked = sorted({min(max(p, 0.0), 1.0) for ps in probes.values() for p in ps})
    found = df.agg(
        *(F.count(c).alias(f"n{i}") for i, c in enumerate(columns)),
        *(F.percentile_approx(F.col(c).cast("double"), asked, accuracy).alias(f"q{i}") for i, c in enumerate(columns)),
    ).first()
    at = {c: (found[f"n{i}"], dict(zip(asked, found[f"q{i}"] or [], strict=False))) for i, c in enumerate(columns)}
    for s in slots:
        s.rows, edges = at[s.column]
        _bracket(s, edges, offsets, s.prob, s.rows, accuracy)


def _bracket(s: _Slot, edges: dict[float, float], offsets: Sequence[float], prob: float, rows: int, accuracy: int) -> None:
    """The narrowest bracket that holds ``prob`` of ``rows`` values for certain: three ranks and twice the error of the sketch away."""
    s.most = rows
    needed = 3 / accuracy + 4 / max(rows, 1)
    for d in offsets:
        if d >= needed:
            s.low = edges[prob - d] if prob - d > needed else s.low
            s.high = edges[prob + d] if prob + d < 1 - needed else s.high
            s.most = math.ceil(rows * (2 * d + needed)) + 2
            return


def _narrow(df: DataFrame, slots: Sequence[_Slot], accuracy: int) -> None:
    """Narrower brackets for slots whose inside is too large: count around it, then sketch it."""
    counted = df.agg(
        *(s.below().alias(f"b{i}") for i, s in enumerate(slots)), *(F.count(s.inside()).alias(f"n{i}") for i, s in enumerate(slots))
    ).first()
    offsets, asked = _offsets(accuracy), []
    shares = []
    for i, s in enumerate(slots):
        share = min(max((s.place - counted[f"b{i}"]) / max(counted[f"n{i}"], 1), 0.0), 1.0)
        shares.append(share)
        asked.append(sorted({min(max(share + d, 0.0), 1.0) for o in offsets for d in (-o, o)}))
    found = df.agg(*(F.percentile_approx(s.inside(), asked[i], accuracy).alias(f"q{i}") for i, s in enumerate(slots))).first()
    for i, s in enumerate(slots):
        before, n = counted[f"b{i}"], counted[f"n{i}"]
        edges = dict(zip(asked[i], found[f"q{i}"] or [], strict=False))
        if s.ranks[1] < before:  # the low end itself
            s.high, s.most = s.low, 0
        elif s.ranks[0] >= before + n:
            s.low, s.most = s.high, 0
        else:
            _bracket(s, edges, offsets, shares[i], n, accuracy)


def _resolve(df: DataFrame, slots: Sequence[_Slot]) -> None:
    """Values at the wanted ranks, from one pass; a slot whose bracket does not hold them stays open."""
    measures = []
    for i, s in enumerate(slots):
        measures += [s.below().alias(f"b{i}"), F.array_sort(F.collect_list(s.inside())).alias(f"v{i}")]
        if s.low is not None:
            measures.append(F.count_if(s.value() < F.lit(s.low)).alias(f"u{i}"))
        if s.high is not None:
            measures.append(F.count_if(s.value() <= F.lit(s.high)).alias(f"h{i}"))
    picks = []
    for i, s in enumerate(slots):
        for name, rank in zip(("x", "y"), s.ranks, strict=True):
            at = F.lit(rank)
            pick = F.when(at >= F.col(f"b{i}"), F.try_element_at(f"v{i}", (at - F.col(f"b{i}") + 1).cast("int")))
            if s.low is not None:
                pick = F.when((at < F.col(f"b{i}")) & (at >= F.col(f"u{i}")), F.lit(s.low)).otherwise(pick)
            if s.high is not None:
                pick = F.when((at >= F.col(f"b{i}") + F.size(f"v{i}")) & (at < F.col(f"h{i}")), F.lit(s.high)).otherwise(pick)
            picks.append(pick.alias(f"{name}{i}"))
    found = df.agg(*measures).select(*picks).first()
    for i, s in enumerate(slots):
        if found[f"x{i}"] is not None and found[f"y{i}"] is not None:
            s.ends = found[f"x{i}"], found[f"y{i}"]


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], accuracy: int = 10_000, held: int = HELD
) -> dict[str, list[float]]:
    """Linearly interpolated quantiles of each column, nulls left out: two passes, and two more for each narrowing of a very long column."""
    slots = [_Slot(c, float(p)) for c in columns for p in probs]
    _sketch(df, slots, accuracy)
    open_slots = [s for s in slots if s.rows]
    while open_slots:
        while wide := [s for s in open_slots if s.most > max(held, 64)]:
            before = [s.most for s in wide]
            _narrow(df, wide, accuracy)
            if [s.most for s in wide] == before:
                raise ValueError("brackets do not get narrower; ask for a higher accuracy")
        _resolve(df, open_slots)
        open_slots = [s for s in open_slots if s.ends is None]
        for s in open_slots:  # a sketch that missed by more than it promises: over all rows again
            s.low = s.high = None
            s.most = s.rows
    out: dict[str, list[float]] = {c: [] for c in columns}
    for s in slots:
        low, high = s.ends or (None, None)
        out[s.column].append(None if low is None else low + (high - low) * (s.place - s.ranks[0]))
    return out


def with_piece(df: DataFrame, keys: Sequence[str], value: str, pieces: int = PIECES) -> DataFrame:
    """Add ``_piece``, a number that grows with ``value`` and cuts the rows of each key into parts of like size,
    however the values crowd. The edges are approximate quantiles, so a piece holds 1 / ``pieces`` of the rows of its key."""
    probs = F.array(*(F.lit(i / pieces) for i in range(1, pieces)))
    edges = df.groupBy(*keys).agg(F.percentile_approx(value, probs, 10 * pieces).alias("_edges"))
    below = F.size(F.filter("_edges", lambda e: e < F.col(value)))
    return df.join(edges, list(keys)).withColumn("_piece", below).drop("_edges")


def series_quantile(df: DataFrame, value: str, prob: float) -> DataFrame:
    """Exact quantile per symbol, as rows. Equal values are merged first; the values of a symbol are
    ranked piece by piece."""
    merged = df.filter(F.col(value).isNotNull()).groupBy(SYMBOL, value).agg(F.count("*").alias("_count"))
    merged = with_piece(merged, (SYMBOL,), value)
    ranked = prefix_scan(merged, (SYMBOL,), "_piece", value, {"_upto": Running("sum", F.col("_count"))}, totals=True)
    place = (F.col("_upto_total") - 1) * prob
    low, high = F.floor(place), F.ceil(place)
    before = F.col("_upto") - F.col("_count")
    hit = F.col("_upto") > low
    near = ranked.filter((hit & (before <= low)) | ((F.col("_upto") > high) & (before <= high)))
    lowest, highest = F.min(value), F.max(value)
    return near.groupBy(SYMBOL).agg(
        (lowest + (highest - lowest) * F.max(place - low)).alias(f"{value}_quantile")
    )
