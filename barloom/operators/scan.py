"""Ordered scans over series of any length.

Nothing here puts a whole series into one task. Rows carry a piece number (``piece``) that grows
with the order and bounds the rows per (keys, piece). A scan runs inside each piece; one summary
row per piece is carried forward over the pieces and joined back on (keys, piece), the columns the
rows are already partitioned by.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_START, _END = Window.unboundedPreceding, Window.unboundedFollowing


@dataclass(frozen=True)
class Running:
    """A running aggregate of ``value``: sum, product, max, min or last (last non-null)."""

    how: str
    value: Column

    def aggregate(self, order: Column | None = None) -> Column:
        """Total of a piece."""
        if self.how == "last":
            return F.max_by(self.value, F.when(self.value.isNotNull(), order))
        return _AGGREGATE[self.how](self.value)

    def over(self, frame) -> Column:
        if self.how == "last":
            return F.last(self.value, ignorenulls=True).over(frame)
        return _AGGREGATE[self.how](self.value).over(frame)

    def combine(self, before: Column, local: Column) -> Column:
        if self.how == "last":
            return F.coalesce(local, before)
        if self.how in ("max", "min"):
            return (F.greatest if self.how == "max" else F.least)(before, local)
        if self.how == "sum":
            return F.coalesce(before + local, before, local)
        return F.coalesce(before * local, before, local)


_AGGREGATE = {"sum": F.sum, "product": F.product, "max": F.max, "min": F.min}


def _carried(
    parts: DataFrame, keys: Sequence[str], piece: str, running: Mapping[str, Running], ascending: bool
) -> DataFrame:
    """From the aggregate of each piece: that of all earlier pieces, and that of all pieces."""
    order = F.col(piece).asc() if ascending else F.col(piece).desc()
    pieces = Window.partitionBy(*keys).orderBy(order)
    columns = []
    for n, r in running.items():
        part = Running(r.how, F.col(f"_{n}"))
        columns += [
            part.over(pieces.rowsBetween(_START, -1)).alias(f"_{n}"),
            part.over(pieces.rowsBetween(_START, _END)).alias(f"{n}_total"),
        ]
    return parts.select(*keys, piece, *columns)


def prefix_scan(
    df: DataFrame,
    keys: Sequence[str],
    piece: str,
    order: str,
    running: Mapping[str, Running],
    *,
    ascending: bool = True,
    totals: bool = False,
) -> DataFrame:
    """Add running aggregates over all rows of ``keys`` up to and including the current one.

    ``piece`` must grow with ``order`` and (keys, order) must be unique. With ``totals`` each
    aggregate also comes for the whole series, as ``<name>_total``.
    """
    by = F.col(order).asc() if ascending else F.col(order).desc()
    local = Window.partitionBy(*keys, piece).orderBy(by).rowsBetween(_START, 0)
    position = F.col(order)
    if not ascending and any(r.how == "last" for r in running.values()):
        raise ValueError("a running 'last' needs ascending order")
    parts = df.groupBy(*keys, piece).agg(*(r.aggregate(position).alias(f"_{n}") for n, r in running.items()))
    scanned = df.withColumns({n: r.over(local) for n, r in running.items()})
    joined = scanned.join(_carried(parts, keys, piece, running, ascending), [*keys, piece], "left")
    return joined.select(
        *df.columns,
        *(r.combine(F.col(f"_{n}"), F.col(n)).alias(n) for n, r in running.items()),
        *(f"{n}_total" for n in running if totals),
    )


def fill_scan(df: DataFrame, keys: Sequence[str], piece: str, order: str, columns: Sequence[str]) -> DataFrame:
    """Fill nulls forward, then the leading nulls backward from the first value."""
    inside = Window.partitionBy(*keys, piece).orderBy(order)
    position = F.col(order)
    ends = []
    for c in columns:
        known = F.when(F.col(c).isNotNull(), position)
        ends += [F.max_by(c, known).alias(f"_last_{c}"), F.min_by(c, known).alias(f"_first_{c}")]
    pieces = Window.partitionBy(*keys).orderBy(piece)
    carried = (
        df.groupBy(*keys, piece)
        .agg(*ends)
        .select(
            *keys,
            piece,
            *(
                F.last(f"_last_{c}", ignorenulls=True).over(pieces.rowsBetween(_START, -1)).alias(f"_before_{c}")
                for c in columns
            ),
            # Own piece included: a row that nothing before it fills lies before the first known value of its piece.
            *(
                F.first(f"_first_{c}", ignorenulls=True).over(pieces.rowsBetween(0, _END)).alias(f"_after_{c}")
                for c in columns
            ),
        )
    )
    filled = {
        c: F.coalesce(
            F.last(c, ignorenulls=True).over(inside.rowsBetween(_START, 0)),
            F.col(f"_before_{c}"),
            F.col(f"_after_{c}"),
        )
        for c in columns
    }
    return df.join(carried, [*keys, piece], "left").withColumns(filled).select(*df.columns)


def pooled(
    parts: DataFrame, keys: Sequence[str], piece: str, names: Iterable[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Mean and sample deviation over a whole series, from count (``_n_``), mean (``_mean_``) and squared
    deviation (``_m2_``) of its pieces.

    The result repeats them on each piece, so that a join back to the rows runs on (keys, piece) and a
    series with most of the rows does not land in one task.
    """
    series = Window.partitionBy(*keys)
    out = []
    for name in names:
        n, mean, m2 = (F.col(f"_{part}_{name}") for part in ("n", "mean", "m2"))
        total = F.sum(n).over(series)
        center = F.try_divide(F.sum(n * mean).over(series), total)
        out.append((name, n, mean, m2, total, center))
    staged = parts.withColumns({f"_center_{name}": center for name, *_, center in out})
    result = []
    for name, n, mean, m2, total, _ in out:
        center = F.col(f"_center_{name}")
        spread = F.sum(m2 + n * (mean - center) * (mean - center)).over(series)
        result += [
            center.alias(f"{name}_mean"),
            F.sqrt(F.try_divide(spread, F.when(total > 1, total - 1))).alias(f"{name}_std"),
        ]
    return staged.select(*keys, piece, *keep, *result)
