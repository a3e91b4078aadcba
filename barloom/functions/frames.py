"""Row frames over an ordered window."""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def trailing(order: WindowSpec, k: int) -> WindowSpec:
    """The current row and the k - 1 rows before it."""
    return order.rowsBetween(-(k - 1), 0)


def prior(order: WindowSpec, k: int, skip: int = 0) -> WindowSpec:
    """The k rows before the current one, leaving out the latest ``skip`` of them."""
    return order.rowsBetween(-(k + skip), -(1 + skip))


def full(value: Column, counted: str, frame: WindowSpec, k: int) -> Column:
    """``value`` only where the frame holds k non-null entries of ``counted``."""
    return F.when(F.count(counted).over(frame) == k, value)


# Spark evaluates a sliding frame anew for every row, k steps for k rows. Long windows are therefore put together from
# running frames (extremes) or from short windows (means).
PART = 10
#: Tiles for extremes: a window of k rows uses the largest tile that fits into it.
TILES = tuple(32 * 8**j for j in range(6))


def is_long(k: int) -> bool:
    return k >= 2 * PART and k % PART == 0


def long_extreme(order: WindowSpec, c: str, how: str, k: int, skip: int = 0) -> tuple[dict[str, Column], Column]:
    """Maximum or minimum of the k latest rows, without the latest ``skip``.

    Rows are cut into tiles by their position. Two running frames give each row the extreme from the start of its tile and the one to the end
    of its tile; a window as long as a tile is covered by the latter of its first row and the former of its last row, whatever
    lies between. A longer window is covered by windows of that length that may overlap. So a row costs two steps of
    running frames and at most sixteen look-ups, for any k, and windows share their tiles.

    Returns the columns of a first level and an expression over them for the next level. ``order`` is that of ``panel.block_window``.
    """
    if k < TILES[0]:
        aggregate = F.max(c) if how == "max" else F.min(c)
        return {}, aggregate.over(order.rowsBetween(-(k - 1 + skip), -skip))
    size = max(t for t in TILES if t <= k)
    tile = Window.partitionBy("symbol", "_block", F.floor(F.col("bar_no") / size))
    upto, onward = f"_{how}_{c}_upto_{size}", f"_{how}_{c}_from_{size}"
    extreme = F.max(c) if how == "max" else F.min(c)
    first = {
        upto: extreme.over(tile.orderBy("bar_no").rowsBetween(Window.unboundedPreceding, 0)),
        onward: extreme.over(tile.orderBy(F.desc("bar_no")).rowsBetween(Window.unboundedPreceding, 0)),
    }
    ends = sorted({*range(0, k - size, size), k - size})
    look = lambda name, back: F.lag(name, back).over(order) if back else F.col(name)
    pieces = [look(n, skip + e + more) for e in ends for n, more in ((upto, 0), (onward, size - 1))]
    return first, (F.greatest if how == "max" else F.least)(*pieces)


def long_mean(order: WindowSpec, c: str, k: int) -> tuple[dict[str, Column], Column]:
    """Mean of the non-null values among the k latest rows, in two levels as above.

    Means over the same rows come out bit for bit equal whatever k, so that comparing a shorter with a
    longer mean says "equal" while the series is shorter than both.
    """
    if not is_long(k):
        return {}, F.avg(c).over(trailing(order, k))
    part, seen = f"_sum_{c}_{PART}", f"_seen_{c}"
    first = {
        part: F.sum(c).over(trailing(order, PART)),
        seen: F.count(c).over(order.rowsBetween(Window.unboundedPreceding, 0)),
    }
    pieces = [F.lag(part, at).over(order) if at else F.col(part) for at in range(0, k, PART)]
    total = sum((F.coalesce(p, F.lit(0.0)) for p in pieces[1:]), F.coalesce(pieces[0], F.lit(0.0)))
    rows = F.col(seen) - F.coalesce(F.lag(seen, k).over(order), F.lit(0))
    return first, F.try_divide(total, rows)
