"""Stored series that grow: numbered bars, and a side table with a row per block of each series.

The side table holds what features over a whole series need of a block (rows, sums, moments of the close). Features read the bars once and the side table
instead of summing the bars up again, and appending bars costs what the new bars cost: they get the positions behind the last ones,
and only the blocks that they fall into get new rows. Rows of the side table are never changed; of several rows of a block the one of the latest append counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.operators.panel import BAR_NO, BLOCK, CHUNK, SYMBOL, TS, number_bars, with_chunk
from barloom.operators.step import SERIES_SUMS, Step, block_parts, compute
from barloom.schema import Layout
from barloom.session import materialize

_SUMS = tuple(f"_{n}" for n in SERIES_SUMS)
_MOMENTS = ("_n_close", "_mean_close", "_m2_close")


@dataclass(frozen=True)
class SeriesStore:
    """Folders ``bars`` and ``blocks`` under ``path``. One writer at a time."""

    spark: SparkSession
    path: str
    layout: Layout

    @staticmethod
    def create(bars: DataFrame, path: str, layout: Layout) -> SeriesStore:
        """Store a panel. ``bars`` is read once: positions and blocks come from the stored rows."""
        store = SeriesStore(bars.sparkSession, path, layout)
        store._add(number_bars(materialize(bars), layout), 0, None)
        return store

    def bars(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/bars")

    def parts(self) -> DataFrame:
        """The current row of each block."""
        rows = self.spark.read.parquet(f"{self.path}/blocks")
        values = [c for c in rows.columns if c not in (SYMBOL, BLOCK)]
        latest = F.max(F.struct("_append", *(c for c in values if c != "_append"))).alias("_latest")
        return rows.groupBy(SYMBOL, BLOCK).agg(latest).select(SYMBOL, BLOCK, "_latest.*")

    def compute(self, *steps: Step) -> DataFrame:
        """Features of all stored bars: one pass over them besides the side table."""
        return compute(self.bars(), self.layout, *steps, parts=self.parts().drop("_append", "_last_ts", "_last_close"))

    def tail(self, n: int, *steps: Step) -> DataFrame:
        """Features of the last ``n`` bars of each series, from those bars and what the steps reach back for.

        The side table says from which position on bars are needed and gives a time before which none is; the time is part of the scan, so older files and row groups
        are not opened. Steps that sum over a series need their block from its start, and the bars that reach into it.
        """
        size, reach = self.layout.block_rows, max((step.back for step in steps), default=0)
        whole_blocks = any(step.series for step in steps)
        by_symbol = Window.partitionBy(SYMBOL)  # over a row per block
        parts = self.parts().withColumn("_total", F.sum("_rows").over(by_symbol))
        first = F.greatest(F.col("_total") - n - reach, F.lit(0))
        if whole_blocks:
            first = F.greatest(F.floor(first / size) * size - reach, F.lit(0))
        parts = parts.withColumn("_first", first.cast("bigint"))
        older = F.when((F.col(BLOCK) + 1) * size <= F.col("_first"), F.col("_last_ts"))
        needed = materialize(parts.groupBy(SYMBOL).agg(F.max("_total").alias("_total"), F.max("_first").alias("_first"), F.max(older).alias("_after")))
        bars = self.bars()
        # The earliest of the times; a series that is needed from its start has none.
        bound = needed.agg(F.min("_after").alias("after"), F.count_if(F.col("_after").isNull()).alias("open")).first()
        if bound["after"] is not None and not bound["open"]:
            bars = bars.filter(F.col(TS) > F.lit(bound["after"]).cast("timestamp_ntz"))
        kept = bars.join(needed.select(SYMBOL, "_first"), SYMBOL).filter(F.col(BAR_NO) >= F.col("_first")).drop("_first")
        featured = compute(kept, self.layout, *steps, parts=self.parts().drop("_append", "_last_ts", "_last_close"))
        last = featured.join(needed.select(SYMBOL, "_total"), SYMBOL).filter(F.col(BAR_NO) >= F.col("_total") - n)
        return last.drop("_total")

    def append(self, bars: DataFrame) -> None:
        """Add later bars. A bar that is not later than all stored ones of its symbol is an error, found before anything is written."""
        parts = self.parts()
        by_symbol = Window.partitionBy(SYMBOL)  # over a row per block
        last = parts.withColumn("_stored", F.sum("_rows").over(by_symbol)).withColumn("_newest", F.max(BLOCK).over(by_symbol))
        last = materialize(last.filter(F.col(BLOCK) == F.col("_newest")))
        fresh = number_bars(materialize(bars), self.layout)
        # Series are joined to their ends by (symbol, chunk): a long series of new bars is spread over tasks.
        chunked = with_chunk(fresh, self.layout)
        ends = last.select(SYMBOL, "_stored", "_last_ts", "_last_close")
        offsets = chunked.groupBy(SYMBOL, CHUNK).agg(F.min(TS).alias("_first")).join(ends, SYMBOL, "left")
        if not offsets.filter(F.col("_first") <= F.col("_last_ts")).isEmpty():
            raise ValueError("bars must be later than the stored bars of their symbol")
        placed = chunked.join(offsets, [SYMBOL, CHUNK]).withColumn(BAR_NO, F.col(BAR_NO) + F.coalesce("_stored", F.lit(0)))
        number = (self.spark.read.parquet(f"{self.path}/blocks").agg(F.max("_append")).first()[0] or 0) + 1
        self._add(placed.select(*fresh.columns), number, last)

    def _add(self, numbered: DataFrame, append: int, last: DataFrame | None) -> None:
        stored = materialize(numbered)
        parts = block_parts(self._with_last(stored, last), self.layout)
        ends = stored.withColumn(BLOCK, F.floor(F.col(BAR_NO) / self.layout.block_rows))
        ends = ends.groupBy(SYMBOL, BLOCK).agg(F.max(TS).alias("_last_ts"), F.max_by("close", BAR_NO).alias("_last_close"))
        if last is not None:
            parts = _continued(parts, last)
        blocks = parts.join(ends, [SYMBOL, BLOCK]).withColumn("_append", F.lit(append))
        # The side table first: a bar is in the store when its block is.
        blocks.write.mode("append").parquet(f"{self.path}/blocks")
        stored.write.mode("append").parquet(f"{self.path}/bars")

    def _with_last(self, stored: DataFrame, last: DataFrame | None) -> DataFrame:
        """New bars behind the last stored one of their series, which gives the first new bar its direction."""
        if last is None:
            return stored
        kinds = {f.name: f.dataType for f in stored.schema}
        before = last.select(
            SYMBOL,
            (F.col("_stored") - 1).cast(kinds[BAR_NO]).alias(BAR_NO),
            F.col("_last_close").alias("close"),
            F.lit(None).cast(kinds["volume"]).alias("volume"),
            F.lit(True).alias("_known"),
        )
        new = stored.select(SYMBOL, BAR_NO, "close", "volume", F.lit(False).alias("_known"))
        return new.unionByName(before.join(new.select(SYMBOL).distinct(), SYMBOL, "left_semi"))


def _continued(parts: DataFrame, last: DataFrame) -> DataFrame:
    """Parts of new bars, added to those of the block that they continue."""
    old = last.select(SYMBOL, BLOCK, *(F.col(c).alias(f"_old{c}") for c in ("_rows", *_SUMS, *_MOMENTS)))
    joined = parts.join(old, [SYMBOL, BLOCK], "left")
    before = F.coalesce("_old_n_close", F.lit(0))
    n = F.col("_n_close") + before
    both = (F.col("_n_close") > 0) & (before > 0)
    gap = F.col("_mean_close") - F.col("_old_mean_close")
    mean = F.when(both, F.col("_old_mean_close") + gap * F.col("_n_close") / n).otherwise(F.coalesce("_mean_close", "_old_mean_close"))
    spread = F.when(both, gap * gap * F.col("_n_close") * before / n).otherwise(0.0)
    m2 = F.coalesce("_m2_close", F.lit(0.0)) + F.coalesce("_old_m2_close", F.lit(0.0)) + spread
    added = lambda c: F.coalesce(F.col(c) + F.col(f"_old{c}"), c, f"_old{c}").alias(c)
    return joined.select(
        SYMBOL, BLOCK, *map(added, ("_rows", *_SUMS)), n.alias("_n_close"), mean.alias("_mean_close"), m2.alias("_m2_close")
    )
