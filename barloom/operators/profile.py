"""Data profiles: summaries, histograms, correlations, volume by price."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions import ratio
from barloom.operators.clean import attach_series
from barloom.operators.moments import class_counts, correlations
from barloom.operators.quantiles import exact_quantiles
from barloom.schema import Layout


def dataset_summary(bars: DataFrame) -> DataFrame:
    return bars.groupBy("symbol").agg(
        F.count("*").alias("rows"), F.min("bar_ts").alias("first_ts"), F.max("bar_ts").alias("last_ts")
    )


def column_summary(df: DataFrame, column: str) -> DataFrame:
    """Mean, sample deviation and range per symbol."""
    return df.groupBy("symbol").agg(
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.min(column).alias("lowest"),
        F.max(column).alias("highest"),
    )


def last_close(bars: DataFrame) -> DataFrame:
    return bars.groupBy("symbol").agg(F.max_by("close", "bar_ts").alias("last_close"))


def _range(value: Column) -> list[Column]:
    """Ends of a histogram; a single value gets a range of width 1 around it."""
    low, high = F.min(value), F.max(value)
    point = low == high
    return [
        F.when(point, low - 0.5).otherwise(low.cast("double")).alias("_low"),
        F.when(point, high + 0.5).otherwise(high.cast("double")).alias("_high"),
    ]


def _bin(value: Column, bins: int) -> Column:
    """Equal-width bins, the last one closed on the right."""
    width = (F.col("_high") - F.col("_low")) / bins
    return F.least(F.floor((value - F.col("_low")) / width), F.lit(bins - 1)).cast("int")


def _complete(counts: DataFrame, ends: DataFrame, keys: Sequence[str], bins: int) -> DataFrame:
    """Edges of every bin, empty ones included."""
    width = (F.col("_high") - F.col("_low")) / bins
    every = ends.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return every.join(counts, [*keys, "bin"], "left").select(
        *keys,
        "bin",
        (F.col("_low") + F.col("bin") * width).alias("left_edge"),
        (F.col("_low") + (F.col("bin") + 1) * width).alias("right_edge"),
        F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows"),
    )


def histogram(df: DataFrame, column: str, layout: Layout, bins: int = 50) -> DataFrame:
    """Rows per bin of a column, each symbol over its own range."""
    value = F.col(column).cast("double")
    known = df.select("symbol", "bar_ts", value.alias("_value")).filter(F.col("_value").isNotNull())
    ends = known.groupBy("symbol").agg(*_range(F.col("_value")))
    placed = attach_series(known, ends, layout).withColumn("bin", _bin(F.col("_value"), bins))
    counts = placed.groupBy("symbol", "bin").agg(F.count("*").alias("rows"))
    return _complete(counts, ends, ["symbol"], bins)


def long_form(df: DataFrame, columns: Sequence[str], *keep: str) -> DataFrame:
    """One row per (row, column) with the value known."""
    entries = F.array(*(F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns))
    return df.select(*keep, F.inline(entries)).filter(F.col("value").isNotNull())


def class_histogram(df: DataFrame, columns: Sequence[str], group: str = "target", bins: int = 30) -> DataFrame:
    """Density histogram per column and class, each over its own range.

    ``group`` is a 0/1 column. Ranges come from one wide aggregate, two rows of numbers; counts from arrays, one per task.
    """
    rows = df.filter(F.col(group).isin(0, 1))
    wide = rows.groupBy(group).agg(
        *(e.alias(f"{n}{i}") for i, c in enumerate(columns) for n, e in zip(("l", "h"), _range(F.col(c).cast("double")), strict=True))
    )
    found = {(i, r[group]): (r[f"l{i}"], r[f"h{i}"]) for r in wide.collect() for i in range(len(columns)) if r[f"l{i}"] is not None}
    counts = class_counts(rows, columns, group, found, bins)
    spark, kind = df.sparkSession, df.schema[group].dataType
    ends = spark.createDataFrame(
        [(i, columns[i], g, *e) for (i, g), e in found.items()], "column int, feature string, _group long, _low double, _high double"
    )
    keys = ["feature", group]
    ends = ends.withColumn(group, F.col("_group").cast(kind)).drop("_group")
    counts = counts.join(F.broadcast(ends.select("column", "feature")).distinct(), "column")  # a row per column
    counts = counts.select("feature", F.col("group").cast(kind).alias(group), "bin", "rows")
    filled = _complete(counts, ends.select(*keys, "_low", "_high"), keys, bins)
    width = F.col("right_edge") - F.col("left_edge")
    every = F.sum("rows").over(Window.partitionBy(*keys))  # over a row per bin
    return filled.select(*keys, "bin", "left_edge", "right_edge", "rows", (F.col("rows") / (every * width)).alias("density"))


def class_means(df: DataFrame, columns: Sequence[str], group: str = "target") -> DataFrame:
    """Mean of each column per class: one wide aggregation, unpivoted afterwards."""
    wide = df.groupBy(group).agg(*(F.avg(F.col(c).cast("double")).alias(f"_{i}") for i, c in enumerate(columns)))
    entries = F.array(*(F.struct(F.lit(c).alias("feature"), F.col(f"_{i}").alias("mean")) for i, c in enumerate(columns)))
    return wide.select(group, F.inline(entries)).filter(F.col("mean").isNotNull()).select("feature", group, "mean")


def volume_profile(bars: DataFrame, layout: Layout, edges: int = 50, close_last: bool = False) -> DataFrame:
    """Volume traded per price range and symbol.

    Ranges are closed on the left and open on the right, so the bars at the highest close fall out
    unless ``close_last`` puts them into the last range.
    """
    bins = edges - 1
    rows = bars.select("symbol", "bar_ts", "close", "volume")
    ends = rows.groupBy("symbol").agg(
        F.min("close").alias("_low"), F.max("close").alias("_high")
    )
    ends = ends.withColumn("_step", (F.col("_high") - F.col("_low")) / bins)
    low, step, close = F.col("_low"), F.col("_step"), F.col("close")
    guess = F.floor(ratio(close - low, step)).cast("int")
    # The quotient can miss an edge by rounding; the edges decide.
    index = (
        F.when(close < low + F.col("_guess") * step, F.col("_guess") - 1)
        .when(close >= low + (F.col("_guess") + 1) * step, F.col("_guess") + 1)
        .otherwise(F.col("_guess"))
    )
    placed = attach_series(rows, ends, layout).withColumn("_guess", guess).withColumn("bin", index)
    if close_last:
        placed = placed.withColumn("bin", F.least(F.coalesce("bin", F.lit(bins - 1)), F.lit(bins - 1)))
    sums = placed.filter(F.col("bin") < bins).groupBy("symbol", "bin").agg(F.sum("volume").alias("_sum"))
    every = ends.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return every.join(sums, ["symbol", "bin"], "left").select(
        "symbol",
        "bin",
        (low + F.col("bin") * step).alias("price_from"),
        (low + (F.col("bin") + 1) * step).alias("price_to"),
        F.coalesce("_sum", F.lit(0).cast("bigint")).alias("volume"),
    )


def volume_against_change(df: DataFrame) -> DataFrame:
    return df.select(
        "symbol", "bar_ts", "volume_ratio", (F.col("price_change") * 100).alias("change_percent"), "target"
    )


def corr_matrix(df: DataFrame, columns: Sequence[str], upper: bool = False) -> DataFrame:
    """Pearson correlation of every pair of columns over the rows that have both, from one matrix of co-moments per task."""
    found = correlations(df, columns)
    if upper:
        found = found.filter("a < b")
    named = F.array(*map(F.lit, columns))
    return found.select(named[F.col("a")].alias("feature_a"), named[F.col("b")].alias("feature_b"), "corr")


def target_corr(df: DataFrame, columns: Sequence[str], target: str = "target") -> DataFrame:
    """Correlation of each feature with the label, weakest first; null (and first) where one of the two does not vary.

    From the co-moments too: Spark's ``corr`` divides by zero for a column that does not vary, whatever is asked of the quotient.
    """
    features = [c for c in columns if c != target]
    found = correlations(df, [*features, target]).filter((F.col("a") < len(features)) & (F.col("b") == len(features)))
    named = F.array(*map(F.lit, [*features, target]))
    return found.select(named[F.col("a")].alias("feature"), "corr").orderBy(F.abs("corr"), "feature")


def quantile_bins(df: DataFrame, columns: Sequence[str], bins: int = 5) -> dict[str, list[float]]:
    """Distinct quantile edges of each column."""
    probs = [i / bins for i in range(bins + 1)]
    return {c: sorted({e for e in edges if e is not None}) for c, edges in exact_quantiles(df, columns, probs).items()}


def error_by_quantile(df: DataFrame, columns: Sequence[str], error: str = "error", bins: int = 5) -> DataFrame:
    """Mean of ``error`` per quantile range of each column; ranges are closed on the right, the
    lowest value belongs to the first."""
    edges = quantile_bins(df, columns, bins)
    long = long_form(df, columns, error)
    place = F.lit(None).cast("int")
    for c in columns:
        inner = edges[c][1:-1]
        index = sum((F.when(F.col("value") > F.lit(e), 1).otherwise(0) for e in inner), F.lit(0))
        place = F.when(F.col("feature") == c, index).otherwise(place)
    binned = long.withColumn("bin", place.cast("int"))
    return binned.groupBy("feature", "bin").agg(F.count("*").alias("rows"), F.avg(error).alias("error_rate"))
