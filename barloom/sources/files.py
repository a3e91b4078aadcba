"""Bar files and stored panels."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators.panel import BAR_NO, number_bars
from barloom.schema import BAR_SCHEMA, PRICES, Layout

_CSV_SCHEMA = T.StructType(
    [
        T.StructField("Date", T.StringType()),
        *(T.StructField(p.title(), T.DoubleType()) for p in PRICES),
        T.StructField("Volume", T.DoubleType()),
    ]
)


def read_bars(
    spark: SparkSession, path: str, symbol: str = "series", fmt: str = "csv", time_format: str = "yyyy.MM.dd HH:mm"
) -> DataFrame:
    """Bars of one instrument from ``;``-separated text, or a panel from Parquet.

    Text has its volume as a double, as fractions occur; Parquet keeps the type it was stored with.
    """
    if fmt == "parquet":
        stored = spark.read.parquet(path)
        return stored.select(*(F.col(f.name) if f.name == "volume" else F.col(f.name).cast(f.dataType) for f in BAR_SCHEMA))
    raw = spark.read.schema(_CSV_SCHEMA).option("sep", ";").option("header", True).csv(path)
    return raw.select(
        F.lit(symbol).alias("symbol"),
        F.to_timestamp_ntz("Date", F.lit(time_format)).alias("bar_ts"),
        *(F.col(p.title()).alias(p) for p in PRICES),
        F.col("Volume").alias("volume"),
    )


def write_bars(bars: DataFrame, path: str, time_format: str = "yyyy.MM.dd HH:mm") -> None:
    """Bars of one instrument as ``;``-separated text, as ``read_bars`` takes them."""
    shown = bars.select(
        F.date_format("bar_ts", time_format).alias("Date"),
        *(F.col(c).alias(c.title()) for c in (*PRICES, "volume")),
    )
    shown.write.mode("overwrite").option("sep", ";").option("header", True).csv(path)


def unique_bars(bars: DataFrame) -> DataFrame:
    """One bar per (symbol, bar_ts); of several, the smallest by all values."""
    values = [c for c in bars.columns if c not in ("symbol", "bar_ts")]
    same = Window.partitionBy("symbol", "bar_ts").orderBy(*values)
    return bars.withColumn("_place", F.row_number().over(same)).filter("_place = 1").select(*bars.columns)


def time_range(bars: DataFrame, start: dt.datetime | str, end: dt.datetime | str) -> DataFrame:
    """Bars in [start, end), as a plain comparison that reaches the file scan."""
    lower, upper = (F.lit(str(x)).cast("timestamp_ntz") for x in (start, end))
    return bars.filter((F.col("bar_ts") >= lower) & (F.col("bar_ts") < upper))


def years(bars: DataFrame, first: int, last: int) -> DataFrame:
    return time_range(bars, f"{first}-01-01 00:00:00", f"{last + 1}-01-01 00:00:00")


def write_panel(bars: DataFrame, path: str, layout: Layout, mode: str = "overwrite") -> None:
    """Store a numbered panel, split by year. Later feature runs then need one shuffle only."""
    numbered = number_bars(bars, layout).withColumn("year", F.year("bar_ts"))
    numbered.write.mode(mode).partitionBy("year").parquet(path)


def read_panel(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """A stored panel, of the years ``first`` to ``last`` only; other years are not opened.

    Cut at the front, a series begins with the first bar read, so the stored positions are left out.
    """
    stored = spark.read.parquet(path)  # the type of the volume is the stored one
    if last is not None:
        stored = stored.filter(F.col("year") <= last)
    if first is not None:
        return stored.filter(F.col("year") >= first).drop("year", BAR_NO)
    return stored.drop("year")
