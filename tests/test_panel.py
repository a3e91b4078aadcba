from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pytest
from conftest import assert_same, bars_frame, collected, to_spark, walk
from pyspark.sql import functions as F

from barloom.functions import epoch_micros, epoch_seconds
from barloom.operators.panel import last_bars, measured_layout, number_bars, spread
from barloom.operators.scan import Running, prefix_scan
from barloom.operators.step import compute
from barloom.operators.technical import rsi, sma
from barloom.plans.features import feature_panel
from barloom.schema import Layout
from barloom.sources import read_bars, read_panel, write_panel
from barloom.sources.files import years


def test_numbers_are_dense_over_gaps(spark, layout):
    frame = walk(200, 1)
    frame["bar_ts"] = frame["bar_ts"] + pd.to_timedelta((np.arange(200) // 30) * 3, unit="D")
    got = collected(number_bars(to_spark(spark, frame.sample(frac=1, random_state=1)), layout))
    assert list(got.bar_no) == list(range(200))


def test_numbering_is_kept_when_present(spark, layout):
    numbered = number_bars(to_spark(spark, walk(20)), layout)
    assert number_bars(numbered, layout) is numbered


def test_layout_of_an_irregular_series(spark):
    frame = walk(300, 1)
    frame["bar_ts"] = pd.Timestamp("2024-01-01") + pd.to_timedelta(np.arange(300) ** 2, unit="s")
    found = measured_layout(to_spark(spark, frame), 900, rows=40)
    chunk = (frame.bar_ts.astype("int64") // 10**9 if frame.bar_ts.dtype == "datetime64[ns]" else frame.bar_ts.astype("datetime64[s]").astype("int64")) // found.chunk_seconds
    assert chunk.value_counts().max() <= 40 and found.block_rows == 40
    got = collected(number_bars(to_spark(spark, frame), found))
    assert list(got.bar_no) == list(range(300))


def test_last_bars(spark, layout):
    both = pd.concat([walk(120, 1, "A"), walk(7, 2, "B")])
    got = collected(last_bars(to_spark(spark, both), 10, layout))
    want = both.groupby("symbol").tail(10).sort_values(["symbol", "bar_ts"])
    assert list(got.bar_ts) == list(want.bar_ts)


@pytest.mark.parametrize("how", ["sum", "product", "max", "min", "last"])
def test_prefix_scan(spark, how):
    rng = np.random.default_rng(0)
    frame = pd.DataFrame({"k": ["x"] * 60 + ["y"] * 30, "t": [*range(60), *range(30)], "v": rng.normal(1, 0.3, 90)})
    frame.loc[[0, 17, 60, 61, 80], "v"] = np.nan
    df = spark.createDataFrame(frame).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    df = df.withColumn("piece", F.floor(F.col("t") / 7))
    got = prefix_scan(df, ("k",), "piece", "t", {"r": Running(how, F.col("v"))}).toPandas().sort_values(["k", "t"])
    by = frame.groupby("k").v
    want = {
        "sum": by.cumsum(), "product": by.cumprod(), "max": by.cummax(), "min": by.cummin(), "last": by.ffill(),
    }[how]
    assert_same(got.r, want.groupby(frame.k).ffill())


def test_descending_scan_with_totals(spark):
    df = spark.range(50).select(F.lit("x").alias("k"), F.col("id").alias("t"), F.floor(F.col("id") / 8).alias("piece"))
    one = Running("sum", F.lit(1))
    got = prefix_scan(df, ("k",), "piece", "t", {"n": one}, ascending=False, totals=True).toPandas().sort_values("t")
    assert list(got.n) == list(range(50, 0, -1)) and set(got.n_total) == {50}


def test_each_bar_is_home_once(spark, layout):
    numbered = number_bars(to_spark(spark, walk(200)), layout)
    framed = spread(numbered, layout, back=70, ahead=3)
    assert framed.filter("_home").count() == 200
    block = framed.filter("_block = 2").agg(F.min("bar_no"), F.max("bar_no")).first()
    assert tuple(block) == (128 - 70, 191 + 3)


def test_time_keys_ignore_the_session_zone(spark):
    frame = bars_frame([1.0, 2.0])
    df = to_spark(spark, frame)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        row = df.select(epoch_seconds("bar_ts"), epoch_micros("bar_ts")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert tuple(row) == (1704067200, 1704067200_000000)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_features_take_one_shuffle_from_a_stored_panel(spark, tmp_path, layout):
    write_panel(to_spark(spark, walk(300)), str(tmp_path / "panel"), layout)
    stored = read_panel(spark, str(tmp_path / "panel"))
    plan = plan_of(compute(stored, layout, sma(), rsi()))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert len(re.findall(r"\bSort \[", plan)) == 1


def test_no_window_spans_a_series(spark, layout):
    """Windows over rows are partitioned by symbol and piece; only summaries are by symbol alone."""
    panel = feature_panel(number_bars(to_spark(spark, walk(300)), layout), layout, "full77")
    plan = plan_of(panel)
    assert "SinglePartition" not in plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        found = re.search(r"Window \[[^\[\]]*\], \[([^\[\]]*)\]", line)
        if found and "_chunk" not in found[1] and "_block" not in found[1]:
            below = next(x for x in lines[i + 1 :] if re.search(r"Aggregate|Generate|Scan", x))
            assert "HashAggregate" in below, line


def test_stored_panel_prunes_columns(spark, tmp_path, layout):
    write_panel(to_spark(spark, walk(100)), str(tmp_path / "panel"), layout)
    plan = plan_of(compute(read_panel(spark, str(tmp_path / "panel")), layout, sma((5,))).select("symbol", "sma_5"))
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert "open" not in schema and "volume" not in schema and "close" in schema


def test_time_range_reaches_the_scan(spark, tmp_path):
    to_spark(spark, walk(50)).write.parquet(str(tmp_path / "bars"))
    plan = plan_of(years(read_bars(spark, str(tmp_path / "bars"), fmt="parquet"), 2022, 2025))
    assert "GreaterThanOrEqual(bar_ts,2022-01-01T00:00)" in plan and "LessThan(bar_ts,2026-01-01T00:00)" in plan


def test_stored_years(spark, tmp_path, layout):
    frame = walk(60)
    frame["bar_ts"] = frame["bar_ts"] + pd.to_timedelta(np.arange(60) * 20, unit="D")
    write_panel(to_spark(spark, frame), str(tmp_path / "panel"), layout)
    late = read_panel(spark, str(tmp_path / "panel"), first=2025)
    assert late.count() == (frame.bar_ts.dt.year >= 2025).sum() and "bar_no" not in late.columns
    assert "PartitionFilters: [isnotnull(year" in plan_of(late)
    early = read_panel(spark, str(tmp_path / "panel"), last=2024)
    assert early.count() == (frame.bar_ts.dt.year <= 2024).sum() and "bar_no" in early.columns


def test_one_dominant_symbol_is_many_tasks(spark):
    chosen = Layout(every=900, chunk_rows=500, block_rows=500)
    framed = spread(number_bars(to_spark(spark, walk(5000)), chosen), chosen, back=20)
    sizes = [r["count"] for r in framed.groupBy("symbol", "_block").count().collect()]
    assert len(sizes) == 11 and max(sizes) <= 520 and sum(sizes) == 5000 + 20 * 10
