"""Values at the edge of their range, and plans that must stay linear and early."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.functions import row_hash
from barloom.operators import backtest, dataset
from barloom.operators.panel import last_bars, number_bars
from barloom.operators.scan import fill_scan
from barloom.plans.charts import dimensionality
from barloom.operators.model import Preparation
from barloom.schema import Layout
from barloom.sources import bars_from_ticks, read_bars

from conftest import START, bars_frame, collected, to_spark, walk


def test_tie_breaks_of_any_size_stay_within_their_microsecond(spark):
    rows = [
        (START, 2**63 - 1, 1.0), (START, -(2**63), 0.5), (START + dt.timedelta(microseconds=1), -(2**63), 2.0),
        (START + dt.timedelta(microseconds=1), 5, 3.0), (START + dt.timedelta(microseconds=1), 2**63 - 1, 4.0),
        (START + dt.timedelta(microseconds=2), -7, 9.0),
    ]
    ticks = spark.createDataFrame(rows, "ts timestamp_ntz, id long, price double")
    bar = bars_from_ticks(ticks, F.lit("a"), "ts", "price", ("ts", "id"), "1 hour").first()
    assert (bar.open, bar.close, bar.volume) == (0.5, 9.0, 6)
    bar = bars_from_ticks(ticks.filter("price < 9"), F.lit("a"), "ts", "price", ("ts", "id"), "1 hour").first()
    assert (bar.open, bar.close) == (0.5, 4.0)


def test_fractional_volume_is_kept(spark, tmp_path):
    (tmp_path / "b.csv").write_text("Date;Open;High;Low;Close;Volume\n2024.01.01 00:00;1;2;0.5;1.5;0.75\n")
    assert read_bars(spark, str(tmp_path / "b.csv"), "s").first().volume == 0.75
    read_bars(spark, str(tmp_path / "b.csv"), "s").write.parquet(str(tmp_path / "p"))
    assert read_bars(spark, str(tmp_path / "p"), fmt="parquet").first().volume == 0.75


def test_bars_within_a_second_have_different_hashes(spark):
    rows = [("a", START + dt.timedelta(milliseconds=300 * k)) for k in range(4)]
    assert spark.createDataFrame(rows, "symbol string, bar_ts timestamp_ntz").select(row_hash(1)).distinct().count() == 4


def test_fill_has_no_frame_that_looks_ahead_over_rows(spark):
    rows = [("a", k // 10, k, None if k % 7 < 4 else float(k)) for k in range(200)]
    df = spark.createDataFrame(rows, "s string, p int, k int, x double")
    filled = fill_scan(df, ("s",), "p", "k", ("x",))
    got = [r.x for r in filled.orderBy("k").collect()]
    known = [r[3] for r in rows]
    want, last = [], next(x for x in known if x is not None)
    for x in known:
        last = last if x is None else x
        want.append(last)
    assert got == want
    windows = [line for line in filled._jdf.queryExecution().optimizedPlan().toString().splitlines() if line.strip(" :+-").startswith("Window")]
    for line in windows:
        if "_first_" not in line:  # over a row per piece
            assert "unboundedfollowing" not in line.lower()


def test_wild_growth_stays_finite(spark, layout):
    rng = np.random.default_rng(3)
    n = 5000
    close = np.exp(np.cumsum(rng.normal(0.5, 1.0, n)) % 20)
    close[::50] *= -1  # returns below -1 turn the sign
    bars = to_spark(spark, bars_frame(close))
    pred = bars.select("symbol", "bar_ts", F.lit("m").alias("model"), F.lit(1).alias("label"), F.lit(1).alias("prediction"))
    got = collected(backtest.equity(pred, bars, layout))
    for c in ("cumulative_return", "buy_hold_return", "running_max", "drawdown", "log_return", "log_max"):
        assert not np.isinf(got[c].astype(float)).any(), c
    factor = 1 + got.strategy_return.to_numpy(float)[1:]
    log = np.cumsum(np.log(np.abs(factor)))
    sign = np.cumprod(np.sign(factor))
    np.testing.assert_allclose(got.log_return.to_numpy(float)[1:], log, rtol=1e-9, atol=1e-7)
    assert (got["sign"].to_numpy(float)[1:] == sign).all()
    top, want = -math.inf, []
    for s, x in zip(sign, log, strict=True):
        top = max(top, x) if s > 0 else top
        want.append(None if top == -math.inf or x - top >= 709 else s * math.exp(x - top) - 1)
    some = [i for i, w in enumerate(want) if w is not None]
    np.testing.assert_allclose(got.drawdown.to_numpy(float)[1:][some], np.array([want[i] for i in some]), rtol=1e-6, atol=1e-6)


def test_negative_and_zero_equity(spark):
    """Without a positive value the maximum is the negative one nearest to zero, or zero."""
    bars = to_spark(spark, bars_frame([1.0, -2.0, -1.0, -4.0, 0.0, 3.0]))
    pred = bars.select("symbol", "bar_ts", F.lit(1).alias("prediction"))
    got = collected(backtest.equity(pred, bars, Layout(every=900, chunk_rows=2, block_rows=2)))
    np.testing.assert_allclose(got.cumulative_return.to_numpy(float)[1:5], [-2, -1, -4, 0])
    np.testing.assert_allclose(got.running_max.to_numpy(float)[1:5], [-2, -1, -1, 0])
    np.testing.assert_allclose(got.drawdown.to_numpy(float)[1:4], [0, 0, 3])


def test_all_rows_and_components_of_the_analysis(spark):
    rng = np.random.default_rng(1)
    values = rng.normal(size=(6000, 3))
    rows = [("a", START + dt.timedelta(seconds=k), k % 2, *map(float, v)) for k, v in enumerate(values)]
    df = spark.createDataFrame(rows, "symbol string, bar_ts timestamp_ntz, target int, x double, y double, z double")
    prepared = Preparation.fit(df, ("x", "y", "z")).model().transform(df)
    found = dimensionality(prepared, 3)
    assert found["scores"].count() == 6000
    variance = found["variance"].collect()
    assert len(variance) == 3 and variance[-1].cumulative == pytest.approx(1)


def test_published_spellings_are_found(spark):
    row = spark.createDataFrame([(4105.0, 7019.0, 30.5, 1.0)], "Close double, Volume_MA double, RSI double, SMA_20 double")
    got = dataset.select_features(row, ("close", "volume_ma_20", "rsi", "sma_20"), keep=()).first()
    assert tuple(got) == (4105.0, 7019.0, 30.5, 1.0)
    ours = spark.createDataFrame([(1.0, 2.0)], "close double, volume_ma_20 double")
    assert tuple(dataset.select_features(ours, ("Close", "Volume_MA"), keep=()).first()) == (1.0, 2.0)


def test_last_bars_of_a_numbered_panel_keep_their_numbers(spark, layout):
    bars = to_spark(spark, walk(300))
    got = collected(last_bars(number_bars(bars, layout), 70, layout))
    assert list(got.bar_no) == list(range(230, 300))


def test_time_range_reaches_the_scan(spark, tmp_path):
    rows = [(START + dt.timedelta(minutes=k), k, float(k)) for k in range(600)]
    spark.createDataFrame(rows, "ts timestamp_ntz, id long, price double").write.parquet(str(tmp_path / "t"))
    bars = bars_from_ticks(
        spark.read.parquet(str(tmp_path / "t")), F.lit("a"), "ts", "price", ("ts", "id"), "1 hour", None,
        "2024-01-01 02:00:00", "2024-01-01 04:00:00",
    )
    assert bars.count() == 2
    assert "GreaterThanOrEqual(ts" in bars._jdf.queryExecution().executedPlan().toString()
