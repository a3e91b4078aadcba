"""Every feature against pandas, with blocks much shorter than the series."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pytest
from conftest import assert_same, bars_frame, collected, to_spark, walk

from barloom.functions import display_name
from barloom.operators import fibonacci, label, structure, technical, volume
from barloom.operators.panel import tile_plan, warm_up
from barloom.operators.step import compute
from barloom.plans.features import STEPS, feature_panel, full77_steps
from barloom.schema import FEATURE_SETS, FULL77, Layout


def expected(b: pd.DataFrame) -> pd.DataFrame:
    """The definitions, in pandas, for one series."""
    o, h, lo, c, v = b.open, b.high, b.low, b.close, b.volume.astype(float)
    e = pd.DataFrame(index=b.index)

    def flag(x):
        return x.astype(int)

    e["rolling_high"], e["rolling_low"] = h.rolling(100, 1).max(), lo.rolling(100, 1).min()
    width = e.rolling_high - e.rolling_low
    e["price_range"] = width
    for name, r in {"0": 0, "236": 0.236, "382": 0.382, "500": 0.5, "618": 0.618, "786": 0.786, "1000": 1}.items():
        e[f"fib_{name}"] = e.rolling_high - r * width
    for name in ("236", "382", "500", "618", "786"):
        e[f"dist_to_fib_{name}"] = (c - e[f"fib_{name}"]) / width
    e["fib_position"] = (c - e.rolling_high) / width
    e["swing_high"] = flag(h == h.rolling(11, center=True).max())
    e["swing_low"] = flag(lo == lo.rolling(11, center=True).min())
    top, bottom = h.shift(1).rolling(10).max(), lo.shift(1).rolling(10).min()
    e["higher_high"], e["lower_high"] = flag(h > top), flag(h < top)
    e["lower_low"], e["higher_low"] = flag(lo < bottom), flag(lo > bottom)
    e["bos_bullish"] = flag(c > h.shift(1).rolling(20).max().shift(1))
    e["bos_bearish"] = flag(c < lo.shift(1).rolling(20).min().shift(1))
    was_high, was_low = e.higher_high.shift(1, fill_value=0), e.lower_low.shift(1, fill_value=0)
    e["choch"] = (was_high & e.lower_low) | (was_low & e.higher_high)
    e["resistance_level"], e["support_level"] = h.rolling(50, 1).max(), lo.rolling(50, 1).min()
    e["near_resistance"] = flag(c > e.resistance_level * 0.995)
    e["near_support"] = flag(c < e.support_level * 1.005)
    before_top, before_bottom = e.resistance_level.shift(1), e.support_level.shift(1)
    e["liquidity_sweep_up"] = flag((h > before_top) & (c < before_top))
    e["liquidity_sweep_down"] = flag((lo < before_bottom) & (c > before_bottom))
    e["bullish_ob"] = flag((c > o) & (c - o > c.std() * 0.5))
    e["bearish_ob"] = flag((c < o) & (o - c > c.std() * 0.5))
    e["fvg_bullish"], e["fvg_bearish"] = flag(lo > h.shift(2)), flag(h < lo.shift(2))
    e["volume_ma_10"], e["volume_ma_20"] = v.rolling(10, 1).mean(), v.rolling(20, 1).mean()
    e["volume_ratio"], e["volume_trend"] = v / e.volume_ma_20, flag(v > e.volume_ma_10)
    e["price_change"] = c.pct_change()
    e["volume_price_corr"] = v.rolling(20, 1).corr(e.price_change.abs()).fillna(0)
    e["obv"] = (np.sign(c.diff()) * v).cumsum()
    e["obv_ma"] = e.obv.rolling(20, 1).mean()
    e["obv_trend"] = flag(e.obv > e.obv_ma)
    e["vwap"] = (c * v).cumsum() / v.cumsum()
    e["dist_to_vwap"] = (c - e.vwap) / e.vwap
    for k in (5, 10, 20, 50, 100):
        e[f"sma_{k}"] = c.rolling(k, 1).mean()
        e[f"ema_{k}"] = c.ewm(span=k, adjust=False).mean()
    e["price_above_sma20"], e["price_above_sma50"] = flag(c > e.sma_20), flag(c > e.sma_50)
    e["ma_cross_10_20"], e["ma_cross_20_50"] = flag(e.sma_10 > e.sma_20), flag(e.sma_20 > e.sma_50)
    d = c.diff()
    gain, loss = d.where(d > 0, 0).rolling(14, 1).mean(), (-d.where(d < 0, 0)).rolling(14, 1).mean()
    e["rsi"] = 100 - 100 / (1 + gain / (loss + 1e-10))
    e["rsi_overbought"], e["rsi_oversold"] = flag(e.rsi > 70), flag(e.rsi < 30)
    e["macd"] = c.ewm(span=12, adjust=False).mean() - c.ewm(span=26, adjust=False).mean()
    e["macd_signal"] = e.macd.ewm(span=9, adjust=False).mean()
    e["macd_histogram"], e["macd_bullish"] = e.macd - e.macd_signal, flag(e.macd > e.macd_signal)
    e["bb_middle"], std = c.rolling(20, 1).mean(), c.rolling(20, 1).std()
    e["bb_upper"], e["bb_lower"] = e.bb_middle + 2 * std, e.bb_middle - 2 * std
    e["bb_width"] = (e.bb_upper - e.bb_lower) / e.bb_middle
    e["bb_position"] = (c - e.bb_lower) / (e.bb_upper - e.bb_lower + 1e-10)
    e["bb_squeeze"] = flag(e.bb_width < e.bb_width.rolling(50, 1).mean() * 0.8)
    ranges = [h - lo, (h - c.shift(1)).abs(), (lo - c.shift(1)).abs()]
    e["true_range"] = pd.concat(ranges, axis=1).max(axis=1)
    e["atr"] = e.true_range.rolling(14, 1).mean()
    e["atr_ratio"] = e.atr / c
    low14, high14 = lo.rolling(14, 1).min(), h.rolling(14, 1).max()
    e["stoch_k"] = 100 * (c - low14) / (high14 - low14 + 1e-10)
    e["stoch_d"] = e.stoch_k.rolling(3, 1).mean()
    for n in (5, 10, 20):
        e[f"momentum_{n}"] = c.pct_change(n)
    e["volatility_20"] = c.pct_change().rolling(20, 1).std()
    e["target"] = flag(c.shift(-6) / c - 1 > 0.001)
    return e


@pytest.fixture(scope="module")
def two_series():
    a, b = walk(330, 1, "A"), walk(150, 2, "B")
    b["bar_ts"] = b["bar_ts"] + pd.to_timedelta(np.arange(150) // 25, unit="D")  # with gaps
    return a, b


@pytest.fixture(scope="module")
def full(spark, layout, two_series):
    mixed = pd.concat(two_series).sample(frac=1, random_state=3)
    return collected(feature_panel(to_spark(spark, mixed), layout, "full77"))


def test_all_features_match_pandas(full, two_series):
    for frame in two_series:
        want = expected(frame.reset_index(drop=True))
        got = full[full.symbol == frame.symbol.iloc[0]].reset_index(drop=True)
        for c in want.columns:
            try:
                assert_same(got[c], want[c])
            except AssertionError as e:
                raise AssertionError(f"{c}: {e}") from e


def test_full77_is_complete(full):
    assert len(FULL77) == 77 and set(FULL77) <= set(full.columns)


def test_feature_set_sizes():
    assert {n: len(c) for n, c in FEATURE_SETS.items()} == {"full77": 77, "core24": 24, "core35": 35, "mini8": 8}


@pytest.mark.parametrize("name", ["core24", "core35", "mini8"])
def test_smaller_sets_agree_with_the_full_one(spark, layout, two_series, full, name):
    panel = collected(feature_panel(to_spark(spark, pd.concat(two_series)), layout, name))
    special = {"fib_position"} | ({"atr", "atr_ratio"} if name == "core24" else set())
    for c in FEATURE_SETS[name]:
        if c in full.columns and c not in special:
            assert_same(panel[c], full[c])
    if name != "mini8":
        assert_same(panel["fib_position"], full["fib_position"] + 1)
    if name == "core24":
        high_low = two_series[0].high - two_series[0].low
        assert_same(panel[panel.symbol == "A"]["atr"], high_low.rolling(14, 1).mean())


def test_block_size_does_not_matter(spark, two_series, full):
    whole = Layout(every=900, chunk_rows=100_000, block_rows=100_000)
    other = collected(feature_panel(to_spark(spark, pd.concat(two_series)), whole, "full77"))
    for c in FULL77:
        assert_same(other[c], full[c], 1e-9)


def test_no_feature_sees_the_future(spark, layout, two_series, full):
    """Cutting later bars changes nothing, except for the order blocks, whose threshold is global."""
    head = two_series[0].iloc[:200]
    cut = collected(feature_panel(to_spark(spark, head), layout, "full77"))
    before = full[full.symbol == "A"].reset_index(drop=True).iloc[:200]
    for c in FULL77:
        if c not in ("bullish_ob", "bearish_ob"):
            assert_same(cut[c], before[c], 1e-9)


def test_price_scale(spark, layout, two_series, full):
    scaled = two_series[0].copy()
    scaled[["open", "high", "low", "close"]] *= 4.0
    got = collected(feature_panel(to_spark(spark, scaled), layout, "full77"))
    before = full[full.symbol == "A"].reset_index(drop=True)
    for c in ("rsi", "stoch_k", "momentum_10", "dist_to_vwap", "bullish_ob", "choch", "target"):
        assert_same(got[c], before[c], 1e-6)


def run(spark, frame, *steps, layout=Layout(every=900, chunk_rows=8, block_rows=8)):
    return collected(compute(to_spark(spark, frame), layout, *steps))


def test_worked_example(spark):
    frame = bars_frame([10, 11, 12, 11, 11, 13], volume=[5, 6, 7, 8, 9, 10])
    got = run(
        spark, frame, technical.rsi(), volume.on_balance_volume(), technical.ema((3,)), label.target(2, 0.001)
    )
    assert_same(got.rsi, [0, 99.99999998, 99.999999985, 66.66666665777777, 66.66666665555556, 79.9999999904], 1e-11)
    assert_same(got.obv, [None, 6, 13, 5, 5, 15])
    assert_same(got.ema_3, [10, 10.5, 11.25, 11.125, 11.0625, 12.03125])
    assert list(got.target) == [1, 0, 0, 1, 0, 0]


def test_ramp(spark):
    got = run(spark, bars_frame(np.arange(1.0, 31.0)), technical.rsi(), structure.trend_flags())
    assert got.rsi[0] == 0 and got.rsi_oversold[0] == 1
    assert (got.rsi[1:] > 99.99).all()
    assert list(got.higher_high) == [0] * 10 + [1] * 20


def test_flat_series_has_no_failures(spark):
    flat = bars_frame(np.full(40, 5.0), spread=0.0, volume=np.full(40, 3))
    got = run(spark, flat, *full77_steps(), label.target())
    assert got.fib_position.isna().all() and (got.volume_price_corr == 0).all()
    assert (got.volatility_20[2:] == 0).all() and (got.target == 0).all()
    assert (got.obv[1:] == 0).all() and (got.macd.abs() < 1e-12).all()


def test_zero_prices(spark):
    close = np.array([1.0, 0.0, 2.0, 0.0, 0.0, 3.0, 1.0])
    got = run(spark, bars_frame(close, spread=0.0), technical.momentum((1,)), label.target(1))
    assert_same(got.momentum_1, [None, -1, None, -1, None, None, 1 / 3 - 1])
    assert list(got.target) == [0, 1, 0, 0, 1, 0, 0]


def test_session_vwap(spark, layout):
    frame = walk(300, 8)
    got = collected(volume.session_vwap(to_spark(spark, frame), layout))
    by_day = frame.assign(pv=frame.close * frame.volume).groupby(frame.bar_ts.dt.date)
    assert_same(got.session_vwap, by_day.pv.cumsum() / by_day.volume.cumsum())


def test_display_name(spark):
    assert spark.sql("SELECT 'cv_f1_mean' AS m").select(display_name("m")).first()[0] == "Cv F1 Mean"


def test_single_bar(spark):
    got = run(spark, bars_frame([7.0]), *full77_steps(), label.target())
    assert np.isnan(got.bb_upper[0]) and np.isnan(got.price_change[0]) and np.isnan(got.obv[0])
    assert got.rsi[0] == 0 and got.ema_100[0] == 7 and got.target[0] == 0


def test_tail_can_stay_unlabelled(spark, layout):
    df = to_spark(spark, walk(50, 4))
    open_ended = compute(df, layout, label.target(drop_unlabelled=True))
    assert label.labelled(open_ended).count() == 44
    assert {r["target"]: r["rows"] for r in label.label_distribution(open_ended).collect()}[None] == 6


def test_trailing_order_block_option(spark, layout):
    frame = walk(120, 5)
    got = collected(compute(to_spark(spark, frame), layout, structure.order_blocks(window=30)))
    limit = frame.close.rolling(30, 2).std() * 0.5
    assert_same(got.bullish_ob, ((frame.close - frame.open) > limit).astype(int))


def test_fibonacci_anchor_is_checked():
    with pytest.raises(ValueError):
        fibonacci.fibonacci(anchor="middle")


@pytest.mark.parametrize("span", [2, 5, 9, 26, 100])
def test_long_exponential_average(spark, span):
    """Many tiles and several blocks."""
    frame = walk(9000, 6)
    chosen = Layout(every=900, chunk_rows=2000, block_rows=2500)
    got = collected(compute(to_spark(spark, frame), chosen, technical.ema((span,))))
    assert_same(got[f"ema_{span}"], frame.close.ewm(span=span, adjust=False).mean(), 1e-12)


def test_tile_plan_nests():
    plan = tile_plan([2, 5, 9, 12, 20, 26, 50, 100, 500])
    sizes = [size for size, _ in plan]
    assert all(b % a == 0 for a, b in zip(sizes, sizes[1:]))
    for size, spans in plan:
        for span in spans:
            decay = 1 - 2 / (span + 1)
            assert warm_up(span) <= size and size * -np.log10(decay) < 260


def test_step_sets_declare_their_reach():
    for name, steps in STEPS.items():
        assert steps(), name
        assert all(s.ahead == 0 for s in steps() if name != "full77")


@pytest.mark.parametrize("window", [31, 32, 50, 100, 257, 500])
def test_extremes_of_any_window(spark, layout, window):
    """Across tiles, blocks and two series, with missing values; ``skip`` leaves out the latest bar."""
    frame = pd.concat([walk(1200, 3, "A"), walk(300, 4, "B")])
    frame.loc[frame.index % 7 == 0, "high"] = np.nan
    df = to_spark(spark, frame)
    step = structure.liquidity(window)
    got = collected(compute(df, Layout(every=900, chunk_rows=40, block_rows=2 * window + 3), step, fibonacci.fibonacci(window)))
    ordered = frame.sort_values(["symbol", "bar_ts"])
    by = ordered.groupby("symbol", sort=False)
    top = by.high.transform(lambda x: x.rolling(window, min_periods=1).max())
    bottom = by.low.transform(lambda x: x.rolling(window, min_periods=1).min())
    assert_same(got.resistance_level, top.to_numpy())
    assert_same(got.support_level, bottom.to_numpy())
    assert_same(got.rolling_high, top.to_numpy())
    before = by.low.transform(lambda x: x.rolling(window, min_periods=1).min().shift(1))
    swept = (ordered.low < before) & (ordered.close > before)
    assert got.liquidity_sweep_down.tolist() == swept.astype(int).tolist()


def test_no_sliding_frame_of_a_long_window(spark, layout):
    """The frames of the extremes are running ones; their number does not grow with the window."""
    frames = {}
    for window in (64, 500):
        plan = compute(to_spark(spark, walk(50)), layout, fibonacci.fibonacci(window))._jdf.queryExecution().optimizedPlan().toString()
        found = re.findall(r"specifiedwindowframe\(RowFrame, ([^,]+), (-?\d+|[a-z]+)", plan)
        wide = [(a, b) for a, b in found if a != b and not a.startswith("unbounded")]  # the others are look-ups of one row
        assert not wide, wide
        frames[window] = sum(a.startswith("unbounded") for a, _ in found)
    assert frames[64] == frames[500] > 0
