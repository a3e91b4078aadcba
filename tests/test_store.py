"""Stored series: appending gives what a rebuild gives, and features read the bars once."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pytest
from conftest import assert_same, collected, to_spark, walk
from pyspark.sql import functions as F

from barloom.operators import structure, technical, volume
from barloom.operators.step import compute
from barloom.schema import Layout
from barloom.sources import SeriesStore, read_panel, write_panel

LAYOUT = Layout(every=900, chunk_rows=40, block_rows=64)
STEPS = (volume.on_balance_volume(), volume.vwap(), structure.order_blocks(), technical.sma((5,)))


def whole():
    frame = pd.concat([walk(500, 1, "A"), walk(200, 2, "B"), walk(64, 3, "C")])
    frame.loc[frame.index % 11 == 3, "close"] = np.nan
    return frame


def by_rows(frame, n):
    early = frame.groupby("symbol").cumcount() < n
    return frame[early], frame[~early]


@pytest.mark.parametrize("cuts", [[64], [1, 2], [128, 130, 301], [63, 64, 65]])
def test_appended_series_equal_rebuilt_ones(spark, tmp_path, cuts):
    """Cuts at block borders, one bar before and behind them; a series that ends early, one that starts late."""
    frame = whole()
    pieces, rest = [], frame
    for a, b in zip([0, *cuts], cuts, strict=False):
        own, rest = by_rows(rest, b - a)
        pieces.append(own)
    rest = pd.concat([rest, walk(90, 5, "D")])  # a new symbol with the last append
    pieces.append(rest)
    store = SeriesStore.create(to_spark(spark, pieces[0]), str(tmp_path / "s"), LAYOUT)
    for piece in pieces[1:]:
        if len(piece):
            store.append(to_spark(spark, piece))
    everything = pd.concat([frame, walk(90, 5, "D")])
    rebuilt = SeriesStore.create(to_spark(spark, everything), str(tmp_path / "r"), LAYOUT)
    keys = ["symbol", "_block"]
    one, two = (x.parts().drop("_append").toPandas().sort_values(keys).reset_index(drop=True) for x in (store, rebuilt))
    assert one[[*keys, "_rows", "_last_ts"]].equals(two[[*keys, "_rows", "_last_ts"]])
    for c in ("_obv", "_pv", "_volume", "_n_close", "_mean_close", "_m2_close", "_last_close"):
        assert_same(one[c], two[c], 1e-9)
    got, want = collected(store.compute(*STEPS)), collected(compute(to_spark(spark, everything), LAYOUT, *STEPS))
    assert got.bar_no.tolist() == collected(rebuilt.bars()).bar_no.tolist()
    for c in ("obv", "obv_ma", "vwap", "dist_to_vwap", "bullish_ob", "bearish_ob", "sma_5"):
        assert_same(got[c], want[c])


def test_bars_that_are_not_later_are_refused(spark, tmp_path):
    frame = walk(100, 1)
    store = SeriesStore.create(to_spark(spark, frame[:60]), str(tmp_path / "s"), LAYOUT)
    with pytest.raises(ValueError, match="later"):
        store.append(to_spark(spark, frame[59:]))
    assert store.bars().count() == 60
    store.append(to_spark(spark, frame[60:]))
    assert store.bars().count() == 100


def test_features_of_a_store_read_the_bars_once(spark, tmp_path):
    store = SeriesStore.create(to_spark(spark, walk(300)), str(tmp_path / "s"), LAYOUT)
    plan = store.compute(*STEPS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and plan.count("/s/bars") == 1


def test_panel_with_fractions_of_volume(spark, tmp_path):
    df = to_spark(spark, walk(100)).withColumn("volume", F.lit(0.75))
    write_panel(df, str(tmp_path / "p"), LAYOUT)
    stored = read_panel(spark, str(tmp_path / "p"))
    assert {r["volume"] for r in stored.select("volume").distinct().collect()} == {0.75}
    assert collected(compute(stored, LAYOUT, volume.vwap())).vwap.notna().all()


@pytest.mark.parametrize("n", [1, 50, 1000])
def test_tail_equals_the_end_of_the_series(spark, tmp_path, n):
    frame = whole()
    store = SeriesStore.create(to_spark(spark, frame), str(tmp_path / "s"), LAYOUT)
    for steps, columns in ((STEPS, ("obv", "obv_ma", "vwap", "bullish_ob", "sma_5")), (STEPS[3:], ("sma_5",))):
        got = collected(store.tail(n, *steps))
        want = collected(compute(to_spark(spark, frame), LAYOUT, *steps)).groupby("symbol").tail(n).reset_index(drop=True)
        assert got.bar_ts.tolist() == want.bar_ts.tolist()
        for c in columns:
            assert_same(got[c], want[c])


def test_tail_pushes_a_time_into_the_scan(spark, tmp_path):
    frame = pd.concat([walk(1000, 1, "A"), walk(900, 2, "B")])
    store = SeriesStore.create(to_spark(spark, frame), str(tmp_path / "s"), LAYOUT)
    found = store.tail(30, technical.sma((5, 20)))
    plan = found._jdf.queryExecution().executedPlan().toString()
    bound = re.search(r"PushedFilters: [^\n]*GreaterThan\(bar_ts,([^)]+)\)", plan).group(1).replace("T", " ")
    # What enters the windows: the bars, their reach, and less than a block before them.
    entered = store.bars().filter(F.col("bar_ts") > F.lit(bound).cast("timestamp_ntz")).groupBy("symbol").count().collect()
    assert max(r["count"] for r in entered if r["symbol"] == "B") <= 30 + 20 + LAYOUT.block_rows
    assert found.count() == 60
