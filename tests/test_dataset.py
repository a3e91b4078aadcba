from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from conftest import assert_same, bars_frame, to_spark, walk
from pyspark.sql import functions as F

from barloom.operators import dataset, label, profile
from barloom.operators.quantiles import exact_quantiles, series_quantile
from barloom.operators.step import compute
from barloom.plans.features import feature_panel
from barloom.schema import FULL77, MINI8


@pytest.fixture(scope="module")
def labelled(spark, layout):
    return compute(to_spark(spark, walk(400, 1)), layout, label.target()).cache()


@pytest.mark.parametrize(("held", "accuracy"), [(4096, 10_000), (4096, 100), (64, 100), (64, 1000)])
def test_exact_quantiles(spark, held, accuracy):
    """Also through the bracketing that large inputs take, and with one value on a third of the rows."""
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, 3000)
    x[:1000] = 0.25
    frame = pd.DataFrame({"x": x, "y": np.exp(rng.normal(0, 4, 3000)), "z": np.full(3000, 7.0)})
    probs = [0.0, 0.1, 0.25, 0.5, 0.77, 0.9, 1.0]
    got = exact_quantiles(spark.createDataFrame(frame), ["x", "y", "z"], probs, accuracy=accuracy, held=held)
    for c in frame:
        assert_same(got[c], frame[c].quantile(probs), 1e-12)


def test_quantiles_of_nothing(spark):
    df = spark.range(3).select(F.lit(None).cast("double").alias("x"), F.col("id").cast("double").alias("y"))
    assert exact_quantiles(df, ["x", "y"], [0.5]) == {"x": [None], "y": [1.0]}


def test_median_per_symbol(spark):
    both = pd.concat([walk(101, 1, "A"), walk(60, 2, "B")])
    got = {r["symbol"]: r["volume_quantile"] for r in series_quantile(to_spark(spark, both), "volume", 0.5).collect()}
    assert got == both.groupby("symbol").volume.median().to_dict()


def test_random_split_is_stratified_and_stable(labelled):
    one = dataset.split_random(labelled).toPandas()
    two = dataset.split_random(labelled.repartition(7)).toPandas()
    for target, rows in one.groupby("target"):
        assert (rows.split == "test").sum() == int(len(rows) * 0.2), target
    keys = ["symbol", "bar_ts", "split"]
    assert one[keys].sort_values(keys).values.tolist() == two[keys].sort_values(keys).values.tolist()


def test_folds_are_balanced(labelled):
    folded = dataset.folds(labelled).toPandas()
    for _, rows in folded.groupby("target"):
        sizes = rows.groupby("fold").size()
        assert len(sizes) == 5 and sizes.max() - sizes.min() <= 1


def test_time_split_with_embargo(spark, layout):
    df = compute(to_spark(spark, walk(100, 2)), layout, label.target())
    df = df.withColumn("known_at", F.col("bar_ts") + F.expr("INTERVAL 90 MINUTES"))
    got = dataset.split_time(df, 0.2, label_ts="known_at").toPandas().sort_values("bar_ts")
    assert list(got.split) == ["train"] * 74 + ["embargo"] * 6 + ["test"] * 20
    plain = dataset.split_time(df, 0.2).toPandas()
    assert set(plain.split) == {"train", "test"}


def test_class_weights(labelled):
    frame = labelled.toPandas()
    got = {r["target"]: r["weight"] for r in dataset.class_weights(labelled).collect()}
    for target, rows in frame.groupby("target"):
        assert got[target] == pytest.approx(len(frame) / (2 * len(rows)))
    total = dataset.with_class_weights(labelled).agg(F.sum("weight")).first()[0]
    assert total == pytest.approx(len(frame))


def test_robust_scaler(spark):
    frame = walk(200, 3)
    frame["volume"] = 5  # no spread: only centred
    df = to_spark(spark, frame)
    scaler = dataset.RobustScaler.fit(df, ["close", "volume"])
    got = scaler.transform(df).toPandas().sort_values("bar_ts")
    q = frame.close.quantile([0.25, 0.5, 0.75]).tolist()
    assert_same(got.close, (frame.close - q[1]) / (q[2] - q[0]))
    assert set(got.volume) == {0.0}
    staged = scaler.stage().transform(df).toPandas().sort_values("bar_ts")
    assert_same(staged.scaled_close, got.close)


def test_finite_and_zero_filled(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, float("inf")), (4, None), (5, -2.0)], "id int, x double")
    assert [r["id"] for r in dataset.finite_rows(df, ["x"]).orderBy("id").collect()] == [1, 5]
    assert [r["x"] for r in dataset.zero_filled(df, ["x"]).orderBy("id").collect()] == [1.0, 0.0, 0.0, 0.0, -2.0]


def test_feature_columns_by_exclusion(spark, layout):
    panel = feature_panel(to_spark(spark, walk(30)), layout, "full77")
    chosen = dataset.feature_columns(panel)
    assert sorted(set(FULL77) - set(chosen)) == [] and chosen[-4:] == ["open", "high", "low", "close"]
    # On top of the set: inputs of the set that are kept visible.
    assert set(chosen) - set(FULL77) == set()


def test_published_spellings(spark, layout):
    panel = feature_panel(to_spark(spark, walk(30)), layout, "mini8")
    got = dataset.select_features(panel, ["volume_ma", "close"])
    assert got.columns == ["symbol", "bar_ts", "target", "volume_ma", "close"]
    with pytest.raises(ValueError):
        dataset.select_features(panel, [*MINI8, "nonsense"])


def test_histogram_like_numpy(spark, layout):
    both = pd.concat([walk(200, 1, "A"), bars_frame([3.0, 3.0], "B", volume=[4, 4])])
    got = profile.histogram(to_spark(spark, both), "volume", layout).toPandas()
    for symbol, rows in both.groupby("symbol"):
        counts, edges = np.histogram(rows.volume, 50)
        mine = got[got.symbol == symbol].sort_values("bin")
        assert mine.rows.tolist() == counts.tolist()
        assert_same(mine.left_edge, edges[:-1])


def test_volume_profile(spark, layout):
    frame = walk(300, 2)
    edges = np.linspace(frame.close.min(), frame.close.max(), 50)
    want = [frame[(frame.close >= a) & (frame.close < b)].volume.sum() for a, b in zip(edges, edges[1:])]
    got = profile.volume_profile(to_spark(spark, frame), layout).toPandas().sort_values("bin")
    assert got.volume.tolist() == want
    closed = profile.volume_profile(to_spark(spark, frame), layout, close_last=True)
    assert closed.agg(F.sum("volume")).first()[0] == frame.volume.sum()


def test_class_histogram_like_numpy(spark):
    rng = np.random.default_rng(1)
    frame = pd.DataFrame({"x": rng.normal(0, 1, 400), "target": rng.integers(0, 2, 400)})
    got = profile.class_histogram(spark.createDataFrame(frame), ["x"]).toPandas()
    for target, rows in frame.groupby("target"):
        density, _ = np.histogram(rows.x, 30, density=True)
        assert_same(got[got.target == target].sort_values("bin").density, density)


def test_correlations(spark):
    rng = np.random.default_rng(2)
    frame = pd.DataFrame(rng.normal(0, 1, (200, 3)), columns=["a", "b", "c"])
    frame["c"] = frame.a + 0.1 * frame.c
    frame["d"] = 1.0
    frame.loc[:50, "b"] = np.nan
    df = spark.createDataFrame(frame).withColumn("b", F.when(~F.isnan("b"), F.col("b")))
    got = profile.corr_matrix(df, ["a", "b", "c", "d"]).toPandas().set_index(["feature_a", "feature_b"])["corr"]
    want = frame.corr()
    for pair in got.index:
        assert_same([got[pair]], [want.loc[pair]])
    assert len(got) == 16
    assert profile.corr_matrix(df, ["a", "b", "c", "d"], upper=True).count() == 6


def test_error_by_quantile_like_qcut(spark):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame({"x": np.round(rng.exponential(1, 500), 1), "error": rng.integers(0, 2, 500)})
    want = frame.groupby(pd.qcut(frame.x, 5, duplicates="drop"), observed=True).error.mean()
    got = profile.error_by_quantile(spark.createDataFrame(frame), ["x"]).toPandas().sort_values("bin")
    assert_same(got.error_rate, want.to_numpy())


def test_correlations_with_the_label_where_a_column_does_not_vary(spark):
    varies = (F.col("id") % 7 + F.col("id") % 2).cast("double")
    df = spark.range(300).select(varies.alias("x"), F.lit(0).alias("flat"), F.lit(None).cast("double").alias("none"), (F.col("id") % 2).alias("target"))
    found = profile.target_corr(df, ["x", "flat", "none", "target"]).collect()
    want = df.select("x", "target").toPandas().corr().loc["x", "target"]
    assert [r["feature"] for r in found] == ["flat", "x"]
    assert found[0]["corr"] is None and abs(found[1]["corr"] - want) < 1e-12
    same = df.select("x", F.lit(1).alias("target"))
    assert [tuple(r) for r in profile.target_corr(same, ["x"]).collect()] == [("x", None)]
