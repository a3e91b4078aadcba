from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from conftest import START, assert_same, collected, to_spark, walk
from pyspark.sql import functions as F

from barloom.operators import backtest, evaluate
from barloom.operators.step import compute


def predictions_frame(n=400, seed=0, digits=2, model="m", symbol="A"):
    rng = np.random.default_rng(seed)
    probability = np.round(rng.random(n), digits)  # tied scores
    return pd.DataFrame(
        {
            "symbol": symbol,
            "bar_ts": pd.date_range(START, periods=n, freq="15min"),
            "model": model,
            "label": (rng.random(n) < probability * 0.6).astype(int),
            "prediction": (probability > 0.5).astype(int),
            "probability": probability,
        }
    )


def as_spark(spark, frame):
    return spark.createDataFrame(frame).withColumn("bar_ts", F.col("bar_ts").cast("timestamp_ntz"))


@pytest.fixture(scope="module")
def frame():
    return pd.concat([predictions_frame(), predictions_frame(200, 1, 6, "n")])


@pytest.fixture(scope="module")
def pred(spark, frame):
    return as_spark(spark, frame).cache()


def test_metrics(pred, frame):
    got = evaluate.metrics(pred).toPandas().set_index("model")
    for name, f in frame.groupby("model"):
        tp = ((f.label == 1) & (f.prediction == 1)).sum()
        precision, recall = tp / (f.prediction == 1).sum(), tp / (f.label == 1).sum()
        assert_same(
            got.loc[name, ["accuracy", "precision", "recall", "f1_score"]].astype(float).to_numpy(),
            [(f.label == f.prediction).mean(), precision, recall, 2 * precision * recall / (precision + recall)],
        )


def test_nothing_predicted_counts_as_zero(spark):
    f = predictions_frame(20)
    f["prediction"] = 0
    row = evaluate.metrics(as_spark(spark, f)).first()
    assert row["precision"] == 0 and row["f1_score"] == 0
    cells = evaluate.confusion(as_spark(spark, f)).collect()
    assert len(cells) == 4 and {r["rows"] for r in cells if r["prediction"] == 1} == {0}


def test_report(pred, frame):
    got = evaluate.class_report(pred).filter("model = 'm'").toPandas().set_index("class")
    f = frame[frame.model == "m"]
    for c in (0, 1):
        row = got.loc[str(c)]
        assert row.support == (f.label == c).sum()
        assert row.precision == pytest.approx((f.label[f.prediction == c] == c).mean())
    weights = [(f.label == c).mean() for c in (0, 1)]
    assert got.loc["weighted avg"].recall == pytest.approx(got.loc["accuracy"].f1_score)
    assert got.loc["macro avg"].f1_score == pytest.approx((got.loc["0"].f1_score + got.loc["1"].f1_score) / 2)
    assert got.loc["weighted avg"].f1_score == pytest.approx(
        got.loc["0"].f1_score * weights[0] + got.loc["1"].f1_score * weights[1]
    )


def test_auc_is_the_rank_statistic(pred, frame):
    got = {r["model"]: r["auc"] for r in evaluate.auc(evaluate.score_curve(pred)).collect()}
    for name, f in frame.groupby("model"):
        up, down = f.probability[f.label == 1].to_numpy(), f.probability[f.label == 0].to_numpy()
        wins = (up[:, None] > down).mean() + 0.5 * (up[:, None] == down).mean()
        assert got[name] == pytest.approx(wins)


def test_curves(pred, frame):
    curve = evaluate.score_curve(pred)
    f = frame[frame.model == "m"]
    points = evaluate.roc(curve).filter("model = 'm' AND threshold IS NOT NULL").toPandas()
    precision = evaluate.precision_recall(curve).filter("model = 'm' AND threshold IS NOT NULL").toPandas()
    assert len(points) == f.probability.nunique()
    for t, fpr, tpr in points[["threshold", "fpr", "tpr"]].itertuples(index=False):
        chosen = f.probability >= t
        assert tpr == pytest.approx((chosen & (f.label == 1)).sum() / (f.label == 1).sum())
        assert fpr == pytest.approx((chosen & (f.label == 0)).sum() / (f.label == 0).sum())
    for t, value in precision[["threshold", "precision"]].itertuples(index=False):
        assert value == pytest.approx(f.label[f.probability >= t].mean())
    ordered = precision.sort_values("threshold", ascending=False)
    want = (ordered.recall.diff().fillna(ordered.recall) * ordered.precision).sum()
    got = evaluate.average_precision(curve).filter("model = 'm'").first()["average_precision"]
    assert got == pytest.approx(want)
    ends = evaluate.roc(curve).filter("threshold IS NULL").collect()
    assert len(ends) == 2 and all(r["fpr"] == 0 and r["tpr"] == 0 for r in ends)


def test_bins_differ_at_zero(spark):
    f = predictions_frame(40, 3, 1)
    f.loc[:4, "probability"] = 0.0
    df = as_spark(spark, f)
    calibrated = {r["bin"]: r["rows"] for r in evaluate.calibration(df).collect()}
    binned = {r["bin"]: r["rows"] for r in evaluate.confidence_bins(df).collect()}
    zeros = (f.probability == 0).sum()
    assert calibrated[1] == binned.get(1, 0) + zeros
    assert sum(calibrated.values()) == 40 and sum(binned.values()) == 40 - zeros
    assert binned[4] == ((f.probability > 0.3) & (f.probability <= 0.4)).sum()


def test_outcomes_and_rolling_accuracy(spark, layout):
    f = predictions_frame(150, 4)
    judged = evaluate.outcomes(as_spark(spark, f))
    got = collected(compute(judged, layout, evaluate.rolling_accuracy()))
    assert_same(got.rolling_accuracy, (f.label == f.prediction).rolling(50, 1).mean())
    names = got.groupby(["correct", "prediction"]).outcome.unique()
    assert names[(0, 1)].tolist() == ["false up"] and names[(1, 0)].tolist() == ["correct down"]


def test_ranking(spark):
    rows = [("a", 0.60, 0.50, 0.01), ("b", 0.66, 0.48, 0.03), ("c", 0.66, 0.48, 0.02), ("d", 0.70, 0.40, 0.0)]
    df = spark.createDataFrame(rows, "model string, accuracy double, f1_score double, cv_f1_std double")
    with_band = {r["model"]: (r["place"], r["best"]) for r in evaluate.rank_models(df).collect()}
    assert with_band == {"a": (1, 0), "b": (3, 0), "c": (2, 1), "d": (4, 0)}
    assert evaluate.rank_models(df, None).filter("best = 1").first()["model"] == "a"
    none_fits = df.withColumn("accuracy", F.col("accuracy") - 0.3)
    assert evaluate.rank_models(none_fits).filter("best = 1").first()["model"] == "a"


def backtest_reference(bars, prediction):
    e = pd.DataFrame({"position": prediction.shift(1)})
    e["r"] = e.position * bars.close.pct_change()
    e["equity"], e["hold"] = (1 + e.r).cumprod(), (1 + bars.close.pct_change()).cumprod()
    e["drawdown"] = e.equity / e.equity.cummax() - 1
    rolling = e.r.rolling(50)
    e["sharpe"] = rolling.mean() / rolling.std() * np.sqrt(252 * 24 * 4)
    return e


def test_backtest(spark, layout):
    bars = pd.concat([walk(300, 1, "A"), walk(120, 2, "B")])
    f = pd.concat([predictions_frame(300, 5), predictions_frame(120, 6, symbol="B")])
    curve = backtest.equity(as_spark(spark, f), to_spark(spark, bars), layout)
    got = collected(curve)
    total = backtest.summary(curve).toPandas().set_index("symbol")
    for symbol in "AB":
        want = backtest_reference(
            bars[bars.symbol == symbol].reset_index(drop=True), f[f.symbol == symbol].prediction.reset_index(drop=True)
        )
        mine = got[got.symbol == symbol]
        for a, b in [
            ("position", "position"), ("strategy_return", "r"), ("cumulative_return", "equity"),
            ("buy_hold_return", "hold"), ("drawdown", "drawdown"), ("rolling_sharpe", "sharpe"),
        ]:
            assert_same(mine[a], want[b], 1e-7)
        row = total.loc[symbol]
        assert row.total_return == pytest.approx(want.equity.iloc[-1] - 1)
        assert row.buy_hold_return == pytest.approx(want.hold.iloc[-1] - 1)
        assert row.max_drawdown == pytest.approx(want.drawdown.min())
        assert row.sharpe == pytest.approx(want.r.mean() / want.r.std() * np.sqrt(252 * 24 * 4))
    single = to_spark(spark, bars[bars.symbol == "A"])
    assert backtest.equity(as_spark(spark, f), single, layout).count() == 300  # joined by key


def test_total_loss_keeps_later_equity_at_zero(spark, layout):
    bars = walk(130, 3)
    bars.loc[20, "close"] = 0.0
    f = predictions_frame(130, 7)
    f["prediction"] = 1
    got = collected(backtest.equity(as_spark(spark, f), to_spark(spark, bars), layout))
    assert (got.cumulative_return[20:] == 0).all() and (got.drawdown[20:] == -1).all()
