from __future__ import annotations

import threading

import numpy as np
import pandas as pd
import pytest
from conftest import START, collected, to_spark, walk
from pyspark.sql import functions as F

from barloom.operators import dataset, label, model, technical, volume
from barloom.operators.step import compute
from barloom.plans import workflow
from barloom.plans.features import feature_panel, mini8_steps
from barloom.schema import MINI8
from barloom.sources import (
    bars_from_ticks,
    comparison_table,
    detail_table,
    evaluation_table,
    read_bars,
    write_details,
    write_evaluation,
)
from barloom.sources.files import unique_bars, years
from barloom.streaming import bar_stream, score_batches, score_stream


@pytest.fixture(scope="module")
def separable(spark):
    """A label that follows from the features."""
    rng = np.random.default_rng(0)
    frame = pd.DataFrame(rng.normal(0, 1, (300, len(MINI8))), columns=list(MINI8))
    frame["target"] = (frame.rsi + 0.5 * frame.close + rng.normal(0, 0.1, 300) > 0.4).astype(int)
    frame.insert(0, "bar_ts", pd.date_range(START, periods=300, freq="15min"))
    frame.insert(0, "symbol", "A")
    return spark.createDataFrame(frame).withColumn("bar_ts", F.col("bar_ts").cast("timestamp_ntz")).cache()


@pytest.fixture(scope="module")
def trained(separable):
    presets = {
        "random_forest": {"numTrees": 10, "maxDepth": 5},
        "gradient_boosting": {"maxIter": 4, "maxDepth": 3},
        "logistic_regression": {"C": 1.0},
        "linear_svm": {"C": 1.0},
    }
    return workflow.train_and_rank(separable, "mini8", presets=presets, k=3)


def test_models_beat_the_constant_answer(trained, separable):
    share = separable.agg(F.avg("target")).first()[0]
    scores = {r["model"]: r for r in trained.results.collect()}
    assert len(scores) == 4
    for row in scores.values():
        assert row["accuracy"] > max(share, 1 - share) + 0.1 and row["cv_f1_mean"] > 0.6
        assert 0 <= row["cv_f1_std"] < 0.3


def test_predictions_keep_their_key(trained, separable):
    joined = trained.predictions.join(separable.select("symbol", "bar_ts", "target"), ["symbol", "bar_ts"])
    assert joined.count() == trained.predictions.count()
    assert joined.filter("label <> target").count() == 0
    assert trained.predictions.filter("probability < 0 OR probability > 1").count() == 0


def test_result_files(spark, trained, tmp_path):
    table = evaluation_table(trained.results).collect()
    assert [r["f1_score"] for r in table] == sorted((r["f1_score"] for r in table), reverse=True)
    assert "numTrees" in next(r for r in table if r["model"] == "random_forest")["best_params"]
    assert comparison_table(trained.results).columns == ["model", "accuracy", "f1_score", "cv_f1_mean"]
    write_evaluation(trained.results, str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.count() == 4 and "cv_f1_std" in back.columns
    write_details(trained.results, trained.best, str(tmp_path / "json"))
    detail = spark.read.json(str(tmp_path / "json")).first()
    assert detail["best_model"] == trained.best and detail["all_results"][trained.best]["f1_score"] == detail["best_f1"]
    assert detail_table(trained.results, trained.best).count() == 1


def test_bundle_round_trip(spark, trained, separable, tmp_path):
    best = trained.models["logistic_regression"]
    model.save_bundle(best, trained.features, "logistic_regression", str(tmp_path / "bundle"), spark)
    loaded, names, name = model.load_bundle(spark, str(tmp_path / "bundle"))
    assert name == "logistic_regression" and tuple(names) == MINI8
    rows = separable.drop("target").limit(40)
    before = collected(model.score(best, rows, MINI8))
    after = collected(model.score(loaded, rows, names))
    assert before.probability.tolist() == after.probability.tolist()
    assert set(after.direction) <= {"UP", "DOWN"}


def test_literal_row_and_missing_model(spark, trained):
    values = (4105.0, 4108.0, 4099.0, 4105.0, 7019.0, 4120.0, 30.5, 1500.0)
    columns = "open double, high double, low double, close double, volume_ma double, sma_20 double, rsi double, volume double"
    row = spark.createDataFrame([values], columns).select(
        F.lit("A").alias("symbol"), F.lit(None).cast("timestamp_ntz").alias("bar_ts"), "*"
    )
    features = ("open", "high", "low", "close", "volume", "sma_20", "rsi", "volume_ma")
    with pytest.raises(ValueError):
        model.score(None, row, features)
    renamed = row.withColumnRenamed("volume_ma", "volume_ma_20")
    assert model.score(trained.models["random_forest"], renamed, MINI8).count() == 1


def test_grid_search_refits_the_best_point(separable):
    train = dataset.folds(separable, 3).cache()
    preparation = model.Preparation.fit(train, MINI8)
    points = model.parameter_points({"C": [1e-6, 1.0]})
    done = model.cross_validate(train, preparation, "logistic_regression", points, k=3)
    assert done.params == {"C": 1.0}
    assert done.model.stages[-1].getRegParam() == pytest.approx(1 / 300)


def test_fits_of_all_models_run_together(separable, monkeypatch):
    """Folds and refits of both kinds are in flight at once: each fit waits here for the other five."""
    together = threading.Barrier(6)

    class Waiting:
        def fit(self, rows):
            together.wait(60)
            return self

        def transform(self, rows):
            return rows

    monkeypatch.setattr(model, "estimator", lambda *a, **k: Waiting())
    monkeypatch.setattr(model, "f1_of_class_1", lambda scored: 0.5)
    preparation = model.Preparation(MINI8, dataset.RobustScaler(dict.fromkeys(MINI8, 0.0), dict.fromkeys(MINI8, 1.0)))
    kinds = {"logistic_regression": [{"C": 1.0}], "linear_svm": [{"C": 2.0}]}
    done = model.search(separable.withColumn("fold", F.col("target")), preparation, kinds, k=2, parallelism=6)
    assert {kind: (d.params, d.f1_mean, d.f1_std) for kind, d in done.items()} == {
        "logistic_regression": ({"C": 1.0}, 0.5, 0.0), "linear_svm": ({"C": 2.0}, 0.5, 0.0),
    }


def test_importances_and_components(spark, trained, separable):
    table = model.importances(spark, trained.models, trained.features)
    assert {r["model"] for r in table.collect()} == {"random_forest", "gradient_boosting"}
    top = model.importance_top(table, 3).collect()
    assert top[0]["feature"] == "rsi" and len(top) == 3 and top[0]["cumulative"] == pytest.approx(top[0]["mean"])
    preparation = model.Preparation.fit(separable, MINI8)
    variance = model.pca_variance(spark, model.pca(preparation.model().transform(separable), 8)).collect()
    assert variance[-1]["cumulative"] == pytest.approx(1)
    matrix = np.array(preparation.scaler.transform(separable).select(*MINI8).collect(), dtype=float)
    values = np.sort(np.linalg.eigvalsh(np.cov(matrix.T)))[::-1]
    assert variance[0]["variance_ratio"] == pytest.approx(values[0] / values.sum())


def test_learning_curve(separable):
    train = dataset.folds(separable, 3).cache()
    preparation = model.Preparation.fit(train, MINI8)
    got = model.learning_curve(train, preparation, "logistic_regression", {"C": 1.0}, shares=(0.5, 1.0), k=3).collect()
    assert len(got) == 4 and all(r["folds"] == 3 for r in got)


def test_bar_file(spark, tmp_path):
    lines = ["Date;Open;High;Low;Close;Volume", "2022.01.03 01:15;2;3;1;2.5;7", "2022.01.03 01:00;1;2;0.5;1.5;9",
             "2021.12.31 23:45;1;1;1;1;1"]
    (tmp_path / "bars.csv").write_text("\n".join(lines))
    got = collected(years(read_bars(spark, str(tmp_path / "bars.csv"), "ABC"), 2022, 2025))
    assert got.close.tolist() == [1.5, 2.5] and got.volume.tolist() == [9, 7]
    assert str(got.bar_ts[0]) == "2022-01-03 01:00:00" and set(got.symbol) == {"ABC"}


def test_duplicate_bars(spark):
    frame = walk(10)
    worse = frame.copy()
    worse["open"] += 1
    got = collected(unique_bars(to_spark(spark, pd.concat([worse, frame, frame]))))
    assert got.open.tolist() == frame.open.tolist()


@pytest.fixture(scope="module")
def ticks(spark, tmp_path_factory):
    rng = np.random.default_rng(1)
    n = 600
    frame = pd.DataFrame(
        {
            "id": rng.permutation(n),
            "ts": pd.Timestamp(START) + pd.to_timedelta(np.sort(rng.integers(0, 8 * 3600, n)), unit="s"),
            "symbol": rng.choice(["A", "B"], n, p=[0.8, 0.2]),
            "price": np.round(rng.normal(100, 1, n), 2),
        }
    )
    path = str(tmp_path_factory.mktemp("ticks"))
    df = spark.createDataFrame(frame).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    df.write.mode("overwrite").parquet(path)
    return frame, path


@pytest.mark.parametrize("order", [("ts", "id"), ("id",), ("ts", "price")])
def test_bars_from_ticks(spark, ticks, order):
    frame, path = ticks
    got = collected(bars_from_ticks(spark.read.parquet(path), "symbol", "ts", "price", order, "1 hour"))
    ordered = frame.sort_values(list(order))
    groups = ordered.groupby(["symbol", ordered.ts.dt.floor("h")]).price
    want = groups.agg(["first", "max", "min", "last", "count"]).reset_index()
    for a, b in zip(("open", "high", "low", "close", "volume"), ("first", "max", "min", "last", "count")):
        assert got[a].tolist() == want[b].tolist()


def test_streamed_bars_equal_closed_batch_bars(spark, ticks, tmp_path):
    frame, path = ticks
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    bars = bar_stream(stream, "symbol", "ts", "price", ("ts", "id"), "1 hour")
    query = bars.writeStream.format("parquet").option("path", str(tmp_path / "out"))
    query = query.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = collected(spark.read.schema(bars.schema).parquet(str(tmp_path / "out")))
    batch = bars_from_ticks(spark.read.parquet(path), "symbol", "ts", "price", ("ts", "id"), "1 hour")
    closed = collected(batch.filter(F.col("bar_ts") + F.expr("INTERVAL 1 HOUR") <= F.lit(frame.ts.max() - pd.Timedelta(minutes=10))))
    pd.testing.assert_frame_equal(got, closed)


def test_scoring_a_stream_of_features(spark, trained, separable, tmp_path):
    separable.drop("target").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(separable.drop("target").schema).parquet(str(tmp_path / "in"))
    scored = score_stream(stream, trained.models["logistic_regression"], MINI8)
    scored.writeStream.format("memory").queryName("scored").trigger(availableNow=True).start().awaitTermination()
    assert spark.table("scored").count() == 300


def test_scoring_batches_of_bars_equals_scoring_the_whole(spark, layout, trained, tmp_path):
    bars = to_spark(spark, walk(80, 9)).cache()
    whole = collected(model.score(trained.models["logistic_regression"], compute(bars, layout, *mini8_steps()), MINI8))
    new = bars.filter(F.col("close").isNotNull()).orderBy(F.desc("bar_ts")).limit(5)
    out = []
    run = score_batches(
        lambda: bars, mini8_steps(), trained.models["logistic_regression"], MINI8, layout,
        lambda df, _: out.append(collected(df)),
    )
    run(new, 0)
    pd.testing.assert_frame_equal(out[0], whole.tail(5).reset_index(drop=True))
    with pytest.raises(ValueError):
        score_batches(lambda: bars, [volume.vwap()], None, MINI8, layout, print)


def test_cleaning_to_training_rows(spark, layout):
    bars = to_spark(spark, walk(250, 11))
    cleaned = workflow.clean_bars(bars, layout)
    rows = workflow.training_rows(cleaned, layout, "core24")
    zeroed = workflow.training_rows(cleaned, layout, "core24", missing="zero")
    assert zeroed.count() == cleaned.count() and rows.count() == cleaned.count() - 10
    panel = feature_panel(cleaned, layout, "mini8", drop_unlabelled=True)
    assert panel.count() == cleaned.count() - 6
    assert compute(bars, layout, technical.rsi(), label.target()).columns[-1] in ("target", "rsi_oversold")
