"""From bars to a chosen model and its evaluation."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators import clean, dataset, evaluate, model
from barloom.plans.features import feature_panel
from barloom.schema import FEATURE_SETS, Layout
from barloom.session import materialize


def clean_bars(bars: DataFrame, layout: Layout) -> DataFrame:
    return clean.traded(clean.sigma_filter(clean.fill_gaps(bars, layout), layout))


def training_rows(
    bars: DataFrame, layout: Layout, name: str, missing: str = "drop", drop_unlabelled: bool = False
) -> DataFrame:
    """Key, label and features; rows with a missing feature are dropped, or the feature set to 0."""
    columns = FEATURE_SETS[name]
    rows = dataset.select_features(feature_panel(bars, layout, name, drop_unlabelled), columns)
    if missing == "drop":
        return dataset.finite_rows(rows, columns)
    return dataset.zero_filled(rows, columns)


@dataclass(frozen=True)
class Trained:
    models: Mapping[str, PipelineModel]
    results: DataFrame  # a row per model
    predictions: DataFrame
    ranking: DataFrame
    best: str
    features: tuple[str, ...]


def train_and_rank(
    rows: DataFrame,
    name: str,
    presets: Mapping[str, Mapping] | None = None,
    grids: Mapping[str, Mapping] | None = None,
    balanced: bool = True,
    band: tuple[float, float] | None = None,
    split: str = "random",
    k: int = 5,
) -> Trained:
    """Split, scale, fit every model, score its folds, evaluate on the test rows, and rank.

    Either ``presets`` (fixed parameters) or ``grids`` (searched) name the models. The feature rows
    are written out once, because every fit and every fold reads them.
    """
    features = FEATURE_SETS[name]
    rows = materialize(rows)
    divided = dataset.split_random(rows) if split == "random" else dataset.split_time(rows)
    train = materialize(dataset.folds(divided.filter(F.col("split") == "train").drop("split"), k))
    test = divided.filter(F.col("split") == "test").drop("split")
    preparation = model.Preparation.fit(train, features)
    models, scored, found = {}, None, []
    asked = grids or presets or model.PRESETS[name]
    kinds = {kind: model.parameter_points(params) if grids else [dict(params)] for kind, params in asked.items()}
    for kind, done in model.search(train, preparation, kinds, balanced, k).items():
        models[kind] = done.model
        found.append((kind, done.f1_mean, done.f1_std, {p: str(v) for p, v in done.params.items()}))
        pred = model.predictions(done.model, test, kind)
        scored = pred if scored is None else scored.union(pred)
    scored = materialize(scored)
    spark = rows.sparkSession
    cv = spark.createDataFrame(
        found, "model string, cv_f1_mean double, cv_f1_std double, best_params map<string,string>"
    )
    results = evaluate.metrics(scored).join(cv, "model")
    ranking = evaluate.rank_models(results, band).orderBy("place")
    best = ranking.filter("best = 1").first()["model"]
    return Trained(models, results, scored, ranking, best, tuple(features))
