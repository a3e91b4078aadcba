"""Training, selection and scoring with Spark ML."""

from __future__ import annotations

import itertools
import math
import statistics
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.functions import row_hash
from barloom.operators.dataset import SEED, RobustScaler, select_features, with_class_weights

LABEL, WEIGHT = "target", "weight"
MAX_DEPTH = 30  # the deepest tree Spark grows; stands for "no limit"

# The search grids.
GRIDS: Mapping[str, Mapping[str, Sequence]] = {
    "random_forest": {"numTrees": [100, 200], "maxDepth": [10, 20, MAX_DEPTH], "minInstancesPerNode": [1, 2]},
    "gradient_boosting": {"maxIter": [100, 200], "maxDepth": [3, 5, 7], "stepSize": [0.05, 0.1]},
    "logistic_regression": {"C": [0.1, 1.0, 10.0]},
    "linear_svm": {"C": [0.1, 1.0, 10.0]},
    "boosted_subsample": {
        "maxIter": [100, 200], "maxDepth": [3, 5, 7], "stepSize": [0.05, 0.1], "subsamplingRate": [0.8, 1.0],
    },
}

# The parameter sets used without a search.
PRESETS: Mapping[str, Mapping[str, Mapping]] = {
    "core24": {
        "random_forest": {"numTrees": 150, "maxDepth": 15},
        "gradient_boosting": {"maxIter": 100, "maxDepth": 4, "stepSize": 0.1},
        "logistic_regression": {"C": 1.0},
        "linear_svm": {"C": 1.0},
    },
    "core35": {
        "random_forest": {"numTrees": 200, "maxDepth": 20, "minInstancesPerNode": 2},
        "gradient_boosting": {"maxIter": 150, "maxDepth": 5, "stepSize": 0.1},
        "logistic_regression": {"C": 1.0},
        "linear_svm": {"C": 1.0},
    },
    "mini8": {"random_forest": {"numTrees": 100, "maxDepth": 15}},
}


def estimator(kind: str, rows: int, balanced: bool = True, **params) -> Estimator:
    """A classifier by name. ``C`` is the inverse penalty on the summed loss over ``rows`` rows.

    Boosting takes no class weights, as in the published runs.
    """
    common = {"labelCol": LABEL, "featuresCol": "features"}
    if balanced and kind not in ("gradient_boosting", "boosted_subsample"):
        common["weightCol"] = WEIGHT
    if "C" in params:
        params["regParam"] = 1 / (params.pop("C") * max(rows, 1))
    if kind == "random_forest":
        return RandomForestClassifier(seed=SEED, **common, **params)
    if kind in ("gradient_boosting", "boosted_subsample"):
        return GBTClassifier(seed=SEED, **common, **params)
    if kind == "logistic_regression":
        return LogisticRegression(maxIter=1000, elasticNetParam=0.0, standardization=False, **common, **params)
    if kind == "linear_svm":
        return LinearSVC(maxIter=100, standardization=False, **common, **params)
    raise ValueError(f"unknown model {kind}")


def f1_of_class_1(scored: DataFrame) -> float:
    """F1 of class 1 in one aggregation."""
    up, said = F.col(LABEL) == 1, F.col("prediction") == 1
    hit = F.count_if(up & said)
    wrong = F.count_if(up != said)
    return float(scored.agg(F.coalesce(F.try_divide(2 * hit, 2 * hit + wrong), F.lit(0.0))).first()[0])


@dataclass(frozen=True)
class Preparation:
    """Scaling and assembling, fitted on training rows."""

    features: tuple[str, ...]
    scaler: RobustScaler

    @staticmethod
    def fit(train: DataFrame, features: Sequence[str]) -> Preparation:
        return Preparation(tuple(features), RobustScaler.fit(train, features))

    def stages(self) -> list:
        scaled = [f"scaled_{c}" for c in self.features]
        return [self.scaler.stage(), VectorAssembler(inputCols=scaled, outputCol="features")]

    def model(self) -> PipelineModel:
        return PipelineModel(self.stages())


def fit(train: DataFrame, preparation: Preparation, classifier: Estimator) -> PipelineModel:
    weighted = with_class_weights(train)
    return Pipeline(stages=[*preparation.stages(), classifier]).fit(weighted)


def parameter_points(grid: Mapping[str, Sequence]) -> list[dict]:
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


@dataclass(frozen=True)
class Searched:
    model: PipelineModel
    params: dict
    f1_mean: float
    f1_std: float


#: Fits that run at the same time, at most; the driver holds the trees of each.
FITS = 16


def search(
    train: DataFrame, preparation: Preparation, kinds: Mapping[str, Sequence[Mapping]],
    balanced: bool = True, k: int = 5, parallelism: int | None = None,
) -> dict[str, Searched]:
    """Score the parameter points of each kind by their mean F1 of class 1 over the folds in column ``fold``; refit the best of each.

    The prepared rows are cached once; every fit and evaluation is a Spark job over them. Fits are long chains of small jobs, so those of
    all kinds run together, one for each core of the cluster if not told otherwise; a refit waits for scores only where there is a choice.
    """
    prepared = preparation.model().transform(with_class_weights(train)).persist()
    parallelism = parallelism or min(max(train.sparkSession.sparkContext.defaultParallelism, 4), FITS)
    try:
        held = {r["fold"]: r["rows"] for r in prepared.groupBy("fold").agg(F.count("*").alias("rows")).collect()}
        rows = sum(held.values())

        def fold_score(kind: str, point: int, fold: int) -> float:
            classifier = estimator(kind, rows - held.get(fold, 0), balanced, **kinds[kind][point])
            fitted = classifier.fit(prepared.filter(F.col("fold") != fold))
            return f1_of_class_1(fitted.transform(prepared.filter(F.col("fold") == fold)))

        def refit(kind: str, point: int):
            return estimator(kind, rows, balanced, **kinds[kind][point]).fit(prepared)

        with ThreadPoolExecutor(parallelism) as pool:
            try:
                asked, fitted, best, scores = {}, {}, {}, {}
                for kind, points in kinds.items():
                    if len(points) == 1:
                        fitted[kind] = pool.submit(refit, kind, 0)
                    asked[kind] = [[pool.submit(fold_score, kind, point, fold) for fold in range(k)] for point in range(len(points))]
                for kind, points in kinds.items():
                    scores[kind] = [[s.result() for s in of_point] for of_point in asked[kind]]
                    best[kind] = max(range(len(points)), key=lambda i: statistics.fmean(scores[kind][i]))  # noqa: B023
                    if kind not in fitted:
                        fitted[kind] = pool.submit(refit, kind, best[kind])
                models = {kind: f.result() for kind, f in fitted.items()}
            except BaseException:
                pool.shutdown(wait=False, cancel_futures=True)  # what has not begun need not
                raise
    finally:
        prepared.unpersist()
    out = {}
    for kind, points in kinds.items():
        chosen = scores[kind][best[kind]]
        out[kind] = Searched(
            PipelineModel([*preparation.stages(), models[kind]]),
            dict(points[best[kind]]), statistics.fmean(chosen), statistics.pstdev(chosen),
        )
    return out


def cross_validate(
    train: DataFrame, preparation: Preparation, kind: str, points: Sequence[Mapping] = ({},),
    balanced: bool = True, k: int = 5, parallelism: int | None = None,
) -> Searched:
    """``search`` for one kind."""
    return search(train, preparation, {kind: points}, balanced, k, parallelism)[kind]


def predictions(model: PipelineModel, df: DataFrame, name: str) -> DataFrame:
    """Predicted class and score of class 1, with the key of each row kept."""
    scored = model.transform(df)
    if "probability" in scored.columns:
        score = vector_to_array("probability")[1]
    else:  # a margin, put on [0, 1] in its order
        score = 1 / (1 + F.exp(-vector_to_array("rawPrediction")[1]))
    label = [F.col(LABEL).cast("int").alias("label")] if LABEL in df.columns else []
    return scored.select(
        "symbol", "bar_ts", F.lit(name).alias("model"), *label,
        F.col("prediction").cast("int").alias("prediction"), score.alias("probability"),
    )


def score(model: PipelineModel | None, rows: DataFrame, features: Sequence[str], name: str = "model") -> DataFrame:
    """Predict rows that have no label; works on batch and streaming frames."""
    if model is None:
        raise ValueError("no trained model: fit or load one first")
    chosen = select_features(rows, features, keep=("symbol", "bar_ts"))
    scored = predictions(model, chosen, name)
    return scored.withColumn("direction", F.when(F.col("prediction") == 1, "UP").otherwise("DOWN"))


def importances(spark: SparkSession, models: Mapping[str, PipelineModel], features: Sequence[str]) -> DataFrame:
    """Importance per feature and tree model: as many rows as features times models."""
    rows = [
        (feature, name, float(value))
        for name, model in models.items()
        if hasattr(model.stages[-1], "featureImportances")
        for feature, value in zip(features, model.stages[-1].featureImportances.toArray())
    ]
    return spark.createDataFrame(rows, "feature string, model string, importance double")


def importance_top(importance: DataFrame, n: int = 20, by: str | None = None) -> DataFrame:
    """Models side by side, their mean and its cumulative share; the best n features by the mean, or by one model."""
    wide = importance.groupBy("feature").pivot("model").agg(F.first("importance"))
    mean = importance.groupBy("feature").agg(F.avg("importance").alias("mean"))
    running = Window.orderBy(F.desc("mean"), "feature").rowsBetween(Window.unboundedPreceding, 0)
    joined = wide.join(mean, "feature").withColumn("cumulative", F.sum("mean").over(running))
    return joined.orderBy(F.desc(by or "mean"), "feature").limit(n)


def pca(prepared: DataFrame, k: int):
    """Principal components of the scaled features, centred first. Returns the fitted pipeline."""
    centre = StandardScaler(inputCol="features", outputCol="centred", withMean=True, withStd=False)
    return Pipeline(stages=[centre, PCA(k=k, inputCol="centred", outputCol="components")]).fit(prepared)


def pca_variance(spark: SparkSession, fitted: PipelineModel) -> DataFrame:
    shares = [float(x) for x in fitted.stages[-1].explainedVariance]
    rows = [(i + 1, share, math.fsum(shares[: i + 1])) for i, share in enumerate(shares)]
    return spark.createDataFrame(rows, "component int, variance_ratio double, cumulative double")


def random_subset(df: DataFrame, n: int = 5000, seed: int = SEED) -> DataFrame:
    """n rows without replacement, the same ones on every run: the n smallest row hashes."""
    return df.orderBy(row_hash(seed), "symbol", "bar_ts").limit(n)


def learning_curve(
    train: DataFrame, preparation: Preparation, kind: str, params: Mapping,
    shares: Sequence[float] = tuple(i / 10 for i in range(1, 11)), k: int = 5,
) -> DataFrame:
    """F1 on nested training samples and on the held-out fold, mean and population deviation."""
    spark = train.sparkSession
    prepared = preparation.model().transform(with_class_weights(train))
    unit = F.conv(F.substring(row_hash(SEED + 1), 1, 8), 16, 10).cast("double") / float(16**8)
    prepared = prepared.withColumn("_unit", unit).persist()
    rows = []
    try:
        for share in shares:
            for fold in range(k):
                inside = prepared.filter((F.col("fold") != fold) & (F.col("_unit") <= share))
                held_out = prepared.filter(F.col("fold") == fold)
                model = estimator(kind, inside.count(), **params).fit(inside)
                for part, data in (("train", inside), ("validation", held_out)):
                    rows.append((share, part, f1_of_class_1(model.transform(data))))
    finally:
        prepared.unpersist()
    scores = spark.createDataFrame(rows, "share double, part string, f1 double")
    return scores.groupBy("share", "part").agg(
        F.avg("f1").alias("f1_mean"), F.stddev_pop("f1").alias("f1_std"), F.count("*").alias("folds")
    )


def parameter_summary(results: DataFrame) -> DataFrame:
    """Best parameters of each model against its scores; ``best_params`` is a map of strings."""
    return results.select(
        "model", F.explode("best_params").alias("parameter", "value"), "f1_score", "cv_f1_mean", "cv_f1_std"
    )


def save_bundle(model: PipelineModel, features: Sequence[str], name: str, path: str, spark: SparkSession) -> None:
    model.write().overwrite().save(f"{path}/model")
    row = spark.createDataFrame([(name, list(features))], "model_name string, feature_names array<string>")
    row.coalesce(1).write.mode("overwrite").json(f"{path}/about")


def load_bundle(spark: SparkSession, path: str) -> tuple[PipelineModel, list[str], str]:
    about = spark.read.schema("model_name string, feature_names array<string>").json(f"{path}/about").first()
    return PipelineModel.load(f"{path}/model"), list(about["feature_names"]), about["model_name"]
