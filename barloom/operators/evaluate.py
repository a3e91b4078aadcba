"""Evaluation of predictions(symbol, bar_ts, model, label, prediction, probability)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions import ratio, trailing
from barloom.operators.panel import block_window
from barloom.operators.profile import class_histogram
from barloom.operators.quantiles import with_piece
from barloom.operators.scan import Running, prefix_scan
from barloom.operators.step import Step



def _counts(pred: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    hit = F.col("prediction") == F.col("label")
    positive = F.col("label") == 1
    return pred.groupBy(*by).agg(
        F.count("*").alias("rows"),
        F.count_if(hit & positive).alias("tp"),
        F.count_if(~hit & ~positive).alias("fp"),
        F.count_if(hit & ~positive).alias("tn"),
        F.count_if(~hit & positive).alias("fn"),
    )


def _share(part: Column, whole: Column) -> Column:
    """A quotient that counts as 0 when there is nothing to divide by."""
    return F.coalesce(ratio(part, whole), F.lit(0.0))


def metrics(pred: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Accuracy, and precision, recall and F1 of class 1, per model."""
    tp, fp, fn = (F.col(c) for c in ("tp", "fp", "fn"))
    return _counts(pred, by).select(
        *by,
        ratio(tp + F.col("tn"), F.col("rows")).alias("accuracy"),
        _share(tp, tp + fp).alias("precision"),
        _share(tp, tp + fn).alias("recall"),
        _share(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
    )


def metrics_long(pred: DataFrame) -> DataFrame:
    wide = metrics(pred)
    scores = [c for c in wide.columns if c != "model"]
    return wide.unpivot("model", scores, "metric", "value")


def confusion(pred: DataFrame) -> DataFrame:
    """All four cells of the 2 x 2 matrix with their share of the row (of the actual class)."""
    cells = [("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1)]
    entries = F.array(
        *(F.struct(F.lit(a).alias("label"), F.lit(p).alias("prediction"), F.col(c).alias("rows")) for c, a, p in cells)
    )
    actual = F.when(F.col("label") == 1, F.col("tp") + F.col("fn")).otherwise(F.col("tn") + F.col("fp"))
    long = _counts(pred).select("model", "tp", "fp", "tn", "fn", F.inline(entries))
    return long.select("model", "label", "prediction", "rows", _share(F.col("rows"), actual).alias("share"))


def class_report(pred: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class; accuracy; plain and weighted means."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    counted = _counts(pred).select(
        "model",
        "rows",
        ratio(tp + tn, F.col("rows")).alias("accuracy"),
        (tn + fp).alias("s0"),
        (tp + fn).alias("s1"),
        _share(tn, tn + fn).alias("p0"),
        _share(tn, tn + fp).alias("r0"),
        _share(2 * tn, 2 * tn + fp + fn).alias("f0"),
        _share(tp, tp + fp).alias("p1"),
        _share(tp, tp + fn).alias("r1"),
        _share(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )

    def line(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            precision.cast("double").alias("precision"),
            recall.cast("double").alias("recall"),
            f1.cast("double").alias("f1_score"),
            support.cast("bigint").alias("support"),
        )

    def plain(c: str) -> Column:
        return (F.col(f"{c}0") + F.col(f"{c}1")) / 2

    def weighted(c: str) -> Column:
        return ratio(F.col(f"{c}0") * F.col("s0") + F.col(f"{c}1") * F.col("s1"), F.col("rows"))

    none = F.lit(None)
    lines = F.array(
        line("0", F.col("p0"), F.col("r0"), F.col("f0"), F.col("s0")),
        line("1", F.col("p1"), F.col("r1"), F.col("f1"), F.col("s1")),
        line("accuracy", none, none, F.col("accuracy"), F.col("rows")),
        line("macro avg", plain("p"), plain("r"), plain("f"), F.col("rows")),
        line("weighted avg", weighted("p"), weighted("r"), weighted("f"), F.col("rows")),
    )
    return counted.select("model", F.inline(lines))


def score_curve(pred: DataFrame) -> DataFrame:
    """Per model and distinct score: rows at the score, and rows at or above it, by class.

    Equal scores are merged before anything is ordered. The order runs over pieces of like size, so a model
    with very many scores is not one task, however they crowd.
    """
    positive = F.col("label") == 1
    merged = pred.groupBy("model", F.col("probability").alias("score")).agg(
        F.count_if(positive).alias("positives"), F.count_if(~positive).alias("negatives")
    )
    running = {"tp": Running("sum", F.col("positives")), "fp": Running("sum", F.col("negatives"))}
    return prefix_scan(
        with_piece(merged.filter(F.col("score").isNotNull()), ("model",), "score"),
        ("model",), "_piece", "score", running, ascending=False, totals=True,
    ).drop("_piece")


def roc(curve: DataFrame) -> DataFrame:
    """Points of the ROC curve, one per distinct score, and the origin (no threshold)."""
    points = curve.select(
        "model",
        F.col("score").alias("threshold"),
        ratio("fp", "fp_total").alias("fpr"),
        ratio("tp", "tp_total").alias("tpr"),
    )
    zero = F.lit(0.0)
    origin = curve.select("model").distinct().select("model", F.lit(None).cast("double"), zero, zero)
    return points.union(origin)


def auc(curve: DataFrame) -> DataFrame:
    """Area under the ROC curve by trapezoids, exact also for tied scores."""
    trapezoid = F.col("negatives") * (2.0 * F.col("tp") - F.col("positives"))
    whole = F.max(F.col("tp_total")) * F.max(F.col("fp_total"))
    return curve.groupBy("model").agg(ratio(F.sum(trapezoid) / 2, whole).alias("auc"))


def precision_recall(curve: DataFrame) -> DataFrame:
    """Points of the precision-recall curve and its end at recall 0 (no threshold)."""
    points = curve.select(
        "model",
        F.col("score").alias("threshold"),
        ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        ratio("tp", "tp_total").alias("recall"),
    )
    end = curve.select("model").distinct()
    return points.union(end.select("model", F.lit(None).cast("double"), F.lit(1.0), F.lit(0.0)))


def average_precision(curve: DataFrame) -> DataFrame:
    """Sum of precision times gain in recall."""
    precision = ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    gain = ratio("positives", "tp_total")
    return curve.groupBy("model").agg(F.sum(precision * gain).alias("average_precision"))


def _score_bin(bins: int) -> Column:
    return F.least(F.greatest(F.ceil(F.col("probability") * bins), F.lit(1)), F.lit(bins)).cast("int")


def calibration(pred: DataFrame, bins: int = 10) -> DataFrame:
    """Mean score and share of positives per score bin that is not empty."""
    return pred.groupBy("model", _score_bin(bins).alias("bin")).agg(
        F.count("*").alias("rows"),
        F.avg("probability").alias("mean_score"),
        F.avg((F.col("label") == 1).cast("int")).alias("positive_share"),
    )


def confidence_bins(pred: DataFrame, bins: int = 10) -> DataFrame:
    """Accuracy and mean score per bin (lo, hi]; a score of exactly 0 is in no bin."""
    return (
        pred.filter(F.col("probability") > 0)
        .groupBy("model", _score_bin(bins).alias("bin"))
        .agg(
            F.count("*").alias("rows"),
            F.avg((F.col("label") == F.col("prediction")).cast("int")).alias("accuracy"),
            F.avg("probability").alias("confidence"),
        )
    )


def outcomes(pred: DataFrame) -> DataFrame:
    """Correctness flags and the outcome class of each prediction."""
    correct, up = F.col("prediction") == F.col("label"), F.col("prediction") == 1
    return pred.withColumns(
        {
            "correct": correct.cast("int"),
            "error": (~correct).cast("int"),
            "outcome": F.when(correct & up, "correct up")
            .when(correct, "correct down")
            .when(up, "false up")
            .otherwise("false down"),
        }
    )


def confidence_histogram(pred: DataFrame, bins: int = 20) -> DataFrame:
    """Density of the scores of right and of wrong predictions; give the predictions of one model."""
    return class_histogram(outcomes(pred), ["probability"], group="correct", bins=bins).drop("feature")


def rolling_accuracy(window: int = 50) -> Step:
    def stages(framed: DataFrame):
        return [{"rolling_accuracy": F.avg("correct").over(trailing(block_window(framed), window))}]

    return Step(stages, back=window - 1)


def hourly_accuracy(judged: DataFrame) -> DataFrame:
    return judged.groupBy(F.hour("bar_ts").alias("hour")).agg(
        F.count("*").alias("rows"), F.avg("correct").alias("accuracy")
    )


def fold_scores(pred: DataFrame) -> DataFrame:
    """Mean and population deviation of F1 over the folds in column ``fold``, per model."""
    per_fold = metrics(pred, ("model", "fold"))
    return per_fold.groupBy("model").agg(
        F.avg("f1_score").alias("cv_f1_mean"), F.stddev_pop("f1_score").alias("cv_f1_std")
    )


def rank_models(results: DataFrame, band: tuple[float, float] | None = (0.65, 0.70)) -> DataFrame:
    """Models by F1, then accuracy, then the spread over folds; ``best`` marks the choice.

    The first model whose accuracy lies in ``band`` is preferred over a better one outside. The table
    has a row per trained model.
    """
    order = [F.desc("f1_score"), F.desc("accuracy"), F.asc("cv_f1_std"), F.asc("model")]
    fits = F.col("accuracy").between(*band) if band else F.lit(True)
    place = F.row_number().over(Window.orderBy(*order))
    choice = F.row_number().over(Window.orderBy(F.desc("_fits"), *order))
    ranked = results.withColumn("_fits", F.coalesce(fits, F.lit(False)))
    return ranked.withColumns({"place": place, "best": (choice == 1).cast("int")}).drop("_fits")
