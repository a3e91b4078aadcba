"""Evaluation results as tables and files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCORES = ("accuracy", "f1_score", "precision", "recall", "cv_f1_mean", "cv_f1_std")


def evaluation_table(results: DataFrame) -> DataFrame:
    """One row per model, best F1 first, parameters as JSON text."""
    columns = [F.col("model"), *(F.col(c) for c in SCORES if c in results.columns)]
    if "best_params" in results.columns:
        columns.append(F.to_json("best_params").alias("best_params"))
    return results.select(*columns).orderBy(F.desc("f1_score"), "model")


def comparison_table(results: DataFrame) -> DataFrame:
    """Accuracy, F1 and cross-validated F1 of each model, best F1 first."""
    shown = [c for c in ("accuracy", "f1_score", "cv_f1_mean") if c in results.columns]
    return results.select("model", *shown).orderBy(F.desc("f1_score"), "model")


def detail_table(results: DataFrame, best: str) -> DataFrame:
    """The best model with its scores and the scores of all models, as one nested row."""
    scores = [c for c in SCORES if c in results.columns]
    is_best = F.col("model") == best
    return results.agg(
        F.lit(best).alias("best_model"),
        F.max(F.when(is_best, F.col("accuracy"))).alias("best_accuracy"),
        F.max(F.when(is_best, F.col("f1_score"))).alias("best_f1"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("model", F.struct(*scores))))).alias("all_results"),
    )


def write_evaluation(results: DataFrame, path: str) -> None:
    """One CSV file: the table has a row per model."""
    evaluation_table(results).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_details(results: DataFrame, best: str, path: str) -> None:
    detail_table(results, best).coalesce(1).write.mode("overwrite").json(path)
