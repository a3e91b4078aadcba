"""The data behind each chart of a report, as tables. Drawing is left to the caller."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators import backtest, evaluate, model, profile
from barloom.operators.panel import last_bars
from barloom.operators.step import compute
from barloom.schema import FIB_INNER, FIB_NAMES, Layout

# The columns shown.
CORRELATED = (
    "close", "volume", "rsi", "macd", "atr", "bb_width", "momentum_10", "volatility_20",
    "fib_position", "volume_ratio", "bos_bullish", "bos_bearish", "choch", "target",
)
DISTRIBUTED = (
    "rsi", "macd_histogram", "atr_ratio", "momentum_10", "bb_position", "volume_ratio",
    "fib_position", "dist_to_vwap",
)
ERROR_DRIVERS = ("rsi", "volatility_20", "volume_ratio")
SIGNALS = (
    "bos_bullish", "bos_bearish", "choch", "liquidity_sweep_up", "liquidity_sweep_down",
    "bullish_ob", "bearish_ob", "fvg_bullish", "fvg_bearish",
)


def price_overview(panel: DataFrame) -> DataFrame:
    return panel.select(
        "symbol", "bar_ts", "close", "sma_20", "sma_50", "sma_100", "bb_upper", "bb_lower", "target", "volume",
        F.when(F.col("close") >= F.col("open"), "up").otherwise("down").alias("candle"),
        "volume_ma_20", "rsi", "macd", "macd_signal", "macd_histogram",
        F.when(F.col("macd_histogram") >= 0, "up").otherwise("down").alias("histogram_side"),
    )


def fibonacci_levels(panel: DataFrame, layout: Layout, n: int = 500) -> DataFrame:
    distances = [f"dist_to_{name}" for name in FIB_INNER if name != "fib_500"]
    return last_bars(panel, n, layout).select("symbol", "bar_ts", "close", *FIB_NAMES, "fib_position", *distances)


def market_structure(panel: DataFrame, layout: Layout, n: int = 300) -> DataFrame:
    """One row per bar and signal raised on it."""
    raised = F.filter(F.array(*(F.when(F.col(s) == 1, F.lit(s)) for s in SIGNALS)), lambda s: s.isNotNull())
    recent = last_bars(panel, n, layout)
    return recent.select(
        "symbol", "bar_ts", "close", "resistance_level", "support_level", F.explode_outer(raised).alias("signal")
    )


def correlation(panel: DataFrame) -> dict[str, DataFrame]:
    return {"matrix": profile.corr_matrix(panel, CORRELATED), "target": profile.target_corr(panel, CORRELATED)}


def distributions(panel: DataFrame) -> dict[str, DataFrame]:
    return {
        "density": profile.class_histogram(panel, DISTRIBUTED),
        "means": profile.class_means(panel, DISTRIBUTED),
    }


def dimensionality(prepared: DataFrame, features: int) -> dict[str, DataFrame]:
    """The first two components of every row, and the variance explained by all components."""
    part = vector_to_array("components")
    fitted = model.pca(prepared, features)
    scores = fitted.transform(prepared)
    return {
        "scores": scores.select("symbol", "bar_ts", "target", part[0].alias("pc1"), part[1].alias("pc2")),
        "variance": model.pca_variance(prepared.sparkSession, fitted),
    }


def model_comparison(pred: DataFrame) -> dict[str, DataFrame]:
    curve = evaluate.score_curve(pred)
    return {
        "metrics": evaluate.metrics(pred),
        "roc": evaluate.roc(curve),
        "auc": evaluate.auc(curve),
        "precision_recall": evaluate.precision_recall(curve),
        "average_precision": evaluate.average_precision(curve),
        "calibration": evaluate.calibration(pred),
    }


def prediction_tables(pred: DataFrame, bars: DataFrame, layout: Layout) -> dict[str, DataFrame]:
    """Predictions of one model over time."""
    judged = evaluate.outcomes(pred)
    priced = judged.join(bars.select("symbol", "bar_ts", "close"), ["symbol", "bar_ts"])
    return {
        "outcomes": priced.select("symbol", "bar_ts", "close", "outcome", "probability"),
        "rolling_accuracy": compute(judged, layout, evaluate.rolling_accuracy()).select(
            "symbol", "bar_ts", "rolling_accuracy"
        ),
        "hourly_accuracy": evaluate.hourly_accuracy(judged),
    }


def error_tables(pred: DataFrame, panel: DataFrame) -> dict[str, DataFrame]:
    drivers = panel.select("symbol", "bar_ts", *ERROR_DRIVERS)
    return {
        "confidence": evaluate.confidence_histogram(pred),
        "calibration": evaluate.calibration(pred),
        "confidence_bins": evaluate.confidence_bins(pred),
        "by_quantile": profile.error_by_quantile(
            evaluate.outcomes(pred).join(drivers, ["symbol", "bar_ts"]), ERROR_DRIVERS
        ),
        "confusion": evaluate.confusion(pred),
        "report": evaluate.class_report(pred),
    }


def backtest_tables(pred: DataFrame, bars: DataFrame, layout: Layout) -> dict[str, DataFrame]:
    curve = backtest.equity(pred, bars, layout)
    return {"curve": curve, "summary": backtest.summary(curve)}
