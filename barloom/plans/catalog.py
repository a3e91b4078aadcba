"""One query per operator, over the driver's tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions import display_name
from barloom.operators import (
    clean,
    dataset,
    evaluate,
    fibonacci,
    label,
    model,
    profile,
    structure,
    technical,
    volume,
)
from barloom.operators.panel import last_bars
from barloom.operators.quantiles import series_quantile
from barloom.operators.step import Step, compute
from barloom.plans import charts
from barloom.plans.features import feature_panel
from barloom.plans.rounding import rounded
from barloom.plans.workflow import train_and_rank, training_rows
from barloom.schema import FEATURE_SETS, MINI8, PRICES, Layout
from barloom.session import checkpoint_dir, materialize
from barloom.sources import (
    SeriesStore,
    bars_from_ticks,
    comparison_table,
    evaluation_table,
    read_bars,
    read_panel,
    write_bars,
    write_details,
    write_evaluation,
    write_panel,
)
from barloom.sources.files import unique_bars
from barloom.streaming import bar_stream, feature_batches, reach_of, with_reach

Query = Callable[[SparkSession, str], DataFrame]
HOURLY, QUARTER, DAILY = Layout(every=3600), Layout(every=900), Layout(every=86_400)
KEY = ("symbol", "bar_ts")
RULES = ("rsi", "bands", "stochastic")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return bars_from_ticks(events, "event_type", "ts", "value", ("ts", "event_id"), "1 hour")


def _bars_of_a_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, week = table(spark, sf_dir, "events"), ("2024-01-08 00:00:00", "2024-01-15 00:00:00")
    return bars_from_ticks(events, "event_type", "ts", "value", ("ts", "event_id"), "1 hour", None, *week)


def bars_15m(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return bars_from_ticks(events, F.lit("all"), "ts", "value", ("ts", "event_id"), "15 minutes")


def bars_orders_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    order = ("o_orderdate", "o_orderkey")
    return bars_from_ticks(orders, "o_orderpriority", "o_orderdate", "o_totalprice", order, "1 day")


def _features(columns: Sequence[str], *steps: Step) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(compute(bars_1h(spark, sf_dir), HOURLY, *steps).select(*KEY, *columns))

    return query


def stored_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars, written once: what reads bars several times need not read the ticks again."""
    return materialize(bars_1h(spark, sf_dir))


def _on_bars(build: Callable[[DataFrame], DataFrame], source: Query = bars_1h) -> Query:
    return lambda spark, sf_dir: rounded(build(source(spark, sf_dir)))


def _feature_set(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        panel = feature_panel(bars_1h(spark, sf_dir), HOURLY, name)
        return rounded(dataset.select_features(panel, FEATURE_SETS[name]))

    return query


def _full(bars: DataFrame) -> DataFrame:
    return feature_panel(bars, HOURLY, "full77")


def _stored(panel: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The needed columns of a panel, written once: the tables below read them several times."""
    return materialize(panel.select(*dict.fromkeys((*KEY, *columns))))


def _labelled(bars: DataFrame) -> DataFrame:
    return compute(bars, HOURLY, label.target()).select(*KEY, "close", "target")


def rule_predictions(bars: DataFrame, rules: Sequence[str] = RULES) -> DataFrame:
    """Predictions of fixed rules that expect a rise from low readings of an indicator."""
    steps = {"rsi": technical.rsi(), "bands": technical.bollinger(), "stochastic": technical.stochastic()}
    panel = compute(bars, HOURLY, label.target(), *(steps[r] for r in rules))
    scores = {
        "rsi": lambda: 1 - F.col("rsi") / 100,
        "bands": lambda: F.greatest(F.least(1 - F.col("bb_position"), F.lit(1.0)), F.lit(0.0)),
        "stochastic": lambda: F.greatest(F.least(1 - F.col("stoch_k") / 100, F.lit(1.0)), F.lit(0.0)),
    }
    known = {"rsi": "rsi", "bands": "bb_position", "stochastic": "stoch_k"}
    entries = F.array(
        *(
            F.struct(
                F.lit(r).alias("model"),
                F.when(F.col(known[r]).isNotNull(), F.round(scores[r](), 6)).alias("probability"),
            )
            for r in rules
        )
    )
    long = panel.select(*KEY, F.col("target").alias("label"), F.inline(entries))
    long = long.filter(F.col("probability").isNotNull())
    predicted = (F.col("probability") > 0.5).cast("int").alias("prediction")
    return long.select(*KEY, "model", "label", predicted, "probability")


def _on_rules(build: Callable[[DataFrame], DataFrame], rules: Sequence[str] = RULES) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(build(materialize(rule_predictions(stored_bars(spark, sf_dir), rules))))

    return query


def _with_bars(build: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        bars = stored_bars(spark, sf_dir)
        return rounded(build(materialize(rule_predictions(bars, ("rsi",))), bars))

    return query


def summary_per_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: share of rising bars, and mean RSI before rises and falls, per symbol."""
    steps = (technical.sma((20,)), technical.rsi(), structure.trend_flags(), label.target())
    panel = compute(bars_1h(spark, sf_dir), HOURLY, *steps)
    up = F.col("target") == 1
    return rounded(
        panel.groupBy("symbol").agg(
            F.count("*").alias("rows"),
            F.avg("target").alias("up_share"),
            F.avg(F.when(up, F.col("rsi"))).alias("rsi_up"),
            F.avg(F.when(~up, F.col("rsi"))).alias("rsi_down"),
            F.sum("higher_high").alias("higher_highs"),
            F.avg(F.col("close") - F.col("sma_20")).alias("mean_gap"),
        )
    )


def _with_gaps(bars: DataFrame) -> DataFrame:
    """The bars with the prices of single-trade bars unknown."""
    return bars.withColumns({c: F.when(F.col("volume") > 1, F.col(c)) for c in PRICES})


def _equity(pred: DataFrame, bars: DataFrame) -> DataFrame:
    """The event values jump so much that growth is shown as its sign and logarithm."""
    curve = charts.backtest_tables(pred, bars, HOURLY)["curve"]
    return curve.select(
        *KEY, "close", F.col("position").cast("double").alias("position"), "strategy_return",
        F.col("sign").cast("double").alias("sign_strategy"),
        F.when(F.col("sign") > 0, F.col("log_return")).alias("log_strategy"),
        F.when(F.col("hold_sign") > 0, F.col("log_hold")).alias("log_buy_hold"),
        F.col("log_max").alias("log_running_max"), "drawdown",
    )


def _backtest_summary(pred: DataFrame, bars: DataFrame) -> DataFrame:
    total = charts.backtest_tables(pred, bars, HOURLY)["summary"]
    return total.select(
        "symbol", F.when(F.col("sign") > 0, F.col("log_return")).alias("log_strategy"),
        F.when(F.col("hold_sign") > 0, F.col("log_hold")).alias("log_buy_hold"), "sharpe", "max_drawdown",
    )


def _error_by_quintile(pred: DataFrame, bars: DataFrame) -> DataFrame:
    steps = (technical.rsi(), technical.volatility(), volume.volume_average())
    return charts.error_tables(pred, _stored(compute(bars, HOURLY, *steps), charts.ERROR_DRIVERS))[
        "by_quantile"
    ]


def _rank_rules(pred: DataFrame) -> DataFrame:
    folded = dataset.folds(pred, label=("model", "label"))
    results = evaluate.metrics(pred).join(evaluate.fold_scores(folded), "model")
    return evaluate.rank_models(results)


def _scaled(bars: DataFrame) -> DataFrame:
    rows = materialize(dataset.select_features(feature_panel(bars, HOURLY, "mini8"), MINI8))
    divided = dataset.split_random(rows)
    scaler = dataset.RobustScaler.fit(divided.filter("split = 'train'"), MINI8)
    return scaler.transform(divided)


def _embargo(bars: DataFrame) -> DataFrame:
    """Split by time; training rows whose label reaches into the test period are set apart."""
    rows = materialize(compute(bars, HOURLY, label.target(), label.label_time()).select(*KEY, "target", "label_ts"))
    return dataset.split_time(rows, label_ts="label_ts")


def _known_labels(bars: DataFrame) -> DataFrame:
    return compute(bars, HOURLY, label.target(drop_unlabelled=True)).select(*KEY, "target")


def _train(kind: str, **params) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = training_rows(stored_bars(spark, sf_dir), HOURLY, "mini8")
        done = train_and_rank(rows, "mini8", presets={kind: params})
        return rounded(evaluation_table(done.results))

    return query


def grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = training_rows(bars_1h(spark, sf_dir), HOURLY, "mini8")
    grids = {k: model.GRIDS[k] for k in ("logistic_regression", "linear_svm")}
    done = train_and_rank(rows, "mini8", grids=grids, balanced=False, band=(0.65, 0.70))
    return rounded(model.parameter_summary(done.results))


def compare_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All models with their published parameters."""
    rows = training_rows(stored_bars(spark, sf_dir), HOURLY, "mini8")
    return rounded(comparison_table(train_and_rank(rows, "mini8", presets=model.PRESETS["core24"]).results))


def _prepared(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, model.Preparation]:
    rows = training_rows(stored_bars(spark, sf_dir), HOURLY, name)
    divided = dataset.split_random(materialize(rows))
    train = materialize(dataset.folds(divided.filter("split = 'train'")))
    return train, model.Preparation.fit(train, FEATURE_SETS[name])


def importance_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, preparation = _prepared(spark, sf_dir, "core24")
    presets = model.PRESETS["core24"]
    models = {
        k: model.fit(train, preparation, model.estimator(k, 1, **presets[k])) for k in ("random_forest", "gradient_boosting")
    }
    return rounded(model.importance_top(model.importances(spark, models, preparation.features)))


def pca_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, preparation = _prepared(spark, sf_dir, "core24")
    prepared = preparation.model().transform(train)
    return rounded(charts.dimensionality(prepared, len(preparation.features))["variance"])


def pca_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, preparation = _prepared(spark, sf_dir, "core24")
    prepared = preparation.model().transform(train)
    return rounded(charts.dimensionality(prepared, len(preparation.features))["scores"])


def learning_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, preparation = _prepared(spark, sf_dir, "mini8")
    return rounded(model.learning_curve(train, preparation, "logistic_regression", {"C": 1.0}))


def score_new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train, store, load, and score the bars whose outcome is not known yet."""
    panel = feature_panel(stored_bars(spark, sf_dir), HOURLY, "mini8", drop_unlabelled=True)
    panel = materialize(panel)
    rows = dataset.finite_rows(dataset.select_features(label.labelled(panel), MINI8), MINI8)
    preparation = model.Preparation.fit(rows, MINI8)
    fitted = model.fit(rows, preparation, model.estimator("logistic_regression", rows.count(), C=1.0))
    path = _fresh_folder(spark, "bundles")
    model.save_bundle(fitted, MINI8, "logistic_regression", path, spark)
    loaded, names, name = model.load_bundle(spark, path)
    return rounded(model.score(loaded, last_bars(panel, 6, HOURLY), names, name))


def _fresh_folder(spark: SparkSession, kind: str) -> str:
    return f"{checkpoint_dir(spark)}/{kind}/{uuid.uuid4()}"


def bars_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """15-minute bars through the text format."""
    path = _fresh_folder(spark, "csv")
    write_bars(bars_15m(spark, sf_dir), path)
    return rounded(read_bars(spark, path, "all"))


def stored_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars, numbered and stored."""
    path = _fresh_folder(spark, "panels")
    write_panel(bars_1h(spark, sf_dir), path, HOURLY)
    return rounded(read_panel(spark, path))


def evaluation_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the rules through the result file."""
    path = _fresh_folder(spark, "results")
    write_evaluation(evaluate.metrics(rule_predictions(bars_1h(spark, sf_dir))), path)
    schema = "model string, accuracy double, f1_score double, precision double, recall double"
    return rounded(spark.read.schema(schema).option("header", True).csv(path))


def evaluation_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the rules through the nested details file: the best one, and a row per model."""
    path = _fresh_folder(spark, "details")
    results = materialize(evaluate.metrics(rule_predictions(stored_bars(spark, sf_dir))))  # a row per rule
    best = results.orderBy(F.desc("f1_score"), "model").first()["model"]
    write_details(results, best, path)
    scores = "struct<accuracy: double, f1_score: double, precision: double, recall: double>"
    schema = f"best_model string, best_accuracy double, best_f1 double, all_results map<string, {scores}>"
    stored = spark.read.schema(schema).json(path)
    each = stored.select("best_model", "best_accuracy", "best_f1", F.explode("all_results").alias("model", "scores"))
    return rounded(each.select("best_model", "best_accuracy", "best_f1", "model", "scores.*"))


def compare_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy and F1 of the rules under their display names."""
    compared = comparison_table(evaluate.metrics(rule_predictions(stored_bars(spark, sf_dir))))
    return rounded(compared.withColumn("model", display_name("model")))


def stream_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars from the events read as a stream. Each batch writes the bars it changed; the last state of a bar counts,
    so bars that the watermark has not closed yet are there too."""
    source = table(spark, sf_dir, "events")
    ticks = spark.readStream.schema(source.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    bars = bar_stream(ticks, "event_type", "ts", "value", ("ts", "event_id"), "1 hour")
    root = _fresh_folder(spark, "streams")

    def store(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{root}/bars/{number}")

    writer = bars.writeStream.outputMode("update").foreachBatch(store)
    writer = writer.option("checkpointLocation", f"{root}/state").trigger(availableNow=True)
    writer.start().awaitTermination()
    schema = T.StructType([*bars.schema.fields, T.StructField("batch", T.IntegerType())])
    written = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{root}/bars")
    values = [c for c in bars.columns if c not in KEY]
    return written.groupBy(*KEY).agg(*(F.max_by(c, "batch").alias(c) for c in values))


STRUCTURE = (structure.liquidity(), structure.trend_flags(), structure.breaks(), structure.order_blocks(), structure.fair_value_gaps())


def _on_tail(build: Callable[[SeriesStore], DataFrame]) -> Query:
    """Over hourly bars in a store: only the last ones and what they need are read for features."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(build(SeriesStore.create(bars_1h(spark, sf_dir), _fresh_folder(spark, "series"), HOURLY)))

    return query


def stream_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RSI of hourly bars that arrive in batches of a week each; the state holds the bars that RSI reaches back for."""
    root = _fresh_folder(spark, "streams")
    bars = stored_bars(spark, sf_dir).withColumn("week", F.floor(F.datediff(F.to_date("bar_ts"), F.lit("2024-01-01")) / 7))
    bars = materialize(bars)
    weeks = [r["week"] for r in bars.select("week").distinct().orderBy("week").collect()]
    for week in weeks:  # a file a batch
        bars.filter(F.col("week") == week).drop("week").coalesce(1).write.mode("append").parquet(f"{root}/bars")
    arriving = spark.readStream.schema(bars.drop("week").schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/bars")
    steps = (technical.rsi(),)

    def store(rows: DataFrame, number: int) -> None:
        shown = rows.select(*KEY, "rsi", "rsi_overbought", "rsi_oversold")
        shown.write.mode("overwrite").parquet(f"{root}/features/batch={number}")

    writer = with_reach(arriving, reach_of(steps)).writeStream.foreachBatch(feature_batches(steps, HOURLY, store))
    writer = writer.option("checkpointLocation", f"{root}/state").trigger(availableNow=True)
    writer.start().awaitTermination()
    return rounded(spark.read.parquet(f"{root}/features").drop("batch"))


def series_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On-balance volume and average price of hourly bars that were stored in two parts; the ticks are read once."""
    bars = stored_bars(spark, sf_dir)
    half = F.col("bar_ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    store = SeriesStore.create(bars.filter(half), _fresh_folder(spark, "series"), HOURLY)
    store.append(bars.filter(~half))
    columns = ("obv", "obv_ma", "obv_trend", "vwap", "dist_to_vwap", "bullish_ob", "bearish_ob")
    steps = (volume.on_balance_volume(), volume.vwap(), structure.order_blocks())
    return rounded(store.compute(*steps).select(*KEY, *columns))


QUERIES: dict[str, Query] = {
    "summary_per_symbol": summary_per_symbol,
    # sources
    "bars_1h": lambda spark, sf_dir: rounded(bars_1h(spark, sf_dir)),
    "bars_15m": lambda spark, sf_dir: rounded(bars_15m(spark, sf_dir)),
    "bars_orders_1d": lambda spark, sf_dir: rounded(bars_orders_1d(spark, sf_dir)),
    "bars_csv": bars_csv,
    "unique_bars": _on_bars(lambda b: unique_bars(b.union(b.withColumn("open", F.col("open") + 1)))),
    "stored_panel": stored_panel,
    "evaluation_csv": evaluation_csv,
    "evaluation_details": evaluation_details,
    "compare_rules": compare_rules,
    "dataset_summary": _on_bars(profile.dataset_summary),
    # filters and cleaning
    "time_range": _on_bars(lambda b: b, _bars_of_a_week),
    "last_n_bars": _on_bars(lambda b: last_bars(b, 50, HOURLY)),
    "null_counts": _on_bars(lambda b: clean.null_counts(_with_gaps(b))),
    "ffill_bfill": _on_bars(lambda b: clean.fill_gaps(_with_gaps(b), HOURLY, PRICES)),
    "sigma_filter": _on_bars(lambda b: clean.traded(clean.sigma_filter(b, HOURLY))),
    "finite_rows": _on_bars(
        lambda b: dataset.finite_rows(
            compute(b, HOURLY, technical.momentum(), technical.volatility()), ("momentum_20", "volatility_20")
        ).select(*KEY, "momentum_20", "volatility_20")
    ),
    "zero_filled": _on_bars(
        lambda b: dataset.zero_filled(
            compute(b, HOURLY, technical.momentum(), technical.volatility()), ("momentum_20", "volatility_20")
        ).select(*KEY, "momentum_20", "volatility_20")
    ),
    "random_subset": _on_bars(lambda b: model.random_subset(b, 500)),
    # retracement levels
    "fib_levels": _features(
        ("rolling_high", "rolling_low", "price_range", *charts.FIB_NAMES), fibonacci.fibonacci()
    ),
    "fib_distance": _features(tuple(f"dist_to_{n}" for n in charts.FIB_INNER), fibonacci.fibonacci()),
    "fib_position_high": _features(("fib_position",), fibonacci.fibonacci(anchor="high")),
    "fib_position_low": _features(("fib_position",), fibonacci.fibonacci(anchor="low")),
    # market structure
    "swings": _features(("swing_high", "swing_low"), structure.swings()),
    "structure_flags": _features(
        ("higher_high", "lower_low", "higher_low", "lower_high"), structure.trend_flags()
    ),
    "choch": _features(("choch",), structure.trend_flags()),
    "bos": _features(("bos_bullish", "bos_bearish"), structure.breaks()),
    "liquidity_levels": _features(
        ("resistance_level", "support_level", "near_resistance", "near_support"), structure.liquidity()
    ),
    "liquidity_sweeps": _features(("liquidity_sweep_up", "liquidity_sweep_down"), structure.liquidity()),
    "order_blocks": _features(("bullish_ob", "bearish_ob"), structure.order_blocks()),
    "order_blocks_trailing": _features(("bullish_ob", "bearish_ob"), structure.order_blocks(window=50)),
    "fair_value_gaps": _features(("fvg_bullish", "fvg_bearish"), structure.fair_value_gaps()),
    # volume
    "volume_ma": _features(
        ("volume_ma_10", "volume_ma_20", "volume_ratio", "volume_trend"), volume.volume_average()
    ),
    "volume_price_corr": _features(("price_change", "volume_price_corr"), volume.price_volume_correlation()),
    "obv": _features(("obv", "obv_ma", "obv_trend"), volume.on_balance_volume()),
    "vwap": _features(("vwap", "dist_to_vwap"), volume.vwap()),
    "vwap_session": _on_bars(lambda b: volume.session_vwap(b, HOURLY).select(*KEY, "session_vwap")),
    # technical indicators
    "sma": _features(tuple(f"sma_{k}" for k in (5, 10, 20, 50, 100)), technical.sma()),
    "ema": _features(tuple(f"ema_{k}" for k in (5, 10, 20, 50, 100)), technical.ema()),
    "ma_flags": _features(
        ("price_above_sma20", "price_above_sma50", "ma_cross_10_20", "ma_cross_20_50"), technical.average_flags()
    ),
    "rsi": _features(("rsi", "rsi_overbought", "rsi_oversold"), technical.rsi()),
    "macd": _features(("macd", "macd_signal", "macd_histogram", "macd_bullish"), technical.macd()),
    "bollinger": _features(
        ("bb_middle", "bb_upper", "bb_lower", "bb_width", "bb_position", "bb_squeeze"), technical.bollinger()
    ),
    "atr": _features(("true_range", "atr", "atr_ratio"), technical.atr()),
    "atr_simple": _features(("atr", "atr_ratio"), technical.atr(true_range=False)),
    "stochastic": _features(("stoch_k", "stoch_d"), technical.stochastic()),
    "momentum": _features(("momentum_5", "momentum_10", "momentum_20"), technical.momentum()),
    "volatility": _features(("volatility_20",), technical.volatility()),
    "candle_shape": _features(("body", "upper_shadow", "lower_shadow"), technical.candle_shape()),
    # label and feature sets
    "target": _features(("close", "target"), label.target()),
    "target_known": _on_bars(lambda b: label.labelled(_known_labels(b))),
    "label_distribution": _on_bars(lambda b: label.label_distribution(_labelled(b))),
    "features_full77": _feature_set("full77"),
    "features_core24": _feature_set("core24"),
    "features_core35": _feature_set("core35"),
    "features_mini8": _feature_set("mini8"),
    # training sets
    "split_random": _on_bars(lambda b: dataset.split_random(materialize(_labelled(b))), stored_bars),
    "split_embargo": _on_bars(_embargo, stored_bars),
    "split_time": _on_bars(lambda b: dataset.split_time(materialize(_labelled(b))), stored_bars),
    "folds": _on_bars(lambda b: dataset.folds(materialize(_labelled(b))), stored_bars),
    "class_weights": _on_bars(lambda b: dataset.class_weights(_labelled(b))),
    "robust_scaled": _on_bars(_scaled, stored_bars),
    # evaluation
    "metrics": _on_rules(evaluate.metrics),
    "metrics_long": _on_rules(evaluate.metrics_long),
    "confusion": _on_rules(evaluate.confusion),
    "class_report": _on_rules(evaluate.class_report),
    "outcomes": _on_rules(evaluate.outcomes),
    "roc": _on_rules(lambda p: charts.model_comparison(p)["roc"]),
    "auc": _on_rules(lambda p: charts.model_comparison(p)["auc"]),
    "pr_curve": _on_rules(lambda p: charts.model_comparison(p)["precision_recall"]),
    "avg_precision": _on_rules(lambda p: charts.model_comparison(p)["average_precision"]),
    "calibration": _on_rules(lambda p: charts.model_comparison(p)["calibration"]),
    "confidence_bins": _on_rules(evaluate.confidence_bins),
    "confidence_hist": _on_rules(evaluate.confidence_histogram, ("rsi",)),
    "rank_models": _on_rules(_rank_rules),
    "rolling_accuracy": _with_bars(lambda p, b: charts.prediction_tables(p, b, HOURLY)["rolling_accuracy"]),
    "hourly_accuracy": _with_bars(lambda p, b: charts.prediction_tables(p, b, HOURLY)["hourly_accuracy"]),
    "prediction_outcomes": _with_bars(lambda p, b: charts.prediction_tables(p, b, HOURLY)["outcomes"]),
    "error_by_quintile": _with_bars(_error_by_quintile),
    # backtest
    "equity": _with_bars(_equity),
    "rolling_sharpe": _with_bars(lambda p, b: charts.backtest_tables(p, b, HOURLY)["curve"].select(*KEY, "rolling_sharpe")),
    "backtest_summary": _with_bars(_backtest_summary),
    # profiles
    "column_summary": _on_bars(lambda b: profile.column_summary(b, "close")),
    "last_close": _on_bars(profile.last_close),
    "volume_median": _on_bars(lambda b: series_quantile(b, "volume", 0.5)),
    "volume_hist": _on_bars(lambda b: profile.histogram(b, "volume", HOURLY), stored_bars),
    "volume_profile": _on_bars(lambda b: profile.volume_profile(b, HOURLY), stored_bars),
    "volume_profile_closed": _on_bars(lambda b: profile.volume_profile(b, HOURLY, close_last=True), stored_bars),
    "volume_vs_return": _on_bars(
        lambda b: profile.volume_against_change(
            compute(b, HOURLY, volume.volume_average(), volume.price_volume_correlation(), label.target())
        )
    ),
    "corr_matrix": _on_bars(lambda b: charts.correlation(_full(b))["matrix"]),
    "corr_upper": _on_bars(lambda b: profile.corr_matrix(_full(b), charts.CORRELATED, upper=True)),
    "target_corr": _on_bars(lambda b: charts.correlation(_full(b))["target"]),
    "class_hist": _on_bars(
        lambda b: charts.distributions(_stored(_full(b), (*charts.DISTRIBUTED, "target")))["density"], stored_bars
    ),
    "class_means": _on_bars(lambda b: charts.distributions(_full(b))["means"]),
    # chart tables not covered above
    "chart_price": _on_bars(lambda b: charts.price_overview(_full(b))),
    "chart_fibonacci": _on_tail(lambda s: charts.fibonacci_levels(s.tail(500, fibonacci.fibonacci()), HOURLY)),
    "chart_structure": _on_tail(lambda s: charts.market_structure(s.tail(300, *STRUCTURE), HOURLY)),
    # streaming
    "stream_features": stream_features,
    "series_append": series_append,
    "stream_bars": lambda spark, sf_dir: rounded(stream_bars(spark, sf_dir)),
    # models
    "train_forest": _train("random_forest", numTrees=100, maxDepth=15),
    "train_gbt": _train("gradient_boosting", maxIter=100, maxDepth=4, stepSize=0.1),
    "train_gbt_subsample": _train("boosted_subsample", maxIter=100, maxDepth=3, stepSize=0.1, subsamplingRate=0.8),
    "train_logistic": _train("logistic_regression", C=1.0),
    "train_linear_svm": _train("linear_svm", C=1.0),
    "grid_search": grid_search,
    "compare_models": compare_models,
    "importance_top": importance_top,
    "pca_variance": pca_variance,
    "pca_scores": pca_scores,
    "learning_curve": learning_curve,
    "score_new_rows": score_new_rows,
}
