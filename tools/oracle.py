"""The same queries as plain SQL, for a second engine to check the results.

The SQL is written against the definitions, over whole series; it shares no code with the operators.
"""

from __future__ import annotations

from collections.abc import Sequence

from barloom.plans.charts import CORRELATED, DISTRIBUTED, ERROR_DRIVERS, SIGNALS
from barloom.plans.rounding import ROUNDING_NUDGE
from barloom.schema import AVERAGE_SPANS, FEATURE_SETS, FIB_INNER, FIB_NAMES, FIB_RATIOS, MINI8

_W = "PARTITION BY symbol ORDER BY bar_ts"


def _bars(table: str, symbol: str, ts: str, price: str, order: str, every: str) -> str:
    return f"""bars AS (
  SELECT {symbol} AS symbol, time_bucket(INTERVAL '{every}', {ts}) AS bar_ts,
    first({price} ORDER BY {order}) AS open, max({price}) AS high, min({price}) AS low,
    last({price} ORDER BY {order}) AS close, count(*) AS volume
  FROM {table} GROUP BY 1, 2)"""


BARS_1H = _bars("events", "event_type", "ts", "value", "ts, event_id", "1 hour")
BARS_15M = _bars("events", "'all'", "ts", "value", "ts, event_id", "15 minutes")
BARS_ORDERS = _bars("orders", "o_orderpriority", "o_orderdate", "o_totalprice", "o_orderdate, o_orderkey", "1 day")


def _last(k: int) -> str:
    return f"OVER ({_W} ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"


def _before(k: int, skip: int = 0) -> str:
    return f"OVER ({_W} ROWS BETWEEN {k + skip} PRECEDING AND {1 + skip} PRECEDING)"


def _all(frame: str = "UNBOUNDED PRECEDING AND CURRENT ROW") -> str:
    return f"OVER ({_W} ROWS BETWEEN {frame})"


def _flag(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


def _gt(a: str, b: str) -> str:
    """Comparison of computed values, blind to the last digits."""
    return f"round({a}, 9) > round({b}, 9)"


def _gated(aggregate: str, column: str, frame: str, k: int) -> str:
    return f"CASE WHEN count({column}) {frame} = {k} THEN {aggregate}({column}) {frame} END"


_centred = f"OVER ({_W} ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)"

_STEP1 = f"""s1 AS (
  SELECT *, row_number() OVER ({_W}) - 1 AS bar_no,
    lag(close) OVER ({_W}) AS prev_close, lead(close, 6) OVER ({_W}) AS later_close,
    lag(high, 2) OVER ({_W}) AS high_2, lag(low, 2) OVER ({_W}) AS low_2,
    max(high) {_last(100)} AS rolling_high, min(low) {_last(100)} AS rolling_low,
    {_gated("max", "high", _centred, 11)} AS centred_high, {_gated("min", "low", _centred, 11)} AS centred_low,
    {_gated("max", "high", _before(10), 10)} AS top_10, {_gated("min", "low", _before(10), 10)} AS bottom_10,
    {_gated("max", "high", _before(20, 1), 20)} AS top_20, {_gated("min", "low", _before(20, 1), 20)} AS bottom_20,
    max(high) {_last(50)} AS resistance_level, min(low) {_last(50)} AS support_level,
    max(high) {_before(50)} AS prev_resistance, min(low) {_before(50)} AS prev_support,
    stddev_samp(close) OVER (PARTITION BY symbol) AS close_std, stddev_samp(close) {_last(50)} AS close_std_50,
    avg(volume) {_last(10)} AS volume_ma_10, avg(volume) {_last(20)} AS volume_ma_20,
    sum(close * volume) {_all()} / nullif(sum(volume) {_all()}, 0) AS vwap,
    {", ".join(f"avg(close) {_last(k)} AS sma_{k}" for k in AVERAGE_SPANS)},
    stddev_samp(close) {_last(20)} AS std_20,
    min(low) {_last(14)} AS low_14, max(high) {_last(14)} AS high_14,
    {", ".join(f"close / nullif(lag(close, {n}) OVER ({_W}), 0) - 1 AS momentum_{n}" for n in (5, 10, 20))}
  FROM bars)"""

_STEP2 = f"""s2 AS (
  SELECT *, rolling_high - rolling_low AS price_range,
    {_flag("high = centred_high")} AS swing_high, {_flag("low = centred_low")} AS swing_low,
    {_flag("high > top_10")} AS higher_high, {_flag("low < bottom_10")} AS lower_low,
    {_flag("low > bottom_10")} AS higher_low, {_flag("high < top_10")} AS lower_high,
    {_flag("close > top_20")} AS bos_bullish, {_flag("close < bottom_20")} AS bos_bearish,
    {_flag(_gt("close", "resistance_level * 0.995"))} AS near_resistance,
    {_flag(_gt("support_level * 1.005", "close"))} AS near_support,
    {_flag("high > prev_resistance AND close < prev_resistance")} AS liquidity_sweep_up,
    {_flag("low < prev_support AND close > prev_support")} AS liquidity_sweep_down,
    {_flag("close > open AND " + _gt("close - open", "close_std * 0.5"))} AS bullish_ob,
    {_flag("close < open AND " + _gt("open - close", "close_std * 0.5"))} AS bearish_ob,
    {_flag("close > open AND " + _gt("close - open", "close_std_50 * 0.5"))} AS bullish_ob_50,
    {_flag("close < open AND " + _gt("open - close", "close_std_50 * 0.5"))} AS bearish_ob_50,
    {_flag("low > high_2")} AS fvg_bullish, {_flag("high < low_2")} AS fvg_bearish,
    volume / nullif(volume_ma_20, 0) AS volume_ratio, {_flag(_gt("volume", "volume_ma_10"))} AS volume_trend,
    close / nullif(prev_close, 0) - 1 AS price_change, (close - vwap) / nullif(vwap, 0) AS dist_to_vwap,
    sum(sign(close - prev_close) * volume) {_all()} AS obv,
    {_flag(_gt("close", "sma_20"))} AS price_above_sma20, {_flag(_gt("close", "sma_50"))} AS price_above_sma50,
    {_flag(_gt("sma_10", "sma_20"))} AS ma_cross_10_20, {_flag(_gt("sma_20", "sma_50"))} AS ma_cross_20_50,
    CASE WHEN close - prev_close > 0 THEN close - prev_close ELSE 0.0 END AS gain,
    CASE WHEN close - prev_close < 0 THEN prev_close - close ELSE 0.0 END AS loss,
    sma_20 AS bb_middle, sma_20 + 2 * std_20 AS bb_upper, sma_20 - 2 * std_20 AS bb_lower,
    greatest(high - low, coalesce(abs(high - prev_close), 0), coalesce(abs(low - prev_close), 0)) AS true_range,
    100 * (close - low_14) / (high_14 - low_14 + 1e-10) AS stoch_k,
    close - open AS body, high - greatest(open, close) AS upper_shadow, least(open, close) - low AS lower_shadow,
    CASE WHEN close = 0 THEN {_flag("later_close > 0")}
      ELSE {_flag("later_close / nullif(close, 0) - 1 > 0.001")} END AS target
  FROM s1)"""

_fib_levels = ", ".join(f"rolling_high - {r} * price_range AS {n}" for n, r in zip(FIB_NAMES, FIB_RATIOS))
_mask = "CASE WHEN price_change IS NOT NULL THEN volume END"

_STEP3 = f"""s3 AS (
  SELECT *, {_fib_levels},
    (close - rolling_high) / nullif(price_range, 0) AS fib_position_high,
    (close - rolling_low) / nullif(price_range, 0) AS fib_position_low,
    lag(higher_high, 1, 0) OVER ({_W}) AS was_high, lag(lower_low, 1, 0) OVER ({_W}) AS was_low,
    coalesce(covar_samp({_mask}, abs(price_change)) {_last(20)} / nullif(
      stddev_samp({_mask}) {_last(20)} * stddev_samp(abs(price_change)) {_last(20)}, 0), 0) AS volume_price_corr,
    avg(obv) {_last(20)} AS obv_ma,
    100 - 100 / (1 + avg(gain) {_last(14)} / (avg(loss) {_last(14)} + 1e-10)) AS rsi,
    (bb_upper - bb_lower) / nullif(bb_middle, 0) AS bb_width,
    (close - bb_lower) / (bb_upper - bb_lower + 1e-10) AS bb_position,
    avg(true_range) {_last(14)} AS atr, avg(high - low) {_last(14)} AS atr_simple,
    avg(stoch_k) {_last(3)} AS stoch_d, stddev_samp(price_change) {_last(20)} AS volatility_20
  FROM s2)"""

_STEP4 = f"""s4 AS (
  SELECT *, {", ".join(f"(close - {n}) / nullif(price_range, 0) AS dist_to_{n}" for n in FIB_INNER)},
    {_flag("(was_high = 1 AND lower_low = 1) OR (was_low = 1 AND higher_high = 1)")} AS choch,
    {_flag(_gt("obv", "obv_ma"))} AS obv_trend,
    {_flag("rsi > 70")} AS rsi_overbought, {_flag("rsi < 30")} AS rsi_oversold,
    {_flag(_gt("avg(bb_width) " + _last(50) + " * 0.8", "bb_width"))} AS bb_squeeze,
    atr / nullif(close, 0) AS atr_ratio, atr_simple / nullif(close, 0) AS atr_simple_ratio
  FROM s3)"""

_FEATURES = f"{BARS_1H}, {_STEP1}, {_STEP2}, {_STEP3}, {_STEP4}"


def _decay(column: str, value: str, span: int) -> str:
    alpha = 2 / (span + 1)
    return f"{alpha!r} * {value} + {1 - alpha!r} * {column}"


_SPANS = {**{f"ema_{k}": k for k in AVERAGE_SPANS}, "fast": 12, "slow": 26}
_next = {n: _decay(f"e.{n}", "b.close", k) for n, k in _SPANS.items()}
_RECURSION = f"""walk AS (
  SELECT symbol, bar_no, {", ".join(f"close AS {n}" for n in _SPANS)}, 0.0::DOUBLE AS macd_signal
  FROM s1 WHERE bar_no = 0
  UNION ALL
  SELECT b.symbol, b.bar_no, {", ".join(_next.values())},
    {_decay("e.macd_signal", f"(({_next['fast']}) - ({_next['slow']}))", 9)}
  FROM walk e JOIN s1 b ON b.symbol = e.symbol AND b.bar_no = e.bar_no + 1),
feat AS (
  SELECT s4.*, {", ".join(f"ema_{k}" for k in AVERAGE_SPANS)}, fast - slow AS macd, macd_signal,
    fast - slow - macd_signal AS macd_histogram, {_flag(_gt("fast - slow", "macd_signal"))} AS macd_bullish
  FROM s4 JOIN walk USING (symbol, bar_no))"""

# Integers and texts among the result columns; everything else is a double and is rounded.
_EXACT = {
    "symbol", "bar_ts", "label_ts", "bar_no", "volume", "target", "split", "fold", "rows", "bin", "label", "prediction", "model",
    "class", "support", "hour", "first_ts", "last_ts", "feature", "feature_a", "feature_b", "metric", "place",
    "best", "outcome", "correct", "error", "candle", "histogram_side", "signal", "higher_highs",
    "swing_high", "swing_low", "higher_high", "lower_low", "higher_low", "lower_high", "bos_bullish",
    "bos_bearish", "choch", "near_resistance", "near_support", "liquidity_sweep_up", "liquidity_sweep_down",
    "bullish_ob", "bearish_ob", "fvg_bullish", "fvg_bearish", "volume_trend", "obv_trend", "price_above_sma20",
    "price_above_sma50", "ma_cross_10_20", "ma_cross_20_50", "rsi_overbought", "rsi_oversold", "macd_bullish",
    "bb_squeeze", "best_model",
}


def _query(
    ctes: str, columns: Sequence[str], source: str, recursive: bool = False, doubles: Sequence[str] = ()
) -> str:
    """Select columns, given as ``name`` or ``expression AS name``, rounded where they are doubles."""
    inner, outer = [], []
    for c in columns:
        name = c.rsplit(" AS ", 1)[-1]
        inner.append(c)
        if name in _EXACT and name not in doubles:
            outer.append(name)
        else:
            nudged = f"round({name} * {ROUNDING_NUDGE!r}, 6)"
            outer.append(f"CASE WHEN abs({name}) < 4.9e-7 THEN 0.0::DOUBLE ELSE {nudged} END AS {name}")
    head = "WITH RECURSIVE" if recursive else "WITH"
    return f"{head} {ctes}\nSELECT {', '.join(outer)} FROM (SELECT {', '.join(inner)} FROM {source}) AS result"


def _features(*columns: str) -> str:
    return _query(_FEATURES, ["symbol", "bar_ts", *columns], "s4")


def _averages(*columns: str) -> str:
    return _query(f"{_FEATURES}, {_RECURSION}", ["symbol", "bar_ts", *columns], "feat", recursive=True)


def _feature_set(name: str, anchor: str, simple_range: bool = False) -> str:
    special = {"fib_position": f"fib_position_{anchor} AS fib_position"}
    if simple_range:
        special |= {"atr": "atr_simple AS atr", "atr_ratio": "atr_simple_ratio AS atr_ratio"}
    return _averages("target", *(special.get(c, c) for c in FEATURE_SETS[name]))


_BARS = ("symbol", "bar_ts", "open", "high", "low", "close", "volume")
_OPEN_BARS = f"WITH {BARS_1H}"
_GAPS = f"""{BARS_1H}, gaps AS (
  SELECT symbol, bar_ts, {", ".join(f"CASE WHEN volume > 1 THEN {c} END AS {c}" for c in _BARS[2:6])}, volume
  FROM bars)"""


def _filled(c: str) -> str:
    return (
        f"coalesce(last_value({c} IGNORE NULLS) {_all()}, "
        f"first_value({c} IGNORE NULLS) {_all('CURRENT ROW AND UNBOUNDED FOLLOWING')}) AS {c}"
    )


def _sigma() -> str:
    ctes, source = [BARS_1H], "bars"
    for i, c in enumerate(_BARS[2:6]):
        mean, std = (f"{f}({c}) OVER (PARTITION BY symbol)" for f in ("avg", "stddev_samp"))
        ctes.append(
            f"r{i} AS (SELECT * FROM {source} "
            f"QUALIFY {c} >= {mean} - 3 * {std} AND {c} <= {mean} + 3 * {std})"
        )
        source = f"r{i}"
    return _query(", ".join(ctes), _BARS, f"{source} WHERE volume > 0")


def _hash(seed: int) -> str:
    return f"md5(symbol || '|' || epoch_us(bar_ts) || '|{seed}')"


_LABELLED = f"""{_FEATURES}, labelled AS (
  SELECT *, row_number() OVER (PARTITION BY target ORDER BY {_hash(42)}) AS class_rank,
    count(*) OVER (PARTITION BY target) AS class_rows FROM s4)"""


def _fold(rank: str, rows: str, k: int = 5) -> str:
    """Ranges of ranks; the first ``rows % k`` folds have one row more."""
    ends = (f"CASE WHEN {rank} > {j} * ({rows} // {k}) + least({j}, {rows} % {k}) THEN 1 ELSE 0 END" for j in range(1, k))
    return f"CAST({' + '.join(ends)} AS INT)"


_SPLIT = "CASE WHEN class_rank <= class_rows * 0.2 THEN 'test' ELSE 'train' END AS split"

# Predictions of three fixed rules.
_clip = "greatest(least({}, 1.0), 0.0)"
_scores = {
    "rsi": "1 - rsi / 100",
    "bands": _clip.format("1 - bb_position"),
    "stochastic": _clip.format("1 - stoch_k / 100"),
}
_known = {"rsi": "rsi", "bands": "bb_position", "stochastic": "stoch_k"}
_PRED = (
    f"{_FEATURES}, scored AS ("
    + " UNION ALL ".join(
        f"SELECT symbol, bar_ts, '{m}' AS model, target AS label, round({e}, 6) AS probability "
        f"FROM s4 WHERE {_known[m]} IS NOT NULL"
        for m, e in _scores.items()
    )
    + f"), pred AS (SELECT symbol, bar_ts, model, label, {_flag('probability > 0.5')} AS prediction, probability, "
    f"CAST(label = {_flag('probability > 0.5')} AS INT) AS correct FROM scored)"
)
_CELLS = f"""{_PRED}, cells AS (
  SELECT model, count(*) AS rows, count(*) FILTER (label = 1 AND prediction = 1) AS tp,
    count(*) FILTER (label = 0 AND prediction = 1) AS fp, count(*) FILTER (label = 0 AND prediction = 0) AS tn,
    count(*) FILTER (label = 1 AND prediction = 0) AS fn FROM pred GROUP BY model)"""


def _part(a: str, b: str) -> str:
    return f"coalesce(({a}) / nullif({b}, 0), 0)"


_SCORES = [
    "(tp + tn) / rows AS accuracy",
    f"{_part('tp', 'tp + fp')} AS precision",
    f"{_part('tp', 'tp + fn')} AS recall",
    f"{_part('2 * tp', '2 * tp + fp + fn')} AS f1_score",
]
_CURVE = f"""{_PRED}, curve AS (
  SELECT model, score, positives, negatives, sum(positives) OVER w AS tp, sum(negatives) OVER w AS fp,
    sum(positives) OVER (PARTITION BY model) AS p, sum(negatives) OVER (PARTITION BY model) AS n
  FROM (SELECT model, probability AS score, count(*) FILTER (label = 1) AS positives,
    count(*) FILTER (label = 0) AS negatives FROM pred GROUP BY 1, 2)
  WINDOW w AS (PARTITION BY model ORDER BY score DESC))"""
_BIN10 = "CAST(least(greatest(ceil(probability * 10), 1), 10) AS INT)"

_REPORT = f"""{_CELLS}, wide AS (
  SELECT *, {_part("tn", "tn + fn")} AS p0, {_part("tn", "tn + fp")} AS r0,
    {_part("2 * tn", "2 * tn + fp + fn")} AS f0, {_part("tp", "tp + fp")} AS p1, {_part("tp", "tp + fn")} AS r1,
    {_part("2 * tp", "2 * tp + fp + fn")} AS f1, tn + fp AS n0, tp + fn AS n1 FROM cells), report AS (
  SELECT model, '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1_score, n0 AS support FROM wide UNION ALL
  SELECT model, '1', p1, r1, f1, n1 FROM wide UNION ALL
  SELECT model, 'accuracy', NULL, NULL, (tp + tn) / rows, rows FROM wide UNION ALL
  SELECT model, 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, rows FROM wide UNION ALL
  SELECT model, 'weighted avg', (p0 * n0 + p1 * n1) / rows, (r0 * n0 + r1 * n1) / rows,
    (f0 * n0 + f1 * n1) / rows, rows FROM wide)"""

_RANKED = f"""{_CELLS}, folded AS (
  SELECT *, {_fold("class_rank", "class_rows")} AS fold FROM (
    SELECT *, row_number() OVER (PARTITION BY model, label ORDER BY {_hash(42)}) AS class_rank,
      count(*) OVER (PARTITION BY model, label) AS class_rows FROM pred)),
fold_f1 AS (
  SELECT model, fold, 2 * count(*) FILTER (label = 1 AND prediction = 1)
    / nullif(2 * count(*) FILTER (label = 1 AND prediction = 1) + count(*) FILTER (label <> prediction), 0) AS f1
  FROM folded GROUP BY model, fold), results AS (
  SELECT model, {", ".join(_SCORES)}, cv_f1_mean, cv_f1_std FROM cells JOIN (
    SELECT model, avg(coalesce(f1, 0)) AS cv_f1_mean, stddev_pop(coalesce(f1, 0)) AS cv_f1_std
    FROM fold_f1 GROUP BY model) USING (model))"""

_BACKTEST = f"""{_PRED}, moves AS (
  SELECT pred.symbol, pred.bar_ts, bars.close, lag(prediction) OVER w AS position,
    bars.close / nullif(lag(bars.close) OVER w, 0) - 1 AS bar_return
  FROM pred JOIN bars USING (symbol, bar_ts) WHERE model = 'rsi'
  WINDOW w AS (PARTITION BY pred.symbol ORDER BY pred.bar_ts)), earned AS (
  SELECT *, position * bar_return AS strategy_return FROM moves), grown AS (
  SELECT *, product(1 + strategy_return) {_all()} AS cumulative_return,
    product(1 + bar_return) {_all()} AS buy_hold_return,
    CASE WHEN count(strategy_return) {_last(50)} = 50 THEN avg(strategy_return) {_last(50)}
      / nullif(stddev_samp(strategy_return) {_last(50)}, 0) * sqrt(24192) END AS rolling_sharpe
  FROM earned), curve AS (
  SELECT *, max(cumulative_return) {_all()} AS running_max FROM grown)"""


def _log(x: str) -> str:
    return f"CASE WHEN {x} > 0 THEN ln({x}) END"


_DRAWDOWN = "cumulative_return / nullif(running_max, 0) - 1"


def _histogram(source: str, keys: str, value: str, bins: int, extra: str) -> str:
    """Complete equal-width histogram of ``value`` per ``keys``; ``extra`` names the density or nothing."""
    on = " AND ".join(f"e.{k.strip()} = c.{k.strip()}" for k in keys.split(","))
    listed = ", ".join(f"e.{k.strip()}" for k in keys.split(","))
    return f"""known AS (SELECT {keys}, CAST({value} AS DOUBLE) AS v FROM {source} WHERE {value} IS NOT NULL),
ends AS (SELECT {keys}, CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
  CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi FROM known GROUP BY {keys}),
counts AS (SELECT {keys}, CAST(least(floor((v - lo) / ((hi - lo) / {bins})), {bins - 1}) AS INT) AS bin,
  count(*) AS n FROM known JOIN ends USING ({keys}) GROUP BY {keys}, bin),
filled AS (SELECT {listed}, CAST(i AS INT) AS bin, e.lo + i * ((e.hi - e.lo) / {bins}) AS left_edge,
  e.lo + (i + 1) * ((e.hi - e.lo) / {bins}) AS right_edge, coalesce(c.n, 0) AS rows{extra}
  FROM ends e CROSS JOIN range({bins}) t(i) LEFT JOIN counts c ON {on} AND c.bin = i)"""


def _profile(close_last: bool) -> str:
    outside = "least(coalesce(bin, 48), 48)" if close_last else "bin"
    return f"""{BARS_1H}, ends AS (
  SELECT symbol, min(close) AS lo, (max(close) - min(close)) / 49 AS step FROM bars GROUP BY symbol), guess AS (
  SELECT bars.*, lo, step, CAST(floor((close - lo) / nullif(step, 0)) AS INT) AS g FROM bars JOIN ends USING (symbol)),
placed AS (
  SELECT *, CASE WHEN close < lo + g * step THEN g - 1 WHEN close >= lo + (g + 1) * step THEN g + 1 ELSE g END AS bin
  FROM guess), sums AS (
  SELECT symbol, {outside} AS bin, CAST(sum(volume) AS BIGINT) AS volume FROM placed GROUP BY 1, 2), profile AS (
  SELECT e.symbol, CAST(i AS INT) AS bin, lo + i * step AS price_from, lo + (i + 1) * step AS price_to,
    coalesce(s.volume, 0) AS volume
  FROM ends e CROSS JOIN range(49) t(i) LEFT JOIN sums s ON s.symbol = e.symbol AND s.bin = i)"""


def _long(columns: Sequence[str], source: str, keep: str) -> str:
    return "long AS (" + " UNION ALL ".join(
        f"SELECT {keep}, '{c}' AS feature, CAST({_alias(c)} AS DOUBLE) AS value FROM {source} WHERE {_alias(c)} IS NOT NULL"
        for c in columns
    ) + ")"


def _alias(c: str) -> str:
    return "fib_position_high" if c == "fib_position" else c


def _pairs(upper: bool) -> str:
    ctes = f"{_FEATURES}, {_RECURSION}, long AS (" + " UNION ALL ".join(
        f"SELECT symbol, bar_ts, {i} AS i, '{c}' AS feature, CAST({_alias(c)} AS DOUBLE) AS value FROM feat"
        for i, c in enumerate(CORRELATED)
    ) + ")"
    where = "a.i < b.i" if upper else "true"
    return f"""{ctes}, corrs AS (
  SELECT a.feature AS feature_a, b.feature AS feature_b, covar_samp(a.value, b.value)
    / nullif(stddev_samp(a.value) * stddev_samp(b.value), 0) AS corr
  FROM long a JOIN long b USING (symbol, bar_ts)
  WHERE {where} AND a.value IS NOT NULL AND b.value IS NOT NULL GROUP BY 1, 2)"""


def _quintiles() -> str:
    ctes, parts = [], []
    for c in ERROR_DRIVERS:
        ctes.append(
            f"edge_{c} AS (SELECT list_sort(list_distinct(quantile_cont(CAST({c} AS DOUBLE), "
            f"[0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS e FROM s4)"
        )
        parts.append(
            f"SELECT '{c}' AS feature, CAST(len(list_filter(e[2:len(e) - 1], lambda x: x < {c})) AS INT) AS bin, "
            f"1 - correct AS error FROM pred JOIN s4 USING (symbol, bar_ts), edge_{c} "
            f"WHERE model = 'rsi' AND {c} IS NOT NULL"
        )
    return f"{_PRED}, {', '.join(ctes)}, binned AS ({' UNION ALL '.join(parts)})"


_signals = " UNION ALL ".join(
    f"SELECT symbol, bar_ts, '{s}' AS signal FROM recent WHERE {s} = 1" for s in SIGNALS
)


def _quartile_scaled() -> list[str]:
    out = []
    for c in MINI8:
        q = f"(SELECT quantile_cont(CAST({c} AS DOUBLE), {{}}) FROM train)"
        spread = f"{q.format(0.75)} - {q.format(0.25)}"
        out.append(
            f"({c} - {q.format(0.5)}) / CASE WHEN {spread} = 0 THEN 1 ELSE {spread} END AS {c}"
        )
    return out


ORACLE: dict[str, str] = {
    "summary_per_symbol": _query(
        _FEATURES,
        [
            "symbol", "count(*) AS rows", "avg(target) AS up_share", "avg(rsi) FILTER (target = 1) AS rsi_up",
            "avg(rsi) FILTER (target = 0) AS rsi_down", "CAST(sum(higher_high) AS BIGINT) AS higher_highs",
            "avg(close - sma_20) AS mean_gap",
        ],
        "s4 GROUP BY symbol",
    ),
    "bars_1h": _query(BARS_1H, _BARS, "bars"),
    "bars_15m": _query(BARS_15M, _BARS, "bars"),
    "bars_orders_1d": _query(BARS_ORDERS, _BARS, "bars"),
    "bars_csv": _query(BARS_15M, [*_BARS[:-1], "CAST(volume AS DOUBLE) AS volume"], "bars"),
    "unique_bars": _query(BARS_1H, _BARS, "bars"),
    "stored_panel": _query(
        BARS_1H, [*_BARS, f"row_number() OVER ({_W}) - 1 AS bar_no"], "bars"
    ),
    "evaluation_csv": _query(_CELLS, ["model", *_SCORES], "cells"),
    "evaluation_details": _query(
        f"{_CELLS}, wide AS (SELECT model, {', '.join(_SCORES)} FROM cells), "
        "top AS (SELECT model, accuracy, f1_score FROM wide ORDER BY f1_score DESC, model LIMIT 1)",
        ["top.model AS best_model", "top.accuracy AS best_accuracy", "top.f1_score AS best_f1", "wide.model AS model",
         *(f"wide.{c} AS {c}" for c in ("accuracy", "f1_score", "precision", "recall"))],
        "wide, top",
    ),
    "compare_rules": _query(
        f"{_CELLS}, wide AS (SELECT model AS rule, {', '.join(_SCORES)} FROM cells)",
        ["upper(rule[1]) || rule[2:] AS model", "accuracy", "f1_score"],
        "wide",
    ),
    "dataset_summary": f"{_OPEN_BARS} SELECT symbol, count(*) AS rows, min(bar_ts) AS first_ts, "
    "max(bar_ts) AS last_ts FROM bars GROUP BY symbol",
    "time_range": _query(
        BARS_1H, _BARS, "bars WHERE bar_ts >= TIMESTAMP '2024-01-08' AND bar_ts < TIMESTAMP '2024-01-15'"
    ),
    "last_n_bars": _query(
        BARS_1H, _BARS, "bars QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY bar_ts DESC) <= 50"
    ),
    "null_counts": f"WITH {_GAPS} SELECT "
    + ", ".join(f"count(*) FILTER ({c} IS NULL) AS {c}" for c in _BARS) + " FROM gaps",
    "ffill_bfill": _query(
        _GAPS, ["symbol", "bar_ts", *(_filled(c) for c in _BARS[2:6]), "volume"], "gaps"
    ),
    "sigma_filter": _sigma(),
    "finite_rows": _query(
        _FEATURES, ["symbol", "bar_ts", "momentum_20", "volatility_20"],
        "s4 WHERE momentum_20 IS NOT NULL AND volatility_20 IS NOT NULL",
    ),
    "zero_filled": _features("coalesce(momentum_20, 0) AS momentum_20", "coalesce(volatility_20, 0) AS volatility_20"),
    "random_subset": _query(BARS_1H, _BARS, f"bars ORDER BY {_hash(42)} LIMIT 500"),
    "fib_levels": _features("rolling_high", "rolling_low", "price_range", *FIB_NAMES),
    "fib_distance": _features(*(f"dist_to_{n}" for n in FIB_INNER)),
    "fib_position_high": _features("fib_position_high AS fib_position"),
    "fib_position_low": _features("fib_position_low AS fib_position"),
    "swings": _features("swing_high", "swing_low"),
    "structure_flags": _features("higher_high", "lower_low", "higher_low", "lower_high"),
    "choch": _features("choch"),
    "bos": _features("bos_bullish", "bos_bearish"),
    "liquidity_levels": _features("resistance_level", "support_level", "near_resistance", "near_support"),
    "liquidity_sweeps": _features("liquidity_sweep_up", "liquidity_sweep_down"),
    "order_blocks": _features("bullish_ob", "bearish_ob"),
    "order_blocks_trailing": _features("bullish_ob_50 AS bullish_ob", "bearish_ob_50 AS bearish_ob"),
    "fair_value_gaps": _features("fvg_bullish", "fvg_bearish"),
    "volume_ma": _features("volume_ma_10", "volume_ma_20", "volume_ratio", "volume_trend"),
    "volume_price_corr": _features("price_change", "volume_price_corr"),
    "obv": _features("obv", "obv_ma", "obv_trend"),
    "vwap": _features("vwap", "dist_to_vwap"),
    "vwap_session": _query(
        BARS_1H,
        ["symbol", "bar_ts", "sum(close * volume) OVER d / nullif(sum(volume) OVER d, 0) AS session_vwap"],
        "bars WINDOW d AS (PARTITION BY symbol, CAST(bar_ts AS DATE) ORDER BY bar_ts)",
    ),
    "sma": _features(*(f"sma_{k}" for k in AVERAGE_SPANS)),
    "ema": _averages(*(f"ema_{k}" for k in AVERAGE_SPANS)),
    "ma_flags": _features("price_above_sma20", "price_above_sma50", "ma_cross_10_20", "ma_cross_20_50"),
    "rsi": _features("rsi", "rsi_overbought", "rsi_oversold"),
    "stream_features": _features("rsi", "rsi_overbought", "rsi_oversold"),
    "series_append": _features("obv", "obv_ma", "obv_trend", "vwap", "dist_to_vwap", "bullish_ob", "bearish_ob"),
    "macd": _averages("macd", "macd_signal", "macd_histogram", "macd_bullish"),
    "bollinger": _features("bb_middle", "bb_upper", "bb_lower", "bb_width", "bb_position", "bb_squeeze"),
    "atr": _features("true_range", "atr", "atr_ratio"),
    "atr_simple": _features("atr_simple AS atr", "atr_simple_ratio AS atr_ratio"),
    "stochastic": _features("stoch_k", "stoch_d"),
    "momentum": _features("momentum_5", "momentum_10", "momentum_20"),
    "volatility": _features("volatility_20"),
    "candle_shape": _features("body", "upper_shadow", "lower_shadow"),
    "target": _features("close", "target"),
    "target_known": _query(_FEATURES, ["symbol", "bar_ts", "target"], "s4 WHERE later_close IS NOT NULL"),
    "label_distribution": f"WITH {_FEATURES} SELECT target, count(*) AS rows FROM s4 GROUP BY target",
    "features_full77": _feature_set("full77", "high"),
    "features_core24": _feature_set("core24", "low", simple_range=True),
    "features_core35": _feature_set("core35", "low"),
    "features_mini8": _feature_set("mini8", "low"),
    "split_random": _query(_LABELLED, ["symbol", "bar_ts", "close", "target", _SPLIT], "labelled"),
    "split_embargo": _query(
        _FEATURES + ", later AS (SELECT *, lead(bar_ts, 6) OVER (PARTITION BY symbol ORDER BY bar_ts) AS label_ts FROM s4)",
        ["symbol", "bar_ts", "target", "label_ts",
         "CASE WHEN epoch_us(bar_ts) > (SELECT quantile_cont(CAST(epoch_us(bar_ts) AS DOUBLE), 0.8) FROM s4) "
         "THEN 'test' WHEN epoch_us(label_ts) > (SELECT quantile_cont(CAST(epoch_us(bar_ts) AS DOUBLE), 0.8) FROM s4) "
         "THEN 'embargo' ELSE 'train' END AS split"],
        "later",
    ),
    "split_time": _query(
        _FEATURES,
        [
            "symbol", "bar_ts", "close", "target",
            "CASE WHEN epoch_us(bar_ts) > (SELECT quantile_cont(CAST(epoch_us(bar_ts) AS DOUBLE), 0.8) FROM s4) "
            "THEN 'test' ELSE 'train' END AS split",
        ],
        "s4",
    ),
    "folds": _query(
        _LABELLED, ["symbol", "bar_ts", "close", "target", f"{_fold('class_rank', 'class_rows')} AS fold"], "labelled"
    ),
    "class_weights": _query(
        _FEATURES, ["target", "count(*) AS rows", "(SELECT count(*) FROM s4) / (2 * count(*)) AS weight"],
        "s4 GROUP BY target",
    ),
    "robust_scaled": _query(
        f"{_LABELLED}, divided AS (SELECT *, {_SPLIT} FROM labelled), "
        "train AS (SELECT * FROM divided WHERE split = 'train')",
        ["symbol", "bar_ts", "target", "split", *_quartile_scaled()],
        "divided",
        doubles=("volume",),
    ),
    "metrics": _query(_CELLS, ["model", *_SCORES], "cells"),
    "metrics_long": _query(
        f"{_CELLS}, wide AS (SELECT model, {', '.join(_SCORES)} FROM cells)",
        ["model", "metric", "value"],
        "(UNPIVOT wide ON accuracy, precision, recall, f1_score INTO NAME metric VALUE value)",
    ),
    "confusion": _query(
        f"{_CELLS}, long AS (SELECT model, 0 AS label, 0 AS prediction, tn AS rows, tn + fp AS n FROM cells UNION ALL "
        "SELECT model, 0, 1, fp, tn + fp FROM cells UNION ALL SELECT model, 1, 0, fn, tp + fn FROM cells UNION ALL "
        "SELECT model, 1, 1, tp, tp + fn FROM cells)",
        ["model", "label", "prediction", "rows", f"{_part('rows', 'n')} AS share"],
        "long",
    ),
    "class_report": _query(_REPORT, ["model", "class", "precision", "recall", "f1_score", "support"], "report"),
    "outcomes": _query(
        _PRED,
        [
            "symbol", "bar_ts", "model", "label", "prediction", "probability", "correct", "1 - correct AS error",
            "CASE WHEN correct = 1 AND prediction = 1 THEN 'correct up' WHEN correct = 1 THEN 'correct down' "
            "WHEN prediction = 1 THEN 'false up' ELSE 'false down' END AS outcome",
        ],
        "pred",
    ),
    "roc": _query(
        f"{_CURVE}, points AS (SELECT model, score AS threshold, fp / nullif(n, 0) AS fpr, tp / nullif(p, 0) AS tpr "
        "FROM curve UNION ALL SELECT DISTINCT model, NULL, 0.0, 0.0 FROM curve)",
        ["model", "threshold", "fpr", "tpr"],
        "points",
    ),
    "auc": _query(
        _CURVE, ["model", "sum(negatives * (2 * tp - positives)) / 2 / nullif(max(p) * max(n), 0) AS auc"],
        "curve GROUP BY model",
    ),
    "pr_curve": _query(
        f"{_CURVE}, points AS (SELECT model, score AS threshold, tp / (tp + fp) AS precision, "
        "tp / nullif(p, 0) AS recall FROM curve UNION ALL SELECT DISTINCT model, NULL, 1.0, 0.0 FROM curve)",
        ["model", "threshold", "precision", "recall"],
        "points",
    ),
    "avg_precision": _query(
        _CURVE, ["model", "sum(tp / (tp + fp) * positives / nullif(p, 0)) AS average_precision"],
        "curve GROUP BY model",
    ),
    "calibration": _query(
        _PRED,
        ["model", f"{_BIN10} AS bin", "count(*) AS rows", "avg(probability) AS mean_score",
         "avg(label) AS positive_share"],
        f"pred GROUP BY model, {_BIN10}",
    ),
    "confidence_bins": _query(
        _PRED,
        ["model", f"{_BIN10} AS bin", "count(*) AS rows", "avg(correct) AS accuracy",
         "avg(probability) AS confidence"],
        f"pred WHERE probability > 0 GROUP BY model, {_BIN10}",
    ),
    "confidence_hist": _query(
        f"{_PRED}, one AS (SELECT * FROM pred WHERE model = 'rsi'), "
        + _histogram("one", "correct", "probability", 20, ", sum(coalesce(c.n, 0)) OVER (PARTITION BY e.correct) AS n"),
        ["correct", "bin", "left_edge", "right_edge", "rows",
         "rows / (n * (right_edge - left_edge)) AS density"],
        "filled",
    ),
    "rank_models": _query(
        _RANKED,
        ["model", *(n for n in ("accuracy", "precision", "recall", "f1_score", "cv_f1_mean", "cv_f1_std")),
         "CAST(row_number() OVER (ORDER BY f1_score DESC, accuracy DESC, cv_f1_std, model) AS INT) AS place",
         _flag("row_number() OVER (ORDER BY accuracy BETWEEN 0.65 AND 0.70 DESC, f1_score DESC, accuracy DESC, "
               "cv_f1_std, model) = 1") + " AS best"],
        "results",
    ),
    "rolling_accuracy": _query(
        _PRED, ["symbol", "bar_ts", f"avg(correct) {_last(50)} AS rolling_accuracy"], "pred WHERE model = 'rsi'"
    ),
    "hourly_accuracy": _query(
        _PRED, ["CAST(hour(bar_ts) AS INT) AS hour", "count(*) AS rows", "avg(correct) AS accuracy"],
        "pred WHERE model = 'rsi' GROUP BY 1",
    ),
    "prediction_outcomes": _query(
        _PRED,
        [
            "symbol", "bar_ts", "close",
            "CASE WHEN correct = 1 AND prediction = 1 THEN 'correct up' WHEN correct = 1 THEN 'correct down' "
            "WHEN prediction = 1 THEN 'false up' ELSE 'false down' END AS outcome", "probability",
        ],
        "pred JOIN bars USING (symbol, bar_ts) WHERE model = 'rsi'",
    ),
    "error_by_quintile": _query(
        _quintiles(), ["feature", "bin", "count(*) AS rows", "avg(error) AS error_rate"],
        "binned GROUP BY feature, bin",
    ),
    "equity": _query(
        _BACKTEST,
        ["symbol", "bar_ts", "close", "CAST(position AS DOUBLE) AS position", "strategy_return",
         "CAST(sign(cumulative_return) AS DOUBLE) AS sign_strategy",
         f"{_log('cumulative_return')} AS log_strategy", f"{_log('buy_hold_return')} AS log_buy_hold",
         f"{_log('running_max')} AS log_running_max", f"{_DRAWDOWN} AS drawdown"],
        "curve",
    ),
    "rolling_sharpe": _query(_BACKTEST, ["symbol", "bar_ts", "rolling_sharpe"], "curve"),
    "backtest_summary": _query(
        _BACKTEST,
        ["symbol", f"{_log('last(cumulative_return ORDER BY bar_ts)')} AS log_strategy",
         f"{_log('last(buy_hold_return ORDER BY bar_ts)')} AS log_buy_hold",
         "avg(strategy_return) / nullif(stddev_samp(strategy_return), 0) * sqrt(24192) AS sharpe",
         f"min({_DRAWDOWN}) AS max_drawdown"],
        "curve GROUP BY symbol",
    ),
    "column_summary": _query(
        BARS_1H,
        ["symbol", "avg(close) AS mean", "stddev_samp(close) AS std", "min(close) AS lowest", "max(close) AS highest"],
        "bars GROUP BY symbol",
    ),
    "last_close": _query(BARS_1H, ["symbol", "arg_max(close, bar_ts) AS last_close"], "bars GROUP BY symbol"),
    "volume_median": _query(
        BARS_1H, ["symbol", "quantile_cont(CAST(volume AS DOUBLE), 0.5) AS volume_quantile"], "bars GROUP BY symbol"
    ),
    "volume_hist": _query(
        f"{BARS_1H}, " + _histogram("bars", "symbol", "volume", 50, ""),
        ["symbol", "bin", "left_edge", "right_edge", "rows"],
        "filled",
    ),
    "volume_profile": _query(_profile(False), ["symbol", "bin", "price_from", "price_to", "volume"], "profile"),
    "volume_profile_closed": _query(_profile(True), ["symbol", "bin", "price_from", "price_to", "volume"], "profile"),
    "volume_vs_return": _features("volume_ratio", "price_change * 100 AS change_percent", "target"),
    "corr_matrix": _query(_pairs(False), ["feature_a", "feature_b", "corr"], "corrs", recursive=True),
    "corr_upper": _query(_pairs(True), ["feature_a", "feature_b", "corr"], "corrs", recursive=True),
    "target_corr": _query(
        _pairs(False), ["feature_a AS feature", "corr"],
        "corrs WHERE feature_b = 'target' AND feature_a <> 'target'", recursive=True,
    ),
    "class_hist": _query(
        f"{_FEATURES}, {_RECURSION}, {_long(DISTRIBUTED, 'feat', 'target')}, "
        + _histogram(
            "long", "feature, target", "value", 30,
            ", sum(coalesce(c.n, 0)) OVER (PARTITION BY e.feature, e.target) AS n",
        ),
        ["feature", "target", "bin", "left_edge", "right_edge", "rows",
         "rows / (n * (right_edge - left_edge)) AS density"],
        "filled",
        recursive=True,
    ),
    "class_means": _query(
        f"{_FEATURES}, {_RECURSION}, {_long(DISTRIBUTED, 'feat', 'target')}",
        ["feature", "target", "avg(value) AS mean"], "long GROUP BY feature, target", recursive=True,
    ),
    "chart_price": _averages(
        "close", "sma_20", "sma_50", "sma_100", "bb_upper", "bb_lower", "target", "volume",
        "CASE WHEN close >= open THEN 'up' ELSE 'down' END AS candle", "volume_ma_20", "rsi", "macd", "macd_signal",
        "macd_histogram", "CASE WHEN macd_histogram >= 0 THEN 'up' ELSE 'down' END AS histogram_side",
    ),
    "chart_fibonacci": _query(
        _FEATURES,
        ["symbol", "bar_ts", "close", *FIB_NAMES, "fib_position_high AS fib_position",
         *(f"dist_to_{n}" for n in FIB_INNER if n != "fib_500")],
        "s4 QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY bar_ts DESC) <= 500",
    ),
    "chart_structure": _query(
        f"{_FEATURES}, recent AS (SELECT * FROM s4 QUALIFY row_number() OVER "
        f"(PARTITION BY symbol ORDER BY bar_ts DESC) <= 300), raised AS ({_signals})",
        ["symbol", "bar_ts", "close", "resistance_level", "support_level", "signal"],
        "recent LEFT JOIN raised USING (symbol, bar_ts)",
    ),
    "stream_bars": _query(BARS_1H, _BARS, "bars"),
}
