"""Schemas, the physical layout of a panel, and the named feature sets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

KEYS = ("symbol", "bar_ts")
PRICES = ("open", "high", "low", "close")

BAR_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType(), False),
        T.StructField("bar_ts", T.TimestampNTZType(), False),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.LongType()),
    ]
)


@dataclass(frozen=True)
class Layout:
    """How a panel is cut into bounded pieces.

    A series is never processed as one group. Time is cut into *chunks* of
    ``chunk_rows`` bar intervals; as (symbol, bar_ts) is unique on the ``every``
    grid, a chunk cannot hold more rows than that. Once bars are numbered, they
    are cut into *blocks* of exactly ``block_rows`` consecutive bars.
    """

    every: int = 900  # seconds between two bars
    chunk_rows: int = 50_000
    block_rows: int = 50_000

    @property
    def chunk_seconds(self) -> int:
        return self.every * self.chunk_rows


# Published ratios, window lengths, feature lists and the columns that are no features.
FIB_RATIOS = (0.0, 0.236, 0.382, 0.5, 0.618, 0.786, 1.0)
FIB_NAMES = tuple(f"fib_{round(r * 1000)}" for r in FIB_RATIOS)
FIB_INNER = FIB_NAMES[1:-1]
AVERAGE_SPANS = (5, 10, 20, 50, 100)
MOMENTUM_LAGS = (5, 10, 20)

# Columns that are computed on the way but are not model inputs.
NOT_FEATURES = (
    "symbol",
    "bar_ts",
    "bar_no",
    "target",
    "rolling_high",
    "rolling_low",
    "price_range",
    "swing_high",
    "swing_low",
    "resistance_level",
    "support_level",
    "vwap",
    "obv",
    "true_range",
)

_STRUCTURE = (
    "higher_high", "lower_low", "higher_low", "lower_high",
    "bos_bullish", "bos_bearish", "choch",
    "near_resistance", "near_support",
    "liquidity_sweep_up", "liquidity_sweep_down",
    "bullish_ob", "bearish_ob", "fvg_bullish", "fvg_bearish",
)
_VOLUME = (
    "volume_ma_10", "volume_ma_20", "volume_ratio", "volume_trend", "price_change",
    "volume_price_corr", "obv_ma", "obv_trend", "dist_to_vwap",
)
_TECHNICAL = (
    *(f"{kind}_{n}" for n in AVERAGE_SPANS for kind in ("sma", "ema")),
    "price_above_sma20", "price_above_sma50", "ma_cross_10_20", "ma_cross_20_50",
    "rsi", "rsi_overbought", "rsi_oversold",
    "macd", "macd_signal", "macd_histogram", "macd_bullish",
    "bb_middle", "bb_upper", "bb_lower", "bb_width", "bb_position", "bb_squeeze",
    "atr", "atr_ratio", "stoch_k", "stoch_d",
    *(f"momentum_{n}" for n in MOMENTUM_LAGS), "volatility_20",
)

FULL77 = (
    "volume",
    *FIB_NAMES,
    *(f"dist_to_{name}" for name in FIB_INNER),
    "fib_position",
    *_STRUCTURE,
    *_VOLUME,
    *_TECHNICAL,
    *PRICES,
)
CORE24 = (
    *PRICES, "volume", "sma_20", "sma_50", "ema_20", "rsi", "volume_ma_20", "volume_ratio",
    "atr", "atr_ratio", "bb_middle", "bb_position", "macd", "macd_histogram",
    "momentum_5", "momentum_10", "fib_position",
    "higher_high", "lower_low", "bos_bullish", "bos_bearish",
)
CORE35 = (
    *PRICES, "volume",
    "sma_5", "sma_10", "sma_20", "sma_50", "ema_5", "ema_10", "ema_20", "ema_50",
    "rsi", "macd", "macd_signal", "macd_histogram", "bb_middle", "bb_width", "bb_position",
    "atr", "atr_ratio", "volume_ma_20", "volume_ratio",
    "momentum_5", "momentum_10", "momentum_20", "body", "upper_shadow", "lower_shadow",
    "fib_position", "higher_high", "lower_low", "bos_bullish", "bos_bearish",
)
MINI8 = (*PRICES, "volume", "sma_20", "rsi", "volume_ma_20")

FEATURE_SETS = {"full77": FULL77, "core24": CORE24, "core35": CORE35, "mini8": MINI8}

# Other spellings of the same column, per published feature list.
ALIASES = {
    "bb_mid": "bb_middle",
    "macd_hist": "macd_histogram",
    "volume_ma": "volume_ma_20",
}
