"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time

from barloom.plans.catalog import QUERIES
from barloom.session import local_session

HEADLINE = (
    "summary_per_symbol", "bars_1h", "bars_15m", "bars_orders_1d", "sigma_filter", "ffill_bfill",
    "fib_levels", "structure_flags", "liquidity_sweeps", "order_blocks", "volume_price_corr", "obv", "vwap",
    "sma", "ema", "rsi", "macd", "bollinger", "atr", "target", "features_full77", "features_core24",
    "split_random", "split_time", "folds", "robust_scaled", "metrics", "class_report", "roc", "auc",
    "rank_models", "error_by_quintile", "equity", "backtest_summary", "corr_matrix", "class_hist",
    "volume_profile", "stream_bars",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    QUERIES["features_full77"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm up the JVM
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
