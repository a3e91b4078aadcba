from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from barloom.schema import BAR_SCHEMA, Layout  # noqa: E402
from barloom.session import local_session  # noqa: E402

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def spark():
    session = local_session(4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def layout():
    """Pieces far smaller than the series, so that every result crosses their borders."""
    return Layout(every=900, chunk_rows=40, block_rows=64)


def bars_frame(close, symbol="A", volume=None, spread=1.0, opens=None, every=900):
    """A pandas panel around the given closes."""
    close = np.asarray(close, dtype=float)
    n = len(close)
    opens = np.concatenate([close[:1], close[:-1]]) if opens is None else np.asarray(opens, dtype=float)
    return pd.DataFrame(
        {
            "symbol": symbol,
            "bar_ts": [START + dt.timedelta(seconds=every * i) for i in range(n)],
            "open": opens,
            "high": np.maximum(opens, close) + spread,
            "low": np.minimum(opens, close) - spread,
            "close": close,
            "volume": np.arange(1, n + 1) if volume is None else volume,
        }
    )


def walk(n, seed=0, symbol="A"):
    """A random walk on a grid of cents."""
    rng = np.random.default_rng(seed)
    close = np.round(1800 + np.cumsum(rng.normal(0, 2, n)), 2)
    opens = np.round(close + rng.normal(0, 1, n), 2)
    frame = bars_frame(close, symbol, rng.integers(1, 500, n), 0.0, opens)
    frame["high"] = np.round(frame["high"] + rng.uniform(0, 2, n), 2)
    frame["low"] = np.round(frame["low"] - rng.uniform(0, 2, n), 2)
    return frame


def to_spark(spark, frame):
    rows = [
        tuple(None if pd.isna(x) else x.to_pydatetime() if isinstance(x, pd.Timestamp) else x for x in r)
        for r in frame[BAR_SCHEMA.names].itertuples(index=False)
    ]
    plain = [tuple(v.item() if isinstance(v, np.generic) else v for v in r) for r in rows]
    plain = [(*r[:6], None if r[6] is None else int(r[6])) for r in plain]
    return spark.createDataFrame(plain, BAR_SCHEMA)


def collected(df):
    return df.toPandas().sort_values(["symbol", "bar_ts"]).reset_index(drop=True)


def assert_same(found, expected, tolerance=1e-8):
    """Equal up to rounding, nulls in the same places."""
    found = np.asarray(pd.Series(found), dtype=float)
    expected = np.asarray(pd.Series(expected), dtype=float)
    assert len(found) == len(expected)
    np.testing.assert_array_equal(np.isnan(found), np.isnan(expected))
    np.testing.assert_allclose(found, expected, rtol=tolerance, atol=tolerance)
