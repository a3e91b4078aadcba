"""Features of a stream of bars from keyed state: the last bars of each symbol, as many as the features reach back for."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators.model import score
from barloom.operators.step import Step, compute
from barloom.schema import PRICES, Layout
from barloom.session import send_package

_VALUES = (*PRICES, "volume")
_STATE = T.StructType(
    [
        T.StructField("micros", T.ArrayType(T.LongType())),
        *(T.StructField(c, T.ArrayType(T.DoubleType())) for c in _VALUES),
        T.StructField("late", T.LongType()),
    ]
)


def reach_of(steps: Sequence[Step]) -> int:
    """Bars before the current one that the steps need; steps over a whole series or with a look ahead have no such number."""
    if any(step.series for step in steps):
        raise ValueError("steps over a whole series cannot run on a tail of it")
    if any(step.ahead for step in steps):
        raise ValueError("steps that look ahead cannot run on a stream")
    return max((step.back for step in steps), default=0)


def with_reach(bars: DataFrame, reach: int) -> DataFrame:
    """For each batch the new bars of every symbol (``is_new``), behind the last ``reach`` bars before them.

    The state of a symbol is those bars and a count: at most ``reach`` times seven numbers, whatever the stream has brought. A bar
    that is not later than the last one of its symbol comes too late for the features after it; it is left out and counted, and ``late`` shows how many there
    have been. Of several bars of one time in a batch the first counts, the others are late. Volumes come out as doubles.
    """
    send_package(bars.sparkSession)

    def advance(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(batches), ignore_index=True)  # a batch's bars of one symbol
        micros = new["bar_ts"].to_numpy().astype("datetime64[us]").astype(np.int64)
        order = np.lexsort((*(new[c].to_numpy(dtype=float) for c in reversed(_VALUES)), micros))
        new, micros = new.iloc[order], micros[order]
        held = dict(zip([f.name for f in _STATE], state.get, strict=True)) if state.exists else {"micros": [], "late": 0, **{c: [] for c in _VALUES}}
        last = held["micros"][-1] if len(held["micros"]) else None
        fresh = np.ones(len(micros), bool)
        fresh[1:] = micros[1:] != micros[:-1]
        if last is not None:
            fresh &= micros > last
        late = int(held["late"]) + int((~fresh).sum())
        joined = {c: np.concatenate([np.asarray(held[c], float), new[c].to_numpy(dtype=float)[fresh]]) for c in _VALUES}
        times = np.concatenate([np.asarray(held["micros"], np.int64), micros[fresh]])
        kept = slice(max(0, len(times) - reach), None)
        floats = lambda x: [None if np.isnan(v) else float(v) for v in x]
        state.update((times[kept].tolist(), *(floats(joined[c][kept]) for c in _VALUES), late))
        if fresh.any():
            yield pd.DataFrame(
                {
                    "symbol": key[0],
                    "bar_ts": times.astype("datetime64[us]"),
                    **joined,
                    "is_new": np.arange(len(times)) >= len(times) - int(fresh.sum()),
                    "late": late,
                }
            )

    out = T.StructType(
        [
            T.StructField("symbol", T.StringType()),
            T.StructField("bar_ts", T.TimestampNTZType()),
            *(T.StructField(c, T.DoubleType()) for c in _VALUES),
            T.StructField("is_new", T.BooleanType()),
            T.StructField("late", T.LongType()),
        ]
    )
    narrow = bars.select("symbol", F.col("bar_ts").cast("timestamp_ntz").alias("bar_ts"), *(F.col(c).cast("double").alias(c) for c in _VALUES))
    return narrow.groupBy("symbol").applyInPandasWithState(advance, out, _STATE, "append", "NoTimeout")


def feature_batches(steps: Sequence[Step], layout: Layout, sink: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function over ``with_reach``: features of the new bars of a batch, ``late`` among the columns, go to ``sink``.

    Nothing but the batch is read. A sink that overwrites by batch number makes a repeated batch harmless.
    """
    reach_of(steps)

    def run(batch: DataFrame, number: int) -> None:
        sink(compute(batch, layout, *steps).filter("is_new").drop("is_new", "bar_no"), number)

    return run


def score_features(model: PipelineModel, names: Sequence[str], sink: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A sink for ``feature_batches`` that scores the rows with a fitted model."""
    return lambda rows, number: sink(score(model, rows, names), number)
