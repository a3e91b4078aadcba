"""Scoring a stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators.model import score
from barloom.operators.panel import last_bars
from barloom.operators.step import Step, compute
from barloom.schema import Layout


def score_stream(features: DataFrame, model: PipelineModel, names: Sequence[str], name: str = "model") -> DataFrame:
    """Predictions for a stream of finished feature rows; no state."""
    return score(model, features, names, name)


def score_batches(
    history: Callable[[], DataFrame],
    steps: Sequence[Step],
    model: PipelineModel,
    names: Sequence[str],
    layout: Layout,
    sink: Callable[[DataFrame, int], None],
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for a stream of bars.

    ``history`` reads the stored bars before the batch; let it read the recent part only, one that holds
    the bars the steps reach back for. Symbols without new bars are left out, the others are cut to
    that reach. Steps that sum over a whole series are not allowed here.
    """
    if any(step.series for step in steps):
        raise ValueError("steps over a whole series cannot run on a tail of it")
    reach = max((step.back for step in steps), default=0)

    def run(batch: DataFrame, batch_id: int) -> None:
        symbols = batch.select("symbol").distinct()
        known = history().join(batch.select("symbol", "bar_ts"), ["symbol", "bar_ts"], "left_anti")
        tail = last_bars(known.join(symbols, "symbol", "left_semi"), max(reach, 1), layout)
        columns = batch.columns
        rows = tail.select(*columns, F.lit(False).alias("is_new")).union(
            batch.select(*columns, F.lit(True).alias("is_new"))
        )
        featured = compute(rows, layout, *steps).filter("is_new")
        sink(score(model, featured, names), batch_id)

    return run
