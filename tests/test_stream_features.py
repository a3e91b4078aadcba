"""Features from keyed state equal those over the whole series; the state stays small and late bars are counted."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from conftest import assert_same, collected, to_spark, walk
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from barloom.operators import structure, technical, volume
from barloom.operators.step import compute
from barloom.schema import BAR_SCHEMA, Layout
from barloom.streaming import feature_batches, reach_of, score_features, with_reach

LAYOUT = Layout(every=900, chunk_rows=40, block_rows=64)


def through(spark, tmp_path, pieces, steps, sink=None):
    """Features of frames that arrive one after the other."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for piece in pieces:
        to_spark(spark, piece).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(BAR_SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)

    def store(rows, number):
        rows.write.mode("overwrite").parquet(f"{out}/batch={number}")

    run = feature_batches(steps, LAYOUT, sink(store) if sink else store)
    writer = with_reach(stream, reach_of(steps)).writeStream.foreachBatch(run)
    writer.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out)


def test_features_and_scores_equal_those_of_the_series(spark, tmp_path):
    """Two symbols, batches shorter and longer than the reach, one symbol missing from a batch; scores of a fitted model."""
    a, b = walk(260, 1, "A"), walk(120, 2, "B")
    a.loc[50, "close"] = np.nan
    pieces = [pd.concat([a[:3], b[:40]]), a[3:9], pd.concat([a[9:150], b[40:41]]), pd.concat([a[150:], b[41:]])]
    steps = (technical.rsi(), technical.sma((5, 20)), technical.ema((5,)), structure.trend_flags())
    names = ("sma_5", "sma_20", "ema_5")
    frame = to_spark(spark, pd.concat([a.dropna(), b]))
    fit = compute(frame, LAYOUT, *steps).withColumn("target", (F.col("close") > F.col("sma_5")).cast("int"))
    assembled = VectorAssembler(inputCols=list(names), outputCol="features")
    model = Pipeline(stages=[assembled, LogisticRegression(labelCol="target", maxIter=5)]).fit(fit)
    pieces = [p.dropna() for p in pieces]
    steps_of = lambda store: score_features(model, names, store)
    got = collected(through(spark, tmp_path, pieces, steps, steps_of))
    from barloom.operators.model import score

    want = collected(score(model, compute(frame, LAYOUT, *steps), names))
    assert len(got) == len(want) == 379
    assert_same(got.probability, want.probability, 1e-9)
    assert got.prediction.tolist() == want.prediction.tolist()


def test_late_and_repeated_bars_are_counted_and_left_out(spark, tmp_path):
    frame = walk(60, 4)
    late = frame[10:15].copy()
    twice = pd.concat([frame[40:50], frame[44:46]])
    pieces = [frame[:30], pd.concat([frame[30:40], late]), twice, frame[50:]]
    got = collected(through(spark, tmp_path, pieces, (technical.sma((5,)),)))
    want = collected(compute(to_spark(spark, frame), LAYOUT, technical.sma((5,))))
    assert got.bar_ts.tolist() == want.bar_ts.tolist()
    assert_same(got.sma_5, want.sma_5)
    assert got.late.tolist() == [0] * 30 + [5] * 10 + [7] * 20


def test_state_is_bounded_by_the_reach(spark, tmp_path):
    """What a batch brings to the features is its bars and the reach, however long the series."""
    frame, seen = walk(300, 5), []
    source = str(tmp_path / "in")
    for k in range(0, 300, 100):
        to_spark(spark, frame[k : k + 100]).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(BAR_SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    writer = with_reach(stream, 19).writeStream.foreachBatch(lambda rows, _: seen.append((rows.count(), rows.filter("is_new").count())))
    writer.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    assert [s for s in seen if s[0]] == [(100, 100), (119, 100), (119, 100)]


def test_steps_without_a_reach_are_refused():
    for step in (volume.vwap(), structure.swings()):
        with pytest.raises(ValueError, match="steps"):
            reach_of([step])
