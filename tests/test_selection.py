"""Radix selection, bracketed quantiles and co-moments: equal to the plain way, and planned as they should be."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barloom.operators import dataset, profile
from barloom.operators.moments import CoMoments
from barloom.operators.quantiles import exact_quantiles
from barloom.operators.selection import hash_thresholds

from conftest import assert_same


def hashed(spark, rows):
    frame = [(k, c, hashlib.md5(f"{c}{v}".encode()).hexdigest()) for k, (c, v) in enumerate(rows)]
    return spark.createDataFrame(frame, "k int, c string, h string")


@pytest.mark.parametrize("digits", [1, 2, 4])
def test_thresholds_are_the_hashes_at_the_ranks(spark, digits):
    """A digit a step makes many refinements; equal hashes lie on both sides of a rank."""
    rows = [("a", v) for v in range(700)] + [("b", v % 40) for v in range(400)] + [("one", 1)] + [("none", v) for v in range(3)]
    df = hashed(spark, rows)
    wanted = lambda n: [F.floor(n * 0.2), F.floor(n / 2), n]
    got = {r[0]: r[1] for r in hash_thresholds(df, ["c"], "h", wanted, digits)}
    for c, own in df.toPandas().groupby("c").h:
        own = sorted(own)
        ranks = [int(len(own) * 0.2), len(own) // 2, len(own)]
        assert got[c] == ["" if r == 0 else own[r - 1] for r in ranks]


def panel(spark, n=900):
    rng = np.random.default_rng(4)
    frame = pd.DataFrame({"symbol": rng.choice(["A", "B"], n), "bar_ts": pd.date_range("2024-01-01", periods=n, freq="h"), "target": rng.choice([0, 1], n, p=[0.8, 0.2])})
    return spark.createDataFrame(frame).withColumn("bar_ts", F.col("bar_ts").cast("timestamp_ntz"))


def test_split_and_folds_equal_ranks(spark):
    df = panel(spark)
    split, folds = dataset.split_random(df), dataset.folds(df, 7)
    both = split.join(folds, ["symbol", "bar_ts", "target"]).withColumn("h", dataset.row_hash(dataset.SEED)).toPandas()
    for _, own in both.groupby("target"):
        own = own.sort_values("h").reset_index(drop=True)
        assert (own.split == np.where(own.index < int(len(own) * 0.2), "test", "train")).all()
        want = np.concatenate([np.full(len(part), k) for k, part in enumerate(np.array_split(np.arange(len(own)), 7))])
        assert (own.fold == want).all()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_marking_is_a_map(spark, tmp_path):
    panel(spark).write.parquet(str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "p"))
    for marked in (dataset.split_random(stored), dataset.folds(stored)):
        plan = plan_of(marked)
        assert "Window" not in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
        assert plan.count("FileScan") == 1


def test_labels_without_rows_and_missing_labels(spark):
    df = panel(spark, 30).withColumn("target", F.when(F.col("target") == 1, 1))
    got = dataset.split_random(df).toPandas()
    assert len(got) == 30 and (got[got.target.isna()].split == "train").sum() == got.target.isna().sum()
    assert dataset.split_random(df.limit(0)).count() == 0 and dataset.folds(df.limit(0)).count() == 0


class Jobs:
    """Counts the jobs of a block of code."""

    def __init__(self, spark, name):
        self.context, self.name = spark.sparkContext, name

    def __enter__(self):
        self.context.setJobGroup(self.name, self.name)
        return self

    def __exit__(self, *_):
        self.count = len(self.context.statusTracker().getJobIdsForGroup(self.name))
        self.context.setLocalProperty("spark.jobGroup.id", None)


def test_quantiles_take_two_passes_whatever_the_columns(spark):
    rng = np.random.default_rng(6)
    frame = pd.DataFrame({f"x{k}": rng.normal(0, 1, 2000).round(k % 3) for k in range(9)})
    df = spark.createDataFrame(frame)
    with Jobs(spark, "quantiles") as jobs:
        got = exact_quantiles(df, list(frame), [0, 0.25, 0.5, 0.75, 1])
    assert jobs.count <= 4
    for c in frame:
        assert_same(got[c], frame[c].quantile([0, 0.25, 0.5, 0.75, 1]), 1e-12)


@pytest.mark.parametrize("crowd", [0.0, 0.5, 0.999])
def test_crowded_values_are_counted_and_not_gathered(spark, crowd):
    """Also where a wanted place lies between a crowd and the next value."""
    x = np.arange(4000, dtype=float)
    x[: int(4000 * crowd)] = -1.0
    frame = pd.DataFrame({"x": x})
    probs = [0.0, 0.1, 0.4998, 0.5, 0.50005, 0.9989, 0.999, 1.0]
    got = exact_quantiles(spark.createDataFrame(frame).repartition(5), ["x"], probs, accuracy=200, held=64)["x"]
    assert_same(got, frame.x.quantile(probs), 1e-8)  # a place is a share of 3999 rows


def test_co_moments_merge_like_the_whole(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(1e6, 1, (500, 5))
    x[:, 3] = 0.1
    x[:, 4] = x[:, 0] * 2 + rng.normal(0, 0.1, 500)
    known = np.ones(x.shape, bool)
    known[:60, 1] = known[40:90, 2] = False
    parts = [CoMoments.of(x[a : a + 37], known[a : a + 37]) for a in range(0, 500, 37)]
    merged = CoMoments.none(5)
    for part in parts:
        merged = merged.merged(part)
    other = CoMoments.none(5)
    for part in reversed(parts):
        other = part.merged(other)
    want = pd.DataFrame(np.where(known, x, np.nan)).corr().to_numpy()
    want[3, :] = want[:, 3] = np.nan
    assert_same(merged.correlation().ravel(), want.ravel(), 1e-9)
    assert_same(other.correlation().ravel(), want.ravel(), 1e-9)
    assert (merged.own[3] == 0).all()


def test_correlations_shuffle_a_row_per_task(spark):
    rng = np.random.default_rng(9)
    df = spark.createDataFrame(pd.DataFrame(rng.normal(0, 1, (300, 4)), columns=list("abcd"))).repartition(6)
    found = profile.corr_matrix(df, list("abcd"))
    plan = plan_of(found)
    assert "Generate" not in plan and found.count() == 16
    assert profile.corr_matrix(df.limit(0), list("abcd")).count() == 0


def test_histogram_of_classes_with_gaps(spark):
    df = spark.createDataFrame(
        [(1.0, None, 0), (2.0, None, 0), (None, 5.0, 1), (3.0, 5.0, 1), (9.0, 1.0, None), (9.0, 1.0, 2)], "x double, y double, target int"
    )
    got = profile.class_histogram(df, ["x", "y"], bins=4).toPandas()
    assert sorted(set(zip(got.feature, got.target, strict=True))) == [("x", 0), ("x", 1), ("y", 1)]
    x0 = got[(got.feature == "x") & (got.target == 0)].sort_values("bin")
    assert x0.rows.tolist() == [1, 0, 0, 1] and x0.left_edge.tolist() == [1.0, 1.25, 1.5, 1.75]
    y1 = got[(got.feature == "y") & (got.target == 1)].sort_values("bin")
    assert y1.rows.tolist() == [0, 0, 2, 0] and y1.left_edge.iloc[0] == 4.5
    assert profile.class_histogram(df.limit(0), ["x", "y"]).count() == 0
