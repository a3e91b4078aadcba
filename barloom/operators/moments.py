"""Co-moments of all pairs of columns in one pass.

Each task turns its rows into one dense matrix of pairwise-complete counts, means and co-moments, Arrow batch by Arrow batch; matrices merge pairwise, and a
row per task is all that is shuffled. This is the one place outside the models where numpy runs in the tasks: a JVM aggregate over all pairs
multiplies every row by their number.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.session import send_package

#: Tasks that merge matrices before the last one does.
MERGERS = 64


@dataclass
class CoMoments:
    """For each pair (i, j), over the rows that have both: count, mean of i, co-moment, squared deviation of i, least and largest i."""

    n: np.ndarray
    mean: np.ndarray
    both: np.ndarray
    own: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @staticmethod
    def none(p: int) -> CoMoments:
        zero = lambda: np.zeros((p, p))
        return CoMoments(zero(), zero(), zero(), zero(), np.full((p, p), np.inf), np.full((p, p), -np.inf))

    @staticmethod
    def of(x: np.ndarray, known: np.ndarray) -> CoMoments:
        """Of the rows of ``x``; columns whose missing values lie in the same rows share their passes."""
        out = CoMoments.none(x.shape[1])
        patterns, group = np.unique(known, axis=1, return_inverse=True)
        group = np.asarray(group).reshape(-1)
        for a in range(patterns.shape[1]):
            for b in range(patterns.shape[1]):
                rows = patterns[:, a] & patterns[:, b]
                n = int(rows.sum())
                if not n:
                    continue
                i, j = np.flatnonzero(group == a), np.flatnonzero(group == b)
                one, two = x[np.ix_(rows, i)], x[np.ix_(rows, j)]
                # Shifted by a value of the rows, a constant column has deviations of exactly 0.
                mean_one = one[0] + (one - one[0]).mean(axis=0)
                mean_two = two[0] + (two - two[0]).mean(axis=0)
                here = np.ix_(i, j)
                out.n[here] = n
                out.mean[here] = mean_one[:, None]
                out.both[here] = (one - mean_one).T @ (two - mean_two)
                out.own[here] = ((one - mean_one) ** 2).sum(axis=0)[:, None]
                out.low[here] = one.min(axis=0)[:, None]
                out.high[here] = one.max(axis=0)[:, None]
        return out

    def merged(self, other: CoMoments) -> CoMoments:
        n = self.n + other.n
        # The values of a side without rows do not count, whatever they are.
        share = np.divide(other.n, n, out=np.zeros_like(n), where=n > 0)
        gap = np.where((self.n > 0) & (other.n > 0), other.mean - self.mean, 0.0)
        weight = self.n * share
        return CoMoments(
            n,
            np.where(self.n > 0, self.mean + gap * share, other.mean),
            self.both + other.both + gap * gap.T * weight,
            self.own + other.own + gap * gap * weight,
            np.minimum(self.low, other.low),
            np.maximum(self.high, other.high),
        )

    def correlation(self) -> np.ndarray:
        """Pearson correlation of each pair; NaN where one of the two does not vary."""
        varies = (self.low < self.high) & (self.low < self.high).T
        with np.errstate(invalid="ignore", divide="ignore"):
            return np.where(varies, self.both / np.sqrt(self.own * self.own.T), np.nan)

    def packed(self) -> bytes:
        return np.stack([self.n, self.mean, self.both, self.own, self.low, self.high]).tobytes()

    @staticmethod
    def unpacked(raw: bytes, p: int) -> CoMoments:
        return CoMoments(*np.frombuffer(raw).reshape(6, p, p))


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(values with 0 where missing, which are known), a column each."""
    values = np.column_stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.columns])
    known = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns])
    return values, known


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, corr) for each ordered pair of columns with common rows; ``corr`` is null where one does not vary. ``a`` and ``b`` are places in ``columns``."""
    p = len(columns)
    send_package(df.sparkSession)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = CoMoments.none(p)
        for batch in batches:
            if batch.num_rows:
                found = found.merged(CoMoments.of(*_columns(batch)))
        yield pa.RecordBatch.from_arrays([pa.array([found.packed()], pa.binary())], names=["moments"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, any_rows = CoMoments.none(p), False
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                found, any_rows = found.merged(CoMoments.unpacked(raw, p)), True
        if any_rows:
            yield pa.RecordBatch.from_arrays([pa.array([found.packed()], pa.binary())], names=["moments"])

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in merge(batches):
            found = CoMoments.unpacked(batch.column(0)[0].as_py(), p)
            a, b = np.nonzero(found.n > 0)
            corr = found.correlation()[a, b]
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(corr, pa.float64(), mask=np.isnan(corr))], names=["a", "b", "corr"]
            )

    kind = "moments binary"
    wide = df.select(*(F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)))
    measured = wide.mapInArrow(measure, kind)
    place = F.pmod(F.xxhash64("moments"), F.lit(MERGERS))
    merged = measured.repartition(MERGERS, place).mapInArrow(merge, kind)
    return merged.repartition(1).mapInArrow(told, "a int, b int, corr double")


def class_counts(df: DataFrame, columns: Sequence[str], group: str, ends: dict[tuple[int, object], tuple[float, float]], bins: int) -> DataFrame:
    """(column, group, bin, rows): counts of equal-width bins of each column and class, an array of counts per task.

    ``ends`` has the range of each (place of the column, class); the last bin is closed on the right.
    """
    send_package(df.sparkSession)
    classes = sorted({g for _, g in ends})
    if not classes:
        return df.sparkSession.createDataFrame([], "column int, group long, bin int, rows long")
    low = np.array([[ends.get((i, g), (0.0, 1.0))[0] for i in range(len(columns))] for g in classes])
    high = np.array([[ends.get((i, g), (0.0, 1.0))[1] for i in range(len(columns))] for g in classes])
    width = (high - low) / bins

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((len(classes), len(columns), bins), np.int64)
        for batch in batches:
            values, known = _columns(batch.select(range(1, len(columns) + 1)))
            own = np.asarray(batch.column(0))
            for k, g in enumerate(classes):
                here = own == g
                for i in range(len(columns)):
                    x = values[here & known[:, i], i]
                    place = np.minimum(np.floor((x - low[k, i]) / width[k, i]), bins - 1).astype(np.int64)
                    found[k, i] += np.bincount(place, minlength=bins)
        k, i, b = np.nonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(np.array(classes, np.int64)[k]), pa.array(b, pa.int32()), pa.array(found[k, i, b])],
            names=["column", "group", "bin", "rows"],
        )

    wide = df.select(F.col(group).cast("long").alias("_group"), *(F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)))
    counted = wide.filter(F.col("_group").isin(*classes)).mapInArrow(count, "column int, group long, bin int, rows long")
    return counted.groupBy("column", "group", "bin").agg(F.sum("rows").alias("rows"))
