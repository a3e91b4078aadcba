"""From a feature panel to a training set: selection, split, folds, weights, scaling."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions import finite, row_hash, zero_if_missing
from barloom.functions.scalar import epoch_micros, names
from barloom.operators.quantiles import exact_quantiles
from barloom.operators.selection import hash_thresholds, with_thresholds
from barloom.schema import ALIASES, NOT_FEATURES, PRICES

SEED = 42


def feature_columns(df: DataFrame) -> list[str]:
    """Model inputs by exclusion, raw prices last."""
    return [c for c in df.columns if c not in NOT_FEATURES and c not in PRICES] + list(PRICES)


def select_features(df: DataFrame, wanted: Sequence[str], keep: Sequence[str] = ("symbol", "bar_ts", "target")):
    """Keys, label and the listed features, which may use another published spelling."""
    spelled = {c.lower(): c for c in df.columns}

    def resolve(c: str) -> str:
        if c in df.columns:
            return c
        plain = c.lower()
        other = {ours: theirs for theirs, ours in ALIASES.items()}.get(plain, plain)
        return spelled.get(plain) or spelled.get(ALIASES.get(plain, plain)) or spelled.get(other) or c

    resolved = [resolve(c) for c in wanted]
    names(df.columns, resolved)
    return df.select(*(k for k in keep if k in df.columns), *(F.col(r).alias(c) for r, c in zip(resolved, wanted)))


def finite_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.filter(reduce(Column.__and__, (finite(c) for c in columns)))


def zero_filled(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: zero_if_missing(c) for c in columns})


def split_random(df: DataFrame, test: float = 0.2, label: str | Sequence[str] = "target", seed: int = SEED) -> DataFrame:
    """Stratified random split. Neighbouring bars share windows, so prefer ``split_time``.

    The rows of a class with the smallest hashes are the test rows. The frame is read for counting and again for marking,
    so one that costs much should be stored.
    """
    keys = (label,) if isinstance(label, str) else tuple(label)
    hashed = df.withColumn("_hash", row_hash(seed))
    at = hash_thresholds(hashed, keys, "_hash", lambda n: [F.floor(n * test)])
    marked = with_thresholds(hashed, keys, at)
    is_test = F.col("_hash") <= F.col("_at")[0]
    return marked.withColumn("split", F.when(is_test, "test").otherwise("train")).select(*df.columns, "split")


def split_time(df: DataFrame, test: float = 0.2, label_ts: str | None = None) -> DataFrame:
    """Chronological split at a quantile of time.

    With ``label_ts``, the time at which the label of a row becomes known, training rows whose label
    reaches into the test period are marked ``embargo``.
    """
    timed = df.withColumn("_micros", epoch_micros("bar_ts"))
    cut = exact_quantiles(timed, ["_micros"], [1 - test])["_micros"][0]
    where = F.when(F.col("_micros") > F.lit(cut), "test")
    if label_ts is not None:
        where = where.when(epoch_micros(label_ts) > F.lit(cut), "embargo")
    return timed.withColumn("split", where.otherwise("train")).drop("_micros")


def folds(df: DataFrame, k: int = 5, label: str | Sequence[str] = "target", seed: int = SEED) -> DataFrame:
    """Stratified fold number 0 .. k-1: ranges of the hash that cut each class into parts of like size, the larger ones first.

    Read twice, as in ``split_random``.
    """
    keys = (label,) if isinstance(label, str) else tuple(label)
    hashed = df.withColumn("_hash", row_hash(seed))
    ends = lambda n: [j * F.floor(n / k) + F.least(F.lit(j), n % k) for j in range(1, k)]
    marked = with_thresholds(hashed, keys, hash_thresholds(hashed, keys, "_hash", ends))
    below = F.size(F.filter("_at", lambda t: t < F.col("_hash")))
    return marked.withColumn("fold", below.cast("int")).select(*df.columns, "fold")


def class_weights(df: DataFrame, label: str = "target") -> DataFrame:
    """Balanced weight of each of the two classes: n / (2 n_class)."""
    counts = df.groupBy(label).agg(F.count("*").alias("rows"))
    every = F.sum("rows").over(Window.partitionBy())  # over a row per class
    return counts.select(label, "rows", (every / (2 * F.col("rows"))).alias("weight"))


def with_class_weights(df: DataFrame, label: str = "target") -> DataFrame:
    """Add ``weight``. The broadcast side has a row per class, and the label is 0 or 1."""
    weights = class_weights(df.filter(F.col(label).isin(0, 1)), label)
    return df.join(F.broadcast(weights.select(label, "weight")), label, "left")


@dataclass(frozen=True)
class RobustScaler:
    """(x - median) / (q75 - q25); a column without spread is only centred."""

    center: dict[str, float]
    scale: dict[str, float]

    @staticmethod
    def fit(train: DataFrame, columns: Sequence[str]) -> RobustScaler:
        quartiles = exact_quantiles(train, columns, [0.25, 0.5, 0.75])
        if any(q[0] is None for q in quartiles.values()):
            raise ValueError("cannot scale a column without values")
        return RobustScaler(
            {c: q[1] for c, q in quartiles.items()},
            {c: (q[2] - q[0]) or 1.0 for c, q in quartiles.items()},
        )

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {c: (F.col(c) - F.lit(self.center[c])) / F.lit(self.scale[c]) for c in self.center}
        )

    def stage(self, prefix: str = "scaled_") -> SQLTransformer:
        """The same as a storable pipeline stage, into new columns."""
        terms = ", ".join(
            f"(`{c}` - {self.center[c]!r}D) / {self.scale[c]!r}D AS `{prefix}{c}`" for c in self.center
        )
        return SQLTransformer(statement=f"SELECT *, {terms} FROM __THIS__")
