"""Quality scores learned by Bradley-Terry pairwise ranking.

Each preference pair says that one document is better than another. A document's strength is a linear function of its
features, and the chance that the first wins is the logistic function of the difference; so the weights come from a
logistic loss on feature differences, minimised by Newton steps. Strengths have no zero, so the cut is a
quantile: the strength below which that share of the labelled documents lies which has the label 0.
Scores are the logistic function of the distance to the cut.

Features come from the text alone: shares of kinds of characters, repeated words and lines, lengths.

The fit uses a bounded sample: at most ``PER_CLASS`` labelled documents of each label (those with the least hash of the id), each
in ``PAIRS`` pairs. Everything else covers all rows. Null and empty texts have all features at zero and get a score like
any other; so do very long ones, which are taken whole. Documents with several labels are used with each; null
labels are not used. Without labels of both kinds every score is 0.5. Repeated rows get the same score. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import utf8_of

PER_CLASS = 20_000
PAIRS = 5
RIDGE = 1.0
#: Standardised features are cut to this size.
REACH = 6.0

_KIND = np.zeros(256, np.uint8)  # 0 other, 1 lower, 2 upper, 3 digit, 4 blank, 5 stop, 6 loud, 7 symbol, 8 above ASCII
_KIND[ord("a") : ord("z") + 1] = 1
_KIND[ord("A") : ord("Z") + 1] = 2
_KIND[ord("0") : ord("9") + 1] = 3
for _c in b" \t\n\r\x0b\x0c":
    _KIND[_c] = 4
for _c in b".,;:":
    _KIND[_c] = 5
for _c in b"!?":
    _KIND[_c] = 6
for _c in b"#$%&*+/<=>@[\\]^_`{|}~":
    _KIND[_c] = 7
_KIND[128:] = 8
FEATURES = (
    "symbols", "upper", "loud", "digits", "blank", "stops", "other", "word_length", "distinct_words",
    "repeated_next", "distinct_lines", "top_word", "log_words", "repeated_pairs",
)


def features(text: bytes) -> list[float]:
    """The features of one text, in the order of ``FEATURES``."""
    if not text:
        return [0.0] * len(FEATURES)
    kind = np.bincount(_KIND[np.frombuffer(text, np.uint8)], minlength=9).tolist()
    inked = max(1, len(text) - kind[4])
    letters = max(1, kind[1] + kind[2])
    words = text.split()
    n = max(1, len(words))
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    pairs = set(zip(words, words[1:], strict=False))
    lines = [x for x in text.split(b"\n") if x.strip()]
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return [
        kind[7] / inked, kind[2] / letters, kind[6] / inked, kind[3] / inked, kind[4] / len(text), kind[5] / inked,
        kind[0] / inked, min(inked / n, 40) / 40, math.log((len(counts) + 1) / (n + 1)), same / n,
        len(set(lines)) / max(1, len(lines)), max(counts.values(), default=0) / n, math.log1p(len(words)) / 10,
        1 - len(pairs) / max(1, n - 1),
    ]


@dataclass
class Ranking:
    """Fitted weights; picklable and tiny."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    slope: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        strength = np.clip((x - self.mean) / self.scale, -REACH, REACH) @ self.weights
        return 1 / (1 + np.exp(-np.clip(self.slope * (strength - self.cut), -500, 500)))


def fit_pairs(good: np.ndarray, bad: np.ndarray, good_share: float) -> Ranking:
    """Weights from pairs of rows of ``good`` and ``bad``; ``good_share`` is the share of label 1 among all labels."""
    width = len(FEATURES)
    if not len(good) or not len(bad):
        return Ranking(np.zeros(width), np.ones(width), np.zeros(width), 0.0, 1.0)
    both = np.concatenate([good, bad])
    mean, scale = both.mean(0), both.std(0)
    scale[scale < 1e-9] = 1.0
    a, b = (np.clip((x - mean) / scale, -REACH, REACH) for x in (good, bad))
    n = PAIRS * max(len(a), len(b))
    rng = np.random.default_rng(1)
    one = np.concatenate([rng.permutation(len(a)) for _ in range(-(-n // len(a)))])[:n]
    two = np.concatenate([rng.permutation(len(b)) for _ in range(-(-n // len(b)))])[:n]
    difference = a[one] - b[two]
    w = np.zeros(width)
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(difference @ w, -500, 500)))
        slope = difference.T @ (1 - chance) - RIDGE * w
        curve = (difference * (chance * (1 - chance))[:, None]).T @ difference + RIDGE * np.eye(width)
        step = np.linalg.solve(curve, slope)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    strength = np.concatenate([a @ w, b @ w])
    weight = np.concatenate([np.full(len(a), good_share / len(a)), np.full(len(b), (1 - good_share) / len(b))])
    order = np.argsort(strength, kind="stable")
    below = np.cumsum(weight[order])
    at = min(int(np.searchsorted(below, (1 - good_share) * (1 + 1e-9), "right")), len(order) - 1)
    cut = (strength[order[at]] + strength[order[max(at - 1, 0)]]) / 2
    return Ranking(mean, scale, w, float(cut), 1.0)


def _rows(batch: pa.RecordBatch, column: int) -> np.ndarray:
    data, ends = utf8_of(batch.column(column))
    text, cuts = memoryview(data), ends.tolist()
    rows = [features(bytes(text[a:b])) for a, b in zip(cuts, cuts[1:], strict=False)]
    return np.array(rows, float).reshape(-1, len(FEATURES))


def held_out(id_column: Column) -> Column:
    """Rows that no fit may see: crc32 of the id as text leaves 1 on division by 3."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id_column: str = "doc_id", text_column: str = "text") -> Ranking:
    """Fit on a bounded sample of the labelled rows that are not held out."""
    usable = labels.select(F.col(id_column).alias("id"), F.col(label).cast("int").alias("label")).where(
        ~held_out(F.col("id")) & F.col("label").isin(0, 1)
    )
    shares = {r["label"]: r["n"] for r in usable.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = F.xxhash64("id")
    wanted = usable.where("label = 1").orderBy(order, "id").limit(PER_CLASS)
    wanted = wanted.unionByName(usable.where("label = 0").orderBy(order, "id").limit(PER_CLASS))
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).join(F.broadcast(wanted), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _rows(batch, 0)
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(list(x), pa.list_(pa.float64()))], names=["id", "label", "x"])

    kind = texts.schema["id"].dataType.simpleString()
    rows = texts.select("text", "id", "label").mapInArrow(run, f"id {kind}, label int, x array<double>")
    found = rows.orderBy("id", "x").select("label", "x").collect()  # at most 2 * PER_CLASS short rows
    x = np.array([r["x"] for r in found], float).reshape(-1, len(FEATURES))
    y = np.array([r["label"] for r in found])
    total = sum(shares.values())
    return fit_pairs(x[y == 1], x[y == 0], shares.get(1, 0) / total if total else 0.5)


def score(docs: DataFrame, ranking: Ranking, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) of each row."""
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ranking.scores(_rows(batch, 1)))], names=["id", "score"])

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, score double").select(
        F.col("id").alias(id_column),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, ranking: Ranking, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score of 0.5 or more, all columns as they are."""
    at = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(ranking.scores(_rows(batch, at)) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
