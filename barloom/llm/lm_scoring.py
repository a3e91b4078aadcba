"""Language-model scoring by cross-entropy difference.

Two bigram models, one of a target (documents known to be good) and one of the background (all others), are
counted over the whole corpus. They are matched: same order, same smoothing, one vocabulary (all words of both). Each word of a
document has a loss under each; the mean difference, target less background, is the document's score, and the lower it is the
more the document looks like the target. A document's own counts are taken out of the model that it was counted in,
so it does not vouch for itself.

Words are split at ASCII white space, with A-Z lower-cased, and stand as 64-bit hashes; pairs of words likewise. Texts are packed into
blocks; a block sends each distinct word and pair once, with its counts, to the bucket of its hash. A bucket
adds up and answers each block in the order of its keys. So no table of counts is ever broadcast or collected, what is
gathered grows with the corpus, and the most frequent pair is one key per block.

A null or empty text has no words, null losses and the score 0. Documents with null ids belong to the background. Several
target entries for an id count once. Repeated rows each count and are each scored. Long texts are taken whole. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import cut, spread
from barloom.llm.jaccard_join import word_hashes
from barloom.llm.suffix_dedup import Keys, _blocks, _mixed

#: Weight of the pair's own rate, and what is added to each word's count.
PAIR_WEIGHT = 0.7
ADDED = 0.5
_FIRST = np.uint64(0x2545F4914F6CDD1D)


class _Words:
    """Words and pairs of one block; keys of words are even, those of pairs odd."""

    def __init__(self, row: dict, buckets: int):
        lengths = np.array(row["lengths"], np.int64)
        data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["payload"]), np.uint8) if lengths.sum() else np.zeros(0, np.uint8)
        word, self.starts = word_hashes(data, np.concatenate([[0], np.cumsum(lengths)]))
        count = np.diff(self.starts)
        self.owner = np.repeat(np.arange(len(lengths)), count)
        before = np.empty_like(word)
        before[1:] = word[:-1]
        before[self.starts[:-1][count > 0]] = _FIRST
        even = ~np.uint64(1)
        pair = _mixed(before * np.uint64(0x9E3779B97F4A7C15) + word) | np.uint64(1)
        self.n = len(word)
        self.keys = Keys(np.concatenate([word & even, pair, before & even]), None, buckets)
        target = np.zeros(len(lengths), bool)
        target[row["target"] or []] = True
        self.target = target

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each key, how often the target and the background have it in this block. A text's start is counted as a word."""
        place = np.concatenate([self.keys.of_place[: 2 * self.n], self.keys.of_place[2 * self.n :][self._opening()]])
        owner = np.concatenate([self.owner, self.owner, self.owner[self._opening()]])
        mine = self.target[owner]
        size = len(self.keys.first)
        return np.bincount(place[mine], minlength=size), np.bincount(place[~mine], minlength=size)

    def _opening(self) -> np.ndarray:
        return self.starts[:-1][np.diff(self.starts) > 0]


def _press(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x).tobytes())


def _open(x: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), kind)


def _row_of(batch: pa.RecordBatch, i: int, names: tuple[str, ...]) -> dict:
    return {n: batch.column(n)[i].as_py() for n in names}


def _requests(frame: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = _row_of(batch, i, ("block", "lengths", "payload", "target"))
                work = _Words(row, buckets)
                good, other = work.counts()
                out = []
                for b in np.flatnonzero(np.diff(work.keys.edges)).tolist():
                    x, y = work.keys.edges[b], work.keys.edges[b + 1]
                    keys = work.keys.first[x:y].view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
                    out.append((row["block"], b, keys, _press(good[x:y].astype(np.uint32)), _press(other[x:y].astype(np.uint32))))
                if out:
                    block, bucket, keys, one, two = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(block, pa.binary()), pa.array(bucket, pa.int32()), *(pa.array(c, pa.binary()) for c in (keys, one, two))],
                        names=["block", "bucket", "keys", "good", "other"],
                    )

    return frame.drop("ids").mapInArrow(run, "block binary, bucket int, keys binary, good binary, other binary")


def _sums(requests: DataFrame, buckets: int) -> DataFrame:
    """(block, bucket, good, other, words): sums for the keys of each block; ``words`` on one row of each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["block", "bucket", "good", "other", "words"]

        def out(rows: list[tuple], bucket: int) -> Iterator[pa.RecordBatch]:
            keys = []
            for r in rows:
                raw = np.zeros((len(r[1]) // 6, 8), np.uint8)
                raw[:, :6] = np.frombuffer(r[1], np.uint8).reshape(-1, 6)
                keys.append(raw.reshape(-1).view(np.uint64))
            distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
            good = np.bincount(at, np.concatenate([_open(r[2], np.uint32) for r in rows]), len(distinct))
            other = np.bincount(at, np.concatenate([_open(r[3], np.uint32) for r in rows]), len(distinct))
            words, start = int((distinct & np.uint64(1) == 0).sum()), 0
            for r, k in zip(rows, keys, strict=True):
                own = at[start : start + len(k)]
                start += len(k)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[0]], pa.binary()), pa.array([bucket], pa.int32()),
                        pa.array([_press(good[own].astype(np.uint64))], pa.binary()),
                        pa.array([_press(other[own].astype(np.uint64))], pa.binary()), pa.array([words], pa.int64()),
                    ],
                    names=names,
                )
                words = 0

        held, rows = None, []
        for batch in batches:
            for block, bucket, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != held and rows:
                    yield from out(rows, held)
                    rows = []
                held = bucket
                rows.append((block, *rest))
        if rows:
            yield from out(rows, held)

    dealt = requests.repartition(spread(requests, "bucket"), "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "block binary, bucket int, good binary, other binary, words long")


def _own(owner: np.ndarray, place: np.ndarray, width: int) -> np.ndarray:
    """For each occurrence, how often its document has the key."""
    _, at, n = np.unique(owner.astype(np.int64) * width + place, return_inverse=True, return_counts=True)
    return n[at]


def cross_entropy_difference(docs: DataFrame, target: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_words, target_loss, background_loss, score, in_target) of each row; ``target`` has the ids of the good documents."""
    frame = _blocks(docs, id_column, text_column)
    good = target.select(F.col(id_column).alias("id")).where("id IS NOT NULL").distinct()
    inside = frame.select("block", F.posexplode("ids").alias("at", "id")).join(good, "id").groupBy("block").agg(F.collect_list("at").alias("target"))
    frame = frame.join(cut(inside), "block", "left")
    total = frame.agg(F.coalesce(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0))).first()[0]
    buckets = max(spread(frame, "bucket"), total // (16 << 20))
    sums = cut(_sums(_requests(frame, buckets), buckets))
    vocabulary = sums.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    answers = sums.groupBy("block").agg(F.collect_list(F.struct("bucket", "good", "other")).alias("answers"))
    sizes = _sizes(frame)
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = _row_of(batch, i, ("block", "lengths", "payload", "target", "answers"))
                work = _Words(row, buckets)
                losses = _losses(work, row["answers"] or [], sizes, vocabulary)
                count = np.diff(work.starts)
                one, two = (np.add.reduceat(np.append(x, 0.0), work.starts[:-1]) if len(count) else x for x in losses)
                some = count > 0
                mean = [np.where(some, x / np.maximum(count, 1), np.nan) for x in (one, two)]
                score = np.where(some, mean[0] - mean[1], 0.0)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("ids")[i].values, pa.array(count), pa.array(mean[0], mask=~some), pa.array(mean[1], mask=~some),
                        pa.array(score), pa.array(work.target),
                    ],
                    names=["id", "n_words", "target_loss", "background_loss", "score", "in_target"],
                )

    schema = f"id {kind}, n_words long, target_loss double, background_loss double, score double, in_target boolean"
    return frame.join(answers, "block", "left").mapInArrow(run, schema).withColumnRenamed("id", id_column)


def _sizes(frame: DataFrame) -> tuple[int, int]:
    """Words of the target and of the background, starts of texts included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                work = _Words(_row_of(batch, i, ("lengths", "payload", "target")), 1)
                count = np.diff(work.starts)
                count = count + (count > 0)
                good = int(count[work.target].sum())
                yield pa.RecordBatch.from_arrays([pa.array([good]), pa.array([int(count.sum()) - good])], names=["good", "other"])

    sums = frame.drop("ids").mapInArrow(run, "good long, other long").agg(F.sum("good"), F.sum("other")).first()
    return sums[0] or 0, sums[1] or 0


def _losses(work: _Words, answers: list[dict], sizes: tuple[int, int], vocabulary: int) -> list[np.ndarray]:
    """Loss of each word under the target and under the background, without the document's own counts."""
    keys, n = work.keys, work.n
    place = keys.of_place
    word, pair, before = place[:n], place[n : 2 * n], place[2 * n :]
    width = len(keys.first) + 1
    opening = work._opening()
    # Own counts: words and starts of texts are in one key space, so they are counted together.
    single = _own(np.concatenate([work.owner, work.owner[opening]]), np.concatenate([word, before[opening]]), width)
    own_word, own_pair = single[:n], _own(work.owner, pair, width)
    own_before = np.empty(n, np.int64)
    own_before[1:] = own_word[:-1]
    own_before[opening] = single[n:]
    count = np.diff(work.starts)
    own_total = (count + (count > 0))[work.owner]
    out = []
    for side, size in (("good", sizes[0]), ("other", sizes[1])):
        total = np.zeros(len(keys.first), np.int64)
        for a in answers:
            total[keys.edges[a["bucket"]] : keys.edges[a["bucket"] + 1]] = _open(a[side], np.uint64)
        mine = work.target[work.owner] == (side == "good")
        less = lambda x, own, mine=mine: np.maximum(x - np.where(mine, own, 0), 0)
        alone = (less(total[word], own_word) + ADDED) / (less(np.full(n, size), own_total) + ADDED * (vocabulary + 1))
        history = less(total[before], own_before)
        together = np.where(history > 0, less(total[pair], own_pair) / np.maximum(history, 1), alone)
        out.append(-np.log(PAIR_WEIGHT * together + (1 - PAIR_WEIGHT) * alone))
    return out
