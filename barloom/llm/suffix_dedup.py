"""Removal of byte strings that occur more than once, by a suffix order over a difference cover.

Two suffixes tie on ``length`` bytes when the same bytes start elsewhere too. Sorting all suffixes would move many times
the text, so the suffixes of a difference cover are ranked first. ``COVER`` holds residues modulo ``PERIOD`` such that every
difference occurs; hence for any two places i and j there is a shift below ``PERIOD`` that puts both on cover places.
If the ``length`` bytes from i and from j agree, then so do the ``length - PERIOD + 1`` bytes (or more) from those two cover places.

1. Rank the cover suffixes by their first ``length - PERIOD + 1`` bytes, one bucket at a time, and note which share a rank.
2. Resolve long ties by the cover: where such a place shares even the whole surrounding with another cover place
   (``PERIOD - 1`` bytes before to ``length`` bytes behind), all starts in the ``PERIOD`` bytes up to it are repeated.
   Copied regions are decided here, at a small share of their places.
3. Only the starts that remain near a shared rank, at the borders of copied regions, are sorted among each other, with
   those decided starts that lie near a rank at which some start is open anywhere.

Suffixes stand in buckets by their hash, so a bucket holds whole ties; a task sorts one bucket at a time, and the number of
buckets follows the size of the text. Strings are represented by hashes: 40 bits beyond the bucket in step 1, which only
proposes, and 96 bits where they decide.

Texts are packed into blocks of about ``BLOCK`` bytes. A block sends each of its suffix keys once, however often it holds it, so a string in a
third of all rows is one key per block. Answers come back as bits in the order in which the block sent its keys. What a block learns from them
goes along with its next keys as a note, a bit for each place in question, and comes back with their answers, so that no step is done again to
read its answers a second time. Blocks are written to the checkpoint folder once, dealt by their id, so that joining the answers does not move texts again. A block's id is its place (partition
and number) among rows in a fixed order, so a map task that runs again sends the same blocks to the same receivers.

A null text is empty; texts shorter than ``length`` have no starts and keep all bytes; a text that repeats is removed
everywhere; long texts are cut into overlapping windows while they are hashed; rows that repeat an id each get their
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import cut, pieces, spread, utf8_of

PERIOD = 133
#: A perfect difference set modulo 133.
COVER = (0, 2, 6, 24, 29, 40, 43, 55, 68, 75, 76, 85)
BLOCK = 2 << 20
#: Bytes hashed at a time; the arrays of a window fit a processor's cache.
WINDOW = 1 << 15
#: Keys of a bucket that a task sorts at a time, on average.
BUCKET_KEYS = 1 << 21


@lru_cache(maxsize=4)
def _base(seed: int) -> tuple[np.ndarray, np.uint64, np.uint64]:
    rng = np.random.default_rng(seed)
    values = rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    base = int(rng.integers(2**40, 2**62)) * 8 + 5
    return values, np.uint64(base), np.uint64(pow(base, -1, 2**64))


@lru_cache(maxsize=8)
def _powers(seed: int, inverse: bool, size: int) -> np.ndarray:
    _, base, back = _base(seed)
    out = np.full(size, back if inverse else base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def window_hashes(data: np.ndarray, starts: np.ndarray, length: int, seed: int) -> np.ndarray:
    """64-bit hashes of ``length`` bytes from each of the ascending ``starts``; equal strings have equal hashes."""
    values, _, _ = _base(seed)
    out = np.empty(len(starts), np.uint64)
    size = WINDOW + length
    up, down = _powers(seed, False, size), _powers(seed, True, size)
    sums = np.zeros(size + 1, np.uint64)
    edges = np.searchsorted(starts, np.arange(0, len(data) + WINDOW, WINDOW))
    for a, b in zip(edges, edges[1:], strict=False):
        if a == b:
            continue
        at = starts[a]
        part = values[data[at : starts[b - 1] + length]]
        part *= up[: len(part)]
        np.cumsum(part, out=sums[1 : len(part) + 1])
        own = starts[a:b] - at
        out[a:b] = (sums[own + length] - sums[own]) * down[own]
    return _mixed(out)


class Block:
    """Bytes of some texts, with the places at which a string of a given length may start."""

    def __init__(self, payload: bytes, lengths: np.ndarray):
        self.data = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), np.uint8) if len(payload) else np.zeros(0, np.uint8)
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths

    def of_text(self, values: np.ndarray, at: np.ndarray) -> np.ndarray:
        """For each of the ascending places the value of its text."""
        return np.repeat(values, np.searchsorted(at, self.ends) - np.searchsorted(at, self.starts))

    def cover(self, least: int) -> np.ndarray:
        """Cover places with ``least`` bytes of their text from there."""
        at = (np.arange(0, len(self.data), PERIOD)[:, None] + np.array(COVER)).reshape(-1)
        at = at[: np.searchsorted(at, len(self.data))]
        return at[at + least <= self.of_text(self.ends, at)]

    def startable(self, length: int) -> np.ndarray:
        """Whether ``length`` bytes of its text follow, for every place."""
        own = self.ends - self.starts
        some = np.maximum(own - (length - 1), 0)
        return np.repeat(np.resize([True, False], 2 * len(own)), np.stack([some, own - some], axis=1).reshape(-1))


def _filled(first: np.ndarray, end: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` places lie in one of the ranges from ``first`` to before ``end``, both ascending."""
    if len(first) == 0:
        return np.zeros(size, bool)
    new = np.flatnonzero(np.concatenate([[True], first[1:] > end[:-1]]))
    last = np.append(new[1:], len(end)) - 1
    edges = np.concatenate([[0], np.stack([first[new], end[last]], axis=1).reshape(-1), [size]])
    return np.repeat(np.resize([False, True], len(edges) - 1), np.diff(edges))


def _order(first: np.ndarray, second: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(order that puts equal keys together by ``first``, whether a key in that order differs from the one before it)."""
    order = np.argsort(first)
    own = first[order]
    new = np.ones(len(own), bool)
    new[1:] = own[1:] != own[:-1]
    if second is None:
        return order, new
    other = second[order]
    differs = other[1:] != other[:-1]
    if (differs & ~new[1:]).any():  # one hash of two strings: the second parts decide
        order = np.lexsort((second, first))
        own, other = first[order], second[order]
        new[1:] = (own[1:] != own[:-1]) | (other[1:] != other[:-1])
    return order, new


class Keys:
    """Distinct keys of some places of a block, ordered by bucket, and the way back from keys to places."""

    def __init__(self, first: np.ndarray, second: np.ndarray | None, buckets: int):
        order, new = _order(first, second)
        number = np.cumsum(new) - 1
        self.of_place = np.empty(len(first), np.int64)
        self.of_place[order] = number
        self.first = first[order[new]]
        self.second = second[order[new]] if second is not None else None
        self.several = np.bincount(number, minlength=len(self.first)) > 1
        self.marks: np.ndarray | None = None
        bucket = ((self.first >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        self.edges = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))

    def mark(self, places: np.ndarray) -> Keys:
        """Send with each key whether one of its places is marked; the answer is whether one is anywhere."""
        self.marks = np.bincount(self.of_place[places], minlength=len(self.first)) > 0
        return self

    def rows(self) -> Iterator[tuple[int, bytes]]:
        """(bucket, keys as bytes): 5 bytes a key, or 12; marks follow as bits."""
        for b in np.flatnonzero(np.diff(self.edges)).tolist():
            x, y = self.edges[b], self.edges[b + 1]
            if self.second is None:
                keys = self.first[x:y].view(np.uint8).reshape(-1, 8)[:, :5].tobytes()
                yield b, keys if self.marks is None else keys + np.packbits(self.marks[x:y]).tobytes()
            else:
                yield b, self.first[x:y].tobytes() + self.second[x:y].tobytes()

    def answered(self, answers: list[dict] | None) -> np.ndarray:
        """For each place, whether its key is held more than once (or is marked), here or elsewhere."""
        flag = (self.several if self.marks is None else self.marks).copy()
        for answer in answers or []:
            if answer["bucket"] < 0:  # a note
                continue
            x, y = self.edges[answer["bucket"]], self.edges[answer["bucket"] + 1]
            flag[x:y] |= np.unpackbits(np.frombuffer(answer["bits"], np.uint8))[: y - x].astype(bool)
        return flag[self.of_place]


WIDE, NARROW, MARKED = "wide", "narrow", "marked"


def _decode(keys: bytes, kind: str) -> tuple[np.ndarray, np.ndarray | None]:
    """(first parts of the keys, second parts or marks)."""
    if kind == WIDE:
        n = len(keys) // 12
        return np.frombuffer(keys, np.uint64, n), np.frombuffer(keys, np.uint32, n, 8 * n)
    n = len(keys) // 5 if kind == NARROW else len(keys) * 8 // 41
    raw = np.zeros((n, 8), np.uint8)
    raw[:, :5] = np.frombuffer(keys, np.uint8, 5 * n).reshape(-1, 5)
    marks = None if kind == NARROW else np.unpackbits(np.frombuffer(keys, np.uint8, -1, 5 * n))[:n]
    return raw.reshape(-1).view(np.uint64), marks


def _sorted_bucket(rows: list[tuple[bytes, bytes]], bucket: int, kind: str) -> Iterator[tuple[bytes, int, bytes]]:
    """Sort the keys of one bucket; (block, bucket, bits) for the blocks with a key that others hold too, or that is marked."""
    firsts, seconds = zip(*(_decode(keys, kind) for _, keys in rows), strict=True)
    first = np.concatenate(firsts)
    second = np.concatenate(seconds) if kind != NARROW else None
    order, new = _order(first, second if kind == WIDE else None)
    same = ~new[1:]
    flag = np.zeros(len(first), bool)
    if kind == MARKED:
        tie = np.concatenate([[0], np.cumsum(~same)])
        flag[order] = (np.bincount(tie, second[order]) > 0)[tie]
    else:
        tied = np.zeros(len(first), bool)
        tied[1:] |= same
        tied[:-1] |= same
        flag[order] = tied
    at = 0
    for (block, _), part in zip(rows, firsts, strict=True):
        bits = flag[at : at + len(part)]
        at += len(part)
        if bits.any():
            yield block, bucket, np.packbits(bits).tobytes()


def _answers(sent: DataFrame, kind: str) -> DataFrame:
    """(block, answers) from (block, bucket, keys): sorts one bucket at a time. Notes go back to their block as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found: list) -> Iterator[pa.RecordBatch]:
            if found:
                block, bucket, bits = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block, pa.binary()), pa.array(bucket, pa.int32()), pa.array(bits, pa.binary())],
                    names=["block", "bucket", "bits"],
                )

        held, rows = None, []
        for batch in batches:
            for block, bucket, keys in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket < 0:
                    yield from out([(block, bucket, keys)])
                    continue
                if bucket != held and rows:
                    yield from out(list(_sorted_bucket(rows, held, kind)))
                    rows = []
                held = bucket
                rows.append((block, keys))
        if rows:
            yield from out(list(_sorted_bucket(rows, held, kind)))

    n = spread(sent, "bucket")
    dealt = sent.repartition(n, "bucket").sortWithinPartitions("bucket")
    found = dealt.mapInArrow(run, "block binary, bucket int, bits binary")
    return found.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias("answers"))


def _blocks(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(block, ids, lengths, payload): texts packed and compressed, under an id that is the same when a task runs again.

    Behind a shuffle the rows of a partition may come in another order each time, so they are sorted before they are packed.
    """
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).sortWithinPartitions("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        partition, number = TaskContext.get().partitionId(), count()
        for batch in batches:
            data, ends = utf8_of(batch.column(1))
            lengths = np.diff(ends)
            for a, b in pieces(lengths.tolist(), BLOCK):
                payload = press.compress(data[ends[a] : ends[b]].tobytes())
                ids = pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), batch.column(0).slice(a, b - a))
                block = partition.to_bytes(8, "big") + next(number).to_bytes(8, "big")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.binary()), ids, pa.array([lengths[a:b]], pa.list_(pa.int64())), pa.array([payload], pa.binary())],
                    names=["block", "ids", "lengths", "payload"],
                )

    kind = source.schema["id"].dataType.simpleString()
    packed = source.mapInArrow(run, f"block binary, ids array<{kind}>, lengths array<long>, payload binary")
    return cut(packed.repartition(spread(packed, "block"), "block"))


class _Places:
    """The steps on one block, each from the answers to the step before and the notes of earlier ones."""

    def __init__(self, row: dict, length: int, buckets: int):
        self.block, self.length, self.buckets = Block(row["payload"], np.array(row["lengths"], np.int64)), length, buckets
        self.row, self.size = row, len(self.block.data)
        #: What the step learnt from its answers, to be sent along with its keys.
        self.note: np.ndarray | None = None

    def _noted(self, number: int, size: int) -> np.ndarray:
        (bits,) = (a["bits"] for a in self.row[f"answers{number}"] if a["bucket"] < 0)
        return np.unpackbits(np.frombuffer(bits, np.uint8), count=size).astype(bool)

    def _wide(self, at: np.ndarray, length: int) -> Keys:
        data = self.block.data
        second = (window_hashes(data, at, length, 12) >> np.uint64(32)).astype(np.uint32)
        return Keys(window_hashes(data, at, length, 11), second, self.buckets)

    def _ranks(self, places: np.ndarray) -> Keys:
        return Keys(window_hashes(self.block.data, places, self.length - PERIOD + 1, 11), None, self.buckets)

    def _near(self, places: np.ndarray) -> np.ndarray:
        """Starts in the ``PERIOD`` bytes up to each place, where their string ends in the same text."""
        return _filled(np.maximum(places - (PERIOD - 1), 0), places + 1, self.size) & self.block.startable(self.length)

    def _share(self, found: np.ndarray | None) -> None:
        """Cover places that share a rank (as noted, if not given), and those of them that have the whole surrounding in their text."""
        block, places = self.block, self.block.cover(self.length - PERIOD + 1)
        at = self.shared = places[self._noted(2, len(places)) if found is None else found]
        self.full = at[(at - (PERIOD - 1) >= block.of_text(block.starts, at)) & (at + self.length <= block.of_text(block.ends, at))]

    def _surrounding_keys(self) -> Keys:
        return self._wide(self.full - (PERIOD - 1), self.length + PERIOD - 1)

    def _decide(self, tied: np.ndarray | None) -> None:
        """Starts that are repeated for certain, and those near a shared rank that are open."""
        self.decided = self._near(self.full[self._noted(3, len(self.full)) if tied is None else tied])
        self.open = self._near(self.shared) & ~self.decided

    def _contested_keys(self) -> Keys:
        before = np.zeros(self.size + 1, np.int32)
        np.cumsum(self.open, out=before[1:])
        some = before[self.shared + 1] > before[np.maximum(self.shared - (PERIOD - 1), 0)]
        return self._ranks(self.shared).mark(some)

    def _ask(self, found: np.ndarray | None) -> None:
        found = self._noted(4, len(self.shared)) if found is None else found
        self.asked = np.flatnonzero(self.open | (self.decided & self._near(self.shared[found])))

    def ranks(self) -> Keys:
        return self._ranks(self.block.cover(self.length - PERIOD + 1))

    def surroundings(self) -> Keys:
        """Surroundings of the cover places that share a rank."""
        self.note = self.ranks().answered(self.row["answers1"])
        self._share(self.note)
        return self._surrounding_keys()

    def contested(self) -> Keys:
        """Shared ranks, marked where a start near them is still open."""
        self._share(None)
        self.note = self._surrounding_keys().answered(self.row["answers2"])
        self._decide(self.note)
        return self._contested_keys()

    def borders(self) -> Keys:
        """Open starts, and the decided ones that may answer an open start elsewhere."""
        self._share(None)
        self._decide(None)
        self.note = self._contested_keys().answered(self.row["answers3"])
        self._ask(self.note)
        return self._wide(self.asked, self.length)

    def covered(self) -> np.ndarray:
        """Which bytes a repeated string covers."""
        self._share(None)
        self._decide(None)
        self._ask(None)
        start = self.decided
        start[self.asked[self._wide(self.asked, self.length).answered(self.row["answers4"])]] = True
        at = np.flatnonzero(start)
        return _filled(at, at + self.length, self.size)


STEPS = ((_Places.ranks, NARROW), (_Places.surroundings, WIDE), (_Places.contested, MARKED), (_Places.borders, WIDE))


def _rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    names = [n for n in batch.schema.names if n != "ids"]
    for i in range(batch.num_rows):
        yield {n: batch.column(n)[i].as_py() for n in names}


def _sent(frame: DataFrame, step: Callable[[_Places], Keys], length: int, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows_of(batch):
                work = _Places(row, length, buckets)
                out = list(step(work).rows())
                if work.note is not None:  # buckets below 0 hold notes, dealt by block
                    out.append((-1 - zlib.crc32(row["block"]) % buckets, np.packbits(work.note).tobytes()))
                if out:
                    bucket, keys = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["block"]] * len(out), pa.binary()), pa.array(bucket, pa.int32()), pa.array(keys, pa.binary())],
                        names=["block", "bucket", "keys"],
                    )

    return frame.drop("ids").mapInArrow(run, "block binary, bucket int, keys binary")


def _with_answers(frame: DataFrame, held: dict[int, DataFrame]) -> DataFrame:
    for k, found in held.items():
        frame = frame.join(found.withColumnRenamed("answers", f"answers{k}"), "block", "left")
    return frame


def repeated_strings(
    docs: DataFrame, length: int = 200, id_column: str = "doc_id", text_column: str = "text", spans: bool = False
) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256[, spans]): each text without the bytes that repeated strings cover.

    ``spans`` adds the removed runs as (start, end) in bytes of the text.
    """
    if length < 2 * PERIOD - 66:
        raise ValueError(f"strings of {length} bytes are too short for a cover of period {PERIOD}")
    frame = _blocks(docs, id_column, text_column)
    size = frame.agg(F.coalesce(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0))).first()[0]
    buckets = max(spread(frame, "bucket"), size * len(COVER) // PERIOD // BUCKET_KEYS)
    held: dict[int, DataFrame] = {}
    for k, (step, kind) in enumerate(STEPS, 1):
        found = cut(_answers(_sent(_with_answers(frame, held), step, length, buckets), kind))
        # Only the notes of the answers before the last are read again; the first ones have none.
        notes = {i: f.withColumn("answers", F.filter("answers", lambda a: a["bucket"] < 0)) for i, f in held.items() if i > 1}
        held = notes | {k: found}
    frame = _with_answers(frame, held)
    names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"][: 6 if spans else 5]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(_rows_of(batch)):
                work = _Places(row, length, buckets)
                gone, block, out = work.covered(), work.block, []
                for a, b in zip(block.starts.tolist(), block.ends.tolist(), strict=True):
                    own = gone[a:b]
                    edge = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]])))
                    kept = block.data[a:b][~own].tobytes() if len(edge) else block.data[a:b].tobytes()
                    runs = [{"start": x, "end": y} for x, y in edge.reshape(-1, 2).tolist()]
                    out.append((b - a, int(own.sum()), len(runs), hashlib.sha256(kept).hexdigest(), runs))
                columns = list(zip(*out, strict=True))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
                ids = batch.column("ids")[i].values
                made = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([ids, *made][: len(names)], names=names)

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    out = frame.mapInArrow(run, schema + ", spans array<struct<start:long,end:long>>" * spans)
    return out.withColumnRenamed("id", id_column)
