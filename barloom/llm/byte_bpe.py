"""Byte-level BPE encoding and decoding with a file of ranks.

Pre-tokens come from the vectorised automaton in ``pretokens``; each is looked up in the vocabulary, then in a
bounded cache of the worker, and only then merged pair by pair. Offsets of the tokens in the UTF-8 bytes are
kept on request, so that a span of ids can be traced back to its text.

Nulls and empty texts have no ids and decode to the empty text; long texts are taken whole; rows are independent,
so repeated rows and ties need no rule; other columns are ignored. Every byte is a token, so any text has ids and
decoding returns it exactly.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import pieces, texts_of
from barloom.llm.pretokens import tokens

#: Pre-tokens that a worker remembers; beyond that it starts anew.
CACHE = 300_000
PIECE = 1 << 19
#: Pieces longer than this are merged with a heap instead of by looking for the least rank again.
LONG = 100


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file) if a}


def merge(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Ids of one pre-token: join the adjacent pair of least rank, leftmost first, until none is known."""
    whole = ranks.get(piece)
    if whole is not None:
        return (whole,)
    if len(piece) > LONG:
        return _merge_long(piece, ranks)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    none = len(ranks) + 1
    rank = [ranks.get(parts[i] + parts[i + 1], none) for i in range(len(parts) - 1)]
    while rank:
        least = min(rank)
        if least == none:
            break
        i = rank.index(least)
        parts[i] += parts.pop(i + 1)
        rank.pop(i)
        if i < len(rank):
            rank[i] = ranks.get(parts[i] + parts[i + 1], none)
        if i:
            rank[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
    return tuple(ranks[p] for p in parts)


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """The same in n log n steps, over a linked list of parts."""
    n = len(piece)
    end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[int, int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n and (r := ranks.get(piece[i : end[j]])) is not None:
            heapq.heappush(heap, (r, i, end[i], end[j]))

    for i in range(n - 1):
        offer(i)
    gone = bytearray(n)
    while heap:
        _, i, middle, last = heapq.heappop(heap)
        if gone[i] or end[i] != middle or (j := after[i]) >= n or end[j] != last:
            continue
        gone[j] = 1
        end[i], after[i] = last, after[j]
        if after[j] < n:
            before[after[j]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = after[i]
    return tuple(out)


class PairTable:
    """Rank of each mergeable pair of ids: an open-addressed table that whole arrays probe at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.size = max(ranks.values(), default=-1) + 1
        self.none = self.size
        pairs = {
            left * self.size + right: i
            for piece, i in ranks.items()
            for k in range(1, len(piece))
            if (left := ranks.get(piece[:k])) is not None and (right := ranks.get(piece[k:])) is not None
        }
        bits = max(4, (3 * len(pairs)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.full(1 << bits, self.none, np.int32)
        keys, values = np.fromiter(pairs.keys(), np.int64, len(pairs)), np.fromiter(pairs.values(), np.int32, len(pairs))
        at = self._home(keys)
        while len(keys):
            free = self.keys[at] == -1
            self.keys[at[free]] = keys[free]  # of several that want a slot one gets it; the others go on
            held = free & (self.keys[at] == keys)
            self.values[at[held]] = values[held]
            keys, values, at = keys[~held], values[~held], (at[~held] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or ``none``; a negative id is in no pair."""
        wanted = left.astype(np.int64) * self.size + right
        wanted[(left < 0) | (right < 0)] = -2
        at = self._home(wanted)
        out = self.values[at]
        open_ = np.flatnonzero((self.keys[at] != wanted) & (self.keys[at] != -1))
        out[self.keys[at] != wanted] = self.none
        while len(open_):
            at[open_] = (at[open_] + 1) & self.mask
            seen = self.keys[at[open_]]
            hit = seen == wanted[open_]
            out[open_[hit]] = self.values[at[open_[hit]]]
            open_ = open_[~hit & (seen != -1)]
        return out


def merge_many(found: list[bytes], ranks: dict[bytes, int], table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """``merge`` for many pre-tokens: (ids of all in order, length of each).

    One step merges the least pair of every row of a matrix of ids; rows that are done leave the matrix.
    """
    size = np.fromiter(map(len, found), np.int64, len(found))
    length, whole = np.zeros(len(found), np.int64), {}
    matrices: list[tuple[np.ndarray, np.ndarray]] = []
    for i in np.flatnonzero(size > LONG).tolist():
        whole[i] = np.array(_merge_long(found[i], ranks), np.int32)
        length[i] = len(whole[i])
    single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
    group = np.where(size > LONG, 0, -(-size // 4) * 4)
    for width in np.unique(group[group > 0]).tolist():
        rows = np.flatnonzero(group == width)
        joined = b"".join([found[i].ljust(width, b"\0") for i in rows.tolist()])
        ids = single[np.frombuffer(joined, np.uint8)].reshape(-1, width)
        place = np.arange(width, dtype=np.int32)
        ids[place[None, :] >= size[rows][:, None]] = -1
        rank = table.rank(ids[:, :-1].reshape(-1), ids[:, 1:].reshape(-1)).reshape(-1, width - 1)
        done, own = np.empty_like(ids), np.arange(len(rows))
        while len(own):
            least = rank.argmin(axis=1)
            value = rank[np.arange(len(own)), least]
            go = value != table.none
            done[own[~go]] = ids[~go]
            own, ids, rank, least, value = own[go], ids[go], rank[go], least[go], value[go]
            each, behind = np.arange(len(own)), place[None, 1:] > least[:, None]
            moved = ids[:, 1:].copy()
            moved[:, :-1][behind[:, :-1]] = ids[:, 2:][behind[:, :-1]]
            moved[:, -1] = -1
            ids[:, 1:] = moved
            ids[each, least] = value
            kept = rank.copy()
            kept[:, :-1] = np.where(place[None, : width - 2] >= least[:, None], rank[:, 1:], rank[:, :-1])
            kept[:, -1] = table.none
            rank = kept
            after = least + 1 < width
            at = np.minimum(least, width - 2)
            rank[each, at] = table.rank(value, np.where(after, ids[each, np.minimum(least + 1, width - 1)], -1))
            led = np.flatnonzero(least > 0)
            rank[led, least[led] - 1] = table.rank(ids[led, least[led] - 1], value[led])
        length[rows] = (done >= 0).sum(1)
        matrices.append((rows, done))
    start = np.cumsum(length) - length
    out = np.empty(int(length.sum()), np.int32)
    for i, ids in whole.items():
        out[start[i] : start[i] + length[i]] = ids
    for rows, done in matrices:
        n = length[rows]
        out[np.arange(n.sum()) + np.repeat(start[rows] - (np.cumsum(n) - n), n)] = done[done >= 0]
    return out, length


class Codec:
    """Encodes and decodes texts in one worker. Known pre-tokens have a slot; slots point into one array of ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.table = ranks, PairTable(ranks)
        size = self.table.size
        spelled = [b""] * size
        for piece, i in ranks.items():
            spelled[i] = piece
        self.lengths = np.fromiter(map(len, spelled), np.int64, size)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)])
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.known, self.first = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _learn(self, new: list[str]) -> None:
        ids, length = merge_many([t.encode("utf-8") for t in new], self.ranks, self.table)
        self.slots.update(zip(new, range(len(self.slots), len(self.slots) + len(new)), strict=True))
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(length)])
        self.known = np.concatenate([self.known, ids])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        found, first = tokens(texts)
        if len(self.slots) > CACHE:
            self._forget()
        new = [t for t in set(found) if t not in self.slots]
        if new:
            self._learn(new)
        slot = np.fromiter(map(self.slots.__getitem__, found), np.int64, len(found))
        length = self.first[slot + 1] - self.first[slot]
        length[first[1:] - 1] = 0  # separators
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.known[np.arange(total) + np.repeat(self.first[slot] - (ends - length), length)]
        cuts = np.concatenate([[0], ends])[first]
        return [ids[a:b] for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False)]

    def ends(self, ids: np.ndarray) -> np.ndarray:
        """Offset behind each token in the decoded bytes."""
        return np.cumsum(self.lengths[ids])

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that the ids spell: one gather from the spelling table."""
        if not len(ids):
            return b""
        length = self.lengths[ids]
        ends = np.cumsum(length)
        at = np.arange(ends[-1]) + np.repeat(self.offsets[ids] - (ends - length), length)
        return self.spelled[at].tobytes()


def _frames(docs: DataFrame, id_column: str, column: str) -> tuple[DataFrame, str]:
    out = docs.select(F.col(id_column).alias("id"), F.col(column).alias("value"))
    return out, out.schema["id"].dataType.simpleString()


def encode(
    docs: DataFrame, ranks_path: str, id_column: str = "doc_id", text_column: str = "text", offsets: bool = False
) -> DataFrame:
    """(id, ids array<int>[, ends array<long>]): token ids of each row, with the byte offset behind each token."""
    source, kind = _frames(docs, id_column, text_column)
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    kept: dict[str, Codec] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = kept.setdefault("own", Codec(shared.value)) if "own" not in kept else kept["own"]
        for batch in batches:
            texts = texts_of(batch.column(1))
            for a, b in pieces(list(map(len, texts)), PIECE):
                ids = codec.encode(texts[a:b])
                columns = [batch.column(0).slice(a, b - a), pa.array(ids, pa.list_(pa.int32()))]
                if offsets:
                    columns.append(pa.array([codec.ends(x) for x in ids], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=["id", "ids", "ends"][: len(columns)])

    out = source.mapInArrow(run, f"id {kind}, ids array<int>" + ", ends array<long>" * offsets)
    return out.withColumnRenamed("id", id_column)


def decode(encoded: DataFrame, ranks_path: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """(id, decoded binary): the bytes that the ids of each row spell; null is empty."""
    source, kind = _frames(encoded, id_column, ids_column)
    shared = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        for batch in batches:
            spelled = [codec.decode(np.array(x or [], np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spelled, pa.binary())], names=["id", "decoded"])

    return source.mapInArrow(run, f"id {kind}, decoded binary").withColumnRenamed("id", id_column)


def digests(
    docs: DataFrame, ranks_path: str, id_column: str = "doc_id", text_column: str = "text", with_ids: bool = False
) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256[, ids]): each text encoded, its ids decoded, both as digests.

    Encoding and decoding share a pass, so that ids need not leave the task unless they are asked for.
    """
    source, kind = _frames(docs, id_column, text_column)
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    kept: dict[str, Codec] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = kept.setdefault("own", Codec(shared.value)) if "own" not in kept else kept["own"]
        decimal = list(map(str, range(len(codec.lengths))))
        for batch in batches:
            texts = texts_of(batch.column(1))
            for a, b in pieces(list(map(len, texts)), PIECE):
                ids = codec.encode(texts[a:b])
                shown = [hashlib.sha256(" ".join(map(decimal.__getitem__, x.tolist())).encode()).hexdigest() for x in ids]
                back = [hashlib.sha256(codec.decode(x)).hexdigest() for x in ids]
                columns = [batch.column(0).slice(a, b - a), pa.array(list(map(len, ids)), pa.int64()), pa.array(shown), pa.array(back)]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                names = ["id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names[: len(columns)])

    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    out = source.mapInArrow(run, schema)
    return out.withColumnRenamed("id", id_column)
