"""N-gram Jaccard join with a token-group matrix, down to connected components.

Every text becomes its set of distinct shingles of ``n`` words. Two sets link when their Jaccard similarity is at least
``percent`` / 100. The join is exact, up to 64-bit hashes of shingles:

1. Rows with the same set form a class; one row of each class goes on.
2. A fixed-size sketch counts all shingles. It gives one order for all sets, rare shingles first. Linked sets share a shingle
   among their first ``size - ceil(size * percent / 100) + 1``; only these prefixes meet. Shingles that one prefix alone
   has are dropped where they meet.
3. Each document with a shared prefix shingle is first compared with a hub: among the documents that share such a shingle with it,
   the one whose shingles are the most common. Large families of near copies collapse onto their hubs in linear work.
4. Documents near the same hub are put into groups of about ``GROUP`` members, those of the hub's component apart from the others.
   The token-group matrix says which groups hold a prefix shingle; shingles that the same groups hold share a column. A document asks
   a group only if it shares a column and the group has members of another component and of fitting size. The union of the shingles of each asked
   group is stored, a row per group and half a hash per shingle; a document's overlap with it bounds what it shares with any member. Only where that is
   enough the group is opened, which means that its members' sets are sent.
5. Links between components are merged by star contraction.

A pair inside a component needs no comparison, so nothing is lost. No step gathers a posting list, a class, a group of copies or
a component in one task: counts combine on the map side, groups and the documents that ask them are split by hash, joins
on hot keys are plain and split by adaptive execution.

A null or empty text, or one without words, has an empty set and links with nothing; a text with fewer words than ``n`` has
one shingle, all its words. Ids must be integers and name documents; a null id is a document of its own with a null component.
Repeated rows of an id share the component, and the component's name is its least id. Texts are taken whole. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import PIECE_BYTES, cut, listed, pieces, short, spread, utf8_of, without
from barloom.llm.suffix_dedup import _mixed

#: Cells of the counting sketch: 2 ** CELL_BITS.
CELL_BITS = 24
CELLS = 1 << CELL_BITS
SEGMENTS = 256
GROUP = 64
#: Documents that ask a group in one task.
ASKERS = 256
#: Prefix shingles of a bucket that a task holds before it merges them.
HELD = 1 << 20
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


def string_hashes(data: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """64-bit hashes of strings of at least one byte: the sum of a mixed value for each eight bytes and their place, mixed with the length.

    Values are mixed before they are added. Sums of powers modulo a power of two would be cheaper, but have strings that collide for every base.
    """
    if not len(first):
        return np.zeros(0, np.uint64)
    held = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), np.dtype("<u8"), held, strides=(1,))
    steps = (length + 7) // 8
    start = np.cumsum(steps) - steps
    owner = np.repeat(np.arange(len(first)), steps)
    place = np.arange(len(owner)) - start[owner]
    part = eights[first[owner] + 8 * place]
    left = length[owner] - 8 * place
    short = left < 8
    part[short] &= (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
    value = _mixed(part ^ _mixed(place.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)))
    return _mixed(np.add.reduceat(value, start) + length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, A-Z lower-cased; first word of each text and past the last).

    ``ends`` are the offsets of the texts in ``data``, one more than there are texts.
    """
    count = len(ends) - 1
    # A white byte behind each text keeps words apart.
    padded = np.full(len(data) + count, 0x20, np.uint8)
    lengths = np.diff(ends)
    padded[np.arange(len(data)) + np.repeat(np.arange(count), lengths)] = np.frombuffer(data.tobytes().translate(_LOWER), np.uint8)
    inside = ~_WHITE[padded]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
    first, last = edge[::2], edge[1::2]
    word = string_hashes(padded, first, last - first)
    owner = np.searchsorted(ends[1:] + np.arange(1, count + 1), first, "right")
    return word, np.searchsorted(owner, np.arange(count + 1))


def shingle_sets(data: np.ndarray, ends: np.ndarray, n: int) -> list[np.ndarray]:
    """The set of each text as sorted distinct hashes; ``ends`` has one entry more than there are texts."""
    word, starts = word_hashes(data, ends)
    odd = np.uint64(0x9E3779B97F4A7C15)
    rolled = np.zeros(max(0, len(word) - n + 1), np.uint64)
    for k in range(n):
        rolled = rolled * odd + word[k : k + len(rolled)]
    rolled = _mixed(rolled)
    out = []
    for a, b in zip(starts.tolist(), starts[1:].tolist(), strict=False):
        if b - a >= n:
            out.append(np.unique(rolled[a : b - n + 1]))
        elif b > a:
            h = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for w in word[a:b]:
                    h = h * odd + w
            out.append(_mixed(np.array([h], np.uint64) ^ np.uint64(0x5555)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _sets(batch: pa.RecordBatch, column: int, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, set) of each row of a batch."""
    data, ends = utf8_of(batch.column(column))
    for a, b in pieces(np.diff(ends).tolist(), PIECE_BYTES):
        found = shingle_sets(data[ends[a] : ends[b]], ends[a : b + 1] - ends[a], n)
        yield from zip(range(a, b), found, strict=True)


def _needed(size: int, percent: int) -> int:
    """Least overlap of a set of this size with a set that it links with."""
    return -(-size * percent // 100)


def _signature(own: np.ndarray) -> bytes:
    with np.errstate(over="ignore"):
        one, two = own.sum(dtype=np.uint64), _mixed(own ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return one.tobytes() + two.tobytes() + len(own).to_bytes(4, "little")


def _sketch(source: DataFrame, n: int) -> np.ndarray:
    """Priority (0 to 255, by the logarithm of the count) of each cell of the counting sketch; its size is fixed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, np.uint16)  # counts stop at the largest value; no other array is as wide

        def add_up(held: list[np.ndarray]) -> None:
            cell, times = np.unique(np.concatenate(held), return_counts=True)
            cells[cell] = np.minimum(cells[cell].astype(np.int64) + times, 65535)

        for batch in batches:
            held, size = [], 0
            for _, own in _sets(batch, 1, n):
                held.append((own >> np.uint64(64 - CELL_BITS)).astype(np.uint32))
                size += len(own)
                if size > HELD // 4:
                    add_up(held)
                    held, size = [], 0
            if held:
                add_up(held)
        packed = [zlib.compress(x.tobytes(), 1) for x in cells.reshape(SEGMENTS, -1)]
        yield pa.RecordBatch.from_arrays([pa.array(range(SEGMENTS), pa.int32()), pa.array(packed, pa.binary())], names=["segment", "cells"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for segment, cells in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.frombuffer(zlib.decompress(cells), np.uint16)
                sums[segment] = sums.get(segment, 0) + own.astype(np.uint64)
        packed = [np.minimum(8 * np.log2(1 + x.astype(float)), 255).astype(np.uint8).tobytes() for x in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(packed, pa.binary())], names=["segment", "cells"])

    kind = "segment int, cells binary"
    counted = source.mapInArrow(count, kind).repartition(SEGMENTS, "segment").mapInArrow(add, kind)
    rows = {r["segment"]: r["cells"] for r in counted.collect()}  # SEGMENTS rows of CELLS bytes in all
    empty = bytes(CELLS // SEGMENTS)
    return np.frombuffer(b"".join(rows.get(k, empty) for k in range(SEGMENTS)), np.uint8)


def _described(source: DataFrame, priority: np.ndarray, n: int, percent: int) -> DataFrame:
    """(id, size, signature, common, prefix): 48 bits of each prefix shingle."""
    shared = source.sparkSession.sparkContext.broadcast(priority)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            size, sign, common, prefix = [], [], [], []
            for _, own in _sets(batch, 1, n):
                rank = table[(own >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
                size.append(len(own))
                sign.append(_signature(own))
                common.append(float(rank.mean()) if len(own) else 0.0)
                length = len(own) - _needed(len(own), percent) + 1 if len(own) else 0
                chosen = own[np.lexsort((own, rank))[:length]] if length else own
                prefix.append((chosen >> np.uint64(16)).view(np.uint8).reshape(-1, 8)[:, :6].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(sign, pa.binary()), pa.array(common, pa.float64()), pa.array(prefix, pa.binary())],
                names=["id", "size", "signature", "common", "prefix"],
            )

    return source.mapInArrow(run, "id long, size long, signature binary, common double, prefix binary")


def _postings(described: DataFrame) -> DataFrame:
    """(token, id): prefix shingles that at least two rows have."""
    buckets = spread(described, "bucket")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            data, ends = utf8_of(batch.column(1))
            raw = np.zeros((len(data) // 6, 8), np.uint8)
            raw[:, :6] = data.reshape(-1, 6)
            token = raw.reshape(-1).view(np.int64)
            owner = np.repeat(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64), np.diff(ends) // 6)
            order = np.argsort(token, kind="stable")
            token, owner = token[order], owner[order]
            edges = np.searchsorted(token, [((k << 48) + buckets - 1) // buckets for k in range(buckets + 1)])
            rows = [
                (k, press.compress(np.diff(token[a:b], prepend=0).tobytes()), press.compress(owner[a:b].tobytes()))
                for k, (a, b) in enumerate(zip(edges.tolist(), edges[1:].tolist(), strict=False))
                if b > a
            ]
            if rows:
                k, t, o = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(t, pa.binary()), pa.array(o, pa.binary())], names=["bucket", "tokens", "ids"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Keep the first document of each token; let out what a second one meets. Memory follows the tokens, not the postings."""
        press = zstandard.ZstdDecompressor()
        seen, first, told = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merge() -> Iterator[pa.RecordBatch]:
            nonlocal seen, first, told, held
            token = np.concatenate([seen, *(t for t, _ in held)])
            owner = np.concatenate([first, *(o for _, o in held)])
            old = len(seen)
            order = np.argsort(token, kind="stable")
            own = token[order]
            new = np.ones(len(own), bool)
            new[1:] = own[1:] != own[:-1]
            number = np.cumsum(new) - 1
            several = np.bincount(number) > 1
            was_told = np.zeros(len(own), bool)
            was_told[: old] = told
            out = several[number] & ~was_told[order]
            told_now = several | (np.bincount(number, was_told[order]) > 0)
            seen, first, told, held = own[new], owner[order][new], told_now, []
            for a in range(0, int(out.sum()), 100_000):
                at = np.flatnonzero(out)[a : a + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(own[at]), pa.array(owner[order][at])], names=["token", "id"])

        size = 0
        for batch in batches:
            for t, o in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                token = np.cumsum(np.frombuffer(press.decompress(t), np.int64))
                held.append((token, np.frombuffer(press.decompress(o), np.int64)))
                size += len(token)
                if size > max(HELD, len(seen) // 2):
                    yield from merge()
                    size = 0
        if held:
            yield from merge()

    sent = described.select("id", "prefix").mapInArrow(send, "bucket int, tokens binary, ids binary")
    return sent.repartition(buckets, "bucket").mapInArrow(meet, "token long, id long")


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for the ends of the edges (a, b): large-star and small-star contraction, least id first."""
    edges = cut(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        edges = cut(small.where("a != b").distinct())
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state:
            return edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.col("m").alias("component"))
        state = now


def _links(asked: DataFrame, members: DataFrame, sets: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """(a, b): links between documents that ask groups and members of the groups; both are (group, id, component).

    The documents that ask a group are split into parts of about ``ASKERS``; each part has the group's members.
    Documents of the same component are not compared.
    """
    parts, one = _parted(asked)
    one = one.withColumn("member", F.lit(False))
    part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    two = members.join(parts, "group").select("group", part, "id", "component", F.lit(True).alias("member"))
    wanted = cut(one.unionByName(two))
    rows = sets(wanted.select("id")).join(short(wanted), "id")

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        inside = rows[rows["member"]]
        held = [np.frombuffer(x, np.uint64) for x in inside["shingles"]]
        union = np.unique(np.concatenate(held)) if held else np.zeros(0, np.uint64)
        own_of, found = list(zip(inside["id"], inside["component"], held, strict=True)), []
        asking = rows[~rows["member"]]
        for i, component, raw in zip(asking["id"], asking["component"], asking["shingles"], strict=True):
            own = np.frombuffer(raw, np.uint64)
            at = np.minimum(np.searchsorted(union, own), max(0, len(union) - 1))
            shared = own[union[at] == own] if len(union) else own[:0]
            if len(shared) < _needed(len(own), percent):
                continue  # the bound: no member shares more with it than the union does
            for j, other_component, other in own_of:
                if component == other_component or min(len(own), len(other)) * 100 < percent * max(len(own), len(other)):
                    continue
                at = np.minimum(np.searchsorted(other, shared), len(other) - 1)
                both = int((other[at] == shared).sum())
                if 100 * both >= percent * (len(own) + len(other) - both):
                    found.append((i, j))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return rows.groupBy("group", "part").applyInPandas(run, "a long, b long")


def _parted(asked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(group, parts), and the documents that ask with their part: parts of about ``ASKERS`` by hash."""
    parts = asked.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / ASKERS).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("id"), "parts").cast("int").alias("part")
    return parts, asked.join(parts, "group").select("group", part, "id", "component")


def _unions(members: DataFrame, halves: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(group, union): the written unions of the shingles of each group's members, half a hash each."""

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        every = np.unique(np.concatenate([np.frombuffer(x, np.uint32) for x in rows["shingles"]]))
        return pd.DataFrame({"group": rows["group"].iloc[:1], "union": [every.tobytes()]})

    rows = halves(members.select("id")).join(short(members.select("group", "id")), "id").select("group", "shingles")
    return cut(rows.groupBy("group").applyInPandas(join, "group long, union binary"))


def _qualifying(asked: DataFrame, unions: DataFrame, halves: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """The rows of ``asked`` whose document shares enough with the union of the group that it asks. Equal halves only raise the bound."""
    parts, one = _parted(asked)
    one = cut(one)
    askers = halves(one.select("id")).join(short(one), "id").select("group", "part", "id", "component", "shingles")
    part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    stored = unions.join(parts, "group").select("group", part, "union")

    def bound(rows: pd.DataFrame, group: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(group):
            return rows[["group", "id", "component"]].iloc[:0]
        union = np.frombuffer(group["union"].iloc[0], np.uint32)
        keep = []
        for raw in rows["shingles"]:
            own = np.frombuffer(raw, np.uint32)
            at = np.minimum(np.searchsorted(union, own), len(union) - 1)
            keep.append(int((union[at] == own).sum()) >= _needed(len(own), percent))
        return rows.loc[keep, ["group", "id", "component"]]

    both = askers.groupBy("group", "part").cogroup(stored.groupBy("group", "part"))
    return both.applyInPandas(bound, "group long, id long, component long")


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of each row of ``docs``."""
    source = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    described = cut(_described(source, _sketch(source, n), n, percent))
    full = described.where("size > 0 AND id IS NOT NULL")
    classes = cut(full.groupBy("signature").agg(F.min("id").alias("class")))
    copies = full.select("id", "signature").join(classes, "signature").where("id <> class")
    alone = without(full.select("id", "prefix"), copies, "id")
    postings = cut(_postings(alone))
    sizes = full.groupBy("id").agg(F.max("size").alias("size"), F.max("common").alias("common"))
    sizes = cut(sizes.join(postings.select("id").distinct(), "id"))

    def sets(ids: DataFrame, half: bool = False) -> DataFrame:
        """(id, shingles) of some documents, whole hashes or their upper halves. They are made anew for each use: that costs a pass, but no disk."""

        def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = [(i, ((x >> np.uint64(32)).astype(np.uint32) if half else x).tobytes()) for i, x in _sets(batch, 1, n)]
                for a in range(0, len(own), 500):
                    part = own[a : a + 500]
                    names = batch.column(0).take(pa.array([i for i, _ in part], pa.int64()))
                    yield pa.RecordBatch.from_arrays([names, pa.array([x for _, x in part], pa.binary())], names=["id", "shingles"])

        return source.join(listed(ids.distinct()), "id", "left_semi").mapInArrow(whole, "id long, shingles binary")

    # Hubs: per token, then the best one per document.
    placed = postings.join(short(sizes), "id")
    rank = F.struct("common", (-F.col("id")).alias("back"), "size")
    hubs = placed.groupBy("token").agg(F.max(rank).alias("hub"))
    near = placed.join(hubs, "token").where("id != -hub.back").where(
        F.least("size", "hub.size") * 100 >= percent * F.greatest("size", "hub.size")
    )
    anchors = cut(near.groupBy("id").agg((-F.max(F.struct("hub.common", "hub.back"))["back"]).alias("anchor")))
    asked = anchors.select(F.col("anchor").alias("group"), "id", F.col("id").alias("component"))
    members = anchors.select(F.col("anchor").alias("group"), F.col("anchor").alias("id"), F.col("anchor").alias("component")).distinct()
    first = cut(_links(asked, members, sets, percent))
    known = cut(components(first))

    # Groups: documents near the same hub, those of its component apart from the others.
    component = F.coalesce("component", "id").alias("component")
    placed_docs = sizes.join(known, "id", "left").join(anchors, "id", "left")
    placed_docs = placed_docs.select("id", "size", component, F.coalesce("anchor", "id").alias("anchor"))
    hub_component = known.select(F.col("id").alias("anchor"), F.col("component").alias("of_anchor"))
    placed_docs = cut(
        placed_docs.join(hub_component, "anchor", "left").withColumn(
            "inside", F.col("component") == F.coalesce("of_anchor", "anchor")
        )
    )
    crowd = placed_docs.groupBy("anchor", "inside").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("groups"))
    number = F.xxhash64("anchor", "inside", F.pmod(F.xxhash64("id"), "groups")).alias("group")
    grouped = cut(placed_docs.join(crowd, ["anchor", "inside"]).select("id", "size", "component", number))
    bounds = grouped.groupBy("group").agg(
        F.min("size").alias("least"), F.max("size").alias("most"), F.min("component").alias("low"), F.max("component").alias("high")
    )

    # The token-group matrix. Tokens held by the same groups are one column of it.
    cells = postings.join(short(grouped.select("id", "component", "group")), "id")
    cells = cells.groupBy("token", "group").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    mark = lambda seed: F.sum(F.xxhash64("group", F.lit(seed)).cast("decimal(20,0)"))
    held = cells.groupBy("token").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.count(F.lit(1)).alias("groups"), mark(1).alias("m1"), mark(2).alias("m2"))
    held = cut(held.where("low < high").drop("low", "high"))
    column = held.groupBy("groups", "m1", "m2").agg(F.min("token").alias("column"))
    columns = cut(held.join(column, ["groups", "m1", "m2"]).select("token", "column"))
    matrix = cells.withColumnRenamed("token", "column").join(columns.select("column").distinct(), "column", "left_semi")
    matrix = matrix.select("column", "group")
    asking = postings.join(columns, "token").select("column", "id").distinct().join(short(grouped), "id")
    asked = (
        asking.withColumnRenamed("group", "own_group")
        .join(matrix.join(bounds, "group"), "column")
        .where("own_group <= group AND NOT (low = component AND high = component)")
        .where((F.col("size") * 100 >= percent * F.col("least")) & (F.col("most") * 100 >= percent * F.col("size")))
        .select("group", "id", "component")
        .distinct()
    )
    asked = cut(asked)
    halves = lambda ids: sets(ids, half=True)
    inside = lambda groups: grouped.join(groups.select("group").distinct(), "group", "left_semi").select("group", "id", "component")
    passed = cut(_qualifying(asked, _unions(cut(inside(asked)), halves), halves, percent))
    second = cut(_links(passed, inside(passed), sets, percent))
    final = components(first.unionByName(second))

    named = described.select("id", "size", "signature").join(classes, "signature", "left")
    named = named.withColumn("class", F.when(F.col("size") > 0, F.col("class")))
    joined = named.join(final.withColumnRenamed("id", "class"), "class", "left")
    return joined.select(
        F.col("id").alias(id_column),
        F.col("size").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "class", "id")).alias("component_id"),
    )
