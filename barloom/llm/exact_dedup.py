"""Exact duplicates by a cuckoo-filter index of live digests.

A text is equal to another when both agree after deleting ASCII white space; its digest is the SHA-256 of what
is left. Digests are dealt over index partitions by their hash. Each partition holds a cuckoo filter: two
candidate buckets for a digest, four places each, with a short fingerprint and the whole stored key per place.
A lookup compares fingerprints; a hit is verified against the keys of the two buckets. Keys can be deleted again;
when an insertion finds no place after ``KICKS`` moves, the table doubles and is rebuilt from the stored keys.

Before digests are shuffled, each Arrow batch merges its own copies, so a group that holds a third of all rows sends a row per
batch to its partition and not a row per document. Joining the answer back is a plain join, which adaptive execution
splits where a digest is hot.

A null text is empty, and all empty texts are equal. Of equal texts the one with the most code points in the original
stays, then the least id; a null id comes last. Rows that repeat an id and a text are one document: they share
their answer and all count in ``group_size``. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import cut, spread, utf8_of

BLANKS = bytes([0x20, *range(0x09, 0x0E)])
PLACES = 4
KICKS = 200


class CuckooIndex:
    """Keys (digests) with a value each; lookups go through fingerprints first."""

    def __init__(self, buckets: int = 64):
        self._empty(buckets)

    def _empty(self, buckets: int) -> None:
        self.buckets = buckets  # a power of two
        self.prints = [[0] * PLACES for _ in range(buckets)]
        self.keys: list[list] = [[None] * PLACES for _ in range(buckets)]
        self.size = 0

    def _homes(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[:2], "big") or 1
        one = int.from_bytes(digest[2:10], "big") & (self.buckets - 1)
        return mark, one, self._other(one, mark)

    def _other(self, home: int, mark: int) -> int:
        return home ^ ((mark * 0x5BD1E995) & (self.buckets - 1))

    def find(self, digest: bytes) -> list | None:
        """The stored [digest, value], or None. Fingerprints decide most misses; a hit is verified by its key."""
        mark, one, two = self._homes(digest)
        for home in (one, two):
            marks = self.prints[home]
            if mark in marks:
                for place in range(PLACES):
                    if marks[place] == mark and self.keys[home][place][0] == digest:
                        return self.keys[home][place]
        return None

    def insert(self, digest: bytes, value) -> None:
        """Add a key that is not in the index yet."""
        entry = [digest, value]
        while (homeless := self._place(entry)) is not None:
            entry = homeless
            self._grow()
        self.size += 1

    def _place(self, entry: list) -> list | None:
        mark, home, two = self._homes(entry[0])
        for b in (home, two):
            if 0 in self.prints[b]:
                place = self.prints[b].index(0)
                self.prints[b][place], self.keys[b][place] = mark, entry
                return None
        for kick in range(KICKS):
            place = (kick * 7 + mark) % PLACES
            self.prints[home][place], mark = mark, self.prints[home][place]
            self.keys[home][place], entry = entry, self.keys[home][place]
            home = self._other(home, mark)
            if 0 in self.prints[home]:
                place = self.prints[home].index(0)
                self.prints[home][place], self.keys[home][place] = mark, entry
                return None
        return entry

    def _grow(self) -> None:
        stored, size = list(self.entries()), self.size
        buckets = self.buckets
        while True:
            buckets *= 2
            self._empty(buckets)
            if all(self._place(entry) is None for entry in stored):
                self.size = size
                return

    def delete(self, digest: bytes) -> bool:
        mark, one, two = self._homes(digest)
        for home in (one, two):
            for place in range(PLACES):
                if self.prints[home][place] == mark and self.keys[home][place][0] == digest:
                    self.prints[home][place], self.keys[home][place] = 0, None
                    self.size -= 1
                    return True
        return False

    def entries(self) -> Iterator[list]:
        for row in self.keys:
            for entry in row:
                if entry is not None:
                    yield entry


def _better(a: tuple, b: tuple) -> tuple:
    """Of two (code points, id): more code points, then the least id, null last."""
    key = lambda x: (-x[0], x[1] is None, x[1])
    return a if key(a) <= key(b) else b


def digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, digest binary, n_points long) of each row."""
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = utf8_of(batch.column(1))
            text = memoryview(data)
            cuts = ends.tolist()
            own = [
                hashlib.sha256(bytes(text[a:b]).translate(None, BLANKS)).digest()
                for a, b in zip(cuts, cuts[1:], strict=False)
            ]
            points = pc.fill_null(pc.utf8_length(batch.column(1)), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(own, pa.binary()), points], names=["id", "digest", "n_points"]
            )

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, digest binary, n_points long")


def _merged_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Copies inside a batch become one row: (digest, id and code points of the best, rows)."""
    for batch in batches:
        best: dict[bytes, tuple] = {}
        rows: dict[bytes, int] = {}
        for i, digest, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            best[digest] = _better(best[digest], (n, i)) if digest in best else (n, i)
            rows[digest] = rows.get(digest, 0) + 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(best), pa.binary()),
                pa.array([b[1] for b in best.values()], batch.column(0).type),
                pa.array([b[0] for b in best.values()], pa.int64()),
                pa.array(list(rows.values()), pa.int64()),
            ],
            names=["digest", "id", "n_points", "rows"],
        )


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One index partition: insert what is new, merge what the index verifies as known."""
    index, kind = CuckooIndex(), None
    for batch in batches:
        kind = batch.column(1).type
        for digest, i, n, rows in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            entry = index.find(digest)
            if entry is None:
                index.insert(digest, (n, i, rows))
            else:
                n_old, i_old, rows_old = entry[1]
                entry[1] = (*_better((n_old, i_old), (n, i)), rows_old + rows)
    out = list(index.entries())
    for a in range(0, len(out), 10_000):
        part = out[a : a + 10_000]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([d for d, _ in part], pa.binary()),
                pa.array([v[1] for _, v in part], kind),
                pa.array([v[2] for _, v in part], pa.int64()),
            ],
            names=["digest", "keep_id", "group_size"],
        )


def groups(digested: DataFrame) -> DataFrame:
    """(digest, keep_id, group_size): one row for each distinct text."""
    kind = digested.schema["id"].dataType.simpleString()
    partial = digested.select("id", "digest", "n_points").mapInArrow(
        _merged_rows, f"digest binary, id {kind}, n_points long, rows long"
    )
    dealt = partial.repartition(spread(partial, "digest"), "digest")
    return dealt.mapInArrow(_indexed, f"digest binary, keep_id {kind}, group_size long")


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) for each row of ``docs``, dropped ones too."""
    own = cut(digests(docs, id_column, text_column))
    found = own.join(groups(own), "digest")
    return found.select(
        F.col("id").alias(id_column),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


# A stored index: one row for each partition, to be changed and asked over time.

_STORED = "part int, index binary"


def _part(parts: int):
    return F.pmod(F.xxhash64("digest"), F.lit(parts)).cast("int").alias("part")


def update_index(index: DataFrame | None, inserts: DataFrame, deletes: DataFrame | None, parts: int) -> DataFrame:
    """The index after deleting the digests of ``deletes`` and then inserting those of ``inserts`` (column ``digest``).

    ``index`` is None for a new one; ``parts`` must stay the same for the life of an index, and should keep a
    partition at some hundred thousand digests.
    """
    changes = inserts.select("digest", F.lit(True).alias("add")).distinct()
    if deletes is not None:
        changes = changes.unionByName(deletes.select("digest", F.lit(False).alias("add")).distinct())
    changes = changes.select(_part(parts), "digest", "add")
    old = index if index is not None else inserts.sparkSession.createDataFrame([], _STORED)

    def run(stored: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        own = pickle.loads(stored["index"].iloc[0]) if len(stored) else CuckooIndex()
        for add in (False, True):
            for digest in new.loc[new["add"] == add, "digest"]:
                known = own.find(digest) is not None
                if add and not known:
                    own.insert(digest, None)
                elif known and not add:
                    own.delete(digest)
        part = (stored if len(stored) else new)["part"].iloc[0]
        return pd.DataFrame({"part": [part], "index": [pickle.dumps(own)]})

    return old.groupBy("part").cogroup(changes.groupBy("part")).applyInPandas(run, _STORED)


def probe_index(index: DataFrame, digested: DataFrame, parts: int) -> DataFrame:
    """(digest, known) for the distinct digests of ``digested``."""
    asked = digested.select("digest").distinct().select(_part(parts), "digest")

    def run(stored: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        own = pickle.loads(stored["index"].iloc[0]) if len(stored) else CuckooIndex()
        return pd.DataFrame({"digest": new["digest"], "known": [own.find(d) is not None for d in new["digest"]]})

    return index.groupBy("part").cogroup(asked.groupBy("part")).applyInPandas(run, "digest binary, known boolean")
