"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of the test items are put into one suffix automaton. The words of each training text are
streamed through it, which gives for every word the length of the longest match that ends there. Where that reaches a
window (``window`` words of an item, or all words of a shorter item), the words of the window are hit. A text is
contaminated when its hit words reach the share ``1 / coverage`` of all its words; ``without_spans`` cuts hit
spans out of texts.

The automaton is broadcast. Its size is bounded: items are dealt over shards of about ``SHARD_WORDS`` words (a longer
item has a shard of its own), there is one pass over the texts for each shard, and hits of several shards are merged
by document. The benchmark tables seen so far need one shard.

A null text has no words and is clean; an item that is null or without words has no window; items with the same id
are one item; a null id of an item is written as the empty string. Repeated rows each get their result. Texts are taken whole.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import cut, utf8_of

SHARD_WORDS = 100_000
#: Lower-cases A-Z and turns each ASCII byte outside words into a space; bytes above 0x7F are parts of words.
NORMAL = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
_REPORT = "n_words long, n_hit long, items array<string>, spans array<struct<first:long,last:long>>, key binary"

_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


class Automaton:
    """Suffix automaton of many word sequences, with the windows that a match contains."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.word: dict[bytes, int] = {}
        for _, words in items:
            for w in words:
                self.word.setdefault(w, len(self.word))
        self.width = max(1, len(self.word))
        self.step: dict[int, int] = {}
        self.link, self.length = [-1], [0]
        out: list[list[int]] = [[]]  # words that lead on from each state, needed to copy states
        for _, words in items:
            last = 0
            for w in words:
                last = self._extend(last, self.word[w], out)
        # Strings move to copied states while the automaton grows, so windows are looked up at the end.
        full: dict[int, set[str]] = {}
        short: dict[int, set[tuple[int, str]]] = {}
        for name, words in items:
            if len(words) >= window:
                state, size = 0, 0
                for w in words:
                    state, size = self.advance(state, size, self.word[w])
                    if size >= window:
                        full.setdefault(self._holding(state, window), set()).add(name)
            elif words:
                state, size = 0, 0
                for w in words:
                    state, size = self.advance(state, size, self.word[w])
                short.setdefault(self._holding(state, len(words)), set()).add((len(words), name))
        self.least = min([window, *(len(w) for _, w in items if w)])
        order = sorted(range(len(self.link)), key=self.length.__getitem__)
        holder = [-1] * len(order)
        within: list[tuple[tuple[int, str], ...]] = [()] * len(order)
        for s in order[1:]:
            up = self.link[s]
            holder[s] = s if self.length[up] < window <= self.length[s] else holder[up]
            within[s] = within[up] + tuple(sorted(short.get(s, ())))
        self.holder = holder
        self.full = {s: tuple(sorted(v)) for s, v in full.items()}
        self.short = {s: c for s, c in enumerate(within) if c}

    def _extend(self, last: int, w: int, out: list[list[int]]) -> int:
        known = self.step.get(last * self.width + w)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._copy(last, w, known, out)
        new = self._state(self.length[last] + 1, out)
        p = last
        while p >= 0 and p * self.width + w not in self.step:
            self._set(p, w, new, out)
            p = self.link[p]
        if p < 0:
            self.link[new] = 0
        else:
            q = self.step[p * self.width + w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._copy(p, w, q, out)
        return new

    def _state(self, length: int, out: list[list[int]]) -> int:
        self.link.append(-1)
        self.length.append(length)
        out.append([])
        return len(self.link) - 1

    def _set(self, state: int, w: int, to: int, out: list[list[int]]) -> None:
        if state * self.width + w not in self.step:
            out[state].append(w)
        self.step[state * self.width + w] = to

    def _copy(self, p: int, w: int, q: int, out: list[list[int]]) -> int:
        """Split the strings of length ``length[p] + 1`` and less off state ``q``."""
        new = self._state(self.length[p] + 1, out)
        for x in out[q]:
            self._set(new, x, self.step[q * self.width + x], out)
        self.link[new] = self.link[q]
        self.link[q] = new
        while p >= 0 and self.step.get(p * self.width + w) == q:
            self.step[p * self.width + w] = new
            p = self.link[p]
        return new

    def _holding(self, state: int, size: int) -> int:
        """The state that holds the suffix of length ``size``."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def advance(self, state: int, size: int, w: int) -> tuple[int, int]:
        """State and length of the longest match after one more word."""
        step, width, link = self.step, self.width, self.link
        to = step.get(state * width + w)
        while to is None:
            state = link[state]
            if state < 0:
                return 0, 0
            size = self.length[state]
            to = step.get(state * width + w)
        return to, size + 1

    def match(self, words: list[bytes]) -> tuple[np.ndarray | None, set[str]]:
        """(which words are hit, items with a window that occurs); None where no word is."""
        ids = np.fromiter(map(self.word.get, words, repeat(-1)), np.int64, len(words))
        edge = np.flatnonzero(np.diff(np.concatenate([[False], ids >= 0, [False]])))
        starts, stops = edge[::2], edge[1::2]
        long = stops - starts >= self.least
        if not long.any():
            return None, set()
        cover, items = np.zeros(len(words) + 1, np.int64), set()
        window, holder, short, full = self.window, self.holder, self.short, self.full
        for a, b in zip(starts[long].tolist(), stops[long].tolist(), strict=True):
            state = size = 0
            for at, w in enumerate(ids[a:b].tolist(), a + 1):
                state, size = self.advance(state, size, w)
                if size >= window:
                    items.update(full[holder[state]])
                    cover[at - window] += 1
                    cover[at] -= 1
                for n, name in short.get(state, ()):
                    if n <= size:
                        items.add(name)
                        cover[at - n] += 1
                        cover[at] -= 1
        return (np.cumsum(cover[:-1]) > 0, items) if items else (None, items)


def _automata(items: DataFrame, window: int, id_column: str, text_column: str) -> Iterator[Automaton]:
    """Automata of the items with words, one at a time and each of bounded size."""
    source = items.select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), F.col(text_column).alias("text")
    ).where(F.col("text").isNotNull())
    shard, total, made = [], 0, 0
    for row in source.orderBy("id", "text").toLocalIterator():
        words = words_of(row.text.encode("utf-8"))
        if words and total and total + len(words) > SHARD_WORDS:
            yield Automaton(shard, window)
            shard, total, made = [], 0, made + 1
        if words:
            shard.append((row.id, words))
            total += len(words)
    if shard or not made:
        yield Automaton(shard, window)


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _scan(docs: DataFrame, automaton: Automaton) -> DataFrame:
    """(id, n_words, n_hit, items, spans of words, key) of each row against one shard."""
    kind = docs.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(automaton)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        names = ["id", "n_words", "n_hit", "items", "spans", "key"]
        span = pa.struct([("first", pa.int64()), ("last", pa.int64())])
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(span), pa.binary()]
        for batch in batches:
            data, ends = utf8_of(batch.column(1))
            text, rows = memoryview(data), []
            cuts = ends.tolist()
            for a, b in zip(cuts, cuts[1:], strict=False):
                whole = bytes(text[a:b])
                words = words_of(whole)
                hit, items = own.match(words)
                spans = []
                if hit is not None:
                    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]])))
                    spans = [{"first": x, "last": y - 1} for x, y in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]
                n_hit = 0 if hit is None else int(hit.sum())
                rows.append((len(words), n_hit, sorted(items), spans, hashlib.md5(whole).digest()))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True))], names=names
            )

    return docs.mapInArrow(run, f"id {kind}, {_REPORT}")


def _united(parts: list[DataFrame]) -> DataFrame:
    """Reports of several shards as one; a row that repeats comes out as often as it went in."""
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    merged = union.groupBy("id", "key").agg(
        F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        (F.count(F.lit(1)) / len(parts)).cast("int").alias("copies"),
    )
    kind = merged.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for r in rows:
                joined = _merge([(s["first"], s["last"]) for s in r["spans"]])
                r["spans"] = [{"first": a, "last": b} for a, b in joined]
                r["n_hit"] = sum(b - a + 1 for a, b in joined)
            table = pa.Table.from_pylist(rows, schema=batch.schema.append(pa.field("n_hit", pa.int64())))
            yield from table.to_batches()

    out = merged.mapInArrow(
        run,
        f"id {kind}, key binary, n_words long, items array<string>, "
        "spans array<struct<first:long,last:long>>, copies int, n_hit long",
    )
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("copy", "copies")


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = 13,
    coverage: int = 20,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
) -> DataFrame:
    """(id, n_words, n_hit, items, spans, contaminated) of each row of ``docs``.

    ``spans`` are the maximal runs of hit words (first, last); a row is contaminated when
    ``coverage * n_hit >= n_words`` and a word is hit.
    """
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    automata = _automata(items, window, item_column, text_column)
    report, more = _scan(source, next(automata)), next(automata, None)
    if more is not None:
        report = _united([cut(report), *(cut(_scan(source, a)) for a in chain([more], automata))])
    return report.select(
        F.col("id").alias(id_column),
        "n_words",
        "n_hit",
        "items",
        "spans",
        ((F.col("n_hit") > 0) & (coverage * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def without_spans(
    docs: DataFrame,
    items: DataFrame,
    window: int = 13,
    least: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(id, text): texts of ``docs`` without their hit spans of at least ``least`` words, from first to last letter."""
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    marks = "array<struct<first:long,last:long>>"
    out = source.withColumn("spans", F.array().cast(marks))
    # Every shard judges the text as it came in; the spans of all are cut in one go.
    for automaton in _automata(items, window, "item_id", "text"):
        shared = docs.sparkSession.sparkContext.broadcast(automaton)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
                spans = [_hit_spans(text, known, shared.value) for text, known in rows]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(spans, _SPANS)], names=["id", "text", "spans"]
                )

        out = out.mapInArrow(run, f"id {kind}, text string, spans {marks}")

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)
            kept = [_removed(text, spans, least) for text, spans in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.string())], names=["id", "text"])

    out = out.mapInArrow(removed, f"id {kind}, text string")
    return out.select(F.col("id").alias(id_column), F.col("text").alias(text_column))


def _hit_spans(text: str | None, known: list[dict], automaton: Automaton) -> list[dict]:
    """``known`` spans of hit words, with those that one more shard hits."""
    hit, _ = automaton.match(words_of((text or "").encode("utf-8")))
    if hit is None:
        return known
    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]])))
    own = zip(edge[::2].tolist(), (edge[1::2] - 1).tolist(), strict=True)
    merged = _merge([*((s["first"], s["last"]) for s in known), *own])
    return [{"first": a, "last": b} for a, b in merged]


def _removed(text: str | None, spans: list[dict], least: int) -> str | None:
    if not spans:
        return text
    whole = text.encode("utf-8")
    inside = np.frombuffer(whole.translate(NORMAL), np.uint8) != 0x20
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
    starts, stops = edge[::2], edge[1::2]
    out, at = [], 0
    for s in spans:
        if s["last"] - s["first"] + 1 >= least:
            out.append(whole[at : starts[s["first"]]])
            at = int(stops[s["last"]])
    return b"".join([*out, whole[at:]]).decode("utf-8")
