"""Ranked lexical search over posting lists cut into geometric blocks, exact.

Documents are dealt into shards; a shard keeps, for each term that the queries of a block ask for, its posting list cut into blocks of similar
documents, and for each block a summary: the coordinatewise maximum of the term parts of its documents. What a document's term adds to a
score is an integer (``part`` below times the term's weight), so the product of a summary with a query bounds the score of every
document of the block exactly. A block is skipped only when that bound lies below the tenth-best score known; everything else is scored in full.

1. *Terms.* One pass over the texts writes a narrow row for each document: its length in terms and its counts of the asked terms.
   N, L and the document frequencies are sums over these rows, so they cover all documents.
2. *Shards.* Rows are dealt by ranges of a similarity key (signs of random projections of the term vector), with the id as the second
   key, so that a shard holds similar documents and a family of copies spreads over as many shards as it needs.
3. *Blocks.* Terms are in order of frequency. A document that a query should find is sought in the list of its rarest asked term, so the summary
   of a list's block needs only the terms up to the list's own, and of these only the ones that share a query with it. Inside a shard each posting list is clustered: evenly spread members are centres, each member goes to the centre with the largest
   inner product of projected vectors, and clusters beyond twice the intended size are cut. The index is a written table, a row per shard.
4. *First pass:* in each shard a query scores its most promising blocks; the best scores of all shards together give each query a floor.
5. *Second pass:* with the floors, shards score what their bounds cannot exclude. Each task keeps the best ``k`` of each query; these meet in a window.

Queries are taken in blocks of at most ``TERMS`` distinct terms (or one query that has more), which bounds what is broadcast and the width of summaries;
each block is a pass over all documents. Nothing else depends on the number of queries.

Null texts have no terms and count neither in N nor in L; rows that repeat an id are documents of their own with the same id; a null id comes
last among equal scores; rows of queries that repeat an id are one query with all their terms; a query without terms has no rows; empty tables
give an empty result; texts are taken whole; other columns are ignored. Ids of documents must be integers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import cut, pieces, utf8_of
from barloom.session import materialize

#: Distinct terms of a block of queries.
TERMS = 1 << 14
#: Documents of a shard at most, and cells (documents times terms) of its dense matrix.
SHARD, CELLS = 4096, 1 << 24
#: Documents of a block, as intended.
BLOCK = 48
#: Random directions for clustering; the first ``SIGNS`` make the similarity key of a document.
DIRECTIONS, SIGNS = 32, 12
#: A query of more terms gets summaries over all more frequent terms, as a list of its pairs of terms would be long.
WIDE = 2048
#: Blocks that a query scores in each shard before floors are known.
FIRST_BLOCKS = 2
#: Fixed values of the scoring function: scale, share of the length in per cent, weight of a document's length.
SCALE, FIXED_SHARE, LENGTH_SHARE, STRETCH = 1_000_000_000, 10, 90, 8
_SEPARATORS = {*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)}
_TERMS_ONLY = bytes(0x20 if b in _SEPARATORS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_NO_ID = np.iinfo(np.int64).max


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, A-Z lower-cased, with repeats."""
    return text.translate(_TERMS_ONLY).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def parts(tf: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term adds to the score of a document of ``length`` terms, before its weight."""
    stretched = FIXED_SHARE + LENGTH_SHARE * length.astype(np.int64) * n_docs // max(1, n_terms)
    return SCALE * tf.astype(np.int64) // (1000 * tf.astype(np.int64) + STRETCH * stretched)


def directions(n_terms: int) -> np.ndarray:
    """A random direction for each of ``DIRECTIONS`` coordinates; the same for every task."""
    return np.random.default_rng(13).standard_normal((n_terms, DIRECTIONS)).astype(np.float32)


def term_rows(docs: DataFrame, vocabulary: list[bytes], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, length, near, terms, counts): length in terms, similarity key, and the asked terms of each document with their counts."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # at most TERMS strings, or one query's

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: k for k, t in enumerate(shared.value)}
        axes = directions(len(number))[:, :SIGNS]
        for batch in batches:
            data, ends = utf8_of(batch.column(1))
            for a, b in pieces(np.diff(ends).tolist()):
                lengths, near, terms, counts = [], [], [], []
                for i in range(a, b):
                    found = terms_of(data[ends[i] : ends[i + 1]].tobytes())
                    own = sorted((number[t], n) for t, n in Counter(found).items() if t in number)
                    at = np.array([t for t, _ in own], np.int32)
                    lengths.append(len(found))
                    signs = axes[at].sum(axis=0) > 0
                    near.append(int(signs @ (1 << np.arange(SIGNS))) if len(at) else -1)
                    terms.append(at)
                    counts.append(np.array([n for _, n in own], np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(lengths, pa.int64()), pa.array(near, pa.int32()), _lists(terms), _lists(counts)],
                    names=["id", "length", "near", "terms", "counts"],
                )

    source = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    return source.mapInArrow(run, "id long, length long, near int, terms array<int>, counts array<int>")


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int32)))


def _flat(column: pa.Array, kind=np.int64) -> tuple[np.ndarray, np.ndarray]:
    """(values of a list column, ends of its rows)."""
    ends = np.asarray(column.offsets).astype(np.int64)
    return np.asarray(column.values)[ends[0] : ends[-1]].astype(kind), ends - ends[0]


def cluster(sketch: np.ndarray, size: int) -> np.ndarray:
    """Order of the rows of ``sketch`` by cluster, and where blocks start: (order, starts with the end)."""
    n = len(sketch)
    if n <= size:
        return np.arange(n), np.array([0, n])
    centres = sketch[np.linspace(0, n - 1, -(-n // size)).astype(np.int64)]
    of = (sketch @ centres.T).argmax(axis=1)
    order = np.argsort(of, kind="stable")
    first = np.flatnonzero(np.diff(of[order], prepend=-1))
    starts = [np.arange(a, b, 2 * size) for a, b in zip(first, [*first[1:], n], strict=True)]
    return order, np.append(np.concatenate(starts), n)


def companions(queries: list[np.ndarray], n_terms: int) -> list[np.ndarray | None]:
    """For each term the terms up to itself that share a query with it; None for all of them, where a query is very long."""
    held: list[set[int] | None] = [set() for _ in range(n_terms)]
    for terms in queries:
        own = terms.tolist()
        for k, t in enumerate(own):
            if len(own) > WIDE:
                held[t] = None
            elif held[t] is not None:
                held[t].update(own[: k + 1])
    return [None if x is None else np.array(sorted(x), np.int64) for x in held]


def _shard_columns(ids: np.ndarray, ends: np.ndarray, term: np.ndarray, part: np.ndarray, wanted: list[np.ndarray | None], size: int) -> dict[str, np.ndarray]:
    """The index of one shard: documents with their terms and parts, posting lists, blocks and summaries, each as values and ends."""
    n = len(ids)
    owner = np.repeat(np.arange(n), np.diff(ends))
    dense = np.zeros((n, len(wanted)), np.int32)
    dense[owner, term] = part
    axes = directions(len(wanted))
    sketch = np.add.reduceat(axes[term] * part[:, None].astype(np.float32), ends[:-1])  # every document has a term
    sketch /= np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-9)
    order = np.argsort(term, kind="stable")
    lists = np.searchsorted(term[order], np.arange(len(wanted) + 1))
    block_terms, sizes, members, coords, most, held = [], [], [], [], [], []
    for t in np.flatnonzero(np.diff(lists)).tolist():
        inside = owner[order[lists[t] : lists[t + 1]]]
        at, starts = cluster(sketch[inside], size)
        inside = inside[at]
        beside = wanted[t] if wanted[t] is not None else np.arange(t + 1)
        peaks = np.maximum.reduceat(dense[np.ix_(inside, beside)], starts[:-1], axis=0)
        row, column = np.nonzero(peaks)
        block_terms.append(np.full(len(peaks), t))
        sizes.append(np.diff(starts))
        members.append(inside)
        coords.append(beside[column])
        most.append(peaks[row, column])
        held.append(np.bincount(row, minlength=len(peaks)))
    joined = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    summed = lambda x: np.concatenate([[0], np.cumsum(joined(x))])
    return {
        "ids": ids, "doc_ends": ends, "doc_terms": term, "doc_parts": part, "block_terms": joined(block_terms), "block_ends": summed(sizes),
        "block_docs": joined(members), "summary_ends": summed(held), "summary_terms": joined(coords), "summary_most": joined(most),
    }


INDEX = ["ids", "doc_ends", "doc_terms", "doc_parts", "block_terms", "block_ends", "block_docs", "summary_ends", "summary_terms", "summary_most"]


def build_index(
    rows: DataFrame, rank: np.ndarray, wanted: list[np.ndarray | None], n_docs: int, all_terms: int, block: int = BLOCK, shard: int = SHARD
) -> DataFrame:
    """A written table with a row for each shard.

    ``rows`` is a written result of ``term_rows``; ``rank`` gives the place of each of its terms, the most frequent first; ``wanted`` are the
    ``companions`` by place; the numbers are N and L of the corpus.
    """
    n_terms = len(rank)
    shared = rows.sparkSession.sparkContext.broadcast((rank, wanted))  # one block of queries
    most = max(1, min(shard, CELLS // max(1, n_terms)))
    held = rows.where(F.size("terms") > 0)
    count = max(1, -(-held.count() // most))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, wanted = shared.value
        waiting: list[tuple] = []
        have = 0

        def shard_of() -> pa.RecordBatch:
            ids, lengths, terms, counts, sizes = (np.concatenate(x) for x in zip(*waiting, strict=True))
            part = parts(counts, np.repeat(lengths, sizes), n_docs, all_terms)
            columns = _shard_columns(ids, np.concatenate([[0], np.cumsum(sizes)]), rank[terms], part, wanted, block)
            return pa.RecordBatch.from_arrays([pa.array([columns[c].astype(np.int64 if c == "ids" else np.int32)]) for c in INDEX], names=INDEX)

        for batch in batches:
            for a in range(0, batch.num_rows, most):
                piece = batch.slice(a, most)
                if waiting and have + piece.num_rows > most:
                    yield shard_of()
                    waiting, have = [], 0
                terms, ends = _flat(piece.column(2))
                counts, _ = _flat(piece.column(3))
                ids = np.asarray(piece.column(0).fill_null(_NO_ID))
                waiting.append((ids, np.asarray(piece.column(1)), terms, counts, np.diff(ends)))
                have += piece.num_rows
        if waiting:
            yield shard_of()

    dealt = held.repartitionByRange(count, "near", "id").sortWithinPartitions("near", "id").select("id", "length", "terms", "counts")
    kind = ", ".join(f"{c} array<{'long' if c == 'ids' else 'int'}>" for c in INDEX)
    return materialize(dealt.mapInArrow(build, kind))


class Shard:
    """One row of the index, ready to be searched."""

    def __init__(self, row: dict[str, np.ndarray]):
        self.__dict__.update(row)
        self.of_term = np.searchsorted(self.block_terms, np.arange((self.block_terms[-1] if len(self.block_terms) else -1) + 2))

    def blocks(self, terms: np.ndarray) -> np.ndarray:
        """Blocks of the posting lists of some terms."""
        terms = terms[terms < len(self.of_term) - 1]
        return _ranges(self.of_term[terms], self.of_term[terms + 1])

    def bounds(self, blocks: np.ndarray, weights: np.ndarray) -> np.ndarray:
        return _sums(self.summary_ends, blocks, self.summary_terms, self.summary_most, weights)

    def scores(self, docs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        return _sums(self.doc_ends, docs, self.doc_terms, self.doc_parts, weights)

    def members(self, blocks: np.ndarray) -> np.ndarray:
        return np.unique(self.block_docs[_ranges(self.block_ends[blocks], self.block_ends[blocks + 1])])


def _ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All numbers from each ``first`` up to its ``last``, in turn."""
    sizes = last - first
    total = int(sizes.sum())
    return np.arange(total) + np.repeat(first - np.cumsum(sizes) + sizes, sizes) if total else np.zeros(0, np.int64)


def _sums(ends: np.ndarray, rows: np.ndarray, term: np.ndarray, value: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Product of some sparse rows with the weights of the terms, in 64-bit integers."""
    first, last = ends[rows], ends[rows + 1]
    at = _ranges(first, last)
    sums = np.concatenate([[0], np.cumsum(weights[term[at]] * value[at])])
    edges = np.concatenate([[0], np.cumsum(last - first)])
    return sums[edges[1:]] - sums[edges[:-1]]


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def search(index: DataFrame, queries: list[np.ndarray], weights: np.ndarray, k: int, floors: list[int] | None, first_blocks: int = FIRST_BLOCKS) -> DataFrame:
    """(query, id, score): of each task the best ``k`` documents of each query (a number into ``queries``).

    Without ``floors`` only the most promising blocks of each shard are scored, which gives true scores of some documents. With them
    (scores that ``k`` documents are known to reach, 0 where unknown) the result is complete.
    """
    shared = index.sparkSession.sparkContext.broadcast((queries, weights, floors))  # one block of queries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights, floors = shared.value
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in queries]
        own = np.zeros(len(weights), np.int64)
        for batch in batches:
            for r in range(batch.num_rows):
                shard = Shard({c: _flat(batch.column(j).slice(r, 1))[0] for j, c in enumerate(INDEX)})
                for q, terms in enumerate(queries):
                    own[terms] = weights[terms]
                    blocks = shard.blocks(terms)
                    if len(blocks):
                        bounds = shard.bounds(blocks, own)
                        ids, scores = found[q]
                        least = max(1, floors[q] if floors else 1, int(scores[-1]) if len(scores) == k else 1)
                        keep = bounds >= least
                        if floors is None:
                            keep &= bounds >= np.partition(bounds, -min(first_blocks, len(bounds)))[-min(first_blocks, len(bounds))]
                        docs = shard.members(blocks[keep])
                        if len(docs):
                            new = shard.scores(docs, own)
                            docs, new = docs[new >= least], new[new >= least]
                            found[q] = _best(np.concatenate([ids, shard.ids[docs]]), np.concatenate([scores, new]), k)
                    own[terms] = 0
        rows = [(q, i, s) for q, (ids, scores) in enumerate(found) for i, s in zip(ids.tolist(), scores.tolist(), strict=True)]
        if rows:
            q, i, s = zip(*rows, strict=True)
            names = pa.array([None if x == _NO_ID else x for x in i], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), names, pa.array(s, pa.int64())], names=["query", "id", "score"])

    return index.mapInArrow(run, "query int, id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _query_blocks(items: DataFrame, item_column: str, text_column: str, most: int) -> Iterator[list[tuple[object, list[bytes]]]]:
    """Queries with their terms, in blocks of at most ``most`` terms (or one query)."""
    terms = F.split(F.translate(F.coalesce(F.col(text_column), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
    found = items.select(F.col(item_column).alias("item"), terms.alias("terms")).groupBy("item")
    found = found.agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("terms")))).alias("terms"))
    block, size = [], 0
    for row in found.orderBy("item").toLocalIterator():  # one block of queries at a time
        own = [t.encode("utf-8") for t in row["terms"] if t]
        if block and size + len(own) > most:
            yield block
            block, size = [], 0
        if own:
            block.append((row["item"], own))
            size += len(own)
    if block:
        yield block


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    block: int = BLOCK,
    shard: int = SHARD,
    terms: int = TERMS,
) -> DataFrame:
    """(item, rank, id, score): the ``k`` best documents of each item with a score above 0, equal scores by ascending id."""
    spark = docs.sparkSession
    kind = items.schema[item_column].dataType
    out = spark.createDataFrame([], "query int, id long, score long, rank int").withColumn("item", F.lit(None).cast(kind))
    out = out.select(F.col("item").alias(item_column), "rank", F.col("id").alias(id_column), "score")
    for asked in _query_blocks(items, item_column, item_text_column, terms):
        vocabulary = sorted({t for _, own in asked for t in own})
        number = {t: n for n, t in enumerate(vocabulary)}
        rows = materialize(term_rows(docs, vocabulary, id_column, text_column))
        total = rows.agg(F.count(F.when(F.col("length") > 0, 1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("l")).first()
        frequency = rows.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # a row for each asked term
        df = {r["term"]: r["count"] for r in frequency}
        common = sorted(range(len(vocabulary)), key=lambda t: (-df.get(t, 0), t))
        weights = np.array([weight(total["n"], df.get(t, 0)) for t in common], np.int64)
        rank = np.argsort(np.array(common, np.int64))
        queries = [np.sort(rank[[number[t] for t in own]]) for _, own in asked]
        index = build_index(rows, rank, companions(queries, len(vocabulary)), total["n"], total["l"], block, shard)
        first = _ranked(search(index, queries, weights, k, None), k).groupBy("query").agg(F.min("score").alias("score"), F.count(F.lit(1)).alias("n"))
        floors = [0] * len(queries)
        for r in first.collect():  # a row for each query of the block
            if r["n"] == k:
                floors[r["query"]] = r["score"]
        best = cut(_ranked(search(index, queries, weights, k, floors), k))
        names = spark.createDataFrame([(q, item) for q, (item, _) in enumerate(asked)], items.select(F.lit(0).alias("query"), F.col(item_column).alias("item")).schema)
        best = best.join(F.broadcast(names), "query")  # one block of queries
        out = out.unionByName(best.select(F.col("item").alias(item_column), "rank", F.col("id").alias(id_column), "score"))
    return out
