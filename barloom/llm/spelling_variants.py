"""Spelling variants: words that differ in one letter, found through PartEnum signatures of their letter multisets.

A word's letters are a binary vector: dimension (letter, k) is set when the word has the letter at least k times. One inserted
or deleted letter changes one dimension, a replaced letter two, so words that are near lie within Hamming distance 2
(and never at distance 0: words of the same letters are no candidates). The dimensions are dealt to ``PARTS`` parts; two vectors within distance 2
differ in two parts at most, so they agree on all others. A word has one signature for each choice of two parts to leave out, the hash
of what it holds in the rest: ``PARTS * (PARTS - 1) / 2`` exact signatures, whatever the corpus. Near words also share their
first or their last three letters (six letters less one edit leave three on one side), which is part of the key on which signatures meet.
The equi-join proposes pairs; the edit distance of the words themselves decides.

1. Each task counts words in a bounded table and sends partial sums; words that are too short or (after summing) too rare go.
2. Signatures of the words that remain meet by key. A key that many words share is a skewed join key, which adaptive execution splits;
   the join keeps only verified pairs, so nothing else leaves it.
3. A word's form is its near word of largest count, if that is ``ratio`` times its own; roots follow forms by pointer jumping, whose rounds are the
   logarithm of the logarithm of the largest count.

``noise`` takes a letter out of a share of the words of a document, by a hash of the document's id and the word: planted misspellings, always
the same ones. Null texts have no words; an empty table gives an empty result; long texts and long words are taken whole; repeated rows count as
often as they stand; a null id is an empty name in the hash; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import cut, pieces, utf8_of

#: Parts of the dimensions of a letter multiset.
PARTS = 6
#: Letters at either end of a word that are part of a key; near words of twice as many letters share one end.
END = 3
#: Distinct words that a task holds before it sends their counts.
HELD = 150_000
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_RUN = re.compile("[A-Za-zÀ-ÿ]+")


def runs(text: str) -> list[str]:
    """Maximal runs of letters, A-Z lower-cased."""
    return _RUN.findall(text.encode("utf-8").translate(_LOWER).decode("utf-8"))


def with_noise(name: str, word: str, noise: int) -> str:
    """The word, without one letter where ``noise`` divides the hash of the document's name and the word."""
    h = zlib.crc32(f"{name}:{word}".encode())
    if h % noise:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(docs: DataFrame, least: int, noise: int | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(word, n): how often each word of at least ``least`` letters occurs."""
    source = docs.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), F.col(text_column).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def sent() -> Iterator[pa.RecordBatch]:
            words, counts = list(total), np.fromiter(total.values(), np.int64, len(total))
            for a in range(0, len(words), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(words[a : a + 50_000], pa.string()), pa.array(counts[a : a + 50_000])], names=["word", "n"])
            total.clear()

        for batch in batches:
            names = batch.column(0).to_pylist()
            data, ends = utf8_of(batch.column(1))
            for a, b in pieces(np.diff(ends).tolist()):
                lower = data[ends[a] : ends[b]].tobytes().translate(_LOWER)
                for i in range(a, b):
                    own = Counter(_RUN.findall(lower[ends[i] - ends[a] : ends[i + 1] - ends[a]].decode("utf-8")))
                    for word, n in own.items():
                        if len(word) >= least:
                            if noise:
                                word = with_noise(names[i], word, noise)
                                if len(word) < least:
                                    continue
                            total[word] += n
                if len(total) > HELD:
                    yield from sent()
        yield from sent()

    return source.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def signatures(words: list[str], parts: int = PARTS) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the letter multiset of each word, its signatures as a matrix with a row per word)."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), sizes)
    order = np.lexsort((letters, owner))
    letters = letters[order]
    new = np.ones(len(letters), bool)
    new[1:] = (letters[1:] != letters[:-1]) | (owner[1:] != owner[:-1])  # owners stay in order
    first = np.flatnonzero(new)
    place = np.arange(len(letters)) - np.repeat(first, np.diff(np.append(first, len(letters))))
    dimension = _mixed((letters << np.uint64(32)) + place.astype(np.uint64))
    part = ((dimension >> np.uint64(40)) % np.uint64(parts)).astype(np.int64)
    sums = np.zeros((len(words), parts), np.uint64)
    np.add.at(sums, (owner, part), _mixed(dimension))
    whole = sums.sum(axis=1, dtype=np.uint64)
    left_out = list(combinations(range(parts), 2))
    out = np.empty((len(words), len(left_out)), np.uint64)
    for k, (a, b) in enumerate(left_out):
        out[:, k] = _mixed(whole - sums[:, a] - sums[:, b] + np.uint64(k + 1))
    return whole, out


def _mixed(h: np.ndarray) -> np.ndarray:
    """The finalizer of a public 64-bit hash."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _keys(words: DataFrame, parts: int) -> DataFrame:
    """(key, letters, word, n): a row for each signature of a word and each of its ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 5_000):
                part = batch.slice(a, 5_000)
                own = part.column(0).to_pylist()
                whole, signs = signatures(own, parts)
                ends = [np.fromiter((zlib.crc32(x(w).encode()) + (k << 32) for w in own), np.uint64, len(own)) for k, x in enumerate((lambda w: w[:END], lambda w: w[-END:]))]
                key = np.concatenate([_mixed(signs ^ _mixed(e)[:, None]) for e in ends], axis=1)
                at = pa.array(np.repeat(np.arange(len(own)), key.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.reshape(-1).view(np.int64)), pa.array(whole.view(np.int64)).take(at), part.column(0).take(at), part.column(1).take(at)],
                    names=["key", "letters", "word", "n"],
                )

    return words.select("word", "n").mapInArrow(run, "key long, letters long, word string, n long")


def near_words(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """(word, near, near_n): every ordered pair of words (of at least ``2 * END`` letters) that one edit tells apart, once.

    ``words`` has (word, n), each word once.
    """
    keys = _keys(words, parts)
    one = keys.select("key", F.col("letters").alias("letters_a"), F.col("word").alias("a"), F.col("n").alias("n_a"))
    two = keys.select("key", F.col("letters").alias("letters_b"), F.col("word").alias("b"), F.col("n").alias("n_b"))
    close = (F.col("a") < F.col("b")) & (F.col("letters_a") != F.col("letters_b")) & (F.abs(F.length("a") - F.length("b")) <= 1)
    pairs = one.join(two, (one["key"] == two["key"]) & close & (F.levenshtein("a", "b", 1) == 1))
    pairs = pairs.select("a", "n_a", "b", "n_b").distinct()
    both = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")),
    )
    return pairs.select(F.inline(both))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the chain of forms of each word that has one; ``forms`` has (word, form), without cycles."""
    state = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        further = state.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        state = cut(state.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")))
        if state.where("moved").isEmpty():
            return state.select("word", "root")
        state = state.select("word", "root")


def spelling_groups(
    docs: DataFrame,
    letters: int = 6,
    occurrences: int = 5,
    ratio: int = 5,
    noise: int | None = None,
    parts: int = PARTS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of each word of at least ``letters`` letters that occurs ``occurrences`` times or more."""
    if letters < 2 * END:
        raise ValueError(f"words of at least {2 * END} letters share an end of {END}")
    words = cut(word_counts(docs, letters, noise, id_column, text_column).where(F.col("n") >= occurrences))
    # The largest count first, then the least word in code-point order: UTF-8 bytes compare that way.
    best = F.min_by(F.struct("near", "near_n"), F.struct(-F.col("near_n"), F.col("near")))
    near = cut(near_words(words, parts).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best")))
    found = words.join(near, "word", "left")
    is_form = F.col("best.near_n") >= ratio * F.col("n")
    found = cut(
        found.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best.near")).alias("form"),
            F.when(is_form, F.col("best.near_n")).alias("form_n"),
        )
    )
    ends = roots(found.where("form IS NOT NULL"))
    return found.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
