"""Token counts by a map-side lookup in two tiers; no pre-token is ever shuffled.

Tier one is a hash table from frequent pre-tokens to their number of tokens, broadcast to all workers. The
entries of a BPE vocabulary are the frequent strings of the language it was made for, so the table holds
those of them that are pre-tokens: its size is bounded by the vocabulary (50,257 here), whatever the corpus.
Tier two is a cache in each Python worker, bounded to about ``CACHE`` entries; what neither knows is
encoded by the tokenizer library, in batches.

Nulls and empty texts have 0 bytes and 0 tokens; long texts are taken whole; repeated rows give repeated
results; other columns are ignored (``id_column`` and ``text_column`` name the two that count).
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barloom.llm.common import pieces, texts_of
from barloom.llm.pretokens import tokens

#: Pre-tokens that a worker's cache holds; beyond that it starts anew.
CACHE = 300_000
#: Pieces of text handled at a time, in characters.
PIECE = 1 << 19


def frequent_lengths(path: str) -> tuple[dict[str, int], list[str]]:
    """(number of tokens of each vocabulary entry that is one pre-token, special strings)."""
    tokenizer = Tokenizer.from_file(path)
    special = [x.content for x in tokenizer.get_added_tokens_decoder().values()]
    shown = [tokenizer.decode([i]) for i in range(tokenizer.get_vocab_size(with_added_tokens=False))]
    texts = sorted({x for x in shown if x and "�" not in x and not any(s in x for s in special)})
    cut, first = tokens(texts)
    single = [texts[i] for i in range(len(texts)) if first[i + 1] - first[i] == 2]
    encoded = tokenizer.encode_batch(single, add_special_tokens=False)
    return {t: len(e) for t, e in zip(single, encoded, strict=True)}, special


def _pieces_without(text: str, special: list[str]) -> list[str]:
    """The text between special strings, leftmost first; there is one special string more than pieces less one."""
    parts, rest = [], text
    while True:
        at = min(((p, s) for s in special if (p := rest.find(s)) >= 0), default=None)
        if at is None:
            return [*parts, rest]
        parts.append(rest[: at[0]])
        rest = rest[at[0] + len(at[1]) :]


class Counter:
    """Counts tokens of texts in one worker."""

    def __init__(self, model: str, frequent: dict[str, int], special: list[str]):
        self.tokenizer, self.frequent, self.special = Tokenizer.from_str(model), frequent, special
        self.cache: dict[str, int] = {}

    def _lengths(self, found: list[str]) -> np.ndarray:
        out = np.fromiter(map(self.frequent.get, found, repeat(0)), np.int64, len(found))  # no token is of length 0
        rare = np.flatnonzero(out == 0).tolist()
        words = [found[i] for i in rare]
        if len(self.cache) > CACHE:
            self.cache.clear()
        new = [w for w in set(words) if w not in self.cache]
        if new:
            codes = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
            self.cache.update(zip(new, map(len, codes), strict=True))
        out[rare] = np.fromiter(map(self.cache.__getitem__, words), np.int64, len(words))
        return out

    def count(self, texts: list[str]) -> np.ndarray:
        parts, owner, total = [], [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            own = _pieces_without(text, self.special) if any(s in text for s in self.special) else [text]
            total[i] = len(own) - 1
            parts += own
            owner += [i] * len(own)
        found, first = tokens(parts)
        lengths = self._lengths(found)
        lengths[first[1:] - 1] = 0  # separators
        sums = np.concatenate([[0], np.cumsum(lengths)])
        np.add.at(total, owner, sums[first[1:]] - sums[first[:-1]])
        return total


def token_counts(
    docs: DataFrame, path: str, limit: int = 1024, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of each row of ``docs`` with the tokenizer file at ``path``."""
    frequent, special = frequent_lengths(path)
    model = json.dumps(json.load(open(path, encoding="utf-8")))
    shared = docs.sparkSession.sparkContext.broadcast((model, frequent, special))
    kept: dict[str, Counter] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = kept.setdefault("own", None) or Counter(*shared.value)
        kept["own"] = counter
        for batch in batches:
            texts = texts_of(batch.column(1))
            sizes = [len(t.encode("utf-8")) for t in texts]
            counts = [counter.count(texts[a:b]) for a, b in pieces(sizes, PIECE)]
            n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(n), pa.array(n > limit)],
                names=["id", "n_bytes", "n_tokens", "over_limit"],
            )

    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    out = source.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("id", id_column)
