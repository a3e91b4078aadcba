"""Ranked search against plain Python."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest

from barloom.llm import lexical_search

from .conftest import ODD

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, k=10):
    found = [(i, terms(t)) for i, t in docs]
    n_docs, n_terms = sum(1 for _, w in found if w), sum(len(w) for _, w in found)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    df = {t: sum(1 for _, w in found if t in set(w)) for t in set().union(*asked.values())} if asked else {}
    out = []
    for i, own in asked.items():
        scored = []
        for d, w in found:
            score = 0
            for t in own:
                if tf := w.count(t):
                    m = 10 + 90 * len(w) * n_docs // n_terms
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            if score:
                scored.append((-score, d is None, d or 0))
        out += [(i, r, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def searched(docs, items, **options):
    return sorted(map(tuple, lexical_search.ranked_search(docs, items, **options).collect()), key=str)


@pytest.fixture
def corpus():
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(120)] + ["é", "Straße", "x1"]
    rows = [(k, " ".join(rng.choices(vocabulary, [1 / (j + 1) for j in range(len(vocabulary))], k=rng.choice([0, 3, 20, 60])))) for k in range(150)]
    rows += [(200 + k, rows[3][1] + " w7 w7 é") for k in range(40)]  # copies: ties
    rows += [(None, rows[5][1]), (None, "w100 w101"), (7, "w100 w101 again"), (300, None), (301, ""), (302, "W1 " * 5_000)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([1, 5, 30])))) for k in range(25)]
    items += [(40, None), (41, ""), (42, "unknown"), (43, "w100 w101"), (43, "W7. é!"), (44, "w7 é w7")]
    return rows, items


@pytest.mark.parametrize("options", [{}, {"block": 3, "shard": 40}, {"block": 2, "shard": 7, "terms": 20, "k": 3}])
def test_search_against_brute_force(frame, spark, corpus, options):
    rows, items = corpus
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert searched(frame(rows).repartition(4), asked, **options) == brute(rows, items, options.get("k", 10))


def test_very_long_queries_take_summaries_over_all_terms(frame, spark, corpus, monkeypatch):
    rows, items = corpus
    monkeypatch.setattr(lexical_search, "WIDE", 4)
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert searched(frame(rows), asked, block=3, shard=40) == brute(rows, items)


def test_search_of_odd_rows(odd, empty, spark):
    items = [(1, "the fox and the dog"), (2, "w3x3 tail"), (3, "12 345 x")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert searched(odd, asked) == brute(ODD, items)
    assert searched(empty, asked) == []
    assert searched(odd, asked.limit(0)) == []


def test_a_skipped_block_holds_nothing_above_the_floor():
    rng = np.random.default_rng(2)
    n, wide = 300, 60
    counts = rng.poisson(0.15, (n, wide))
    counts[:, 0] += 1
    owner, term = np.nonzero(counts)
    part = lexical_search.parts(counts[owner, term], counts.sum(axis=1)[owner], n, int(counts.sum()))
    queries = [np.sort(rng.choice(wide, 6, replace=False)) for _ in range(30)]
    ends = np.concatenate([[0], np.cumsum((counts > 0).sum(axis=1))])
    columns = lexical_search._shard_columns(np.arange(n), ends, term, part, lexical_search.companions(queries, wide), 8)
    shard = lexical_search.Shard(columns)
    weights = np.arange(wide, 0, -1) * 13
    skipped = 0
    for q in queries:
        own = np.zeros(wide, np.int64)
        own[q] = weights[q]
        scores = np.zeros(n, np.int64)
        np.add.at(scores, owner, own[term] * part)
        blocks = shard.blocks(q)
        bounds, floor = shard.bounds(blocks, own), np.sort(scores)[-10]
        opened = shard.members(blocks[bounds >= floor])
        assert set(np.flatnonzero(scores >= max(floor, 1))) <= set(opened.tolist())
        assert (shard.scores(opened, own) == scores[opened]).all()
        skipped += int((bounds < floor).sum())
    assert skipped > 100


def test_clusters_cover_a_list_once():
    sketch = np.random.default_rng(1).standard_normal((500, 8)).astype(np.float32)
    sketch[100:400] = sketch[0]  # one family
    order, starts = lexical_search.cluster(sketch, 10)
    assert sorted(order.tolist()) == list(range(500)) and starts[0] == 0 and starts[-1] == 500
    assert np.diff(starts).max() <= 20 and np.diff(starts).min() >= 1
