"""Exact, near and substring duplicates against brute force."""

from __future__ import annotations

import hashlib
import os
import random
import re

import numpy as np
import pytest
import zstandard

from barloom.llm import exact_dedup, jaccard_join, suffix_dedup
from barloom.llm.exact_dedup import CuckooIndex

from .conftest import ODD


def test_cuckoo_index_grows_and_deletes():
    index, keys = CuckooIndex(2), [os.urandom(32) for _ in range(3000)]
    for k in keys:
        assert index.find(k) is None
        index.insert(k, 1)
    assert all(index.find(k)[0] == k for k in keys) and index.size == 3000
    assert all(index.delete(k) for k in keys[:1500]) and not index.delete(keys[0])
    assert [index.find(k) is not None for k in keys] == [False] * 1500 + [True] * 1500
    for k in keys[:1500]:
        index.insert(k, 2)
    assert index.size == 3000


def test_exact_duplicates_of_odd_rows(odd, empty):
    got = sorted(map(tuple, exact_dedup.exact_duplicates(odd).collect()), key=str)
    groups: dict[str, list] = {}
    for i, t in ODD:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), i is None, i or 0))
    want = []
    for i, t in ODD:
        own = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        _, null, keep = min(groups[own])
        keep = None if null else keep
        want.append((i, keep, len(groups[own]), i == keep, hashlib.sha256(own.encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert exact_dedup.exact_duplicates(empty).count() == 0


def test_stored_index_takes_insertions_and_deletions(frame):
    digest = lambda rows: exact_dedup.digests(frame(rows))
    index = exact_dedup.update_index(None, digest([(1, "a"), (2, "b"), (3, "c")]), None, 4)
    index = exact_dedup.update_index(index, digest([(4, "d")]), digest([(2, "b")]), 4)
    known = {bytes(r.digest): r.known for r in exact_dedup.probe_index(index, digest([(0, "abcd"[k]) for k in range(4)]), 4).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).digest()
    assert known == {sha("a"): True, sha("b"): False, sha("c"): True, sha("d"): True}


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def brute_components(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    ids = list(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(seed, families=6, size=12, words=60):
    rng, rows = random.Random(seed), []
    for _ in range(families):
        base = [f"w{rng.randint(0, 500)}" for _ in range(rng.randint(3, words))]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = f"n{rng.randint(0, 9)}"
            rows.append((len(rows) * 7 + 3, " ".join(own)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates(frame, seed, monkeypatch):
    monkeypatch.setattr(jaccard_join, "GROUP", 3)
    rows = near_copies(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(frame(rows)).collect()}
    assert got == brute_components(rows)


def test_near_duplicates_of_odd_rows(odd, empty):
    got = sorted(map(tuple, jaccard_join.near_duplicates(odd).collect()), key=str)
    known = brute_components([(i, t) for i, t in ODD if i is not None])
    want = [(i, *known[i]) if i is not None else (None, len(shingles(t)), None) for i, t in ODD]
    assert got == sorted(want, key=str)
    assert jaccard_join.near_duplicates(empty).count() == 0


def test_cover_is_a_difference_cover():
    assert {(a - b) % suffix_dedup.PERIOD for a in suffix_dedup.COVER for b in suffix_dedup.COVER} == set(range(suffix_dedup.PERIOD))


def brute_repeats(texts, length=200):
    count: dict[bytes, int] = {}
    for b in texts:
        for k in range(len(b) - length + 1):
            count[b[k : k + length]] = count.get(b[k : k + length], 0) + 1
    out = []
    for b in texts:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if count[b[k : k + length]] > 1:
                gone[k : k + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()))
    return out


def test_repeated_strings(frame, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 3000)
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 8)))
    passages = [" ".join(word() for _ in range(n)) for n in (36, 40, 60, 150)]
    texts = []
    for _ in range(60):
        parts = [" ".join(word() for _ in range(rng.randint(0, 60))) for _ in range(3)]
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(passages)
            a, b = sorted((rng.randrange(len(p)), rng.randrange(len(p))))
            parts.insert(rng.randrange(4), p[a:b] if rng.random() < 0.5 else p)
        texts.append(" ".join(parts))
    texts += ["xyz" * 300, "q" * 199, "q" * 201, texts[0], "z" * 200, "z" * 200]
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.repeated_strings(frame(rows)).collect()}
    assert [got[i] for i, _ in rows] == brute_repeats([t.encode() for t in texts])


def test_repeated_strings_of_odd_rows(odd, empty):
    got = sorted(map(tuple, suffix_dedup.repeated_strings(odd).collect()), key=str)
    want = [(i, *r) for (i, _), r in zip(ODD, brute_repeats([(t or "").encode() for _, t in ODD]), strict=True)]
    assert got == sorted(want, key=str)
    assert suffix_dedup.repeated_strings(empty).count() == 0


def test_later_steps_hash_only_places_that_share_a_rank(monkeypatch):
    """What a block learnt comes back as notes; nothing is hashed again to read old answers."""
    sd, hashed = suffix_dedup, []
    plain = sd.window_hashes
    monkeypatch.setattr(sd, "window_hashes", lambda data, at, length, seed: hashed.append(len(at)) or plain(data, at, length, seed))
    same = random.Random(7).randbytes(400)
    text = random.Random(8).randbytes(60_000) + same + random.Random(9).randbytes(40_000) + same
    row = {"block": b"b" * 16, "lengths": [len(text)], "payload": zstandard.ZstdCompressor().compress(text)}
    for k, (step, _) in enumerate(sd.STEPS, 1):
        work = sd._Places(row, 200, 4)
        step(work)
        row[f"answers{k}"] = [] if work.note is None else [{"bucket": -1, "bits": np.packbits(work.note).tobytes()}]
    gone = sd._Places(row, 200, 4).covered()
    want = np.zeros(len(text), bool)
    want[60_000:60_400] = want[-400:] = True
    assert (gone == want).all()
    places = len(sd._Places(row, 200, 4).block.cover(200 - sd.PERIOD + 1))
    assert 2 * places <= sum(hashed) < 2 * places + 8 * 400 * 2


def test_order_of_keys_with_equal_first_parts():
    first, second = np.array([5, 7, 5, 5, 7], np.uint64), np.array([2, 1, 1, 2, 1], np.uint32)
    order, new = suffix_dedup._order(first, second)
    assert list(zip(first[order], second[order], strict=True)) == [(5, 1), (5, 2), (5, 2), (7, 1), (7, 1)]
    assert new.tolist() == [True, True, False, True, False]


def test_blocks_repeat_when_a_task_runs_again(frame, monkeypatch):
    """A rerun, also one that gets its rows in another order, makes the same blocks under the same ids."""
    monkeypatch.setattr(suffix_dedup, "BLOCK", 300)
    monkeypatch.setattr(suffix_dedup, "cut", lambda df: df)
    rows = [(i // 2 if i % 9 else None, f"text {i % 7} " * (9 * (i % 5))) for i in range(60)] + [(3, "x" * 1000), (3, None)]
    made = lambda own: sorted(map(str, suffix_dedup._blocks(frame(own).coalesce(1), "doc_id", "text").collect()))
    first = made(rows)
    assert len(first) > 5 and first == made(rows) == made(rows[::-1])
    several = suffix_dedup._blocks(frame(rows).repartition(4), "doc_id", "text").collect()
    assert len({bytes(r.block) for r in several}) == len(several) and sum(len(r.ids) for r in several) == len(rows)


def thue_morse(length):
    text = "a"
    while len(text) < length:
        text += text.translate(str.maketrans("ab", "ba"))
    return text


@pytest.mark.parametrize("length", [1024, 4096])
def test_long_regular_words_are_told_apart(frame, length):
    """Sums of powers modulo 2 ** 64 have one value for such a word and its complement, for any base."""
    one = thue_morse(length)
    two = one.translate(str.maketrans("ab", "ba"))
    got = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(frame([(1, one), (2, two), (3, one)])).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_hashes_of_words_depend_on_every_byte_and_its_place():
    words = [b"a", b"aa", b"ab", b"ba", b"abcdefgh", b"abcdefghabcdefgh", b"hgfedcba", b"abcdefghi", b"iabcdefgh", b"a" * 64, b"a" * 65, b"a" * 72]
    data = np.frombuffer(b"\x00".join(words), np.uint8)
    length = np.array([len(w) for w in words])
    first = np.cumsum(length + 1) - length - 1
    assert len(set(jaccard_join.string_hashes(data, first, length).tolist())) == len(words)
    again = jaccard_join.string_hashes(np.concatenate([data, data]), np.concatenate([first, first + len(data)]), np.tile(length, 2))
    assert (again[: len(words)] == again[len(words) :]).all()


def test_groups_are_opened_only_where_their_union_suffices(spark, frame, monkeypatch):
    """Two documents that share a rare beginning but not enough; the group that the second asks is not opened."""
    seen = []
    links = jaccard_join._links

    def watched(asked, members, sets, percent):
        seen.append((asked.count(), members.count()))
        return links(asked, members, sets, percent)

    monkeypatch.setattr(jaccard_join, "_links", watched)
    rng = random.Random(1)
    words = [f"v{k}" for k in range(4000)]
    base = rng.sample(words, 60)
    rows = [(k, " ".join(base[:20] + rng.sample(words, 40))) for k in range(30)]
    rows += [(100 + k, " ".join([*base, f"t{k}"])) for k in range(5)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(frame(rows)).collect()}
    assert got == brute_components(rows)
    unions = jaccard_join._unions(
        spark.createDataFrame([(1, 10, 10), (1, 11, 11)], "group long, id long, component long"),
        lambda ids: spark.createDataFrame(
            [(10, np.array([1, 5], "u4").tobytes()), (11, np.array([5, 9], "u4").tobytes()), (12, np.array([1, 9, 9], "u4").tobytes()), (13, np.array([1, 2, 3], "u4").tobytes())],
            "id long, shingles binary",
        ).join(ids.distinct(), "id"),
    )
    assert [np.frombuffer(r.union, np.uint32).tolist() for r in unions.collect()] == [[1, 5, 9]]
    asked = spark.createDataFrame([(1, 12, 12), (1, 13, 13)], "group long, id long, component long")
    halves = lambda ids: spark.createDataFrame(
        [(12, np.array([1, 9, 9], "u4").tobytes()), (13, np.array([1, 2, 3], "u4").tobytes())], "id long, shingles binary"
    ).join(ids, "id")
    assert [r.id for r in jaccard_join._qualifying(asked, unions, halves, 80).collect()] == [12]
    assert len(seen) == 2
