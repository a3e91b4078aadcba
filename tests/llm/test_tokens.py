"""Token counts and byte-level BPE against the libraries whose files they use."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from barloom.llm import byte_bpe, token_counts
from barloom.llm.byte_bpe import Codec, _merge_long, merge, read_ranks

from .conftest import ODD

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ranks = read_ranks(RANKS)
codec = Codec(ranks)
library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
tokenizer = Tokenizer.from_file(JSON)
counter = token_counts.Counter(tokenizer.to_str(), *token_counts.frequent_lengths(JSON))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("ab'sretvlmd \n\t12é.!-"), st.characters(exclude_categories=["Cs"])))))
def test_any_text(texts):
    ids = codec.encode(texts)
    assert [i.tolist() for i in ids] == [library.encode_ordinary(t) for t in texts]
    assert [codec.decode(i) for i in ids] == [t.encode() for t in texts]
    assert counter.count(texts).tolist() == [len(e) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_special_strings_count_as_the_library_counts_them():
    texts = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", "x  <|endoftext|>  y", "<|endoftext"]
    assert counter.count(texts).tolist() == [len(e) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_long_pieces_merge_alike():
    random.seed(4)
    for _ in range(50):
        piece = bytes(random.choice(b"abcthe ing") for _ in range(random.randint(2, 90)))
        assert _merge_long(piece, ranks) == merge(piece, ranks)
    text = "a" * 5000 + " " + "xyz" * 900
    assert codec.encode([text])[0].tolist() == library.encode_ordinary(text)


def test_counts_of_odd_rows(odd, empty):
    got = sorted(map(tuple, token_counts.token_counts(odd, JSON).collect()), key=str)
    want = []
    for i, t in ODD:
        n = len(tokenizer.encode(t or "", add_special_tokens=False))
        want.append((i, len((t or "").encode()), n, n > 1024))
    assert got == sorted(want, key=str)
    assert token_counts.token_counts(empty, JSON).count() == 0


def test_digests_of_odd_rows(odd, empty):
    got = sorted(map(tuple, byte_bpe.digests(odd, RANKS).collect()), key=str)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, t in ODD:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode())))
    assert got == sorted(want, key=str)
    assert byte_bpe.digests(empty, RANKS).count() == 0


def test_round_trip_with_offsets(odd):
    encoded = byte_bpe.encode(odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), RANKS, offsets=True)
    ends = {r.doc_id: (r.ids, r.ends) for r in encoded.collect()}
    back = {r.doc_id: bytes(r.decoded) for r in byte_bpe.decode(encoded, RANKS).collect()}
    texts = {i: (t or "").encode() for i, t in ODD if i is not None}
    assert back == texts
    for i, (ids, at) in ends.items():
        starts = [0, *at[:-1]] if at else []
        assert [texts[i][a:b] for a, b in zip(starts, at, strict=True)] == [library.decode_single_token_bytes(x) for x in ids]
