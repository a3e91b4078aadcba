"""Token files and spelling variants against plain Python."""

from __future__ import annotations

import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barloom.llm import spelling_variants, token_files

from .conftest import ODD

MODEL = public_tokenizers.path("byte_bpe_50k.json")


def library_ids(texts):
    tokenizer = Tokenizer.from_file(MODEL)
    return [[*e.ids, 0] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def shown(rows):
    return sorted((r.doc_id is not None, r.doc_id or 0, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in rows)


def test_file_round_trip_reads_only_the_frames_of_a_document():
    rng = random.Random(3)
    rows = [(None if k == 0 else k * 7, np.array([rng.randrange(50_000) for _ in range(rng.choice([0, 1, 5, 400, 9_000]))], "<u4").tobytes()) for k in range(300)]
    out = io.BytesIO()
    writer = token_files.TokenFileWriter(out, frame=2_000, large=10_000)
    for i, ids in rows:
        writer.add(i, ids)
    writer.close()
    raw = out.getvalue()
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
    assert plain == b"".join(ids for _, ids in rows)  # any reader of zstandard
    file = token_files.TokenFile(io.BytesIO(raw), len(raw))
    assert [ids for _, ids in file.documents()] == [ids for _, ids in rows]
    assert [(int(i) if k else None) for i, k in zip(file.ids, file.known, strict=True)] == [i for i, _ in rows]
    small = next(k for k, (_, ids) in enumerate(rows) if len(ids) == 20)
    file = token_files.TokenFile(io.BytesIO(raw), len(raw))
    assert list(file.documents([small])) == [(small, rows[small][1])] and file.decompressed == 1
    assert len(file.table) > 50
    damaged = bytearray(raw)
    damaged[int(file.place[3]) + int(file.table[3, 0]) - 3] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(token_files.TokenFile(io.BytesIO(bytes(damaged)), len(raw)).documents())
    with pytest.raises(ValueError, match="seekable"):
        token_files.TokenFile(io.BytesIO(raw[:-1]), len(raw) - 1)


def test_empty_file():
    out = io.BytesIO()
    token_files.TokenFileWriter(out).close()
    assert list(token_files.TokenFile(io.BytesIO(out.getvalue()), len(out.getvalue())).documents()) == []


@pytest.mark.parametrize(
    "text",
    ["a  b", " a b ", "x\n y z \n", "it's 'twas  'll", "<|endoftext|> a b<|endoftext|>  c", "", "  ", "é ü 12 345\t x", "a​ b", "　 a b", "a   b\u0085 c", "x" * 60 + " y"],
)
def test_pieces_are_encoded_as_the_whole_text(text):
    encode = token_files.Encoder(open(MODEL, encoding="utf-8").read(), kept=4)
    for _ in range(3):
        got, again = encode.encode([text, text + " some more words of it, with commas"])
        assert [np.frombuffer(x, "<u4").tolist() + [0] for x in (got, again)] == library_ids([text, text + " some more words of it, with commas"])


def test_token_files_of_odd_rows(odd, empty, tmp_path):
    manifest = token_files.write_token_files(odd, MODEL, folder=str(tmp_path / "tokens"), frame=1 << 10, file_bytes=1 << 12)
    got = token_files.read_token_files(manifest).collect()
    ids = library_ids([t for _, t in ODD])
    rows = sorted(((i is not None, i or 0), x) for (i, _), x in zip(ODD, ids, strict=True))
    assert sorted((r.doc_id is not None, r.doc_id or 0, np.frombuffer(r.ids, "<u4").tolist()) for r in got) == [(*k, x) for k, x in rows]
    # Starts: the documents in order, one behind the other.
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += len(r.ids) // 4
    order = [(r.doc_id is not None, r.doc_id or 0) for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order)
    some = token_files.read_token_files(manifest, [8, 2, 77]).collect()
    assert shown(some) == shown([r for r in got if r.doc_id in (2, 8)])
    assert token_files.read_token_files(token_files.write_token_files(empty, MODEL)).count() == 0


def brute_groups(rows, least=6, occurrences=5, ratio=5, noise=None):
    counts: dict[str, int] = {}
    for i, text in rows:
        for w in spelling_variants.runs(text or ""):
            if noise:
                h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
                if h % noise == 0:
                    w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] = counts.get(w, 0) + 1
    counts = {w: n for w, n in counts.items() if len(w) >= least and n >= occurrences}
    one_edit = lambda a, b: any(
        a[:k] + a[k + 1 :] in (b, b[:k] + b[k + 1 :]) or b[:k] + b[k + 1 :] == a for k in range(max(len(a), len(b)))
    )
    near = {w: sorted((x for x in counts if x != w and abs(len(x) - len(w)) <= 1 and one_edit(w, x)), key=lambda x: (-counts[x], x)) for w in counts}
    form = {w: near[w][0] if near[w] and counts[near[w][0]] >= ratio * counts[w] else None for w in counts}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, n, len(near[w]), form[w] or "", counts.get(form[w], 0), root(w)) for w, n in counts.items())


def groups(df, **options):
    rows = spelling_variants.spelling_groups(df, **options).collect()
    return sorted((r.word, r.n, r.n_near, r.form or "", r.form_n or 0, r.root) for r in rows)


def test_spelling_groups_against_brute_force(frame):
    rng = random.Random(5)
    stems = ["".join(rng.choice("abcdé") for _ in range(rng.randrange(6, 9))) for _ in range(40)]
    words = []
    for k, s in enumerate(stems):
        words += [s] * (5 * 6 ** (k % 4))
        for _ in range(5):
            at = rng.randrange(len(s))
            v = rng.choice([s[:at] + s[at + 1 :], s[:at] + rng.choice("abcdeÿ") + s[at + 1 :], s[:at] + rng.choice("abcdé") + s[at:]])
            words += [v.upper() if v.isascii() else v] * rng.choice([1, 5, 6, 30])
    words += ["planet"] * 5 + ["planets"] * 27 + ["planetsy"] * 150
    rng.shuffle(words)
    rows = [(k, ", ".join(words[a : a + 97])) for k, a in enumerate(range(0, len(words), 97))]
    rows += [(None, "×÷àéîõü " * 6), (3, None), (4, ""), (5, "x" * 5_000 + " " + "x" * 5_000), (5, ("y" * 4_999 + " ") * 9 + ("y" * 5_000 + " ") * 5)]
    for options in ({}, {"noise": 3}, {"parts": 4, "ratio": 2}):
        want = brute_groups(rows, noise=options.get("noise"), ratio=options.get("ratio", 5))
        assert groups(frame(rows).repartition(3), **options) == want
        assert sum(1 for w in want if w[3]) > 10
        assert options.get("noise") or any(w[3] and w[5] != w[3] for w in want)


def test_chains_of_forms_are_followed_to_the_end(spark):
    chain = [("a" * k, "a" * (k + 1)) for k in range(1, 12)]
    got = spelling_variants.roots(spark.createDataFrame([*chain, ("b", "c")], "word string, form string"))
    assert dict(map(tuple, got.collect())) == {**{w: "a" * 12 for w, _ in chain}, "b": "c"}


def test_near_words_lie_within_two_parts():
    rng = random.Random(9)
    for _ in range(200):
        a = "".join(rng.choice("abcdefghé") for _ in range(rng.randrange(6, 12)))
        at = rng.randrange(len(a))
        b = rng.choice([a[:at] + a[at + 1 :], a[:at] + "z" + a[at + 1 :], a[:at] + "a" + a[at:]])
        whole, signs = spelling_variants.signatures([a, b])
        assert (signs[0] == signs[1]).any() and whole[0] != whole[1]
    whole, signs = spelling_variants.signatures(["listen", "silent", "enlist"])
    assert len(set(whole.tolist())) == 1 and (signs == signs[0]).all()


def test_words_of_empty_tables(empty, spark):
    assert spelling_variants.spelling_groups(empty, noise=199).count() == 0
    with pytest.raises(ValueError):
        spelling_variants.spelling_groups(empty, letters=5)


def test_repeated_rows_count_as_often_as_they_stand(frame):
    got = spelling_variants.spelling_groups(frame([(1, "planet")] * 5)).select("word", "n", F.col("root"))
    assert [tuple(r) for r in got.collect()] == [("planet", 5, "planet")]
