"""Token ids as files of independent zstandard frames with a trailing seek table.

A file holds the ids of its documents one after the other, as little-endian unsigned 32-bit integers, in the order of the documents:

* data frames of about ``FRAME`` bytes that hold whole documents (a document beyond ``LARGE`` bytes goes on in further frames), each a
  zstandard frame of its own, so any zstandard reader gives back the plain sequence of ids;
* a skippable frame with the directory: id and number of tokens of each document;
* the seek table of the public seekable format, a skippable frame at the very end: compressed size, decompressed size and checksum (the
  low half of XXH64 of the decompressed bytes) of each frame, then the number of frames and the closing magic number.

A reader fetches the end of the file, finds the frames of the documents it is asked for, and reads and decompresses these alone, each checked
against its sum.

Documents are dealt by ranges of (id, hash of the text) and sorted inside a range; each range is a task that encodes and writes its files, so files
are in ascending order among themselves. A repeated id that many rows hold is split by the hash. A file's name is new for every attempt of a task; the
manifest, written once all are done, lists the files of the attempts that count, so a task that runs again leaves nothing twice.

Texts are cut at single spaces and line feeds between other characters, where no token of this kind of tokenizer (byte-level, with the published
pattern and no space put in front) crosses; another kind is refused. Each piece is encoded by the tokenizer library once per worker and kept in a bounded
table. Null and empty texts have the end id alone; long texts are taken
whole; rows that repeat an id each have their place; rows with a null id come first; an empty table writes no file; other columns are ignored.
Ids of documents must be integers.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barloom.llm.common import cut, pieces, spread, texts_of
from barloom.session import checkpoint_dir

#: Bytes of ids after which a frame is closed, and those beyond which a document is split over frames.
FRAME = 1 << 18
LARGE = 1 << 28
#: Bytes of compressed frames after which a file is closed.
FILE = 1 << 28
#: Pieces of text whose ids a worker keeps, and the longest of them in characters.
KEPT, SHORT = 1_200_000, 48
# Fixed values of the seekable format.
SKIPPABLE_DIRECTORY = 0x184D2A50
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
WITH_CHECKSUMS = 0x80

# White space beyond the space and the line feed, and characters that some engines take for it.
_WHITE = "\\t\\x0b-\\r\\x1c-\\x1f\\x85\\xa0\\u1680\\u180e\\u2000-\\u200b\\u2028\\u2029\\u202f\\u205f\\u3000\\ufeff"
_RARE = re.compile(f"[{_WHITE}]")
#: A space alone between two other characters.
_SINGLE = re.compile(f"(?<=[^ \\n{_WHITE}]) (?=[^ \\n{_WHITE}])")


#: A piece that is one word, perhaps behind a line feed and before some punctuation: three pre-tokens at most.
_WORD = re.compile("(\\n?)([A-Za-z\\u00c0-\\u00d6\\u00d8-\\u00f6\\u00f8-\\u024f]+)([.,;:!?*$%]*)")
# Fixed values of byte-level tokenizers: bytes without a visible character stand as characters from 256 on.
_VISIBLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_SHOWN = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _VISIBLE)}


def _cut_up(text: str) -> list[str]:
    """The text cut before spaces and line feeds that stand alone between two other characters.

    A piece that starts with a line feed has no space before it, every other but the first has.
    """
    plain = text[:1] != " " and text[-1:] != " " and not any(x in text for x in ("  ", "\n ", " \n", "\n\n"))
    return text.replace("\n", " \n").split(" ") if plain and _RARE.search(text) is None else _SINGLE.split(text)


class Encoder:
    """Ids of texts as bytes. What the library said about short pieces is kept for two generations of ``kept`` / 2 pieces each."""

    def __init__(self, model: str, kept: int = KEPT):
        self.tokenizer, self.most = Tokenizer.from_str(model), kept // 2
        kind = json.loads(model)["pre_tokenizer"] or {}
        if kind.get("type") != "ByteLevel" or kind.get("add_prefix_space") or not kind.get("use_regex", True):
            raise ValueError("the tokenizer must be byte-level, with its pattern and without a space put in front")
        self.bpe = self.tokenizer.model
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {"": b"", "\n": self._encoded(["\n"])[0]}

    def _encoded(self, found: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(found, add_special_tokens=False)]

    def _word(self, shown: str) -> bytes:
        """Ids of one pre-token in the characters that stand for its bytes."""
        return array("I", [t.id for t in self.bpe.tokenize(shown)]).tobytes()

    def _learn(self, missing: list[str]) -> None:
        whole = []
        for x in missing:
            if (ids := self.old.get(x)) is None:
                if x.isascii() and x.isalpha() and len(x) <= SHORT:  # most new pieces
                    self.young[x] = self._word(_SPACE + x)
                    continue
                found = _WORD.fullmatch(x) if len(x) <= SHORT else None
                if found is None:
                    whole.append(x)
                    continue
                line, stem, tail = found.groups()
                if tail not in self.tails:
                    if len(self.tails) > 10_000:
                        self.tails = {"": b"", "\n": self.tails["\n"]}
                    self.tails[tail] = self._encoded([tail])[0]
                shown = stem if stem.isascii() else stem.encode("utf-8").decode("latin-1").translate(_SHOWN)
                if line:
                    ids = self.tails["\n"] + self._word(shown) + self.tails[tail]
                else:
                    ids = self.young.get(stem) or self.old.get(stem)
                    if ids is None:
                        ids = self.young[stem] = self._word(_SPACE + shown)
                    ids += self.tails[tail]
            self.young[x] = ids
        self.young.update(zip(whole, self._encoded([x if x[:1] == "\n" else " " + x for x in whole]), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        cut_up = [_cut_up(t) for t in texts]
        heads = self._encoded([p[0] for p in cut_up])
        out = []
        for head, own in zip(heads, cut_up, strict=True):
            own[0] = ""
            self.young[""] = head
            ids = list(map(self.young.get, own))
            long = []
            if None in ids:
                gaps = [k for k, x in enumerate(ids) if x is None]
                missing = {own[k] for k in gaps}
                self._learn(list(missing))
                for k in gaps:
                    ids[k] = self.young[own[k]]
                long = [x for x in missing if len(x) > SHORT]
            out.append(b"".join(ids))
            for x in long:
                del self.young[x]
            if len(self.young) > self.most:
                self.old, self.young = self.young, {}
        return out


_SPACE = chr(_SHOWN[0x20])

#: The encoder of this worker process, under the checksum of its model; tasks that the same worker runs share it.
_ENCODERS: dict[int, Encoder] = {}


def encoder(model: str) -> Encoder:
    key = zlib.crc32(model.encode())
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(model)
    return _ENCODERS[key]


class TokenFileWriter:
    """Writes one file; ``out`` is a binary stream."""

    def __init__(self, out, frame: int = FRAME, large: int = LARGE, level: int = 3):
        self.out, self.frame, self.large = out, frame, large
        self.press = zstandard.ZstdCompressor(level=level)
        self.table: list[tuple[int, int, int]] = []
        self.ids: list[int | None] = []
        self.sizes: list[int] = []
        self.held: list[bytes] = []
        self.in_frame = self.written = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """The ids of the next document, four bytes each."""
        self.ids.append(doc_id)
        self.sizes.append(len(ids) // 4)
        for a in range(0, len(ids), self.large):
            self.held.append(ids[a : a + self.large])
            self.in_frame += len(self.held[-1])
            if self.in_frame >= self.frame:
                self._close_frame()

    def _close_frame(self) -> None:
        if self.in_frame:
            plain = b"".join(self.held)
            self._put(self.press.compress(plain), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF)
            self.held, self.in_frame = [], 0

    def _put(self, packed: bytes, size: int, checksum: int) -> None:
        self.out.write(packed)
        self.table.append((len(packed), size, checksum))
        self.written += len(packed)

    def close(self) -> None:
        """Directory and seek table; the stream itself stays open."""
        self._close_frame()
        known = np.array([i is not None for i in self.ids], np.uint8).tobytes()
        named = np.array([i or 0 for i in self.ids], "<i8").tobytes()
        directory = self.press.compress(struct.pack("<Q", len(self.ids)) + known + named + np.array(self.sizes, "<u8").tobytes())
        # A frame without data for a reader of ids.
        self._put(struct.pack("<II", SKIPPABLE_DIRECTORY, len(directory)) + directory, 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF)
        entries = b"".join(struct.pack("<III", *x) for x in self.table)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(entries) + 9) + entries)
        self.out.write(struct.pack("<IBI", len(self.table), WITH_CHECKSUMS, SEEKABLE_MAGIC))


class TokenFile:
    """Reads one file; ``source`` is a stream with ``seek`` and ``read``, ``size`` its length."""

    def __init__(self, source, size: int):
        self.source, self.decompressed = source, 0
        count, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_MAGIC or not flags & WITH_CHECKSUMS:
            raise ValueError("not a seekable file with checksums")
        start = size - 9 - 12 * count - 8
        head, length = struct.unpack("<II", self._at(start, 8))
        if head != SKIPPABLE_SEEK_TABLE or length != 12 * count + 9:
            raise ValueError("the seek table is damaged")
        self.table = np.frombuffer(self._at(start + 8, 12 * count), "<u4").reshape(-1, 3).astype(np.int64)
        self.place = np.concatenate([[0], np.cumsum(self.table[:, 0])])
        self.first = np.concatenate([[0], np.cumsum(self.table[:, 1])])
        if self.place[-1] != start:
            raise ValueError("frames and seek table do not fit")
        self._read_directory(self._at(int(self.place[-2]), int(self.table[-1, 0])))

    def _read_directory(self, raw: bytes) -> None:
        head, length = struct.unpack("<II", raw[:8])
        if head != SKIPPABLE_DIRECTORY or length != len(raw) - 8:
            raise ValueError("the directory is damaged")
        plain = zstandard.ZstdDecompressor().decompress(raw[8:])
        n = struct.unpack("<Q", plain[:8])[0]
        self.known = np.frombuffer(plain, np.uint8, n, 8).astype(bool)
        self.ids = np.frombuffer(plain, "<i8", n, 8 + n)
        self.sizes = np.frombuffer(plain, "<u8", n, 8 + 9 * n).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        if self.starts[-1] * 4 != self.first[-1]:
            raise ValueError("directory and seek table do not fit")

    def _at(self, place: int, length: int) -> bytes:
        self.source.seek(place)
        return self.source.read(length)

    def frame(self, k: int) -> bytes:
        """The k-th frame, checked."""
        plain = zstandard.ZstdDecompressor().decompress(self._at(int(self.place[k]), int(self.table[k, 0])))
        if len(plain) != self.table[k, 1] or xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != self.table[k, 2]:
            raise ValueError(f"frame {k} is damaged")
        self.decompressed += 1
        return plain

    def documents(self, places: Iterable[int] | None = None) -> Iterator[tuple[int, bytes]]:
        """(place, ids) of the documents at ascending ``places``, or of all; a frame is read once and only if it is needed."""
        at, plain = -1, b""
        for i in range(len(self.ids)) if places is None else places:
            a, b = int(self.starts[i]) * 4, int(self.starts[i + 1]) * 4
            parts = []
            while a < b:
                k = int(np.searchsorted(self.first, a, "right")) - 1
                if k != at:
                    at, plain = k, self.frame(k)
                own = plain[a - int(self.first[k]) : b - int(self.first[k])]
                parts.append(own)
                a += len(own)
            yield i, parts[0] if len(parts) == 1 else b"".join(parts)


def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    folder: str | None = None,
    end_id: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
    frame: int = FRAME,
    large: int = LARGE,
    file_bytes: int = FILE,
) -> DataFrame:
    """Encode all documents and write them; the manifest (file, first_id, first_key, part, last_id, n_docs, n_ids, n_bytes).

    ``tokenizer`` is the path of a tokenizer file on the driver, ``folder`` a folder that all executors share (one below
    ``spark.checkpoint.dir`` where none is named). ``end_id`` follows each document.
    """
    spark = docs.sparkSession
    folder = folder or f"{checkpoint_dir(spark)}/token-files-{uuid.uuid4().hex}"
    model = spark.sparkContext.broadcast(open(tokenizer, encoding="utf-8").read())  # one vocabulary
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pyarrow.fs.FileSystem.from_uri(folder)
        name, out, writer, first_key, rows = "", None, None, 0, []

        def close() -> None:
            writer.close()
            size = out.tell()
            out.close()
            rows.append((name, writer.ids[0], first_key, len(rows), writer.ids[-1], len(writer.ids), sum(writer.sizes), size))

        for batch in batches:
            names, keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts_of(batch.column(2))
            for a, b in pieces([len(t) for t in texts]):
                for i, ids in zip(range(a, b), encoder(model.value).encode(texts[a:b]), strict=True):
                    if writer is None:
                        store.create_dir(root, recursive=True)
                        name = f"{uuid.uuid4().hex}.tokens.zst"
                        out, first_key = store.open_output_stream(f"{root}/{name}", compression=None), keys[i]
                        writer = TokenFileWriter(out, frame, large)
                    writer.add(names[i], ids + end)
                    if writer.written >= file_bytes:
                        close()
                        writer = None
        if writer is not None:
            close()
        if rows:
            columns = zip(*rows, strict=True)
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=MANIFEST.names)

    source = docs.select(F.col(id_column).cast("long").alias("id"), F.xxhash64(text_column).alias("key"), F.col(text_column).alias("text"))
    dealt = source.repartitionByRange(spread(docs, "id"), "id", "key").sortWithinPartitions("id", "key")
    kind = "file string, first_id long, first_key long, part int, last_id long, n_docs long, n_ids long, n_bytes long"
    return cut(dealt.mapInArrow(write, kind).withColumn("file", F.concat(F.lit(f"{folder}/"), "file")))


MANIFEST = pa.schema([(n, pa.null()) for n in ("file", "first_id", "first_key", "part", "last_id", "n_docs", "n_ids", "n_bytes")])


def read_token_files(manifest: DataFrame, wanted: Sequence[int] | None = None, id_column: str = "doc_id") -> DataFrame:
    """(id, start, ids) of the documents in the files of a manifest: how many ids all documents before it have, and its own as bytes.

    With ``wanted`` (ids of documents, a list for the driver) only the files and frames that hold them are read.
    """
    order = Window.orderBy(F.col("first_id").asc_nulls_first(), "first_key", "part")  # a row for each file
    before = F.coalesce(F.sum("n_ids").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before")
    files = manifest.select("file", before, "first_id", "last_id")
    asked = None if wanted is None else np.unique(np.array(list(wanted), np.int64))
    if asked is not None:
        inside = F.exists(F.lit(asked.tolist()).cast("array<bigint>"), lambda x: (x >= F.coalesce("first_id", x)) & (x <= F.coalesce("last_id", x)))
        files = files.where(inside)
    files = cut(files.select("file", "before"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                store, place = pyarrow.fs.FileSystem.from_uri(path)
                with store.open_input_file(place) as source:
                    file = TokenFile(source, source.size())
                    places = None if asked is None else np.flatnonzero(np.isin(file.ids, asked) & file.known).tolist()
                    held, size = [], 0
                    for i, ids in file.documents(places):
                        held.append((int(file.ids[i]) if file.known[i] else None, before + int(file.starts[i]), ids))
                        size += len(ids) + 64
                        if size > 1 << 22:
                            yield _rows(held)
                            held, size = [], 0
                    if held:
                        yield _rows(held)

    found = files.repartition(max(1, files.count())).mapInArrow(read, "id long, start long, ids binary")
    return found.withColumnRenamed("id", id_column)


def _rows(held: list[tuple[int | None, int, bytes]]) -> pa.RecordBatch:
    names, starts, ids = zip(*held, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(starts, pa.int64()), pa.array(ids, pa.binary())], names=["id", "start", "ids"])
