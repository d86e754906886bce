"""Token ids in binary files of independent zstandard frames.

A file holds the ids of its documents one after another, little-endian, two bytes each if the
vocabulary allows and four otherwise. The documents of a frame are compressed together, and each
frame can be decompressed alone. Two skippable frames end the file: the documents' places, and
the seek table of the public seekable format: compressed size, size and checksum (the low half of
XXH64) of each frame, the number of frames, flags and magic number. A reader takes the tables
from the file's end, decompresses the frames of the documents it wants and checks their sums.

Documents are dealt to files by ranges of doc_id and written in ascending order, null ids first;
rows of one id follow by a hash of their texts. A null text is an empty one: the end id alone.
Repeated rows are written each. Other columns are not looked at. A file is written under a name
of its own and then renamed, so a repeated task leaves one whole file.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linepulse.scratch import fresh_path

END_ID = 0
FRAME_BYTES = 1 << 18
LEVEL = 3
_SKIPPABLE = 0x184D2A5E
_PLACES = 0x184D2A50
_SEEKABLE = 0x8F92EAB1
#: Pieces of texts before those kept with their ids make way, and pieces that are added at most at a time.
_CACHED = 250_000
#: Letters of a piece that is kept; text without blanks is one piece.
_LONGEST = 64
#: Bytes of texts that are taken apart at a time, and texts or pieces that are encoded whole at a time.
_TEXTS = 1 << 22
_WHOLE = 64
#: Letters that every version of Unicode calls so, and signs that are none of those, digits and ASCII.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_ODD = re.compile(rf"[^\t\n\r\x20-\x7e{_LETTERS}]")
#: The usual pattern of byte-level tokenizers, over pieces that zeros end; a zero is a word of its own.
_SPLIT = re.compile(
    rf"\x00|'(?:s|t|re|ve|m|ll|d)| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s{_LETTERS}0-9\x00]+|\s+(?![^\s\x00])|\s+"
)
#: Byte-level vocabularies write printable bytes of Latin-1 as they are, the others from U+0100 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
_BYTE_TABLE = np.array([0, *(_BYTE_LETTERS.get(b, b) for b in range(1, 256))], dtype="<u2")
MANIFEST = "file string, part int, docs long, ids long, low long, high long"


class _Known:
    """Pieces met before and their ids: the recent ones and those before them, so memory is bounded."""

    def __init__(self) -> None:
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def find(self, pieces: list[str], encode: Callable[[list[str]], list[bytes | None]]) -> pa.Array:
        """Ids of each piece; null where ``encode`` gives None."""
        if len(self.new) > _CACHED:
            self.new, self.old = {}, self.new
        found = list(map(self.new.get, pieces))
        gaps = [i for i, x in enumerate(found) if x is None]
        for i in gaps:
            found[i] = self.old.get(pieces[i])
        fresh = [i for i in gaps if found[i] is None]
        for i, x in zip(fresh, encode([pieces[i] for i in fresh]), strict=True):
            found[i] = x
        kept = (i for i in gaps[:_CACHED] if found[i] is not None and len(pieces[i]) <= _LONGEST)
        self.new.update((pieces[i], found[i]) for i in kept)
        return pa.array(found, pa.large_binary())


def _strings(values: pa.Array) -> list[str]:
    return values.to_numpy(zero_copy_only=False).tolist()


def _joined(ids: pa.Array, ends: np.ndarray) -> list[bytes]:
    """The ids of pieces, put together: those from each end to the next one."""
    at = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1, 8 * ids.offset)[ends].tolist()
    data = memoryview(ids.buffers()[2] or b"")
    return [bytes(data[a:b]) for a, b in zip(at, at[1:], strict=False)]


#: A worker keeps a tokenizer and its pieces from task to task.
_ENCODERS: dict[str, tuple[Callable[[list[str | None] | pa.Array], list[bytes]], int]] = {}


def encoder(path: str) -> tuple[Callable[[list[str | None] | pa.Array], list[bytes]], int]:
    """A function that encodes texts to bytes of ids, and the bytes of an id.

    A byte-level tokenizer that splits by its usual pattern never joins a blank that a letter
    follows with what stands before it. So texts are taken apart at blanks, many at a time, and
    each piece is looked up once; one that was met before is not encoded again, and of new ones the
    words are looked up likewise. Texts with special tokens or white space behind a blank, and all
    texts of other tokenizers, are encoded whole.
    """
    if path not in _ENCODERS:
        _ENCODERS[path] = _load(path)
    return _ENCODERS[path]


def _load(path: str) -> tuple[Callable[[list[str | None] | pa.Array], list[bytes]], int]:
    # Spark runs a worker for each core; threads of their own would only contend.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    width = 2 if tokenizer.get_vocab_size() <= 1 << 16 else 4
    kind = np.dtype(f"<u{width}")
    setup = json.loads(tokenizer.to_str())
    before = setup["pre_tokenizer"] or {}
    apart = (
        before.get("type") == "ByteLevel"
        and before.get("use_regex")
        and not before.get("add_prefix_space")
        and setup["normalizer"] is None
        and not setup.get("truncation")
        and not setup.get("padding")
        and setup["model"].get("type") == "BPE"
        and not setup["model"].get("dropout")
    )
    special = [t["content"] for t in setup["added_tokens"]]
    apart = apart and not any(" " in s for s in special)
    unsure = re.compile("|".join([r" (?:\s|\Z)", *map(re.escape, special)])).search
    known, words = _Known(), _Known()
    model = tokenizer.model

    def whole(texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for i in range(0, len(texts), _WHOLE):
            found = tokenizer.encode_batch_fast(texts[i : i + _WHOLE], add_special_tokens=False)
            out += [np.array(x.ids, dtype=kind).tobytes() for x in found]
        return out

    bytes_of = [i.to_bytes(width, "little") for i in range(tokenizer.get_vocab_size())]

    def new_words(found: list[str]) -> list[bytes]:
        raw = "\0".join(found).encode()
        letters = _BYTE_TABLE[np.frombuffer(raw, np.uint8)].tobytes().decode("utf-16-le").split("\0") if found else []
        return [b"".join([bytes_of[t.id] for t in model.tokenize(x)]) for x in letters]

    def plain(pieces: list[str]) -> list[bytes]:
        """Pieces of plain letters go to the model word by word."""
        if not pieces:
            return []
        split = pa.array(_SPLIT.findall("\0".join([*pieces, ""])), pa.large_string())
        coded = split.dictionary_encode()
        distinct = _strings(coded.dictionary)
        zero = distinct.index("\0")
        distinct[zero] = ""
        ends = np.flatnonzero(coded.indices.to_numpy() == zero)
        return _joined(words.find(distinct, new_words).take(coded.indices), np.append(0, ends))

    def new_pieces(pieces: list[str]) -> list[bytes | None]:
        """None where white space follows a blank, or a special token is in the piece."""
        out: list[bytes | None] = [None] * len(pieces)
        even: list[int] = []
        odd: list[int] = []
        for i, p in enumerate(pieces):
            if not unsure(p):
                (odd if _ODD.search(p) else even).append(i)
        for some, how in ((even, plain), (odd, whole)):
            for i, x in zip(some, how([pieces[i] for i in some]), strict=True):
                out[i] = x
        return out

    def some(texts: pa.Array) -> list[bytes]:
        if not apart:
            return whole(_strings(texts))
        split = pc.split_pattern(texts, " ")
        ends = split.offsets.to_numpy()
        coded = split.flatten().dictionary_encode()
        # Each piece has its blank, but the first of a text.
        pieces = [f" {p}" for p in _strings(coded.dictionary)]
        codes = coded.indices.to_numpy().copy()
        first = codes[ends[:-1]]
        codes[ends[:-1]] = len(pieces) + np.arange(len(first))
        pieces += [pieces[i][1:] for i in first.tolist()]
        ids = known.find(pieces, new_pieces)
        out = _joined(ids.take(pa.array(codes)), ends)
        if ids.null_count:
            null = np.add.reduceat(ids.is_null().to_numpy(zero_copy_only=False)[codes], ends[:-1], dtype=np.int64)
            rows = np.flatnonzero(null)
            for i, x in zip(rows.tolist(), whole(_strings(texts.take(pa.array(rows)))), strict=True):
                out[i] = x
        return out

    def encode(texts: list[str | None] | pa.Array) -> list[bytes]:
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string()), "")
        texts = texts.cast(pa.large_string())
        out: list[bytes] = []
        size = pc.binary_length(texts).to_numpy().cumsum()
        while len(out) < len(texts):
            # Texts of some bytes, one at least.
            at = len(out)
            most = _TEXTS + (size[at - 1] if at else 0)
            out += some(texts.slice(at, max(1, int(np.searchsorted(size, most, side="right")) - at)))
        return out

    return encode, width


def token_count(text: Column, path: str) -> Column:
    """Number of ids of each text, without an end id; a null text has none."""

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode, width = encoder(path)
        for texts in batches:
            yield pd.Series([len(x) // width for x in encode(texts.tolist())], dtype="int64")

    of.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(of, "long")(text)


def _skippable(magic: int, content: bytes) -> bytes:
    return struct.pack("<II", magic, len(content)) + content


class Writer:
    """Writes one file; documents come in the order of the file."""

    def __init__(self, out: pa.NativeFile, width: int, frame_bytes: int = FRAME_BYTES) -> None:
        self.out, self.width, self.most = out, width, frame_bytes
        self.compress = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True).compress
        self.held: list[bytes] = []
        self.size = 0
        self.frames: list[tuple[int, int, int]] = []
        self.doc_ids: list[int | None] = []
        self.lengths: list[int] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(doc_id)
        self.lengths.append(len(ids) // self.width)
        self.held.append(ids)
        self.size += len(ids)
        if self.size >= self.most:
            self.flush()

    def flush(self) -> None:
        if self.held:
            data = b"".join(self.held)
            packed = self.compress(data)
            self.out.write(packed)
            self.frames.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
            self.held, self.size = [], 0

    def close(self) -> None:
        self.flush()
        lengths = np.array(self.lengths, dtype="<u8").tobytes()
        known = np.array([d is not None for d in self.doc_ids], dtype=np.uint8).tobytes()
        doc_ids = np.array([d or 0 for d in self.doc_ids], dtype="<i8").tobytes()
        head = struct.pack("<BQ", self.width, len(self.doc_ids))
        places = _skippable(_PLACES, head + zlib.compress(doc_ids + lengths + known))
        self.out.write(places)
        # The places are a frame of the table too, of no content; so a plain reader skips them.
        rows = [*self.frames, (len(places), 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF)]
        table = b"".join(struct.pack("<III", *x) for x in rows) + struct.pack("<IBI", len(rows), 0x80, _SEEKABLE)
        self.out.write(_skippable(_SKIPPABLE, table))


class Reader:
    """Reads documents of a file, and of it only the tables and the frames that hold them."""

    def __init__(self, file: pa.NativeFile) -> None:
        self.file = file
        size = file.size()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != _SEEKABLE or not flags & 0x80:
            raise ValueError("no seek table")
        raw = self._at(size - 9 - 12 * n, 12 * n)
        frames = np.frombuffer(raw, dtype="<u4").reshape(-1, 3).astype(np.int64)
        self.at = np.append(0, frames[:, 0].cumsum())
        self.packed, sizes, self.sums = frames[:-1, 0], frames[:-1, 1], frames[:-1, 2]
        places = self._at(int(self.at[n - 1]), int(frames[-1, 0]))[8:]
        self.width, docs = struct.unpack_from("<BQ", places)
        tables = zlib.decompress(places[9:])
        doc_ids, self.lengths = np.frombuffer(tables, "<i8", docs), np.frombuffer(tables, "<i8", docs, 8 * docs)
        known = np.frombuffer(tables, np.uint8, docs, 16 * docs)
        self.doc_ids = [int(d) if k else None for d, k in zip(doc_ids, known, strict=True)]
        self.starts = self.lengths.cumsum() - self.lengths
        self.frame_at = np.append(0, sizes.cumsum())
        self.held: tuple[int, bytes] = (-1, b"")

    def _at(self, place: int, n: int) -> bytes:
        self.file.seek(place)
        return self.file.read(n)

    def frame(self, i: int) -> bytes:
        if self.held[0] != i:
            data = zstandard.ZstdDecompressor().decompress(self._at(int(self.at[i]), int(self.packed[i])))
            if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.sums[i]:
                raise ValueError(f"frame {i} is damaged")
            self.held = (i, data)
        return self.held[1]

    def ids(self, number: int) -> np.ndarray:
        """Ids of the document with this number in the file."""
        start = int(self.starts[number]) * self.width
        stop = start + int(self.lengths[number]) * self.width
        # A document lies in one frame.
        i = int(np.searchsorted(self.frame_at, start, side="right")) - 1
        at = int(self.frame_at[i])
        return np.frombuffer(self.frame(i)[start - at : stop - at], dtype=f"<u{self.width}").astype("<u4")


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def write(docs: DataFrame, tokenizer: str, folder: str, files: int | None = None, end_id: int = END_ID) -> DataFrame:
    """Write ``docs(doc_id, text)`` to ``folder``; the manifest, one row per file.

    The folder is one that all executors share. ``files`` defaults to the shuffle partitions.
    """
    files = files or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"))
    dealt = rows.repartitionByRange(files, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    # The number of the range goes along: a task knows only its own rows.
    dealt = dealt.select(F.spark_partition_id().alias("part"), "doc_id", "text")
    width = encoder(tokenizer)[1]
    end = np.array([end_id], dtype=f"<u{width}").tobytes()

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _place(folder)
        encode, _ = encoder(tokenizer)
        writer = out = None
        name = temporary = ""
        for batch in batches:
            parts, doc_ids = (c.to_pylist() for c in batch.columns[:2])
            for part, doc_id, x in zip(parts, doc_ids, encode(batch.column(2)), strict=True):
                if writer is None:
                    number, name = part, f"part-{part:06d}.zst"
                    temporary = f"{root}/.{name}-{uuid.uuid4().hex}"
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(temporary, compression=None)
                    writer = Writer(out, width)
                writer.add(doc_id, x + end)
        if writer is not None:
            writer.close()
            out.close()
            store.move(temporary, f"{root}/{name}")
            real = [d for d in writer.doc_ids if d is not None]
            row = [name, number, len(writer.doc_ids), sum(writer.lengths), min(real, default=None), max(real, default=None)]
            yield pa.RecordBatch.from_pylist([dict(zip(("file", "part", "docs", "ids", "low", "high"), row, strict=True))], schema=_MANIFEST)

    return dealt.mapInArrow(put, MANIFEST)


_MANIFEST = pa.schema([("file", pa.string()), ("part", pa.int32()), *((c, pa.int64()) for c in ("docs", "ids", "low", "high"))])


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document in the files of a manifest."""
    # One row per file; the running sum is of those alone.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("start"))
    spread = files.repartition(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), "file")

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _place(folder)
        for batch in batches:
            for name, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with store.open_input_file(f"{root}/{name}") as file:
                    reader = Reader(file)
                    sums = [zlib.crc32(reader.ids(i).tobytes()) for i in range(len(reader.doc_ids))]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(reader.doc_ids, pa.int64()),
                            pa.array(reader.starts + start, pa.int64()),
                            pa.array(reader.lengths, pa.int64()),
                            pa.array(sums, pa.int64()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    return spread.mapInArrow(get, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, files: int | None = None) -> DataFrame:
    """Write ``docs`` to a new folder beside the checkpoints and read the files back."""
    spark = docs.sparkSession
    folder, listed = fresh_path(spark, "token-files"), fresh_path(spark, "token-manifest")
    write(docs, tokenizer, folder, files).write.parquet(listed)
    return read(spark.read.parquet(listed), folder)
