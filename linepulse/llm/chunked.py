"""Ids of texts with each distinct chunk of the corpus encoded once.

For tokenizers that never join anything across certain places of a text, so that a text's ids are those of
its chunks one after another. Three steps follow one another, with two shuffles and without a join:

1. texts become packs of numbers and a dictionary of chunks (``packs``); a dictionary is dealt over
   buckets by the chunks' hashes,
2. a bucket encodes each distinct chunk of the corpus once and answers every pack,
3. the numbers, made once more from the texts, meet the answers: a pack puts the ids of its texts
   together by position. Making numbers twice costs less than carrying them through the shuffle of the
   chunks.

A frequent chunk costs one entry per pack, however often it occurs, so no bucket grows with it. A task
holds one pack and one bucket's distinct chunks.

Rows are sorted within their partition first, so both times, and in a repeated task, packs are alike.
They are named by what they hold and checked to be whole: a table whose partitions change between two
readings fails the job rather than mixing two versions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linepulse.llm.packs import Pack, grown, places, shrunk

#: Buckets of chunks per partition: a bucket's table goes before the next one comes.
BUCKETS = 8
#: Chunks and ids that are put together, and ids that are returned, at a time.
_BLOCK = 500_000
_ROWS = "bucket int, pack string, kind int, codes binary, lengths binary, body binary"
_SCHEMA = pa.schema([("bucket", pa.int32()), ("pack", pa.string()), ("kind", pa.int32()), *((c, pa.binary()) for c in ("codes", "lengths", "body"))])
_WORDS, _TEXTS = 0, 1


class Encoder(Protocol):
    """A tokenizer, and what it does with the chunks of a text."""

    def chunks(self, text: str) -> Iterator[list[str]]:
        """The chunks of a text in order, in parts."""

    def segment(self, chunks: list[str]) -> list[list[int]]:
        """Ids of each chunk."""


def _packed(load: Callable[[], Encoder], buckets: int, kind: int):
    """Step 1: ``(doc_id, text)`` to the dictionaries of packs, by bucket, or to the numbers of packs."""

    def rows(pack: Pack) -> Iterator[pa.RecordBatch]:
        chunks, counts, flat = pack.ranked()
        ids = np.array([i or 0 for (i,) in pack.rows], np.int64)
        known = np.array([i is not None for (i,) in pack.rows], np.int64)
        texts = [shrunk(flat), shrunk(counts), shrunk(np.concatenate([ids, known]))]
        words = [c.encode() for c in chunks]
        name = hashlib.sha256(b"".join([*texts, *words])).hexdigest()[:32]
        table = []
        if kind == _TEXTS:
            table.append([0, name, _TEXTS, *texts])
        else:
            at = np.fromiter((xxhash.xxh32_intdigest(w) for w in words), np.int64, len(words)) % buckets
            order = np.argsort(at, kind="stable")
            ends = np.searchsorted(at[order], np.arange(buckets + 1))
            for b in np.unique(at).tolist():
                mine = order[ends[b] : ends[b + 1]]
                held = [words[i] for i in mine.tolist()]
                sizes = np.fromiter(map(len, held), np.int32, len(held))
                body = zstandard.ZstdCompressor(level=1).compress(b"".join(held))
                table.append([b, name, _WORDS, shrunk(np.diff(mine, prepend=0)), shrunk(sizes), body])
        if table:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*table, strict=True), _SCHEMA, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, held = load(), Pack()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held.add((doc_id,), of.chunks(text.as_py() or ""))
                if held.full:
                    yield from rows(held)
                    held = Pack()
        if held.rows:
            yield from rows(held)

    return pack


def _cut(body: bytes, sizes: np.ndarray) -> list[str]:
    data, ends = zstandard.ZstdDecompressor().decompress(body), np.cumsum(sizes).tolist()
    return [data[a:b].decode() for a, b in zip([0, *ends], ends, strict=False)]


def _segmented(load: Callable[[], Encoder]):
    """Step 2: dictionaries, sorted by bucket, to the ids of their words."""

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, at, known = load(), None, {}
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != at:
                    at, known = row["bucket"], {}
                words = _cut(row["body"], grown(row["lengths"]))
                new = [w for w in words if w not in known]
                known.update(zip(new, (np.array(x, np.int32).tobytes() for x in of.segment(new)), strict=True))
                ids = [known[w] for w in words]
                row["lengths"] = shrunk(np.fromiter(map(len, ids), np.int32, len(ids)) // 4)
                row["body"] = shrunk(np.frombuffer(b"".join(ids), np.int32))
                yield pa.RecordBatch.from_pylist([row], schema=_SCHEMA)

    return segment


def _assembled(finish: Callable, schema: pa.Schema):
    """Step 3: rows sorted by pack, its words first, to what ``finish(doc_ids, ends, ids)`` makes of its rows."""

    def texts(row: dict, answers: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        flat, counts, rows = grown(row["codes"]), grown(row["lengths"]).astype(np.int64), grown(row["body"])
        codes, lengths, ids = (np.concatenate([np.empty(0, np.int64), *x]) for x in zip(*answers, strict=True)) if answers else (np.empty(0, np.int64),) * 3
        # Two packs of the same rows have one name, and the same answers twice.
        if not np.array_equal(np.unique(codes), np.arange(flat.max(initial=-1) + 1)):
            raise RuntimeError(f"pack {row['pack']} is not whole: its rows changed while the job ran")
        start, length = np.empty((2, flat.max(initial=-1) + 1), np.int64)
        start[codes.astype(np.int64)] = np.cumsum(lengths) - lengths
        length[codes.astype(np.int64)] = lengths
        ids = ids.astype(np.int32)
        n = len(counts)
        ends = np.append(0, np.cumsum(counts))
        first = 0
        while first < n:
            # Rows of about a block of chunks, one at least.
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + _BLOCK, side="right")) - 1)
            here = flat[ends[first] : ends[last]]
            took = np.append(0, np.cumsum(length[here]))[ends[first : last + 1] - ends[first]]
            found = ids[places(start[here], length[here])]
            doc_ids = pa.array(rows[first:last], mask=rows[n + first : n + last] == 0)
            yield pa.RecordBatch.from_arrays(finish(doc_ids, took, found), schema=schema)
            first = last

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, answers = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["pack"] != at:
                    at, answers = row["pack"], []
                if row["kind"] == _WORDS:
                    answers.append((np.cumsum(grown(row["codes"])), grown(row["lengths"]), grown(row["body"])))
                else:
                    yield from texts(row, answers)

    return assemble


def encoded(docs: DataFrame, load: Callable[[], Encoder], finish: Callable, schema: pa.Schema, ddl: str) -> DataFrame:
    """What ``finish`` makes of the ids of every row of ``docs(doc_id, text)``; a null text is an empty one.

    ``load`` gives a worker its tokenizer. ``finish`` gets the doc_ids of some rows, the places where each
    row's ids begin and end, and the ids, and returns the columns of ``schema``, which ``ddl`` is too.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.sortWithinPartitions("doc_id", F.xxhash64("text"))
    words = rows.mapInArrow(_packed(load, BUCKETS * parts, _WORDS), _ROWS)
    dealt = words.repartitionById(parts, F.col("bucket") % parts).sortWithinPartitions("bucket")
    answered = dealt.mapInArrow(_segmented(load), _ROWS)
    texts = rows.mapInArrow(_packed(load, BUCKETS * parts, _TEXTS), _ROWS)
    back = answered.union(texts).repartition(parts, "pack").sortWithinPartitions("pack", "kind")
    return back.mapInArrow(_assembled(finish, schema), ddl)
