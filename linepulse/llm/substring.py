"""Passages that repeat across documents, by content-defined chunking.

A gear hash rolls over the bytes of a text, and a chunk ends where it is small. The hash knows
only the last 32 bytes, so after an insertion the chunks fall into step again. Chunks are small
against the passages looked for, and equal ones are found by digest: of two neighbours together, so
a chunk joins the next only where an earlier document has them one after the other as well. Such pairs,
one after another with enough words together, make a repeated span.

The first document in order of doc_id keeps its copy. Rows of one doc_id are one document; a row without
an id is one by itself, equal texts being one, and comes first. What repeats inside a document is left
alone. Spans belong to a row's text, which ``text_hash`` names, so different texts of one id are cut
apart. Null and empty texts have no chunks. Places are those of bytes in UTF-8, on chunk borders: the ends of a passage
that lie in mixed chunks are not part of the span. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linepulse.llm.common import free_name
from linepulse.scratch import stage

#: One place in so many ends a chunk, but none within LEAST bytes of the place before.
EVERY = 16
LEAST = 8
MOST = 256
#: Words that a repeated span has at least.
WORDS = 20
_MEMORY = 32
#: A fixed value for each byte: a hash of it.
_GEAR = np.array([xxhash.xxh32_intdigest(bytes([i]), 42) for i in range(256)], dtype=np.uint32)
_SPACE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))


def chunk_ends(raw: bytes, every: int = EVERY, least: int = LEAST, most: int = MOST) -> np.ndarray:
    """Ends of the chunks of ``raw``; the last is its length."""
    n = len(raw)
    if not n:
        return np.zeros(0, dtype=np.int64)
    # h[i] is the sum of gear[raw[i - j]] << j over the last 32 bytes, by doubling.
    h = _GEAR[np.frombuffer(raw, dtype=np.uint8)]
    span = 1
    while span < _MEMORY:
        h[span:] += h[:-span].copy() << np.uint32(span)
        span *= 2
    ends = np.flatnonzero(h < np.uint32((1 << 32) // every)) + 1
    ends = ends[np.diff(ends, prepend=-least) >= least]
    ends = np.append(ends[ends < n], n)
    starts = np.append(0, ends[:-1])
    pieces = -(-(ends - starts) // most)
    if pieces.max() > 1:
        within = np.arange(pieces.sum()) - np.repeat(pieces.cumsum() - pieces, pieces)
        ends = np.minimum(np.repeat(starts, pieces) + (within + 1) * most, np.repeat(ends, pieces))
    return ends


def chunks(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Digests, starts, ends and words of the chunks; a word counts where its white space is."""
    raw = text.encode("utf-8", "replace")
    ends = chunk_ends(raw)
    if not len(ends):
        return (ends,) * 4
    starts = np.append(0, ends[:-1])
    digest = xxhash.xxh3_64_intdigest
    digests = np.fromiter((digest(raw[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)), "<u8", len(ends))
    spaces = np.append(0, _SPACE[np.frombuffer(raw, dtype=np.uint8)].cumsum())
    return digests.view("<i8"), starts, ends, spaces[ends] - spaces[starts]


_PAIRS = pa.schema([("digest", pa.int64()), ("doc_id", pa.int64()), ("text_hash", pa.int64()), *((c, pa.int32()) for c in ("start", "middle", "end", "words", "more"))])


def _pairs(text: str) -> tuple[np.ndarray, ...]:
    """Of neighbouring chunks together: digest, start, middle, end, and the words of the first and the second."""
    digests, starts, ends, words = chunks(text)
    both = digests[:-1].astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    both = (both ^ (both >> np.uint64(32))) + digests[1:].astype(np.int64).view(np.uint64)
    return both.view(np.int64), starts[:-1], ends[:-1], ends[1:], words[:-1], words[1:]


def _columns(batch: pa.RecordBatch, each_once: bool) -> Iterator[pa.RecordBatch]:
    parts = [_pairs(t or "") for t in batch.column(2).to_pylist()]
    if each_once:
        digests = [np.unique(p[0]) for p in parts]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(digests).astype(np.int64))], ["digest"])
        return
    rows = pa.array(np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts]))
    digests, *places = (np.concatenate([p[i] for p in parts]) for i in range(6))
    columns = [pa.array(digests.astype(np.int64)), batch.column(0).take(rows), batch.column(1).take(rows)]
    yield pa.RecordBatch.from_arrays([*columns, *(pa.array(x.astype(np.int32)) for x in places)], schema=_PAIRS)


def repeats(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``(doc_id, text_hash, start, end, words, first_doc_id)``: spans that documents before have as well."""
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from _columns(b, each_once=True)

    def all_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from _columns(b, each_once=False)

    # Texts are read twice: that moves less than keeping every pair would.
    seen = rows.mapInArrow(once, "digest long").groupBy("digest").count()
    shared = seen.where("count > 1").select("digest")
    kinds = "digest long, doc_id long, text_hash long, start int, middle int, end int, words int, more int"
    found = stage(rows.mapInArrow(all_of, kinds).join(shared, "digest"), "chunks")
    # The hash tells rows without an id apart.
    which = F.struct("doc_id", F.when(F.col("doc_id").isNull(), F.col("text_hash")).alias("text"))
    first = found.groupBy("digest").agg(F.min(which).alias("first"))
    later = found.join(first, "digest").where(which != F.col("first"))
    later = later.dropDuplicates(["doc_id", "text_hash", "start", "digest"])
    order = Window.partitionBy("doc_id", "text_hash").orderBy("start")
    starts = (F.col("start") != F.lag("middle", 1, -1).over(order)).cast("int")
    runs = later.withColumn("starts", starts).withColumn("run", F.sum("starts").over(order))
    return (
        runs.groupBy("doc_id", "text_hash", "run")
        .agg(
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            (F.min_by("words", "start") + F.sum("more")).alias("words"),
            F.min("first.doc_id").alias("first_doc_id"),
        )
        .where(F.col("words") >= words)
        .select("doc_id", "text_hash", "start", "end", "words", "first_doc_id")
    )


def without_repeats(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the ``spans`` of :func:`repeats` cut out of their texts."""
    of, cut = free_name(docs, "span_of"), free_name(docs, "span_cut")
    text_of = free_name(docs, "span_text")
    each = spans.groupBy(F.col("doc_id").alias(of), F.col("text_hash").alias(text_of)).agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias(cut)
    )
    same = docs["doc_id"].cast("long").eqNullSafe(each[of]) & (F.xxhash64(docs["text"]) == each[text_of])
    rows = docs.join(each, same, "left")

    def left(texts: pd.Series, cuts: pd.Series) -> pd.Series:
        out = []
        for text, spans_of in zip(texts, cuts, strict=True):
            if spans_of is None or text is None:
                out.append(text)
                continue
            raw, at, kept = text.encode("utf-8", "replace"), 0, []
            for s in spans_of:
                kept.append(raw[at : s["start"]])
                at = s["end"]
            out.append(b"".join([*kept, raw[at:]]).decode("utf-8", "ignore"))
        return pd.Series(out, dtype=object)

    text = F.pandas_udf(left, "string")(F.col("text"), F.col(cut))
    return rows.select(*[text.alias(c) if c == "text" else F.col(c) for c in docs.columns])
