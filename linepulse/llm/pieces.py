"""Piece tokenizers: every text as ids and back, with each distinct marked word segmented once.

Blanks become markers and the text gets one in front. Where no piece has a marker behind another
character, no merge reaches across the start of a run of markers, so a text's ids are those of its
marked words (a run of markers and what follows it up to the next run) one after another. ``chunked``
makes the table of distinct marked words, and joins their ids back by position.

Texts of a model whose pieces do cross markers, or whose normalizer does more than mark blanks, are one
chunk each; the results are the same.

A null text is an empty one: no ids, empty text. Repeated rows, null and repeated ids give a row each.
U+2581 in a text is a marker like a blank's and is decoded to a blank, as the library does. An empty
table gives no rows. Other columns are not looked at. A text has to fit into a task's memory.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from linepulse.llm.chunked import encoded
from linepulse.llm.packs import slices

MARKER = "▁"
_RUN = re.compile(r"(?<! ) ")
_MARKED = re.compile(r" +[^ ]*")


class Model:
    """A model file, and what it does with a marked word."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.of = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = map(self.of.id_to_piece, range(self.of.get_piece_size()))
        odd = "A  b ①ﬁ \t　é"
        plain = self.of.normalize(odd) == MARKER + odd.replace(" ", MARKER)
        self.apart = plain and not any(re.search(f"[^{MARKER}]{MARKER}", p) for p in pieces)
        # A text that ends in a blank ends in a marker alone.
        self.marker = self.of.encode("a ")[len(self.of.encode("a")) :]

    def chunks(self, text: str) -> Iterator[list[str]]:
        """The marked words of a text in order, each without its first marker, in parts."""
        if not text:
            return
        if not self.apart:
            yield [text]
            return
        for part in slices(" " + text.replace(MARKER, " "), _RUN):
            yield [c[1:] for c in _MARKED.findall(part)] if "  " in part else part[1:].split(" ")

    def segment(self, chunks: list[str]) -> list[list[int]]:
        """Ids of each chunk: the library puts back the marker before it."""
        found = self.of.encode(chunks, num_threads=1) if chunks else []
        return [ids if c else self.marker for c, ids in zip(chunks, found, strict=True)]


#: A worker keeps its models from task to task.
_MODELS: dict[str, Model] = {}


def model(path: str) -> Model:
    if path not in _MODELS:
        _MODELS[path] = Model(path)
    return _MODELS[path]


_OUT = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("text", pa.string())])


def _decoded(path: str, doc_ids: pa.Array, ends: np.ndarray, ids: np.ndarray) -> list[pa.Array]:
    lists = [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)]
    texts = model(path).of.decode(lists, num_threads=1)
    return [doc_ids, pa.ListArray.from_arrays(ends.astype(np.int32), ids), pa.array(texts, pa.string())]


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id long, ids array<int>, text string)`` of every row of ``docs(doc_id, text)``.

    ``ids`` is what the library's encode gives, without begin and end ids; ``text`` what its decode
    makes of them.
    """
    ddl = "doc_id long, ids array<int>, text string"
    return encoded(docs, partial(model, path), partial(_decoded, path), _OUT, ddl)
