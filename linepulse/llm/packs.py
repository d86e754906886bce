"""Texts as codes of their chunks: what operators share that look at each distinct chunk once.

A pack holds the texts of a stretch of rows as numbers of the chunks that occur in it, and its own
dictionary of those. Frequent chunks have small numbers, so a number takes little more than a byte.
A pack ends at ``PACK_CHUNKS`` chunks or ``PACK_DISTINCT`` different ones; one longer text is a pack
of its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import zstandard

PACK_CHUNKS = 2_000_000
PACK_DISTINCT = 500_000
#: Characters of a text that are taken apart at a time.
SLICE = 1 << 20


class Codes(dict):
    """Numbers of chunks, in the order in which they are first met."""

    def __missing__(self, chunk: str) -> int:
        self[chunk] = number = len(self)
        return number


def shrunk(numbers: np.ndarray) -> bytes:
    """Whole numbers as compressed bytes, low bytes first and alike bytes together."""
    kind = np.dtype(f"<i{8 if numbers.dtype.itemsize == 8 else 4}")
    planes = np.ascontiguousarray(numbers, dtype=kind).view(np.uint8).reshape(-1, kind.itemsize).T
    return bytes([kind.itemsize]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def grown(data: bytes) -> np.ndarray:
    """The numbers of ``shrunk``."""
    width = data[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8)
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(f"<i{width}").reshape(-1)


def slices(text: str, boundary: re.Pattern) -> Iterator[str]:
    """``text`` in parts of about ``SLICE`` characters, each but the first begun by a match of ``boundary``."""
    at = 0
    while len(text) - at > SLICE and (found := boundary.search(text, at + SLICE)):
        yield text[at : found.start()]
        at = found.start()
    yield text[at:] if at else text


class Pack:
    """The texts of a stretch of rows, with what stands for each row."""

    def __init__(self) -> None:
        self.codes = Codes()
        self.rows: list[tuple] = []
        self.numbers: list[np.ndarray] = []
        self.chunks = 0

    def add(self, row: tuple, parts: Iterable[list[str]]) -> None:
        """A row and its chunks, given in parts."""
        found = [np.fromiter(map(self.codes.__getitem__, p), np.int32, len(p)) for p in parts]
        self.rows.append(row)
        self.numbers.append(found[0] if len(found) == 1 else np.concatenate([np.empty(0, np.int32), *found]))
        self.chunks += len(self.numbers[-1])

    @property
    def full(self) -> bool:
        return self.chunks >= PACK_CHUNKS or len(self.codes) >= PACK_DISTINCT

    def ranked(self) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The chunks by falling count, each row's number of chunks, and all numbers one after another."""
        chunks = list(self.codes)
        flat = np.concatenate([np.empty(0, np.int32), *self.numbers])
        order = np.argsort(-np.bincount(flat, minlength=len(chunks)), kind="stable")
        rank = np.empty(len(chunks), np.int32)
        rank[order] = np.arange(len(chunks), dtype=np.int32)
        return [chunks[i] for i in order.tolist()], np.array([len(x) for x in self.numbers], np.int32), rank[flat]


def places(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places of the stretches ``starts[i] .. starts[i] + lengths[i]``, one stretch after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)

