"""Benchmark decontamination by the q-gram lemma.

A benchmark item is taken in overlapping windows. Two texts of which one has m characters, and
that are at most k edits apart, share m + 1 - q (k + 1) of the q-grams at least, and on an
alignment of k edits all of those lie within k diagonals of each other. So shared q-grams are
counted in diagonal bands that overlap by half, bands with fewer are given up, and the regions
that are left are verified by a banded alignment: exact edit distance of the window to its best
place there. No window within its budget is missed.

Windows have 96 characters and start at every 48th. For parts of an item there are windows of 48
characters besides, which start at every word, and at every 8th character of a word longer than
that. So the smallest passage found is one of 48 characters (8 or 9 words) from the start of a
word of the item, or of 55 from any place, with a tenth of a window's characters in edits.
Shorter passages are not found, unless they are a whole item.

A text is looked at in slices of bounded length, and pairs of its places with those of the items are made
a bounded number at a time; nothing is given up in repetitive texts.

Letters are compared in lower case and any white space as a blank, one character for one, so the
places found are places in the text. Null texts have no regions; an item that is null or has
fewer than ``LEAST_CHARS`` characters takes no part; ``left_out`` tells which. Repeated items and rows are found each.
Other columns are not looked at.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Q = 8
WINDOW = 96
#: The windows that start at every word; the least characters of a passage that is found in a longer item.
PASSAGE = 48
#: Characters of a word after which a window starts inside it.
STEP = 8
#: Shorter items take no part: such a phrase stands in texts that know nothing of the benchmark.
LEAST_CHARS = 20
#: Edits allowed, as a share of a window's characters.
EDITS = 0.1
#: Most characters of the items that are indexed at a time; more items make more blocks.
BLOCK_CHARS = 750_000
#: White space other than the blank itself.
_SPACE = re.compile(r"[^\S ]")
#: Characters of a text that are looked at together, and pairs of places that are made together.
SLICE, _PAIRS = 1 << 12, 1 << 21
_BITS = 22
_FAR = 1 << 30
#: Characters of short texts that are looked at together, and what stands between them.
_GROUP = 1 << 15
_NO_LETTER = 0x110000
SCHEMA = "doc_id long, item_id long, start int, end int, distance int"


def plain(text: str) -> str:
    """``text`` in lower case with blanks for white space, character by character."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower()[0] for c in text)
    return _SPACE.sub(" ", low)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4")


def grams(codes: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of the q characters from each place on."""
    if len(codes) < q:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(len(codes) - q + 1, dtype=np.uint64)
    wide = codes.astype(np.uint64)
    for i in range(q):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += wide[i : i + len(out)] + np.uint64(1)
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out


@dataclass
class Index:
    """The windows of a block of items, and where each q-gram occurs in them."""

    q: int
    items: np.ndarray  # of each window: item id
    codes: list[np.ndarray]
    budget: np.ndarray  # edits
    least: np.ndarray  # q-grams to share
    known: np.ndarray  # hashes of q-grams, sorted
    first: np.ndarray  # of each: its places in window and offset
    window: np.ndarray
    offset: np.ndarray
    maybe: np.ndarray  # by the hash's last bits: may it be known
    number: np.ndarray  # of each window: which item of the block
    sieve: Sieve


@dataclass
class Sieve:
    """Where each known q-gram occurs in the items, and what any window of an item asks for."""

    first: np.ndarray  # of each q-gram: its places in item and offset
    item: np.ndarray
    offset: np.ndarray
    step: np.ndarray  # of each item: most edits, and one
    need: np.ndarray  # fewest q-grams to share
    reach: np.ndarray  # most characters between the first and the last


def word_starts(codes: np.ndarray, step: int = STEP) -> np.ndarray:
    """Places where a word starts, and every ``step`` characters on until the next one does."""
    blank = codes == ord(" ")
    at = np.flatnonzero(~blank & np.append(True, blank[:-1]))
    gaps = np.diff(at, append=len(codes))
    more = -(-gaps // step)
    return np.repeat(at, more) + step * (np.arange(more.sum()) - np.repeat(more.cumsum() - more, more))


def build(
    items: list[tuple[int, str]], q: int = Q, window: int = WINDOW, edits: float = EDITS, passage: int | None = None
) -> Index:
    """The index of ``items``; with ``passage``, windows of so many characters start at every word too."""
    ids, codes, wholes, number = [], [], [], []
    for item_id, text in items:
        whole = _codes(plain(text))
        if len(whole) < max(q, LEAST_CHARS):
            continue
        before = len(codes)
        last = max(0, len(whole) - window)
        for start in sorted({*range(0, last, window // 2), last}):
            ids.append(item_id)
            codes.append(whole[start : start + window])
        if passage and len(whole) > passage:
            starts = word_starts(whole)
            for start in [*starts[starts < len(whole) - passage].tolist(), len(whole) - passage]:
                ids.append(item_id)
                codes.append(whole[start : start + passage])
        number.extend([len(wholes)] * (len(codes) - before))
        wholes.append(whole)
    size = np.array([len(c) for c in codes], dtype=np.int64)
    # As many edits as leave one q-gram to share at least.
    budget = np.minimum((edits * size).astype(np.int64), np.maximum(size // q - 1, 0))
    least = size + 1 - q * (budget + 1)
    known, first, window_of, offset = _places(codes, q)
    maybe = np.zeros(1 << _BITS, dtype=bool)
    maybe[(known >> np.uint64(64 - _BITS)).astype(np.int64)] = True
    # The windows cover their items, so both tables have the same q-grams.
    _, item_first, item_of, item_offset = _places(wholes, q)
    number_of = np.array(number, dtype=np.int64)
    step, need, reach = np.zeros(len(wholes), np.int64), np.full(len(wholes), 1 << 40), np.zeros(len(wholes), np.int64)
    np.maximum.at(step, number_of, budget + 1)
    np.minimum.at(need, number_of, least)
    np.maximum.at(reach, number_of, size - q)
    sieve = Sieve(item_first, item_of, item_offset, step, need, reach)
    return Index(
        q, np.array(ids, dtype=np.int64), codes, budget, least, known, first, window_of, offset, maybe, number_of, sieve
    )


def _places(codes: list[np.ndarray], q: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The q-grams of ``codes``, sorted, and where the places of each begin; of each place, text and offset."""
    hashes = [grams(c, q) for c in codes]
    every = np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)
    order = np.argsort(every, kind="stable")
    known, first = np.unique(every[order], return_index=True)
    counts = [len(h) for h in hashes]
    text = np.repeat(np.arange(len(codes)), counts)[order]
    offset = (np.concatenate([np.arange(n) for n in counts]) if hashes else np.zeros(0, dtype=np.int64))[order]
    return known, np.append(first, len(every)), text, offset


def _ranges(first: np.ndarray, of: np.ndarray, count: int, k: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of owners (items, windows) whose places make at most ``_PAIRS`` pairs with the q-grams ``k``.

    A single owner with more is a range of its own.
    """
    if (first[k + 1] - first[k]).sum() <= _PAIRS:
        yield 0, count
        return
    each, times = np.unique(k, return_counts=True)
    n = first[each + 1] - first[each]
    place = np.repeat(first[each] - np.append(0, n.cumsum()[:-1]), n) + np.arange(n.sum())
    total = np.cumsum(np.bincount(of[place], weights=np.repeat(times, n), minlength=count))
    low = 0
    while low < count:
        before = total[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(total, before + _PAIRS, side="right")))
        yield low, high
        low = high


def _flat(
    first: np.ndarray, of: np.ndarray, k: np.ndarray, low: int, high: int, count: int
) -> tuple[np.ndarray, np.ndarray]:
    """All places of the q-grams ``k`` in owners from ``low`` to ``high``, and how many each has."""
    begin, end = first[k], first[k + 1]
    if low or high < count:
        # Places of a q-gram are sorted by owner.
        each, back = np.unique(k, return_inverse=True)
        cuts = np.array([first[g] + np.searchsorted(of[first[g] : first[g + 1]], (low, high)) for g in each.tolist()])
        begin, end = cuts[back, 0], cuts[back, 1]
    n = end - begin
    return np.repeat(begin - np.append(0, n.cumsum()[:-1]), n) + np.arange(n.sum()), n


def _sifted(sieve: Sieve, at: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Which items can have a window in a text with the q-grams ``k`` at places ``at``.

    Bands of the item's widest budget, and in one of them as many q-grams as the easiest window
    needs, no further apart than the longest window reaches: every match has that.
    """
    count = len(sieve.step)
    passed = np.zeros(count, dtype=bool)
    for low, high in _ranges(sieve.first, sieve.item, count, k):
        place, n = _flat(sieve.first, sieve.item, k, low, high, count)
        item = sieve.item[place]
        # Most items have too few places in the whole text.
        many = (np.bincount(item, minlength=count) >= sieve.need)[item]
        if not many.any():
            continue
        item, offset = item[many], sieve.offset[place[many]]
        band = (np.repeat(at, n)[many] - offset + _FAR) // sieve.step[item]
        key = (item << 32) + band
        # Few items have enough places in any two neighbouring bands; the others go before the sort by offset.
        bands, back, shared = np.unique(key, return_inverse=True, return_counts=True)
        near = np.where(np.diff(bands, append=-9) == 1, np.append(shared[1:], 0), 0)
        before = np.where(np.diff(bands, prepend=-9) == 1, np.append(0, shared[:-1]), 0)
        enough = np.maximum(shared + near, shared + before) >= sieve.need[bands >> 32]
        able = enough[back]
        key, offset = key[able], offset[able]
        key, offset = np.concatenate([key, key - 1]), np.concatenate([offset, offset])
        order = np.lexsort((offset, key))
        key, offset = key[order], offset[order]
        item = key >> 32
        last = np.arange(len(key)) + sieve.need[item] - 1
        inside = last < len(key)
        item, last = item[inside], last[inside]
        close = (key[last] == key[inside]) & (offset[last] - offset[inside] <= sieve.reach[item])
        passed[item[close]] = True
    return passed


def candidates(index: Index, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows and first diagonals of the bands that share enough q-grams with a text."""
    none = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    hashes = grams(codes, index.q)
    at = np.flatnonzero(index.maybe[(hashes >> np.uint64(64 - _BITS)).astype(np.int64)])
    if not len(at) or not len(index.known):
        return none
    k = np.minimum(np.searchsorted(index.known, hashes[at]), len(index.known) - 1)
    hit = index.known[k] == hashes[at]
    at, k = at[hit], k[hit]
    passed = _sifted(index.sieve, at, k)
    if not passed.any():
        return none
    found = []
    count = len(index.codes)
    for low, high in _ranges(index.first, index.window, count, k):
        if not passed[index.number[low:high]].any():
            continue
        place, n = _flat(index.first, index.window, k, low, high, count)
        w, diagonal = index.window[place], np.repeat(at, n) - index.offset[place] + _FAR
        able = passed[index.number[w]]
        w, diagonal = w[able], diagonal[able]
        # A step of k + 1 and bands of two steps: any k + 1 neighbouring diagonals are in one band.
        band = diagonal // (index.budget[w] + 1)
        key = np.concatenate([(w << 32) + band, (w << 32) + band - 1])
        # A place in the window counts once for each place in the text, so a repeated q-gram counts as the lemma needs.
        key, shared = np.unique(key, return_counts=True)
        found.append(key[shared >= index.least[key >> 32]])
    key = np.concatenate(found) if found else np.zeros(0, dtype=np.int64)
    w, band = key >> 32, key & 0xFFFFFFFF
    return w, band * (index.budget[w] + 1) - _FAR


def verify(
    index: Index, texts: list[np.ndarray], w: np.ndarray, diagonal: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Like ``align``; windows that stand in their text letter by letter are found without it.

    All windows of a call have one budget.
    """
    n, width = len(w), 2 * (int(index.budget[w[0]]) + 1)
    cost, start, end = np.full(n, -1, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    length = np.array([len(index.codes[i]) for i in w])
    for size in np.unique(length).tolist():
        rows = np.flatnonzero(length == size)
        pattern = np.stack([index.codes[i] for i in w[rows].tolist()])
        there = np.full((len(rows), size + width), -1, np.int64)
        for i, row in enumerate(rows.tolist()):
            left = int(diagonal[row])
            a, b = max(0, left), min(len(texts[row]), left + size + width)
            if a < b:
                there[i, a - left : b - left] = texts[row][a:b]
        same = np.ones((len(rows), width), dtype=bool)
        for j in range(size):
            same &= there[:, j : j + width] == pattern[:, j : j + 1]
        which = np.flatnonzero(same.any(axis=1))
        at = diagonal[rows[which]] + same[which].argmax(axis=1)
        cost[rows[which]], start[rows[which]], end[rows[which]] = 0, at, at + size
    left = np.flatnonzero(cost < 0)
    if len(left):
        cost[left], start[left], end[left] = align(index, [texts[i] for i in left.tolist()], w[left], diagonal[left])
    return cost, start, end


def align(index: Index, texts: list[np.ndarray], w: np.ndarray, diagonal: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least edit distance of each window to a piece of its text in its band, and the piece's ends.

    ``texts[i]`` goes with window ``w[i]``. All alignments advance together, one character of the
    windows at a time; a row holds the cells of the band, and runs over the gap of its diagonals.
    """
    n = len(w)
    k = index.budget[w]
    # Paths of k edits may leave the band's diagonals by k on either side.
    left, width = diagonal - k, int((2 * (k + 1) + 2 * k).max()) + 1
    length = np.array([len(index.codes[i]) for i in w])
    rows = int(length.max())
    pattern = np.zeros((n, rows), dtype=np.uint32)
    pad = np.zeros((n, rows + width), dtype=np.uint32)
    inside = np.zeros((n, rows + width), dtype=bool)
    for i in range(n):
        c = index.codes[w[i]]
        pattern[i, : len(c)] = c
        a, b = max(0, left[i]), min(len(texts[i]), left[i] + rows + width)
        if a < b:
            pad[i, a - left[i] : b - left[i]] = texts[i][a:b]
            inside[i, a - left[i] : b - left[i]] = True
    big = np.int16(1 << 14)
    cells = np.arange(width, dtype=np.int16)
    # Cell j of row r stands for r characters of the window and the text up to left + r + j.
    cost = np.zeros((n, width), dtype=np.int16)
    start = np.broadcast_to(cells, (n, width)).copy()
    done_cost, done_end, done_start = (np.full(n, big, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64))
    # Windows that no path can end within their budget are left behind as soon as half of them are such.
    rest = np.arange(n)
    for r in range(rows):
        text_at = pad[:, r : r + width]
        swap = cost + ((text_at != pattern[:, r : r + 1]) | ~inside[:, r : r + width])
        drop = np.full_like(cost, big)  # a character of the window is missing in the text
        drop[:, :-1] = cost[:, 1:] + 1
        drop_start = np.zeros_like(start)
        drop_start[:, :-1] = start[:, 1:]
        best = np.minimum(swap, drop)
        from_start = np.where(swap <= drop, start, drop_start)
        # A character of the text is added: cell j from cell j - 1, for one each.
        reach = best - cells
        least = np.minimum.accumulate(reach, axis=1)
        came = np.maximum.accumulate(np.where(reach == least, cells, 0), axis=1)
        cost = least + cells
        start = np.take_along_axis(from_start, came.astype(np.int64), axis=1)
        ends = np.flatnonzero(length == r + 1)
        if len(ends):
            j = cost[ends].argmin(axis=1)
            to = rest[ends]
            done_cost[to] = cost[ends, j]
            done_end[to] = left[ends] + r + 1 + j
            done_start[to] = left[ends] + start[ends, j]
        if r % 4 == 3:
            alive = np.flatnonzero((cost.min(axis=1) <= k) & (length > r + 1))
            if not len(alive):
                break
            if len(alive) < len(rest) // 2:
                rest, k, left, length, pattern, pad, inside, cost, start = (
                    x[alive] for x in (rest, k, left, length, pattern, pad, inside, cost, start)
                )
    return done_cost, done_start, done_end


def _joined(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """``(item, start, end, edits)`` with those of one item that touch made one."""
    out: list[tuple[int, int, int, int]] = []
    for x in sorted(found):
        if out and out[-1][0] == x[0] and x[1] <= out[-1][2]:
            last = out[-1]
            out[-1] = (*last[:2], max(last[2], x[2]), max(last[3], x[3]))
        else:
            out.append(x)
    return out


def regions(index: Index, texts: list[str | None], batch: int = 4096) -> Iterator[tuple[int, int, int, int, int]]:
    """``(text number, item id, start, end, edits)``: verified windows, those that touch made one.

    A text is looked at in slices that overlap by more than a window and its budget, so each match lies
    whole in one. Slices of a text that are alike, as in rules and tables, are looked at once.
    """
    waiting: dict[int, list[tuple[list, np.ndarray, int, int]]] = {}
    held = 0
    most = int(index.budget.max(initial=0))
    sizes = np.array([len(c) for c in index.codes], dtype=np.int64)
    overlap = 2 * int(sizes.max(initial=0)) + 8 * most + 8
    # Between texts that are looked at together: longer than any match can reach over from both sides.
    gap = np.full(2 * most + 2, _NO_LETTER, dtype=np.uint32)
    pieces: list[tuple[list[tuple[int, int, int, int]], list[tuple[int, int, int, int]]]] = []

    def flush() -> None:
        # Rows and bands are as large as the largest of a batch needs, so windows of one budget go together.
        for some in waiting.values():
            w, d = (np.array([x[i] for x in some], dtype=np.int64) for i in (2, 3))
            cost, start, end = verify(index, [x[1] for x in some], w, d)
            for i in np.flatnonzero(cost <= index.budget[w]).tolist():
                found, _, win, _ = some[i]
                found.append((int(index.items[win]), int(start[i]), int(end[i]), int(cost[i])))
                if len(found) > batch:
                    found[:] = _joined(found)
        waiting.clear()

    def look(piece: np.ndarray, first: bool = True, last: bool = True) -> list[tuple[int, int, int, int]]:
        nonlocal held
        found: list[tuple[int, int, int, int]] = []
        w, diagonals = candidates(index, piece)
        # What a slice's end may cut off is whole in the slice before or after it.
        whole = np.full(len(w), True) if first else diagonals >= most
        if not last:
            whole &= diagonals + 3 * index.budget[w] + 2 + sizes[w] <= len(piece)
        for win, diagonal in zip(w[whole].tolist(), diagonals[whole].tolist(), strict=True):
            waiting.setdefault(int(index.budget[win]), []).append((found, piece, win, diagonal))
            held += 1
            if held >= batch:
                flush()
                held = 0
        return found

    def together(some: list[tuple[int, np.ndarray]]) -> None:
        spans, at = [], 0
        for row, codes in some:
            spans.append((at, row, len(codes), 0))
            at += len(codes) + len(gap)
        if some:
            pieces.append((spans, look(np.concatenate([x for _, codes in some for x in (codes, gap)]))))

    short: list[tuple[int, np.ndarray]] = []
    size = 0
    for row, text in enumerate(texts):
        if not text:
            continue
        codes = _codes(plain(text))
        if len(codes) <= SLICE + overlap:
            short.append((row, codes))
            size += len(codes)
            if size >= _GROUP:
                together(short)
                short, size = [], 0
            continue
        alike: dict[tuple[bytes, bool, bool], list] = {}
        for base in range(0, len(codes) - overlap, SLICE):
            piece = codes[base : base + SLICE + overlap]
            key = piece.tobytes(), base == 0, base + SLICE >= len(codes) - overlap
            if key not in alike:
                alike[key] = look(piece, *key[1:])
            pieces.append(([(0, row, len(piece), base)], alike[key]))
    together(short)
    flush()
    whole: dict[int, list[tuple[int, int, int, int]]] = {}
    for spans, found in pieces:
        begins = [x[0] for x in spans]
        for item, a, b, c in _joined(found):
            begin, row, length, base = spans[bisect_right(begins, (a + b) // 2) - 1]
            whole.setdefault(row, []).append((item, max(0, a - begin) + base, min(b - begin, length) + base, c))
    for row in sorted(whole):
        for x in _joined(whole[row]):
            yield row, *x


def _blocks(benchmark: DataFrame, chars: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size; only one is held at a time."""
    block: list[tuple[int, str]] = []
    held = 0
    for row in benchmark.select("item_id", "text").where("item_id IS NOT NULL AND text IS NOT NULL").toLocalIterator():
        if block and held + len(row[1]) > chars:
            yield block
            block, held = [], 0
        block.append((row[0], row[1]))
        held += len(row[1])
    if block:
        yield block


def left_out(benchmark: DataFrame) -> DataFrame:
    """The items that take no part, being null or short."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return benchmark.where(F.col("item_id").isNull() | (F.length(text) < LEAST_CHARS))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    q: int = Q,
    window: int = WINDOW,
    edits: float = EDITS,
    block_chars: int = BLOCK_CHARS,
    passage: int | None = PASSAGE,
) -> DataFrame:
    """``(doc_id, item_id, start, end, distance)``: regions of ``docs(doc_id, text)`` taken from items.

    The index of a block of items is of bounded size and goes to the tasks with their function; the
    documents are read once for each block.
    """
    spark, result = docs.sparkSession, None
    for block in _blocks(benchmark, block_chars):
        index = build(block, q, window, edits, passage)

        def find(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for rows in batches:
                ids = rows.column(0)
                hits = list(regions(index, rows.column(1).to_pylist()))
                if hits:
                    row, *rest = (list(x) for x in zip(*hits, strict=True))
                    doc = ids.take(pa.array(row))
                    types = (pa.int64(), pa.int32(), pa.int32(), pa.int32())
                    rest = [pa.array(x, t) for x, t in zip(rest, types, strict=True)]
                    yield pa.RecordBatch.from_arrays([doc.cast(pa.int64()), *rest], ["doc_id", "item_id", "start", "end", "distance"])

        part = docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(find, SCHEMA)
        result = part if result is None else result.union(part)
    if result is None:
        result = spark.createDataFrame([], SCHEMA)
    return result


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, with their columns."""
    rows = docs
    for block in _blocks(benchmark, BLOCK_CHARS):
        rows = rows.where(~_holds(F.col("text"), build(block, passage=PASSAGE)))
    return rows


def _holds(text: Column, index: Index) -> Column:
    def of(texts: pd.Series) -> pd.Series:
        hit = np.zeros(len(texts), dtype=bool)
        hit[[x[0] for x in regions(index, texts.tolist())]] = True
        return pd.Series(hit)

    return F.pandas_udf(of, "boolean")(text)
