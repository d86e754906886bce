"""Runs of words: stretches that repeat with a period, as long as they go.

A run has its smallest period, is at least twice as long as that and at least ``LEAST`` words, and
no neighbouring word extends it. Every run begins one of its periods with a Lyndon word that is the
longest at its place under the order of the words or under the reversed one. So:

1. Baier's grouping, the first phase of his suffix sorter, gives each place's longest Lyndon word:
   suffixes are grouped by first word; from the greatest group down, each member appends its group's
   context to the nearest place before it that is in a lower group, and places that got the same
   go on to a group of their own. The length of a place's context in the end is the Lyndon array.
   Once per order.
2. Each Lyndon word is a root: the longest common extension of its place and the place a period
   later, to the right and to the left, gives the run. A root inside a run already found is passed.

Only stretches that can hold a run are looked at. A run of period q has at least max(LEAST, 2q) words,
so the part in which words equal those a period later, and that in which they equal those a period
before, have LEAST / 2 words or more and together are all of it: each of its words lies in a sequence of
LEAST / 2 words that the text has twice. Stretches of such words therefore hold runs whole.

Work is linear but for the extensions, texts are independent, and nothing is shuffled. A null or empty
text has no runs and an empty rest; repeated rows and ids give a row each; an empty table gives no rows.
Other columns are not looked at. A text has to fit into a task's memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linepulse.llm.packs import Codes

LEAST = 12
#: Words of texts that are looked at together.
_TOGETHER = 500_000
_MIX, _APART = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def lyndon_array(symbols: list[int], count: int) -> list[int]:
    """The length of the longest Lyndon word at each place; symbols are 0 to ``count`` - 1.

    Places before the current one that are still in lower groups form a linked list, so the nearest
    of them is at hand; each place is taken out once and hands on its context once.
    """
    n = len(symbols)
    group = list(symbols)
    members: list[list[int]] = [[] for _ in range(count)]
    for i, s in enumerate(symbols):
        members[s].append(i)
    length = [1] * count
    below, above = list(range(-1, count - 1)), [*range(1, count), -1]
    before, after = list(range(-1, n)), list(range(1, n + 2))
    found = [0] * n
    at = count - 1
    while at >= 0:
        context = length[at]
        got: dict[int, int] = {}
        for i in members[at]:
            if group[i] == at:
                found[i] = context
                p, q = before[i], after[i]
                before[q] = p
                if p >= 0:
                    after[p] = q
                    got[p] = got.get(p, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for p, times in got.items():
            moved.setdefault((times, group[p]), []).append(p)
        # Who got more goes higher: each new group comes right above its old one.
        for key in sorted(moved, reverse=True) if len(moved) > 1 else moved:
            times, old = key
            new, up = len(length), above[old]
            length.append(length[old] + times * context)
            members.append(moved[key])
            below.append(old)
            above.append(up)
            above[old] = new
            if up >= 0:
                below[up] = new
            for p in moved[key]:
                group[p] = new
        members[at] = []
        at = below[at]
    return found


def _extension(data: bytes, reverse: bytes, i: int, j: int, n: int) -> tuple[int, int]:
    """How far the places i < j agree to the right, and those before them to the left."""
    return _common(data, i, j, n - j), _common(reverse, n - j, n - i, i)


def _common(data: bytes, x: int, y: int, most: int) -> int:
    """Length of the longest common stretch of four-byte symbols from x and from y on, up to ``most``."""
    done, step = 0, 1
    while done < most:
        step = min(step, most - done)
        a, b = 4 * (x + done), 4 * (y + done)
        if data[a : a + 4 * step] == data[b : b + 4 * step]:
            done += step
            step *= 2
        elif step == 1:
            break
        else:
            most = done + step - 1
            step = max(1, step // 2)
    return done


def runs_of(symbols: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run, by start and period."""
    n = len(symbols)
    _, codes = np.unique(symbols, return_inverse=True)
    codes = codes.astype(np.int32)
    count = int(codes.max()) + 1 if n else 0
    data, reverse = codes.tobytes(), codes[::-1].tobytes()
    found: set[tuple[int, int, int]] = set()
    for order in (codes, count - 1 - codes):
        root = np.array(lyndon_array(order.tolist(), count), np.int64)
        place = np.arange(n)
        later = np.minimum(place + root, n - 1)
        ahead = (place + root < n) & (codes[later] == codes)
        back = (place > 0) & (codes[later - (place + root < n)] == codes[place - 1])
        back &= later - (place + root < n) == place + root - 1
        ends: dict[int, int] = {}
        maybe = np.nonzero((ahead | back) & (2 * root <= n))[0]
        for i, p in zip(maybe.tolist(), root[maybe].tolist(), strict=True):
            if ends.get(p, 0) >= i + p:
                continue
            right, left = _extension(data, reverse, i, i + p, n)
            size = left + p + right
            if size >= 2 * p:
                ends[p] = i + p + right
                if size >= least:
                    found.add((i - left, size, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _stretches(codes: np.ndarray, texts: np.ndarray, width: int) -> Iterator[tuple[int, int]]:
    """Stretches of words, each inside one text, that lie in sequences of ``width`` words which their text repeats."""
    last = len(codes) - width + 1
    if last < 1:
        return
    key = texts[:last].astype(np.uint64) * _APART
    with np.errstate(over="ignore"):
        for k in range(width):
            key = (key ^ codes[k : k + last].astype(np.uint64)) * _MIX
            key ^= key >> np.uint64(29)
    inside = texts[:last] == texts[width - 1 :]
    ordered = np.sort(key[inside])
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return
    at = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
    begins = np.nonzero(inside & (twice[at] == key))[0]
    steps = np.zeros(len(codes) + 1, np.int64)
    np.add.at(steps, begins, 1)
    np.add.at(steps, begins + width, -1)
    covered = np.cumsum(steps[:-1]) > 0
    edge = covered[1:] & covered[:-1] & (texts[1:] == texts[:-1])
    starts = np.nonzero(covered & ~np.append(False, edge))[0]
    stops = np.nonzero(covered & ~np.append(edge, False))[0] + 1
    yield from zip(starts.tolist(), stops.tolist(), strict=True)


def find(texts: list[bytes], least: int = LEAST) -> list[tuple[list[tuple[int, int, int]], bytes]]:
    """The runs of each text, and the text without repeats: words of a run after its first period go."""
    codes, words = Codes(), [t.split() for t in texts]  # bytes are split at the six ASCII white-space characters
    sizes = np.array([len(w) for w in words], np.int64)
    flat = np.concatenate([np.empty(0, np.int64), *(np.fromiter(map(codes.__getitem__, w), np.int64, len(w)) for w in words)])
    owner, first = np.repeat(np.arange(len(words)), sizes), np.cumsum(sizes) - sizes
    found: list[list[tuple[int, int, int]]] = [[] for _ in words]
    for start, stop in _stretches(flat, owner, (least + 1) // 2):
        if stop - start >= least:
            t = int(owner[start])
            shift = start - int(first[t])
            found[t] += [(s + shift, size, p) for s, size, p in runs_of(flat[start:stop], least)]
    rest = []
    for w, runs in zip(words, found, strict=True):
        if runs:
            steps = np.zeros(len(w) + 1, np.int64)
            for s, size, p in runs:
                steps[s + p] += 1
                steps[s + size] -= 1
            w = [w[i] for i in np.nonzero(np.cumsum(steps[:-1]) == 0)[0].tolist()]
        rest.append(b" ".join(w))
    return list(zip(found, rest, strict=True))


_RUN = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
_OUT = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])


def runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``(doc_id long, runs array<struct<start, length, period>>, collapsed string)`` of ``docs(doc_id, text)``.

    Words are numbered from 0, runs come by start and then period. ``collapsed`` is the words that
    no run repeats, joined by one blank.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            at, size, held = 0, 0, []
            for i in range(batch.num_rows):
                held.append((texts[i].as_py() or "").encode())
                size += len(held[-1]) // 5
                if size >= _TOGETHER or i + 1 == batch.num_rows:
                    out = find(held, least)
                    lists = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in found] for found, _ in out]
                    columns = [ids.slice(at, len(held)), pa.array(lists, pa.list_(_RUN)), pa.array([x.decode() for _, x in out])]
                    yield pa.RecordBatch.from_arrays(columns, schema=_OUT)
                    at, size, held = i + 1, 0, []

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(rows, "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
