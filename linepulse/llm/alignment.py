"""Two tokenizers side by side: which tokens of the one stand for which tokens of the other.

Both read the same bytes. Offsets where tokens of both end cut the text into groups, and every token of
a group is linked with every token of the other side in it. Where tokens agree one to one, the end arrays
are equal along a diagonal: the index of the one is that of the other plus a shift. ``stretches`` probes such a
stretch in steps that double while the arrays compare equal and halve at a difference, so a stretch is
passed in a few comparisons. Where the ends differ, the side that is behind moves on until both end
together; that closes an irregular group, and the shift is taken anew.

On Spark there are three steps:

1. Texts are aligned in packs. A pack encodes each distinct chunk of its texts once; chunks are cut at blanks
   where neither tokenizer joins anything. What a pack links is kept as a dictionary of id pairs and numbers.
   Written to the shared folder.
2. The dictionaries are summed to the number of texts that hold a pair, and to each A id's greatest number.
3. Every pack gets the numbers of its own pairs and adds them up per text. A frequent pair is one row per
   pack, whatever its texts; a pack's dictionary is bounded by the pack.

A text that is null, empty, or whose tokens do not give its bytes back on either side (U+2581 is read as a
blank by piece models) has no tokens: zeros and an empty string. Repeated rows count as texts of their own,
null and repeated ids give a row each, an empty table gives no rows, other columns are not looked at. A group
may be long: its pairs are counted by distinct ids, in blocks. A text has to fit into a task's memory.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linepulse.llm import pieces
from linepulse.llm.packs import Pack, grown, places, shrunk, slices
from linepulse.scratch import stage

#: A blank with something else than a blank before it and no white space behind it.
_CUT = re.compile(r"(?<![ ▁])(?= [^\s])")
_UNSURE = re.compile(r" (?:\s|\Z)|▁ ")
#: Chunks that are put together at a time, and pairs of one group that are made at a time.
_BLOCK = 250_000
#: Chunks that are encoded as one text.
_TOGETHER = 1000
#: Printable bytes of Latin-1 that byte-level vocabularies write as they are; the others from U+0100 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}


class Pair:
    """A byte-level tokenizer A and a piece model B, and their tokens' bytes."""

    def __init__(self, a: str, b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a), pieces.model(b)
        # Special tokens' strings are plain text.
        self.a.encode_special_tokens = True
        others = (x for x in range(256) if x not in _PRINTABLE)
        letters = {chr(x): x for x in _PRINTABLE} | {chr(256 + i): x for i, x in enumerate(others)}
        size = self.a.get_vocab_size()
        names = [self.a.id_to_token(i) or "" for i in range(size)]
        self.a_bytes = [bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t in names]
        of = self.b.of
        self.b_bytes = [
            bytes([int(of.id_to_piece(i)[3:5], 16)]) if of.is_byte(i) else of.id_to_piece(i).replace(pieces.MARKER, " ").encode()
            for i in range(of.get_piece_size())
        ]
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        self.names = [f"{i}{sign}" for sign in ",|;" for i in range(max(size, len(self.b_bytes)))]
        setup = json.loads(self.a.to_str())
        split = setup["pre_tokenizer"] or {}
        # The usual byte-level split never joins a blank that a letter or sign follows with what is before it.
        usual = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
        self.apart = bool(usual) and self.b.apart and setup["normalizer"] is None and not setup["model"].get("dropout")

    def chunks(self, text: str) -> Iterator[list[str]]:
        """Blank and text in chunks whose tokens do not depend on what is around them."""
        text = " " + text
        if not self.apart:
            yield [text]
        elif _UNSURE.search(text):
            for part in slices(text, _CUT):
                yield [c for c in _CUT.split(part) if c]
        else:
            for part in slices(text, _CUT):
                yield [" " + c for c in part[1:].split(" ")]

    def encode(self, chunks: list[str]) -> tuple[list[tuple[np.ndarray, np.ndarray, np.ndarray]], np.ndarray]:
        """For both sides the number of ids of each chunk, where they begin, and the ids; and which chunks come back whole.

        Chunks are encoded many at a time, one behind another as in a text, and told apart by their bytes.
        Those that are not whole, or would join what follows, are done alone.
        """
        if not self.apart:
            return self._alone(chunks)
        alone = [i for i, c in enumerate(chunks) if c[-1] == " " or pieces.MARKER in c]
        lone = set(alone)
        rest = np.array([i for i in range(len(chunks)) if i not in lone], np.int64)
        sides, whole = self._alone([chunks[i] for i in alone])
        held = [chunks[i] for i in rest.tolist()]
        alone = np.array(alone, np.int64)
        texts = ["".join(held[i : i + _TOGETHER]) for i in range(0, len(held), _TOGETHER)]
        a = chain.from_iterable(x.ids for x in self.a.encode_batch_fast(texts, add_special_tokens=False))
        b = chain.from_iterable(self.b.of.encode([t[1:] for t in texts], num_threads=1) if texts else ())
        ends = np.cumsum(np.fromiter((len(c.encode()) for c in held), np.int64, len(held)))
        out = []
        for ids, size, (length, start, values) in zip((a, b), (self.a_size, self.b_size), sides, strict=True):
            found = np.fromiter(ids, np.int64)
            at = np.cumsum(size[found])
            last = np.searchsorted(at, ends)
            if len(ends) and (len(at) <= last[-1] or not np.array_equal(at[last], ends)):
                return self._alone(chunks)
            lengths, starts = np.empty((2, len(chunks)), np.int64)
            lengths[rest] = np.diff(last + 1, prepend=0)
            starts[rest] = last + 1 - lengths[rest]
            lengths[alone], starts[alone] = length, start + len(found)
            out.append((lengths, starts, np.concatenate([found, values])))
        data = "".join(held).encode()
        for (_, _, values), (_, _, extra), names in zip(out, sides, (self.a_bytes, self.b_bytes), strict=True):
            if b"".join(map(names.__getitem__, values[: len(values) - len(extra)].tolist())) != data:
                return self._alone(chunks)
        every = np.ones(len(chunks), bool)
        every[alone] = whole
        return out, every

    def _alone(self, chunks: list[str]) -> tuple[list[tuple[np.ndarray, np.ndarray, np.ndarray]], np.ndarray]:
        """Each chunk by itself; a chunk begins with a blank, which B puts there itself."""
        a = [x.ids for x in self.a.encode_batch_fast(chunks, add_special_tokens=False)]
        sides, whole = [], np.ones(len(chunks), bool)
        for ids, names in ((a, self.a_bytes), (self.b.segment([c[1:] for c in chunks]), self.b_bytes)):
            length = np.fromiter(map(len, ids), np.int64, len(ids))
            sides.append((length, np.cumsum(length) - length, np.fromiter(chain.from_iterable(ids), np.int64, int(length.sum()))))
            whole &= np.array([b"".join(map(names.__getitem__, x)) == c.encode() for x, c in zip(ids, chunks, strict=True)], bool)
        return sides, whole


_PAIRS: dict[tuple[str, str], Pair] = {}


def pair(a: str, b: str) -> Pair:
    if (a, b) not in _PAIRS:
        _PAIRS[a, b] = Pair(a, b)
    return _PAIRS[a, b]


def stretches(a: list[int], b: list[int]) -> tuple[list[int], list[int], list[int]]:
    """The groups of two end arrays with the same last end, in stretches.

    For each stretch the numbers of tokens up to its end, on both sides, and how many groups it has: many
    of one token on each side, or a single irregular one.
    """
    to_a: list[int] = []
    to_b: list[int] = []
    groups: list[int] = []
    i = j = 0
    n = len(a)
    while i < n:
        if a[i] == b[j]:
            # One to one along the shift j - i: probe ahead, twice as far each time.
            begin, step = i, 2
            i += 1
            j += 1
            while a[i : i + step] == b[j : j + step] and i < n:
                i, j, step = i + step, j + step, 2 * step
            if i >= n:
                i, j = n, j - (i - n)
            else:
                # The probe holds a difference: halve it down to the place.
                while step > 1:
                    step //= 2
                    if a[i : i + step] == b[j : j + step]:
                        i += step
                        j += step
            groups.append(i - begin)
        else:
            x, y = a[i], b[j]
            while x != y:
                if x < y:
                    i += 1
                    x = a[i]
                else:
                    j += 1
                    y = b[j]
            i += 1
            j += 1
            groups.append(1)
        to_a.append(i)
        to_b.append(j)
    return to_a, to_b, groups


def cuts(a: list[int], b: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """For each group the number of tokens up to its end, on both sides."""
    to_a, to_b, groups = (np.array(x, np.int64) for x in stretches(a, b))
    # Inside a stretch of one-token groups both sides go up by one.
    return places(to_a - groups + 1, groups), places(to_b - groups + 1, groups)


def _written(names: list[str], a: np.ndarray, b: np.ndarray, to_a: np.ndarray, to_b: np.ndarray) -> str:
    """Groups as text, ``a1,a2|b1;a3|b2,b3``; ``names`` has each id with each of the signs that may follow."""
    size = len(names) // 3
    m, n = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
    after_a, after_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    after_a[to_a - 1], after_b[to_b - 1] = size, 2 * size
    line = np.empty(len(a) + len(b), np.int64)
    # Before a token of A stand all B tokens of earlier groups; before one of B the A tokens up to its own.
    line[np.arange(len(a)) + np.repeat(to_b - n, m)] = a + after_a
    line[np.arange(len(b)) + np.repeat(to_a, n)] = b + after_b
    return "".join(map(names.__getitem__, line.tolist()))[:-1]


def _linked(a: np.ndarray, b: np.ndarray, to_a: np.ndarray, to_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct linked id pairs of a text as one number each, and how many occurrences are linked."""
    m, n = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
    keys, times = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    size = m * n
    large = size > _BLOCK
    at = np.append(0, np.cumsum(np.where(large, 0, size)))
    first = 0
    while first < len(m):
        last = max(first + 1, int(np.searchsorted(at, at[first] + _BLOCK, side="right")) - 1)
        here = np.arange(first, last)[~large[first:last]]
        mm, nn = m[here], n[here]
        # Every A token of a group, once for each B token of it.
        of_a = places(to_a[here] - mm, mm)
        per = np.repeat(nn, mm)
        left = np.repeat(a[of_a], per)
        right = b[places(np.repeat(to_b[here] - nn, mm), per)]
        k, t = np.unique(left << 32 | right, return_counts=True)
        keys.append(k)
        times.append(t)
        first = last
    for g in np.nonzero(large)[0].tolist():
        ka, ta = np.unique(a[to_a[g] - m[g] : to_a[g]], return_counts=True)
        kb, tb = np.unique(b[to_b[g] - n[g] : to_b[g]], return_counts=True)
        step = max(1, _BLOCK // len(kb))
        for s in range(0, len(ka), step):
            keys.append((ka[s : s + step, None] << 32 | kb).ravel())
            times.append((ta[s : s + step, None] * tb).ravel())
    if len(keys) == 2:
        return keys[1], times[1]
    unique, where = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(unique), np.int64)
    np.add.at(total, where, np.concatenate(times))
    return unique, total


_FIGURES = ["n_a", "n_b", "n_groups", "n_links"]
_PACK = (
    "pack string, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups array<string>, pairs array<long>, texts array<long>, codes binary, times binary, sizes binary"
)
_PACK_SCHEMA = pa.schema([
    ("pack", pa.string()), *((c, pa.list_(pa.int64())) for c in ("doc_ids", *_FIGURES)), ("groups", pa.list_(pa.string())),
    *((c, pa.list_(pa.int64())) for c in ("pairs", "texts")), *((c, pa.binary()) for c in ("codes", "times", "sizes")),
])


def _aligned(a_path: str, b_path: str, written: Callable[[str], str]):
    """Step 1: ``(doc_id, text)`` to packs."""

    def rows(pack: Pack, number: int) -> pa.RecordBatch:
        of = pair(a_path, b_path)
        chunks, counts, flat = pack.ranked()
        sides, whole = of.encode(chunks)
        ends = np.append(0, np.cumsum(counts.astype(np.int64)))
        columns: dict[str, list] = {c: [] for c in ("doc_ids", *_FIGURES, "groups")}
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for t, (doc_id,) in enumerate(pack.rows):
            here = flat[ends[t] : ends[t + 1]]
            if not len(here) or not whole[here].all():
                line, figures, links = "", [0, 0, 0, 0], (np.empty(0, np.int64), np.empty(0, np.int64))
            else:
                a, b = (values[places(start[here], length[here])] for length, start, values in sides)
                to_a, to_b = cuts(np.cumsum(of.a_size[a]).tolist(), np.cumsum(of.b_size[b]).tolist())
                line = _written(of.names, a, b, to_a, to_b)
                links = _linked(a, b, to_a, to_b)
                figures = [len(a), len(b), len(to_a), int(links[1].sum())]
            found.append(links)
            for c, x in zip(columns, [doc_id, *figures, written(line)], strict=True):
                columns[c].append(x)
        pairs, codes, texts = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True, return_counts=True)
        packed = [shrunk(x) for x in (codes.astype(np.int32), np.concatenate([t for _, t in found]), np.array([len(k) for k, _ in found], np.int64))]
        digest = hashlib.sha256(b"".join([pairs.tobytes(), *packed, repr(columns["doc_ids"]).encode()])).hexdigest()[:32]
        name = f"{TaskContext.get().partitionId()}-{number}-{digest}"
        row = {"pack": name, **columns, "pairs": pairs, "texts": texts, **dict(zip(("codes", "times", "sizes"), packed, strict=True))}
        return pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in _PACK_SCHEMA], schema=_PACK_SCHEMA)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, held, number = pair(a_path, b_path), Pack(), 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py() or ""
                held.add((doc_id,), of.chunks(text) if text else ())
                if held.full:
                    yield rows(held, number)
                    held, number = Pack(), number + 1
        if held.rows:
            yield rows(held, number)

    return align


_OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
_OUT_SCHEMA = pa.schema([*((c, pa.int64()) for c in ("doc_id", *_FIGURES, "n_best", "count_sum")), ("groups", pa.string())])


def _summed(packs: pa.Table, numbers: pa.Table) -> pa.Table:
    """Step 3: one pack, and the numbers of its pairs."""
    if packs.num_rows != 1:
        raise RuntimeError("a pack is not whole: its rows changed while the job ran")
    row = {c: packs.column(c)[0].as_py() for c in packs.column_names}
    n = numbers.num_rows
    count, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
    code = numbers.column("code").to_numpy()
    count[code] = numbers.column("holds").to_numpy()
    best[code] = numbers.column("best").to_numpy()
    codes, times, sizes = (grown(row[c]).astype(np.int64) for c in ("codes", "times", "sizes"))
    ends = np.cumsum(sizes)
    sums = []
    for value in (best, count):
        total = np.append(0, np.cumsum(value[codes] * times))
        sums.append(total[ends] - total[ends - sizes])
    columns = [row["doc_ids"], *(row[c] for c in _FIGURES), *sums, row["groups"]]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _OUT_SCHEMA, strict=True)], schema=_OUT_SCHEMA)


def pair_counts(packs: DataFrame) -> DataFrame:
    """Step 2: ``(pair, holds, best)``: in how many texts a pair is linked, and whether no pair of its A id is in more."""
    held = packs.select(F.inline(F.arrays_zip("pairs", "texts"))).groupBy("pairs").agg(F.sum("texts").alias("holds"))
    held = stage(held, "pair-counts")
    first = F.shiftright("pairs", 32)
    most = held.groupBy(first.alias("a")).agg(F.max("holds").alias("most"))
    # At most one row for each id of A's vocabulary.
    best = (F.col("holds") == F.col("most")).cast("long")
    return held.join(F.broadcast(most), first == F.col("a")).select(F.col("pairs").alias("pair"), "holds", best.alias("best"))


def align(docs: DataFrame, a: str, b: str, digest: bool = False) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: the numbers of tokens, groups and links, and the groups as text.

    ``a`` is a byte-level tokenizer's file, ``b`` a piece model's. ``n_best`` counts the links whose pair is
    in as many texts as any pair of its A id, ``count_sum`` adds up the pairs' numbers of texts over links.
    ``digest`` gives the groups' sha256 in place of the text, which is several times the text's length.
    """

    def written(line: str) -> str:
        return hashlib.sha256(line.encode()).hexdigest() if digest and line else line

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    packs = stage(rows.mapInArrow(_aligned(a, b, written), _PACK), "aligned")
    counts = pair_counts(packs)
    wanted = packs.select("pack", F.posexplode("pairs").alias("code", "pair"))
    numbers = wanted.join(counts, "pair").select(F.col("pack").alias("of"), "code", "holds", "best")
    kept = packs.drop("pairs", "texts")
    return kept.groupBy("pack").cogroup(numbers.groupBy("of")).applyInArrow(_summed, _OUT)
