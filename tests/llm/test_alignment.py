"""Groups and links against a plain walk over the bytes."""

from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import frame  # noqa: F401
from tokenizers import Tokenizer

from linepulse.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
byte_level = Tokenizer.from_file(A)
byte_level.encode_special_tokens = True
pieces = sentencepiece.SentencePieceProcessor(model_file=B)
of = alignment.pair(A, B)
PARTS = [" ", "  ", "\n", "\t ", "a", "Été", "don't", "'s", "▁", " the", "日本", "😀", "\x00", "<|endoftext|>", "<s>", "　", "  ", "x" * 9, "-" * 11]

lengths = st.lists(st.integers(1, 4), min_size=1, max_size=30)


@settings(max_examples=500, deadline=None)
@given(lengths, lengths, st.booleans())
def test_cuts_are_where_both_end(a, b, alike):
    x = np.cumsum(a).tolist()
    y = np.cumsum(b).tolist()
    if alike:
        y = [e for i, e in enumerate(x) if i % 7 != 3]
    last = max(x[-1], y[-1])
    x, y = ([*(e for e in s if e < last), last] for s in (x, y))
    common = sorted(set(x) & set(y))
    got = [c.tolist() for c in alignment.cuts(x, y)]
    assert got == [[x.index(c) + 1 for c in common], [y.index(c) + 1 for c in common]]


def test_a_one_to_one_stretch_takes_few_comparisons():
    class Counted(list):
        slices = 0

        def __getitem__(self, i):
            Counted.slices += isinstance(i, slice)
            return super().__getitem__(i)

    ends = Counted(range(1, 100_001))
    assert alignment.stretches(ends, list(ends)) == ([100_000], [100_000], [100_000])
    assert Counted.slices < 40


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), min_size=1, max_size=12))
def test_chunks_are_encoded_like_the_whole(parts):
    text = "".join(parts)
    for chunks in ([c for part in of.chunks(text) for c in part], list(of.chunks(text + " the end"))[0]):
        sides, whole = of.encode(chunks)
        alone, same = of._alone(chunks)
        for n, c in enumerate(chunks):
            assert whole[n] == same[n] == ("▁" not in c)
            for (length, start, ids), (length_, start_, ids_) in zip(sides, alone, strict=True):
                assert ids[start[n] :][: length[n]].tolist() == ids_[start_[n] :][: length_[n]].tolist()
    chunks = [c for part in of.chunks(text) for c in part]
    a, b = ([i for n in range(len(chunks)) for i in ids[start[n] :][: length[n]]] for length, start, ids in of.encode(chunks)[0])
    assert a == byte_level.encode(" " + text, add_special_tokens=False).ids
    assert b == pieces.encode(text)


def plain(rows):
    """The contract's rows, byte by byte."""
    texts, holds = [], Counter()
    for doc_id, text in rows:
        groups = _groups(text or "")
        links = Counter((a, b) for x, y in groups for a in x for b in y)
        holds.update(links.keys())
        texts.append((doc_id, groups, links))
    most = {}
    for (a, _), n in holds.items():
        most[a] = max(n, most.get(a, 0))
    out = []
    for doc_id, groups, links in texts:
        n_a, n_b = (sum(len(g[side]) for g in groups) for side in (0, 1))
        best = sum(t for k, t in links.items() if holds[k] == most[k[0]])
        line = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc_id, n_a, n_b, len(groups), sum(links.values()), best, sum(t * holds[k] for k, t in links.items()), line))
    return sorted(out, key=repr)


def _groups(text):
    whole = (" " + text).encode()
    a = byte_level.encode(" " + text, add_special_tokens=False).ids if text else []
    b = pieces.encode(text)
    if b"".join(of.a_bytes[i] for i in a) != whole or b"".join(of.b_bytes[i] for i in b) != whole:
        return []
    ends = [set(np.cumsum([len(names[i]) for i in ids]).tolist()) for names, ids in ((of.a_bytes, a), (of.b_bytes, b))]
    groups, sides = [], [(of.a_bytes, iter(a)), (of.b_bytes, iter(b))]
    at = 0
    for end in sorted(ends[0] & ends[1]):
        found = []
        for names, ids in sides:
            mine, place = [], at
            while place < end:
                mine.append(next(ids))
                place += len(names[mine[-1]])
            found.append(mine)
        groups.append(found)
        at = end
    return groups


ROWS = [
    (1, None), (2, ""), (3, " "), (4, "has ▁ inside"), (5, "Some words, and the same words again."), (5, "Some words, and the same words again."),
    (5, "another of one id"), (None, "no id"), (6, "日本語 <|endoftext|> 😀  two"), (7, "the " * 3_000), (8, "-" * 5_000), (9, "=-" * 700 + " " * 333),
    (10, "\n \n  x\t y "), (11, "Ünïcödé wörds ﬁ \x00"),
]


def test_rows_of_all_kinds(frame):
    docs = frame([(*r, "x", 2) for r in ROWS], "doc_id long, text string, groups string, pack int")
    got = alignment.align(docs, A, B)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(ROWS)


def test_over_several_packs_and_empty(frame):
    rows = [(i, f"thing{i % 5} and others, number {i}") for i in range(200)]
    docs = frame(rows, "doc_id long, text string").repartition(9)
    assert sorted((tuple(r) for r in alignment.align(docs, A, B).collect()), key=repr) == plain(rows)
    assert alignment.align(frame([], "doc_id long, text string"), A, B).count() == 0
    assert [tuple(r) for r in alignment.align(frame([(1, None)], "doc_id long, text string"), A, B).collect()] == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_a_long_group_is_counted_by_distinct_ids(monkeypatch):
    monkeypatch.setattr(alignment, "_BLOCK", 50)
    rng = np.random.default_rng(3)
    for _ in range(60):
        a, b = rng.integers(0, 9, 60), rng.integers(0, 9, 50)
        to_a = np.array(sorted({*rng.integers(1, 60, 4).tolist(), 60}))
        to_b = np.array([*sorted(rng.choice(np.arange(1, 50), len(to_a) - 1, replace=False).tolist()), 50])
        keys, times = alignment._linked(a, b, to_a, to_b)
        want, i, j = Counter(), 0, 0
        for x, y in zip(to_a.tolist(), to_b.tolist(), strict=True):
            want.update((int(p) << 32) | int(q) for p in a[i:x] for q in b[j:y])
            i, j = x, y
        assert dict(zip(keys.tolist(), times.tolist(), strict=True)) == want
