"""Lyndon arrays and runs against their definitions."""

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import SF, frame  # noqa: F401

from linepulse.llm import periodic, queries
from linepulse.llm.common import table


def lyndon_by_definition(s):
    """A Lyndon word is smaller than all its proper suffixes."""
    return [max(j - i for j in range(i + 1, len(s) + 1) if all(s[i:j] < s[k:j] for k in range(i + 1, j))) for i in range(len(s))]


def runs_by_definition(s, least):
    found = []
    for p in range(1, len(s) // 2 + 1):
        i = 0
        while i + p < len(s):
            j = i
            while j + p < len(s) and s[j] == s[j + p]:
                j += 1
            size = j + p - i
            smaller = any(all(s[k] == s[k + q] for k in range(i, i + size - q)) for q in range(1, p))
            if size >= max(least, 2 * p) and not smaller:
                found.append((i, size, p))
            i = max(j, i) + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


symbols = st.one_of(
    st.lists(st.integers(0, 3), max_size=40),
    st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=6), st.integers(1, 12), st.lists(st.integers(0, 3), max_size=8)).map(lambda x: (x[0] * x[1])[:45] + x[2]),
)


@settings(max_examples=400, deadline=None)
@given(symbols.filter(len))
def test_grouping_gives_the_lyndon_array(s):
    ranks = np.unique(s, return_inverse=True)[1].tolist()
    assert periodic.lyndon_array(ranks, max(ranks) + 1) == lyndon_by_definition(ranks)


@settings(max_examples=400, deadline=None)
@given(symbols, st.sampled_from([2, 5, 12]))
def test_runs(s, least):
    assert periodic.runs_of(np.array(s, np.int64), least) == runs_by_definition(s, least)


@settings(max_examples=300, deadline=None)
@given(st.lists(symbols, max_size=4), st.sampled_from([2, 12]))
def test_texts_together_are_like_each_alone(many, least):
    texts = [" ".join(f"w{x}" for x in s).encode() for s in many]
    for s, (runs, rest) in zip(many, periodic.find(texts, least), strict=True):
        assert runs == runs_by_definition(s, least)
        gone = {i for a, size, p in runs for i in range(a + p, a + size)}
        assert rest.decode() == " ".join(f"w{x}" for i, x in enumerate(s) if i not in gone)


@pytest.mark.parametrize("period", [1, 2, 1000, 100_000])
def test_long_repetitive_texts(period):
    runs, rest = periodic.find([" ".join(f"w{i % period}" for i in range(200_000)).encode()])[0]
    assert runs == [(0, 200_000, period)]
    assert len(rest.split()) == period


def test_rows_of_all_kinds(frame):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a b\x0b" * 8), (4, "a b\x0b" * 8), (None, "x " * 12), (5, "x " * 11), (6, "é  " * 12)]
    docs = frame([(*r, "x") for r in rows], "doc_id long, text string, runs string")
    got = sorted(periodic.runs(docs).collect(), key=repr)
    assert [(r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in got] == [
        (1, [], ""), (2, [], ""), (3, [], ""), (4, [(0, 16, 2)], "a b"), (4, [(0, 16, 2)], "a b"),
        (5, [], " ".join("x" * 11)), (6, [(0, 12, 1)], "é "), (None, [(0, 12, 1)], "x"),
    ]
    assert periodic.runs(frame([], "doc_id long, text string")).count() == 0


def test_query_against_definitions(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in queries.op12_periodic_runs(spark, SF).collect()}
    assert got.keys() == texts.keys()
    seen = 0
    for doc_id, text in texts.items():
        words = [w.decode() for w in (text or "").encode().split()]
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if n > 500:
            continue
        if h % 10 == 0 and n:
            a = (h // 10) % n
            p = 1 + (n - a) // (3 + (h // 10) % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        runs = runs_by_definition([words.index(w) for w in words], 12)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        gone = {i for s, size, p in runs for i in range(s + p, s + size)}
        shown = "".join(f"{s},{size},{p}\n" for s, size, p in runs)
        rest = " ".join(w for i, w in enumerate(words) if i not in gone)
        figures = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert got[doc_id] == (len(runs), *figures, *(hashlib.sha256(x.encode()).hexdigest() for x in (shown, rest)))
        seen += bool(runs)
    assert seen > 3
