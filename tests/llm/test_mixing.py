"""Targets, cuts and rows of the mix."""

from collections import defaultdict

import pytest
from llm_helpers import frame  # noqa: F401

from linepulse.llm import mixing

SCHEMA = "doc_id long, source string, text string, size string, target string, of int"


def plain_targets(sizes, weights, epochs=3):
    """Share what is left by weight, and cap the largest excess, until nothing is above."""
    target, free = {}, set(sizes)
    left = sum(sizes.values())
    while free:
        share = left / sum(weights[s] for s in free)
        over = {s for s in free if share * weights[s] > epochs * sizes[s]}
        if not over:
            return {**target, **{s: share * weights[s] for s in free}}
        for s in over:
            target[s] = epochs * sizes[s]
            left -= target[s]
            free.discard(s)
    return target


def documents():
    rows = []
    for source, n, words in (("b", 400, 7), ("a", 30, 11), (None, 3, 2), ("Z", 60, 40), ("empty", 2, 0), ("é", 9, 500)):
        rows += [(len(rows) + i, source, " ".join(["word"] * (words + i % 3 * (words > 0)))) for i in range(n)]
    rows += [(5, "b", "same text twice")] * 4 + [(None, "b", "no id"), (7, "a", None)]
    return [(*r, "clash", "clash", 1) for r in rows]


def test_targets_and_taken_words(frame):
    docs = frame(documents(), SCHEMA)
    got = mixing.mix(docs).collect()
    assert len(got) == len(documents())
    sizes = defaultdict(int)
    for _, source, text, *_ in documents():
        sizes[source] += len((text or "").split())
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    want = plain_targets(sizes, {s: 1 + i % 3 for i, s in enumerate(order)})
    by_size = defaultdict(list)
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        by_size[r.source_size].append(r)
    for source, size in sizes.items():
        rows = by_size[size]
        assert rows[0].target == pytest.approx(want[source])
        # Ties at the cut share its words; less than one for each may be lost.
        assert 0 <= want[source] - sum(r.taken for r in rows) < 4
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_small_ranges_change_nothing(frame):
    docs = frame(documents(), SCHEMA)
    cut = [sorted(map(repr, mixing.cuts(docs, range_rows=n).collect())) for n in (1, 7, 1024)]
    assert cut[0] == cut[1] == cut[2]


def test_rows_of_the_mix_keep_columns_and_texts(frame):
    docs = frame(documents(), SCHEMA)
    rows = mixing.apply_mix(docs).collect()
    assert rows[0].__fields__ == docs.columns
    texts = {(r[0], r[2]) for r in documents()}
    assert {(r.doc_id, r.text) for r in rows} <= texts
    goals = {r.source: r for r in mixing.cuts(docs).collect()}
    words, longest = defaultdict(int), defaultdict(int)
    for r in rows:
        words[r.source] += len((r.text or "").split())
    for _, source, text, *_ in documents():
        longest[source] = max(longest[source], len((text or "").split()))
    for source, goal in goals.items():
        assert abs(words[source] - goal.target) <= longest[source]


def test_empty(frame):
    assert mixing.mix(frame([], SCHEMA)).count() == 0
    assert mixing.apply_mix(frame([], SCHEMA)).count() == 0
    wordless = frame([(1, "a", "", "", "", 0), (2, None, None, "", "", 0)], SCHEMA)
    assert [r.taken for r in mixing.mix(wordless).collect()] == [0, 0]
