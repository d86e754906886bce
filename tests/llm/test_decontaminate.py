"""Regions against plain edit distance."""

import random
import tracemalloc

import numpy as np
import pytest
from llm_helpers import frame  # noqa: F401

from linepulse.llm import decontaminate as d

SYLLABLES = "an be ti lo ra su me no pi ka".split()


def prose(rng, n):
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n))


def best_distance(pattern, text):
    """Edit distance of ``pattern`` to its best piece of ``text``."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row[0] = row[0], i
        for j, t in enumerate(text, 1):
            last, row[j] = row[j], min(last + (p != t), row[j] + 1, row[j - 1] + 1)
    return min(row)


def damaged(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = "x"
        elif kind == 1:
            out.insert(at, "y")
        elif len(out) > 1:
            del out[at]
    return "".join(out)


def test_regions_are_those_within_the_budget():
    rng = random.Random(4)
    items = [(i, prose(rng, rng.randint(12, 18))) for i in range(12)]
    items = [(i, t[:90]) for i, t in items]  # one window each
    index = d.build(items)
    texts = []
    for k in range(60):
        _, item = items[k % 12]
        texts.append(prose(rng, 20) + " " + damaged(rng, item, k % 14) + prose(rng, 15))
    texts += [t for _, t in items] + ["", None, "short"]
    found = {(row, item) for row, item, *_ in d.regions(index, texts, batch=7)}
    want = {
        (row, item)
        for row, text in enumerate(texts)
        for (item, _), codes, budget in zip(items, index.codes, index.budget, strict=True)
        if text and best_distance([chr(c) for c in codes], d.plain(text)) <= budget
    }
    assert found == want
    assert len(want) > 30


def test_places_point_at_the_passage(frame):
    rng = random.Random(9)
    item = prose(rng, 60)
    before = prose(rng, 30)
    text = before + "\n" + item.upper().replace(" ", "\t") + "\n" + prose(rng, 30)
    rows = [(1, text), (2, before), (None, text), (1, text), (4, None), (5, "")]
    docs = frame([(*r, 5, "x") for r in rows], "doc_id long, text string, start int, item_id string")
    bench = frame([(8, item, None), (9, None, None), (None, item, None), (10, "tiny", None)], "item_id long, text string, more string")
    got = d.contaminated(docs, bench).collect()
    assert sorted((r.doc_id or 0, r.item_id) for r in got) == [(0, 8), (1, 8), (1, 8)]
    for r in got:
        assert abs(r.start - len(before) - 1) <= 9
        assert abs(r.end - len(before) - 1 - len(item)) <= 9
    assert [r.doc_id for r in d.clean(docs, bench).collect()] == [2, 4, 5]
    assert d.clean(docs, bench).columns == docs.columns


def test_blocks_of_items_change_nothing(frame):
    rng = random.Random(2)
    items = [(i, prose(rng, 30)) for i in range(9)]
    docs = frame([(i, prose(rng, 10) + t) for i, t in items], "doc_id long, text string")
    bench = frame(items, "item_id long, text string")
    one, many = (sorted(map(tuple, d.contaminated(docs, bench, block_chars=n).collect())) for n in (10**6, 300))
    assert one == many
    assert len(one) == 9


def test_empty(frame):
    docs, bench = frame([], "doc_id long, text string"), frame([], "item_id long, text string")
    full = frame([(1, "some text")], "doc_id long, text string")
    assert d.contaminated(full, bench).count() == 0
    assert d.clean(full, bench).count() == 1
    assert d.contaminated(docs, frame([(1, "an item of a benchmark")], "item_id long, text string")).count() == 0


@pytest.mark.parametrize("size", [0, 7, 8, 9, 200])
def test_grams(size):
    codes = np.arange(size, dtype=np.uint32)
    assert len(d.grams(codes, 8)) == max(0, size - 7)


def test_parts_of_long_items_are_found_off_the_grid(frame):
    rng = random.Random(6)
    items = [(i, prose(rng, 120)) for i in range(6)]
    rows = []
    for i in range(90):
        words, n = items[i % 6][1].split(), (13, 16, 20)[i // 6 % 3]
        at = rng.randrange(len(words) - n)
        while len(" ".join(words[at : at + n])) < d.PASSAGE:
            at = rng.randrange(len(words) - n)
        part = " ".join(words[at : at + n])
        rows.append((i, prose(rng, 40) + " " + (damaged(rng, part, 2) if i % 2 else part) + " " + prose(rng, 40)))
    docs = frame([*rows, (90, prose(rng, 200))], "doc_id long, text string")
    bench = frame([*items, (6, "語" * 20 + "".join(chr(0x4E00 + rng.randrange(5000)) for _ in range(300)))], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in d.contaminated(docs, bench).collect()}
    assert got == {(i, i % 6) for i in range(90)}
    assert [r.doc_id for r in d.clean(docs, bench).collect()] == [90]


def test_windows_start_inside_text_without_blanks():
    codes = np.array([ord(c) for c in "ab abcdefghijklmnopqrs  c"], dtype=np.uint32)
    assert d.word_starts(codes).tolist() == [0, 3, 11, 19, 24]


def all_places(item, text, budget):
    """Ends of all pieces of ``text`` within ``budget`` edits of ``item``."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, t in enumerate(text, 1):
            last, row[j] = row[j], min(last + (p != t), row[j] + 1, row[j - 1] + 1)
    return [j for j, c in enumerate(row) if c <= budget]


@pytest.mark.parametrize("text", ["-" * 700, "=-" * 300, "| a | " * 90, "ab " * 60 + "-" * 200 + " cd" * 70, " " * 500])
def test_repetitive_texts_against_edit_distance(monkeypatch, text):
    monkeypatch.setattr(d, "SLICE", 128)
    monkeypatch.setattr(d, "_PAIRS", 500)
    items = [(1, "-" * 60), (2, "=-" * 25), (3, "| a | " * 9 + "|"), (4, "x" * 40), (5, "cd cd cd " + "e" * 30)]
    index = d.build(items)
    got = {item: (a, b) for _, item, a, b, _ in d.regions(index, [text])}
    for n, (item, pattern) in enumerate(items):
        ends = all_places(pattern, text, int(index.budget[n]))
        assert (item in got) == bool(ends)
        if ends:
            assert got[item][1] == max(ends) or abs(got[item][1] - max(ends)) <= index.budget[n]


def test_a_long_rule_takes_bounded_memory():
    items = [(i, "-" * 60) for i in range(40)]
    tracemalloc.start()
    try:
        got = list(d.regions(d.build(items, passage=d.PASSAGE), ["-" * 100_000]))
        assert tracemalloc.get_traced_memory()[1] < 600e6
    finally:
        tracemalloc.stop()
    assert [x[:4] for x in got] == [(0, i, 0, 100_000) for i in range(40)]


def test_texts_together_are_like_each_alone():
    rng = random.Random(12)
    items = [(i, prose(rng, 40)) for i in range(8)]
    index = d.build(items, passage=d.PASSAGE)
    texts = []
    for i in range(80):
        words = items[i % 8][1].split()
        part = " ".join(words[: rng.randrange(3, 40)]) if i % 3 else prose(rng, 9)
        texts.append(damaged(rng, part, i % 4) if i % 2 else prose(rng, i) + part)
    alone = [(i, *x[1:]) for i, t in enumerate(texts) for x in d.regions(index, [t])]
    assert list(d.regions(index, texts)) == alone
    assert len(alone) > 30


def test_short_items_take_no_part(frame):
    bench = frame([(1, "in general"), (2, None), (None, "an item that has no id"), (3, "an item that is long enough")], "item_id long, text string")
    docs = frame([(1, "words in general and more of them")], "doc_id long, text string")
    assert d.contaminated(docs, bench).count() == 0
    assert sorted(r.text or "" for r in d.left_out(bench).collect()) == ["", "an item that has no id", "in general"]


def test_slices_change_nothing(monkeypatch):
    rng = random.Random(21)
    items = [(i, prose(rng, 60)) for i in range(6)]
    index = d.build(items, passage=d.PASSAGE)
    texts = [" ".join(x for i in range(12) for x in (prose(rng, rng.randint(5, 60)), damaged(rng, items[i % 6][1], i % 5))) for _ in range(4)]
    whole = list(d.regions(index, texts))
    monkeypatch.setattr(d, "SLICE", 512)
    assert list(d.regions(index, texts)) == whole
    assert len(whole) >= 48
