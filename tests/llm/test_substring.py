"""Chunks, spans and cuts."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import frame  # noqa: F401

from linepulse.llm import substring as s


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(n))


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=3000), st.integers(0, 3000), st.binary(max_size=5))
def test_chunks_cover_and_fall_into_step(raw, at, more):
    ends = s.chunk_ends(raw).tolist()
    assert ends == sorted(set(ends))
    assert (ends[-1] if ends else 0) == len(raw)
    assert all(b - a <= s.MOST for a, b in zip([0, *ends], ends, strict=False))
    changed = raw[:at] + more + raw[at:]
    moved = {e + len(changed) - len(raw) for e in ends if e > at}
    later = set(s.chunk_ends(changed).tolist())
    far = {e for e in moved if e > at + len(more) + 600}
    assert len(far - later) <= len(far) // 2 + 8


def test_gear_by_doubling_is_the_plain_sum():
    raw = random.Random(1).randbytes(200)
    h, want = 0, []
    for i, b in enumerate(raw):
        h = ((h << 1) + int(s._GEAR[b])) % 2**32
        if h < 2**32 // 16:
            want.append(i + 1)
    got = s.chunk_ends(raw, least=1, most=10**6).tolist()
    assert got == [w for w in want if w < 200] + [200]


def test_passages_are_found_and_clean_texts_left(frame):
    rng = random.Random(3)
    passages = [prose(rng, 60) for _ in range(20)]
    rows, planted = [], set()
    for i in range(200):
        text = prose(rng, 80)
        if i % 4 == 0:
            words = text.split()
            at = rng.randrange(80)
            text = " ".join([*words[:at], passages[i // 4 % 20], *words[at:]])
            if i >= 80:
                planted.add(i)
        rows.append((i, text, "x", 1))
    rows += [(None, None, "x", 1), (500, "", "x", 1), (0, rows[0][1], "x", 1), (501, "same words here " * 300, "x", 1)]
    docs = frame(rows, "doc_id long, text string, first_doc_id string, start int")
    spans = s.repeats(docs).collect()
    assert {r.doc_id for r in spans} == planted
    texts = {r[0]: r[1] for r in rows}
    for r in spans:
        cut = texts[r.doc_id].encode()[r.start : r.end].decode("utf-8", "ignore")
        assert cut in texts[r.first_doc_id]
        assert r.words >= s.WORDS
    left = s.without_repeats(docs, s.repeats(docs))
    assert left.columns == docs.columns
    assert left.count() == len(rows)
    for r in left.collect():
        if r.doc_id in planted:
            assert len(r.text.split()) < 105
        elif r.doc_id is not None:
            assert r.text == texts[r.doc_id]


def test_copies_keep_the_first_and_null_ids_come_first(frame):
    text = prose(random.Random(8), 100)
    docs = frame([(4, text), (9, text), (9, text), (None, text + " more"), (None, text)], "doc_id long, text string")
    got = s.repeats(docs).collect()
    # Of the two texts without an id one is first, and the other, 4 and 9 repeat it.
    assert sorted(((r.doc_id or 0), r.first_doc_id) for r in got) == [(0, None), (4, None), (9, None)]


def test_texts_of_one_id_are_cut_apart(frame):
    rng = random.Random(5)
    passage, other, own = prose(rng, 60), prose(rng, 90), prose(rng, 90)
    docs = frame([(1, passage), (2, own + " " + passage), (2, other)], "doc_id long, text string")
    spans = s.repeats(docs)
    assert [r.doc_id for r in spans.collect()] == [2]
    left = {r.text for r in s.without_repeats(docs, spans).collect()}
    assert passage in left and other in left
    assert len(left) == 3 and all(len(x) < len(own) + 80 for x in left)
    shared = frame([(None, own + " " + passage), (None, other + " " + passage)], "doc_id long, text string")
    assert s.repeats(shared).count() == 1


def test_pairs_are_equal_where_both_chunks_are():
    rng = random.Random(7)
    words = [prose(rng, 12) for _ in range(12)]
    seen = {}
    for _ in range(40):
        text = " ".join(rng.choices(words, k=20))
        digests, _, ends, n = s.chunks(text)
        pair, start, middle, end, one, two = s._pairs(text)
        assert len(pair) == len(digests) - 1
        assert middle.tolist() == ends[:-1].tolist() and end.tolist() == ends[1:].tolist()
        assert one.tolist() == n[:-1].tolist() and two.tolist() == n[1:].tolist()
        for i, d in enumerate(pair.tolist()):
            assert seen.setdefault(d, digests[i : i + 2].tolist()) == digests[i : i + 2].tolist()
    assert len(seen) == len({tuple(x) for x in seen.values()})


def test_chunks_that_never_follow_each_other_make_no_span(frame):
    """Each half of the later text is known, the order is not: two spans, from one text each."""
    rng = random.Random(11)
    one, two = prose(rng, 80), prose(rng, 80)
    docs = frame([(1, one + " " + prose(rng, 50)), (2, prose(rng, 50) + " " + two), (3, two + " " + one)], "doc_id long, text string")
    texts = {r.doc_id: r.text.encode() for r in docs.collect()}
    got = sorted(s.repeats(docs).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.first_doc_id) for r in got] == [(3, 2), (3, 1)]
    assert all(texts[3][r.start : r.end] in texts[r.first_doc_id] for r in got)
