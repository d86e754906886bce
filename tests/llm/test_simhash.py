"""Fingerprints and groups against plain Python."""

import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import frame  # noqa: F401

from linepulse.llm import simhash
from linepulse.llm.components import components

SCHEMA = "doc_id long, text string, fp string, key string, source string"


def plain_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aAbÉé \t\n \x1c.", max_size=60))
def test_fingerprint_is_the_plain_one(text):
    assert simhash.fingerprint_of(text) == plain_fingerprint(text)


def plain_components(ids, links):
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for u, v in links:
            low = min(root[u], root[v])
            if root[u] != low or root[v] != low:
                root[u] = root[v] = low
                changed = True
    return root


@pytest.mark.parametrize("segments", [1, 4, 8])
def test_links_join_all_within_the_radius(frame, segments):
    rng = np.random.default_rng(segments)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    near = [int(x) ^ sum(1 << int(b) for b in rng.choice(64, k, replace=False)) for x in base for k in (1, 2, 3, 4, 5)]
    prints = sorted({*map(int, base), *near, 0, 7, 2**64 - 1})
    signed = [(x - 2**64 if x >= 2**63 else x,) for x in prints]
    found = simhash.links(frame(signed, "fp long"), segments=segments, tile_rows=16).collect()
    want = [(a, b) for i, a in enumerate(prints) for b in prints[i + 1 :] if (a ^ b).bit_count() <= 3]
    got = plain_components(prints, [(u % 2**64, v % 2**64) for u, v in found])
    assert got == plain_components(prints, want)


def test_groups_by_the_least_id_reached(frame):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(30):
        text = list(rng.choice(words, 300))
        rows.append((100 + i, " ".join(text)))
        text[7] = "other"
        rows.append((50 + i, " ".join(text).upper()))
    rows += [(9, ""), (8, None), (7, " \n"), (None, " "), (None, rows[0][1]), (100, rows[0][1]), (3, "one two")]
    docs = frame([(*r, "x", "y", None) for r in rows], SCHEMA)
    got = simhash.near_duplicates(docs).collect()
    prints = [plain_fingerprint(t) for _, t in rows]
    nodes = plain_components(range(len(rows)), [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3])
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[nodes[i]] = min(doc_id, least.get(nodes[i], doc_id))
    want = sorted(((d, f"{p:016x}", least.get(nodes[i])) for i, ((d, _), p) in enumerate(zip(rows, prints, strict=True))), key=repr)
    assert sorted((tuple(r) for r in got), key=repr) == want
    kept = simhash.keep_one(docs).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(least.values()))
    assert kept[0].__fields__ == docs.columns


def test_nothing_in_nothing_out(frame):
    docs = frame([], SCHEMA)
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.keep_one(docs).count() == 0


def test_a_hot_group_gives_few_links():
    base = np.uint64(0x0F0F_0F0F_0F0F_0F0F)
    a = np.array([base ^ np.uint64((1 << i) | (1 << j)) for i in range(40) for j in range(i)], dtype=np.uint64)
    u, v = simhash.join_pair(a, np.append(a, base), 3)
    assert len(u) <= 2 * len(a) + 1
    assert len(set(plain_components([*map(int, a), int(base)], [*zip(map(int, u), map(int, v), strict=True)]).values())) == 1


def test_components_of_a_long_path_and_a_star(frame):
    path = [(i, i + 1) for i in range(200)]
    star = [(1000, i) for i in range(1001, 1200)]
    found = dict(components(frame([*path, *star, (5, 5), (None, 3)], "u long, v long")).collect())
    assert found == {**dict.fromkeys(range(201), 0), **dict.fromkeys(range(1000, 1200), 1000)}
