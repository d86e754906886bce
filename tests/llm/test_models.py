"""The trained models: held-out accuracy, places and odd inputs."""

import numpy as np
import pytest
from llm_helpers import auc, frame  # noqa: F401

from linepulse.llm import quality, toxicity

SCHEMA = "doc_id long, text string, label string, score string, spans int"
GOOD = "the of and river stone garden morning letter window market summer".split()
BAD = "vile nasty".split()


def corpus(n=600, seed=1):
    rng = np.random.default_rng(seed)
    rows, marks = [], []
    for i in range(n):
        sentences = [" ".join(rng.choice(GOOD, rng.integers(4, 12))) for _ in range(rng.integers(1, 9))]
        toxic = i % 4 == 0
        if toxic:
            at = rng.integers(len(sentences))
            sentences[at] += " " + rng.choice(BAD) + "ness"
        rows.append((i, ". ".join(sentences) + ".", None, None, None))
        marks.append((i, int(toxic)))
    return rows, marks


def test_toxicity_is_learnt_and_located(frame):
    rows, marks = corpus()
    odd = [(None, "A vileness. The river.", *[None] * 3), (9000, None, *[None] * 3), (9001, "", *[None] * 3), (9002, "river " * 50_000, *[None] * 3)]
    docs = frame([*rows, rows[0], *odd], SCHEMA)
    labels = frame([*marks, marks[0], (None, 1), (5, None)], "doc_id long, toxic int")
    got = toxicity.scored(docs, labels).collect()
    score = {r.doc_id: r.score for r in got}
    assert len(got) == len(rows) + 5
    assert all(0 <= r.score <= 1 for r in got)
    assert auc([score[i] for i, _ in marks], [y for _, y in marks]) > 0.99
    assert score[None] > 0.3
    assert max(score[9000], score[9001], score[9002]) < 0.3
    texts = dict((r[0], r[1]) for r in rows)
    for r in got:
        for s in r.spans or []:
            if r.doc_id in texts:
                assert any(b in texts[r.doc_id][s.start : s.end] for b in BAD)


def test_models_without_labels(frame):
    rows, _ = corpus(20)
    none = frame([], "doc_id long, toxic int, quality int")
    assert all(r.score < 0.3 for r in toxicity.scored(frame(rows, SCHEMA), none).collect())
    assert {r.score for r in quality.scored(frame(rows, SCHEMA), none).collect()} == {0.5}
    assert toxicity.scored(frame([], SCHEMA), none).count() == 0
    assert quality.scored(frame([], SCHEMA), none).count() == 0


def test_labels_of_the_held_out_fold_are_not_learnt(frame):
    import zlib

    rows, marks = corpus()
    docs = frame(rows, SCHEMA)
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, y in marks]
    models = [toxicity.train(docs, frame(m, "doc_id long, toxic int")) for m in (marks, turned)]
    assert models[0] == models[1]


def test_quality_is_learnt(frame):
    rows, _ = corpus()
    junk = [(10_000 + i, (r[1].upper() + "!! ") * 2, *[None] * 3) for i, r in enumerate(rows[:200])]
    docs = frame([*rows, *junk, (None, None, *[None] * 3), (-1, "", *[None] * 3)], SCHEMA)
    labels = frame([(r[0], 1) for r in rows] + [(r[0], 0) for r in junk], "doc_id long, quality int")
    score = {r.doc_id: r.score for r in quality.scored(docs, labels).collect()}
    assert auc([score[r[0]] for r in [*rows, *junk]], [1] * len(rows) + [0] * len(junk)) > 0.99
    assert all(0 <= s <= 1 for s in score.values())
    assert score[None] == score[-1]


def test_flat_trees_give_what_the_training_gave():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 5))
    y = ((x[:, 0] > 0.2) ^ (x[:, 3] > 0)).astype(float)
    forest = quality.fit(x, y, trees=40)
    assert auc(forest.score(x), y) > 0.99

    def walk(row):
        total = forest.base
        for f, limit, leaf in zip(forest.feature, forest.limit, forest.leaf, strict=True):
            node = 0
            while node < len(f):
                node = 2 * node + 1 + int(row[f[node]] > limit[node])
            total += leaf[node - len(f)]
        return total

    assert [walk(r) for r in x[:50]] == pytest.approx(forest.raw(x[:50]).tolist())


def test_noisy_or_is_the_product_of_the_complements():
    p = np.array([0.1, 0.5, 0.2])
    assert toxicity.noisy_or(p) == pytest.approx(1 - 0.9 * 0.5 * 0.8)
