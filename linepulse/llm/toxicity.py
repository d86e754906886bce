"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence has a score, and the document is toxic if one of
them is: its score is the noisy-or, one minus the product of the sentences' complements. The
weights are trained from the labels of documents alone; the sentences' scores then say where the
offending ones are.

A sentence is the set of its words and of their first four and five letters. Only the text is
looked at. A null text is an empty one; a text without words has a low score, the one of an
empty sentence. Without labelled rows, or with one class, every score is low or high alike.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linepulse.llm.common import labelled_sample

#: Most labelled documents to train on.
SAMPLE = 6000
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
MIN_DOCS = 3
STEPS = 100
#: What a weight of one costs, in log likelihood; and by how much steps are shortened for words that occur together.
PENALTY = 0.4
SPREAD = 8.0
_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"[^.!?\n]+")
_CACHED = 500_000
RESULT = "struct<score: double, spans: array<struct<start: int, end: int, score: double>>>"


def sentences(text: str) -> Iterator[tuple[int, int]]:
    """Starts and ends of the sentences; an empty text is one of no words."""
    found = False
    for m in _SENTENCE.finditer(text):
        found = True
        yield m.start(), m.end()
    if not found:
        yield 0, len(text)


def features(word: str) -> tuple[str, ...]:
    if len(word) <= 4:
        return (word,)
    return (word, "^" + word[:4]) if len(word) == 5 else (word, "^" + word[:4], "^" + word[:5])


@dataclass
class Model:
    bias: float
    weights: dict[str, float]

    def scorer(self) -> Callable[[str], tuple[np.ndarray, list[tuple[int, int]]]]:
        """A function of a text: the scores and places of its sentences."""
        weights, known = self.weights, {}

        def of(text: str) -> tuple[np.ndarray, list[tuple[int, int]]]:
            nonlocal known
            if len(known) > _CACHED:
                known = {}
            text_lower, places, z = text.lower(), [], []
            if len(text_lower) != len(text):  # a few letters become two
                text_lower = "".join(c.lower()[0] for c in text)
            for start, end in sentences(text_lower):
                total = self.bias
                for w in set(_WORD.findall(text_lower, start, end)):
                    x = known.get(w)
                    if x is None:
                        x = known[w] = sum(weights.get(f, 0.0) for f in features(w))
                    total += x
                z.append(total)
                places.append((start, end))
            return 1 / (1 + np.exp(-np.clip(np.array(z), -30, 30))), places

        return of


def noisy_or(p: np.ndarray) -> float:
    return float(-np.expm1(np.log1p(-p).sum()))


def fit(texts: Sequence[str], labels: Sequence[int], min_docs: int = MIN_DOCS, steps: int = STEPS) -> Model:
    """The most likely weights under the noisy-or and a penalty on their absolute values.

    Proximal gradient steps, each weight's scaled by its curvature. The penalty leaves only
    weights that several documents speak for, so words that met toxic documents by chance go.
    """
    if not len(texts):
        return Model(-8.0, {})
    ids, sentence_of, doc_of, names = _table(texts, min_docs)
    n, docs, width = len(doc_of), len(texts), len(names)
    y = np.array(labels, dtype=bool)
    w, bias = np.zeros(width), -4.0
    often = np.bincount(ids, minlength=width)
    for _ in range(steps):
        z = bias + np.bincount(sentence_of, weights=w[ids], minlength=n)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        toxic = np.maximum(-np.expm1(np.bincount(doc_of, weights=np.log1p(-p), minlength=docs)), 1e-12)
        # The change of a document's log likelihood with a sentence's z.
        up = (np.where(y, (1 - toxic) / toxic, -1.0)[doc_of] * p).astype(np.float32)
        step = 1 / (SPREAD * (1 + often * min(0.25, float((p * (1 - p)).mean()))))
        moved = w + step * np.bincount(ids, weights=up[sentence_of], minlength=width)
        w = np.sign(moved) * np.maximum(np.abs(moved) - step * PENALTY, 0)
        bias += float(up.sum()) / (1 + SPREAD * float((p * (1 - p)).sum()))
    return Model(float(bias), {f: float(w[i]) for i, f in enumerate(names) if w[i]})


def _table(texts: Sequence[str], min_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """Features of sentences as numbers, sentences of those, documents of sentences, and the features' names."""
    number: dict[str, int] = {}
    of_word: dict[str, list[int]] = {}
    flat, lengths, counts = array("i"), array("i"), array("i")
    seen = array("i")  # documents of each feature
    last = array("i")
    for doc, text in enumerate(texts):
        low, before = text.lower(), len(lengths)
        for a, b in sentences(low):
            own: set[int] = set()
            for word in set(_WORD.findall(low, a, b)):
                known = of_word.get(word)
                if known is None:
                    known = of_word[word] = [number.setdefault(f, len(number)) for f in features(word)]
                own.update(known)
            for f in own:
                if f >= len(seen):
                    seen.extend([0] * (f + 1 - len(seen)))
                    last.extend([-1] * (f + 1 - len(last)))
                if last[f] != doc:
                    last[f] = doc
                    seen[f] += 1
            flat.extend(own)
            lengths.append(len(own))
        counts.append(len(lengths) - before)
    often = np.zeros(len(number), dtype=np.int32)
    often[: len(seen)] = np.frombuffer(seen, dtype=np.int32) if len(seen) else 0
    keep = often >= min_docs
    new = np.cumsum(keep, dtype=np.int32) - 1
    ids = np.frombuffer(flat, dtype=np.int32) if len(flat) else np.zeros(0, np.int32)
    sentence_of = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    used = keep[ids]
    names = [f for f, i in number.items() if keep[i]]
    doc_of = np.repeat(np.arange(len(texts), dtype=np.int32), counts)
    return new[ids[used]], sentence_of[used], doc_of, names


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE, folds: int = FOLDS, held_out: int = HELD_OUT) -> Model:
    """A model from a bounded sample of ``labels(doc_id, toxic)`` outside the held-out fold."""
    sample = labelled_sample(docs, labels, "toxic", folds, held_out, rows).toPandas()
    return fit(sample["text"].tolist(), sample["label"].tolist())


def judge(text: Column, model: Model, threshold: float = THRESHOLD) -> Column:
    """The document's score, and the sentences that reach the threshold by themselves."""

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        score = model.scorer()
        for texts in batches:
            scores, spans = [], []
            for t in texts:
                p, places = score(t or "")
                scores.append(noisy_or(p))
                spans.append([{"start": places[i][0], "end": places[i][1], "score": p[i]} for i in np.flatnonzero(p >= threshold)])
            yield pd.DataFrame({"score": scores, "spans": spans})

    of.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(of, RESULT)(text)


def scored(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> DataFrame:
    """``(doc_id, score, spans)`` for each row of ``docs(doc_id, text)``."""
    found = docs.select("doc_id", judge(F.col("text"), train(docs, labels, rows)).alias("judged"))
    return found.select("doc_id", "judged.score", "judged.spans")
