"""Quality by histogram gradient-boosted trees over statistics of a document.

The statistics are binned by quantiles of a bounded sample, the trees grow level by level on
histograms of gradients, and are flattened into arrays, through which numpy moves all rows of a
batch one level at a time. Only the text is looked at. A null text is an empty one; its
statistics are zero. Without labelled rows every score is one half, with one class near it.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linepulse.llm.common import labelled_sample

#: Most labelled documents to train on.
SAMPLE = 12_000
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
BINS = 64
DEPTH = 4
TREES = 80
RATE = 0.2
LEAST = 10
_SYMBOLS = b"#$%&*+/<=>@[\\]^_`{|}~"


def _class(chars: bytes) -> np.ndarray:
    mask = np.zeros(256)
    mask[list(chars)] = 1
    return mask


_CLASSES = np.array(
    [
        _class(bytes(range(65, 91))),
        _class(bytes(range(97, 123))),
        _class(bytes(range(48, 58))),
        _class(b" "),
        _class(b"\n"),
        _class(b"\t\r\x0b\x0c"),
        _class(b".,;:"),
        _class(b"!"),
        _class(b"?"),
        _class(b"|"),
        _class(_SYMBOLS),
        _class(b"\"'()-"),
        _class(bytes(range(128, 256))),
    ]
)
#: Number of statistics.
WIDTH = len(_CLASSES) + 15


def statistics(text: str | None) -> list[float]:
    """Shares of kinds of characters, and how words and lines vary and repeat."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * WIDTH
    bytes_seen = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    shares = bytes_seen / len(raw)
    some = shares[shares > 0]
    counted = Counter(words)
    lengths = [len(w) for w in words]
    lines = [x for x in text.split("\n") if x.strip()]
    line_counts = Counter(lines)
    pairs = len(set(zip(words, words[1:], strict=False)))
    stops = sum(w[-1] in ".!?" for w in words)
    return [
        *(_CLASSES @ shares).tolist(),
        math.log1p(len(text)),
        math.log1p(n),
        sum(lengths) / n,
        max(lengths),
        len(counted) / n,
        counted.most_common(1)[0][1] / n,
        sum(v for v in counted.values() if v > 1) / n,
        pairs / max(1, n - 1),
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        stops / n,
        sum(w[0].isupper() for w in words) / n,
        sum(not w[-1].isalnum() and w[-1] not in ".,!?;:" for w in words) / n,
        n / len(lines),
        1 - len(line_counts) / len(lines),
        float(-(some * np.log2(some)).sum()),
    ]


@dataclass
class Forest:
    """Trees as arrays by tree and node; node i's children are 2i + 1 and 2i + 2."""

    base: float
    feature: np.ndarray
    limit: np.ndarray
    leaf: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Sum of the leaves that each row reaches."""
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        inner = self.feature.shape[1] if len(self.feature) else 0
        for feature, limit, leaf in zip(self.feature, self.limit, self.leaf, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(int(math.log2(inner + 1))):
                node = 2 * node + 1 + (x[rows, feature[node]] > limit[node])
            total += leaf[node - inner]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE) -> Forest:
    """Newton boosting of the logistic loss."""
    inner, leaves = 2**depth - 1, 2**depth
    if not len(x):
        return Forest(0.0, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, leaves)))
    n, width = x.shape
    edges = np.quantile(x, np.arange(1, bins) / bins, axis=0)
    binned = np.stack([np.searchsorted(edges[:, j], x[:, j], side="left") for j in range(width)], axis=1)
    mean = (y.sum() + 1) / (n + 2)
    base = math.log(mean / (1 - mean))
    raw = np.full(n, base)
    features, limits, values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        feature, limit = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            cell = (((node - first) * width)[:, None] + np.arange(width)) * bins + binned
            size = count * width * bins
            shape = (count, width, bins)
            gs, hs, ns = (
                np.bincount(cell.ravel(), weights=None if v is None else np.repeat(v, width), minlength=size)
                .reshape(shape)
                .cumsum(axis=2)
                for v in (g, h, None)
            )
            g_all, h_all, n_all = gs[:, :, -1:], hs[:, :, -1:], ns[:, :, -1:]
            gain = gs**2 / (hs + 1) + (g_all - gs) ** 2 / (h_all - hs + 1) - g_all**2 / (h_all + 1)
            gain[(ns < LEAST) | (n_all - ns < LEAST)] = 0
            gain[:, :, -1] = 0
            best = gain.reshape(count, -1).argmax(axis=1)
            won = gain.reshape(count, -1)[np.arange(count), best] > 1e-6
            j, b = best // bins, best % bins
            at = first + np.arange(count)
            feature[at[won]] = j[won]
            limit[at[won]] = edges[b[won], j[won]]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > limit[node])
        end = node - inner
        leaf = rate * np.bincount(end, weights=g, minlength=leaves) / (np.bincount(end, weights=h, minlength=leaves) + 1)
        raw += leaf[end]
        features.append(feature)
        limits.append(limit)
        values.append(leaf)
    return Forest(base, np.array(features), np.array(limits), np.array(values))


def statistics_column(text: Column) -> Column:
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts])

    return F.pandas_udf(of, "array<double>")(text)


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE, folds: int = FOLDS, held_out: int = HELD_OUT) -> Forest:
    """A forest from a bounded sample of ``labels(doc_id, quality)`` outside the held-out fold."""
    sample = labelled_sample(docs, labels, "quality", folds, held_out, rows)
    seen = sample.select(statistics_column(F.col("text")).alias("x"), "label").toPandas()
    x = np.array(seen["x"].tolist(), dtype=float).reshape(-1, WIDTH)
    return fit(x, seen["label"].to_numpy(dtype=float))


def score(text: Column, forest: Forest) -> Column:
    """How likely a text has label 1."""

    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(forest.score(np.array([statistics(t) for t in texts]).reshape(-1, WIDTH)))

    return F.pandas_udf(of, "double")(text)


def scored(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> DataFrame:
    """``(doc_id, score)`` for each row of ``docs(doc_id, text)``."""
    return docs.select("doc_id", score(F.col("text"), train(docs, labels, rows)).alias("score"))
