"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics come from whole texts. The trees are fitted on a documented, bounded sample:
the ``TRAIN_ROWS`` labelled documents with the smallest hash of their id, none of them
held out. They are kept as flat arrays of a complete binary tree each, which numpy walks
for all rows and trees of a batch at once. Scoring needs no shuffle.

Defined cases: null and empty texts are scored from statistics of zero; rows that share an
id are labelled by the mean of that id's labels (0.5 and more is 1); null labels and ids
teach nothing; labels of one class only, or none, give that class's smoothed share (0.5
without labels) as every score; an empty table gives an empty result; other columns are
ignored, or carried by ``keep_good``.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import full_text

TRAIN_ROWS = 20_000
TREES = 80
DEPTH = 4
BINS = 64
RATE = 0.15
SHRINK = 1.0
LEAST_WEIGHT = 1.0

_KINDS = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b".", b",", b"!?", b"*#%$&@^~", b"|<>{}[]\\/=_+", b"'\"-;:()")


def held_out(fold_of: int = 3, fold: int = 1) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % fold_of == fold, F.lit(False))


def statistics(text: str) -> list[float]:
    """Shape of one text; no dictionary and no position in the corpus."""
    raw = text.encode()
    if not raw:
        return [0.0] * (len(_KINDS) + 14)
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    share = counts[counts > 0] / len(raw)
    words, lines = raw.split(), raw.split(b"\n")
    bag, n = Counter(words), max(1, len(words))
    pairs = len(set(zip(words, words[1:], strict=False)))
    return [
        *(counts[np.frombuffer(kind, dtype=np.uint8)].sum() / len(raw) for kind in _KINDS),
        counts[128:].sum() / len(raw), np.log1p(len(raw)), -(share * np.log2(share)).sum(),
        np.log1p(len(words)), len(raw) / n, len(bag) / n, max(bag.values(), default=0) / n, pairs / n,
        np.log1p(len(lines)), len(set(lines)) / len(lines), len(words) / len(lines), max(map(len, words), default=0),
        len(zlib.compress(raw, 1)) / len(raw), sum(not w[-1:].isalnum() and w[-1] < 128 for w in words) / n,
    ]


def _matrix(texts) -> np.ndarray:
    return np.array([statistics(t) for t in texts], dtype=np.float64).reshape(len(texts), len(_KINDS) + 14)


class Trees:
    """Flat arrays: split feature and threshold per inner node, value per leaf, tree by tree."""

    def __init__(self, start: float, feature: np.ndarray, threshold: np.ndarray, leaf: np.ndarray) -> None:
        self.start, self.feature, self.threshold, self.leaf = start, feature, threshold, leaf

    def score(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros((len(x), len(self.leaf)), dtype=np.int64)
        tree, row = np.arange(len(self.leaf))[None, :], np.arange(len(x))[:, None]
        inner = self.feature.shape[1]
        while self.leaf.size and inner and node.size and node.flat[0] < inner:
            node = 2 * node + 1 + (x[row, self.feature[tree, node]] > self.threshold[tree, node])
        margin = self.start + self.leaf[tree, node - inner].sum(axis=1) if self.leaf.size else np.full(len(x), self.start)
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS) -> Trees:
    """Boosted trees on the logistic loss; splits are searched in histograms of binned statistics."""
    share = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
    start = float(np.log(share / (1 - share)))
    if len(set(y.tolist())) < 2:
        return Trees(start, np.zeros((0, 0), int), np.zeros((0, 0)), np.zeros((0, 0)))
    borders = [np.unique(np.quantile(x[:, f], np.arange(1, bins) / bins)) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(b, x[:, f], side="left") for f, b in enumerate(borders)])
    inner, width = 2 ** depth - 1, x.shape[1]
    feature, threshold = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf)
    leaf, margin = np.zeros((trees, inner + 1)), np.full(len(y), start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        slope, bend = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, many = 2 ** level - 1, 2 ** level
            best = np.full(many, 1e-6)
            for f in range(width):
                at = (node - first) * bins + binned[f]
                g = np.bincount(at, slope, many * bins).reshape(many, bins).cumsum(axis=1)
                h = np.bincount(at, bend, many * bins).reshape(many, bins).cumsum(axis=1)
                gt, ht = g[:, -1:], h[:, -1:]
                gain = g ** 2 / (h + SHRINK) + (gt - g) ** 2 / (ht - h + SHRINK) - gt ** 2 / (ht + SHRINK)
                gain[(h < LEAST_WEIGHT) | (ht - h < LEAST_WEIGHT)] = -1
                gain[:, len(borders[f]):] = -1
                cut = gain.argmax(axis=1)
                top = gain[np.arange(many), cut]
                for k in np.flatnonzero(top > best):
                    best[k], feature[t, first + k], threshold[t, first + k] = top[k], f, borders[f][cut[k]]
            go = x[np.arange(len(y)), feature[t, node]] > threshold[t, node]
            node = 2 * node + 1 + go
        at = node - inner
        leaf[t] = -RATE * np.bincount(at, slope, inner + 1) / (np.bincount(at, bend, inner + 1) + SHRINK)
        margin += leaf[t, at]
    return Trees(start, feature, threshold, leaf)


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Trees:
    """Fit on at most ``rows`` labelled documents outside the held-out fold."""
    mean = labels.filter(~held_out() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.avg("quality").alias("mean")).filter("mean is not null")
    # The smallest hashes are searched only where they can lie, so a task sends few rows on.
    wide = 1 << 20
    near = min(wide, -(-2 * rows * wide // max(1, mean.count())))
    mean = mean.filter(F.pmod(F.shiftrightunsigned(F.xxhash64("doc_id"), 44), F.lit(wide)) < near)
    sample = mean.select("doc_id", (F.col("mean") >= 0.5).cast("int").alias("label")).orderBy(F.shiftrightunsigned(F.xxhash64("doc_id"), 1), "doc_id").limit(rows)
    stats = F.pandas_udf(lambda texts: pd.Series(list(_matrix(texts))), "array<double>")
    taught = docs.select("doc_id", full_text().alias("text")).join(F.broadcast(sample), "doc_id").select("doc_id", "label", stats("text").alias("x"))
    found = taught.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).toPandas().sort_values("doc_id", kind="stable")
    x = np.array(found["x"].tolist(), dtype=np.float64).reshape(len(found), len(_KINDS) + 14)
    return fit(x, found["label"].to_numpy(dtype=np.float64))


def _score(model: Trees) -> Column:
    @F.pandas_udf("double")
    def of_texts(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(_matrix(texts)), dtype="float64")

    return of_texts(full_text())


def quality_scores(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    scored = docs.select("doc_id", held_out().alias("held_out"), _score(train(docs, labels, rows)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject."""
    return docs.filter(_score(train(docs, labels, rows)) >= 0.5)
