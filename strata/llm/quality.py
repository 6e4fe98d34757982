"""Quality classifier: histogram gradient-boosted trees over document statistics.

Features are binned once at quantiles; trees grow level by level from histograms
of gradients and Hessians and are stored as flat arrays (a complete binary tree of
fixed depth), so numpy walks all trees for a batch of documents at once.

Training uses at most ``SAMPLE_ROWS`` labelled rows (chosen by hashes of id and text), whose
feature rows, not texts, come to the driver.

Defined results: null texts count as empty; empty texts have all features 0 and
get a score like any other; without labels every score is 0.5, with one class the
score is near that class; rows with a null label are ignored; repeated rows get equal
scores.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import arrow_column, prepare

SAMPLE_ROWS = 20_000
TREES, DEPTH, RATE, BINS = 80, 4, 0.15, 64
LEAST_HESSIAN, RIDGE = 1.0, 1.0

FEATURES = [
    "log_bytes", "log_words", "mean_word", "longest_word", "different_words", "different_pairs",
    "top_word", "same_as_previous", "upper", "digits", "marks", "exclamations", "space",
    "not_ascii", "log_lines", "repeated_lines", "mean_line", "ended_lines", "most_frequent_byte",
    "byte_entropy", "bars", "upper_words"]

_UPPER, _DIGIT, _SPACE, _MARK = (np.array([test(c) for c in range(256)]) for test in (
    lambda c: 65 <= c <= 90, lambda c: 48 <= c <= 57, lambda c: c in (9, 10, 11, 12, 13, 32),
    lambda c: 33 <= c < 127 and not chr(c).isalnum()))


def features(raw: bytes) -> list[float]:
    if not raw:
        return [0.0] * len(FEATURES)
    size = len(raw)
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.split()
    count = len(words) or 1
    times = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n_lines = len(lines) or 1
    share = seen[seen > 0] / size
    return [
        math.log1p(size), math.log1p(len(words)), sum(map(len, words)) / count,
        float(max(map(len, words), default=0)), len(times) / count,
        len(set(zip(words, words[1:]))) / count, max(times.values(), default=0) / count,
        sum(map(bytes.__eq__, words, words[1:])) / count,
        seen[_UPPER].sum() / size, seen[_DIGIT].sum() / size, seen[_MARK].sum() / size,
        seen[33] / size, seen[_SPACE].sum() / size, seen[128:].sum() / size,
        math.log1p(len(lines)), 1 - len(set(lines)) / n_lines, sum(map(len, lines)) / n_lines,
        sum(x.rstrip()[-1:] in b".!?" for x in lines) / n_lines, seen.max() / size,
        float(-(share * np.log(share)).sum()), seen[124] / size,
        sum(map(bytes.isupper, words)) / count]


@dataclass
class Trees:
    """Complete binary trees of one depth; node i has children 2i + 1 and 2i + 2."""

    base: float
    feature: np.ndarray      # trees x inner nodes
    threshold: np.ndarray
    value: np.ndarray        # trees x leaves

    def score(self, x: np.ndarray) -> np.ndarray:
        trees, inner = self.feature.shape
        total = np.full(len(x), self.base)
        if trees:
            depth = inner.bit_length()
            rows, which = np.arange(len(x))[:, None], np.arange(trees)
            node = np.zeros((len(x), trees), np.int64)
            for _ in range(depth):
                right = x[rows, self.feature[which, node]] > self.threshold[which, node]
                node = 2 * node + 1 + right
            total += self.value[which, node - inner].sum(1)
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, *, trees: int = TREES, depth: int = DEPTH,
        rate: float = RATE, bins: int = BINS) -> Trees:
    inner, n = (1 << depth) - 1, len(y)
    empty = Trees(0.0, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    if not n:
        return empty
    mean = min(max(float(y.mean()), 0.5 / (n + 1)), 1 - 0.5 / (n + 1))
    empty.base = math.log(mean / (1 - mean))
    if y.min() == y.max():
        return empty
    edges = [np.unique(np.quantile(x[:, f], np.arange(1, bins) / bins)) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)])
    margin = np.full(n, empty.base)
    all_features, all_thresholds, all_values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, hessian = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            nodes, offset = 1 << level, (1 << level) - 1
            at = node - offset
            best = np.zeros(nodes)
            cut = np.zeros(nodes, np.int64)
            for f, edge in enumerate(edges):
                if not len(edge):
                    continue
                cell = at * bins + binned[f]
                g = np.bincount(cell, gradient, nodes * bins).reshape(nodes, bins).cumsum(1)
                h = np.bincount(cell, hessian, nodes * bins).reshape(nodes, bins).cumsum(1)
                total_g, total_h = g[:, -1:], h[:, -1:]
                gain = g ** 2 / (h + RIDGE) + (total_g - g) ** 2 / (total_h - h + RIDGE) \
                    - total_g ** 2 / (total_h + RIDGE)
                gain[(h < LEAST_HESSIAN) | (total_h - h < LEAST_HESSIAN)] = 0
                gain[:, len(edge):] = 0
                b = gain.argmax(1)
                top = gain[np.arange(nodes), b]
                better = top > best + 1e-9
                best[better], cut[better] = top[better], b[better]
                feature[offset:offset + nodes][better] = f
                threshold[offset:offset + nodes][better] = edge[np.minimum(b, len(edge) - 1)][better]
            go = x[np.arange(n), feature[node]] > threshold[node]
            node = 2 * node + 1 + go
        leaf = node - inner
        g = np.bincount(leaf, gradient, inner + 1)
        h = np.bincount(leaf, hessian, inner + 1)
        value = -rate * g / (h + RIDGE)
        margin += value[leaf]
        all_features.append(feature)
        all_thresholds.append(threshold)
        all_values.append(value)
    return Trees(empty.base, np.stack(all_features), np.stack(all_thresholds), np.stack(all_values))


def _feature_rows(text: pa.Array) -> list[list[float]]:
    return [features(t or b"") for t in text.cast(pa.binary()).to_pylist()]


def train(docs: DataFrame, labels: DataFrame, may_learn: Column, *, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Trees:
    """Fit on rows of ``labels`` that satisfy ``may_learn``, joined to ``docs`` by id."""
    spark = docs.sparkSession
    prepare(spark)
    # one label an id, the greatest
    known = labels.where(may_learn & labels[label_col].isNotNull()).groupBy(labels[id_col].alias("id")).agg(
        F.max((labels[label_col] > 0).cast("int")).alias("y"))
    share_of = lambda n: min(1 << 20, -(-(sample_rows << 20) // max(1, n)))
    # about sample_rows ids, whatever the table's size
    sample = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share_of(known.count()))

    def run(text: pa.Array) -> pa.Array:
        return pa.array(_feature_rows(text), pa.list_(pa.float64()))

    joined = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text")).join(
        F.broadcast(sample), "id")
    # and about as many documents, should ids repeat; rows that repeat count once
    turn = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 20))
    joined = joined.where(turn < share_of(joined.count())).dropDuplicates(["id", "y", "text"])
    rows = joined.select("id", "y", arrow_column(run, "array<double>")(F.col("text")).alias("x")).toArrow()
    x = rows.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
    y = rows.column("y").to_numpy().astype(float)
    order = np.lexsort((*x.T, y, rows.column("id").to_numpy()))   # the order of rows is Spark's choice
    return fit(x[order], y[order])


def score(docs: DataFrame, model: Trees, *, text_col: str = "text") -> Column:
    """Column with the probability of label 1 for the texts of ``docs``."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(text: pa.Array) -> pa.Array:
        x = np.array(_feature_rows(text)).reshape(-1, len(FEATURES))
        return pa.array(shared.value.score(x), pa.float64())

    return arrow_column(run, "double")(docs[text_col].cast("string"))
