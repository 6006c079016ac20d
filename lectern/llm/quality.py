"""Document quality by histogram gradient-boosted trees over document statistics.

Statistics of the whole text (sizes, kinds of characters, repeated words and lines) are taken inside
tasks. Trees of a fixed depth are grown level by level from histograms of binned statistics, and kept as
flat arrays (feature and threshold of each node, value of each leaf), so a batch of documents walks all
trees with numpy indexing.

Labels are learned only from rows outside the held-out fold, from a bounded sample; every whole text is
scored. Defined results: null texts count as empty; without labelled rows every score is 0, with one label
only all score that label. Repeated rows score alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lectern.llm.labelled import held_out, sample

PER_CLASS = 6_000
MOST_CHARS = 200_000
TREES, DEPTH, BINS, RATE, LEAST = 60, 4, 64, 0.15, 10
THRESHOLD = 0.3
SYMBOLS = b"!%$#&*|.,;:@<>/=+-_?"
STATISTICS = (
    "chars", "words", "word_length", "longest_word", "upper", "lower", "digits", "space", "breaks", "wide", "control", "punctuation",
    "distinct_words", "commonest_word", "distinct_pairs", "lines", "distinct_lines", "line_length", "plain_words", "capital_words",
    "ends", *[f"symbol_{chr(s)}" for s in SYMBOLS],
)
_UPPER, _LOWER, _DIGIT = slice(65, 91), slice(97, 123), slice(48, 58)
_MARKS = np.array([i for i in range(33, 127) if not chr(i).isalnum()])


def statistics(text: str | None) -> list[float]:
    """One value for each of ``STATISTICS``; counts are logarithms, the rest are shares."""
    data = (text or "").encode("utf-8", "surrogatepass")
    size = max(1, len(data))
    kinds = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    words = data.split()
    n = max(1, len(words))
    counts = Counter(words)
    lines = data.split(b"\n")
    lower = sum(map(bytes.islower, words))
    return [
        np.log1p(len(data)), np.log1p(len(words)), sum(map(len, words)) / n, max(map(len, words), default=0),
        kinds[_UPPER].sum() / size, kinds[_LOWER].sum() / size, kinds[_DIGIT].sum() / size, kinds[32] / size, kinds[10] / size,
        kinds[128:].sum() / size, (kinds[:9].sum() + kinds[11:32].sum()) / size, kinds[_MARKS].sum() / size,
        len(counts) / n, max(counts.values(), default=0) / n, len(set(zip(words, words[1:]))) / n,
        np.log1p(len(lines)), len(set(lines)) / len(lines), size / len(lines),
        sum(map(bytes.isalpha, words)) / n, sum(map(bytes.isupper, words)) / n, lower / n,
        *(kinds[s] / size for s in SYMBOLS),
    ]


@dataclass
class Forest:
    """Complete trees, flattened: node i of a level has children 2i+1 and 2i+2; leaves come by their place."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    base: float
    constant: float | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - (2**DEPTH - 1)]
        return 1.0 / (1.0 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, bins: int = BINS, rate: float = RATE) -> Forest:
    nothing = np.empty((0, 2**DEPTH - 1))
    if not len(y) or y.min() == y.max():
        return Forest(nothing, nothing, nothing, 0.0, float(y[0]) if len(y) else 0.0)
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T)], axis=1)
    width = bins + 1
    base = float(np.log(y.mean() / (1 - y.mean())))
    total = np.full(len(y), base)
    nodes = 2**DEPTH - 1
    all_features, all_thresholds, all_leaves = [], [], []
    for _ in range(trees):
        p = 1.0 / (1.0 + np.exp(-total))
        slope, bend = y - p, p * (1 - p)
        feature, threshold = np.zeros(nodes, dtype=np.int64), np.full(nodes, np.inf)
        node = np.zeros(len(y), dtype=np.int64)
        for depth in range(DEPTH):
            first, count = 2**depth - 1, 2**depth
            best = np.full(count, 1e-6)
            split = np.full(count, width)
            for j in range(x.shape[1]):
                cell = (node - first) * width + binned[:, j]
                g = np.bincount(cell, weights=slope, minlength=count * width).reshape(count, width)
                h = np.bincount(cell, weights=bend, minlength=count * width).reshape(count, width)
                n = np.bincount(cell, minlength=count * width).reshape(count, width)
                gl, hl, nl = g.cumsum(axis=1), h.cumsum(axis=1), n.cumsum(axis=1)
                gt, ht, nt = gl[:, -1:], hl[:, -1:], nl[:, -1:]
                gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                gain[(nl < LEAST) | (nt - nl < LEAST)] = 0.0
                gain[:, len(edges[j]) :] = 0.0
                at = gain.argmax(axis=1)
                value = gain[np.arange(count), at]
                better = value > best
                best[better] = value[better]
                feature[first : first + count][better] = j
                split[better] = at[better]
                threshold[first : first + count][better] = edges[j][at[better]]
            local = node - first
            right = binned[np.arange(len(y)), feature[node]] > split[local]
            node = 2 * node + 1 + right
        place = node - nodes
        leaf = rate * np.bincount(place, weights=slope, minlength=2**DEPTH) / (np.bincount(place, weights=bend, minlength=2**DEPTH) + 1)
        total += leaf[place]
        all_features.append(feature)
        all_thresholds.append(threshold)
        all_leaves.append(leaf)
    return Forest(np.array(all_features), np.array(all_thresholds), np.array(all_leaves), base)


def _measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "x": [statistics(t) for t in batch["text"]]})


def learn(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, most_chars: int = MOST_CHARS) -> Forest:
    """Fit on at most ``2 * per_class`` labelled documents; only their statistics come to the driver."""
    rows = sample(docs, labels, "quality", per_class, most_chars).mapInPandas(_measured, "doc_id long, label int, x array<double>").orderBy("doc_id").collect()
    return fit(np.array([r["x"] for r in rows], dtype=float).reshape(len(rows), -1), np.array([r["label"] for r in rows], dtype=float))


def score(docs: DataFrame, model: Forest, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array([statistics(t) for t in batch["text"]], dtype=float).reshape(len(batch), len(STATISTICS))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": model.scores(x)})

    scored = docs.select("doc_id", "text").mapInPandas(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
