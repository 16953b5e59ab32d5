"""Quality classifier: histogram gradient-boosted trees over statistics of a document's text.

The trees are fitted with numpy on a bounded sample of labelled rows and flattened into arrays; all rows are
scored in Arrow batches, where every step of the traversal takes all rows and all trees at once.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.llm.columns import Compute, add_columns
from tapeworks.llm.labelled import TRAINING_ROWS, first_rows, held_out, training_rows

_CLASSES = {
    "upper": range(0x41, 0x5B), "lower": range(0x61, 0x7B), "digits": range(0x30, 0x3A), "beyond_ascii": range(0x80, 0x100),
    "spaces": b" \t\n\r\x0b\x0c", "lines": b"\n", "stops": b".", "commas": b",", "shouts": b"!", "bars": b"|",
    "signs": b"#$%&*+=<>@^~_\\/{}[]", "dashes": b"-:;'\"()",
}
_MASKS = np.array([[b in set(members) for b in range(256)] for members in _CLASSES.values()], dtype=np.float64).T

STATISTICS = (
    "log_bytes", "log_words", "entropy", *_CLASSES, "word_length", "longest_word", "distinct_words", "repeated_next",
    "commonest_word", "capital_words", "line_length", "distinct_lines", "compressed",
)


def statistics(text: str | None) -> list[float]:
    """The document's numbers, in the order of STATISTICS; a null or empty text has zeros."""
    data = (text or "").encode()
    n = len(data)
    words = data.split()
    if not words:
        return [float(np.log1p(n)), *[0.0] * (len(STATISTICS) - 1)]
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    share = counts[counts > 0] / n
    m = len(words)
    lines = data.split(b"\n")
    distinct = Counter(words)
    return [
        float(np.log1p(n)), float(np.log1p(m)), float(-(share * np.log2(share)).sum()), *(counts @ _MASKS / n),
        n / m, max(map(len, distinct)), len(distinct) / m, sum(map(eq, words, words[1:])) / m,
        max(distinct.values()) / m,
        sum(map(bytes.istitle, words)) / m, n / len(lines), len(set(lines)) / len(lines),
        len(zlib.compress(data, 1)) / n,
    ]


@dataclass(frozen=True)
class Trees:
    """All trees in flat arrays: a leaf is its own child, so rows that have arrived stay where they are."""

    start: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return 1 / (1 + np.exp(-(self.start + self.value[at].sum(axis=1))))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64,
        leaf_rows: int = 10, smooth: float = 1.0) -> Trees:
    """Boosts trees on the logistic loss; splits are looked for among the bins of each feature's histogram.

    Without rows, or with one label only, there are no trees and every score is the smoothed share of label 1.
    """
    share = (y.sum() + 1) / (len(y) + 2)
    start = float(np.log(share / (1 - share)))
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def node() -> int:
        at = len(feature)
        for column, initial in ((feature, 0), (threshold, 0.0), (left, at), (right, at), (value, 0.0)):
            column.append(initial)
        return at

    if len(y) and 0 < y.sum() < len(y):
        edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in x.T]
        binned = np.stack([np.searchsorted(e, column) for e, column in zip(edges, x.T)], axis=1)
        flat = binned + np.arange(x.shape[1]) * bins
        margin = np.full(len(y), start)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            slope, curve = p - y, p * (1 - p)
            roots.append(node())
            open_nodes = [(roots[-1], np.arange(len(y)), 0)]
            while open_nodes:
                at, rows, level = open_nodes.pop()
                g, h = slope[rows].sum(), curve[rows].sum()
                best = None
                if level < depth and len(rows) >= 2 * leaf_rows:
                    cells = flat[rows].ravel()
                    shape, size = (x.shape[1], bins), x.shape[1] * bins
                    sums = [np.bincount(cells, None if w is None else np.repeat(w[rows], x.shape[1]), size)
                            .reshape(shape).cumsum(axis=1) for w in (slope, curve, None)]
                    gl, hl, nl = sums
                    gain = gl**2 / (hl + smooth) + (g - gl) ** 2 / (h - hl + smooth) - g**2 / (h + smooth)
                    gain[(nl < leaf_rows) | (len(rows) - nl < leaf_rows)] = 0
                    f, b = np.unravel_index(gain.argmax(), shape)
                    best = (int(f), int(b)) if gain[f, b] > 1e-9 and b < len(edges[f]) else None
                if best is None:
                    value[at] = float(-rate * g / (h + smooth))
                    margin[rows] += value[at]
                    continue
                f, b = best
                feature[at], threshold[at] = f, float(edges[f][b])
                left[at], right[at] = node(), node()
                goes_left = binned[rows, f] <= b
                open_nodes += [(left[at], rows[goes_left], level + 1), (right[at], rows[~goes_left], level + 1)]
    return Trees(start, *(np.array(c, dtype=t) for c, t in (
        (roots, np.int64), (feature, np.int64), (threshold, float), (left, np.int64), (right, np.int64), (value, float),
    )), depth)


def with_statistics(docs: DataFrame, text: str = "text", name: str = "statistics",
                    keep: Sequence[str] | None = None) -> DataFrame:
    """docs with the array of each text's STATISTICS."""
    def make() -> Compute:
        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            return [pa.array([statistics(t) for t in batch.column(text).to_pylist()], pa.list_(pa.float64()))]
        return compute

    return add_columns(docs, text, T.StructType([T.StructField(name, T.ArrayType(T.DoubleType()))]), make, keep)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAINING_ROWS,
          id_col: str = "doc_id", text: str = "text") -> Trees:
    """Trees fitted on at most ``rows`` labelled documents that are not held out; only their numbers are collected."""
    sample = training_rows(docs.select(id_col, text), labels, label, rows, id_col)
    numbers = first_rows(with_statistics(sample, text, keep=[id_col, "target"]), rows, id_col)
    found = numbers.select("statistics", "target").collect()
    x = np.array([r[0] for r in found], dtype=float).reshape(-1, len(STATISTICS))
    return fit(x, np.array([r[1] for r in found], dtype=float))


def score(docs: DataFrame, model: Trees, text: str = "text", name: str = "score",
          keep: Sequence[str] | None = None) -> DataFrame:
    """docs with the probability that each whole text is good.

    Only the text counts. Null and empty texts are scored like any other; equal texts score the same; repeated
    rows stay. A column that has the name of the score is replaced.
    """
    def make() -> Compute:
        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            x = np.array([statistics(t) for t in batch.column(text).to_pylist()]).reshape(-1, len(STATISTICS))
            return [pa.array(model.scores(x))]
        return compute

    return add_columns(docs, text, T.StructType([T.StructField(name, T.DoubleType())]), make, keep)


def judged(docs: DataFrame, model: Trees, at_least: float = 0.3, id_col: str = "doc_id",
           text: str = "text") -> DataFrame:
    """id, held_out, score and predicted (1 from ``at_least`` on) of each document."""
    return score(docs, model, text, keep=[id_col]).select(
        id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= at_least).cast("int").alias("predicted"))
