"""Quality rules: gradient-boosted trees over document statistics.

The trees are fitted on a bounded labelled sample with monotonic constraints on chosen statistics and flattened into
numpy node arrays; every document is scored by walking all trees at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .labelled import PER_CLASS, training_rows
from .runs import tidy
from .words import grams, slices, split

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
_UPPER, _LOUD, _DIGIT, _STOP = (np.isin(np.arange(256), list(x)) for x in (range(65, 91), b"!", range(48, 58), b".,;:?"))
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Statistics the trees see, and the sign a score may follow each with (-1: never rises with it, 0: free).
FEATURES = {"log_words": 0, "mean_word": 0, "symbols_per_word": -1, "dup_lines": -1, "repeat_share": -1, "capitals": -1, "exclamations": -1, "digits": 0, "stops": 0, "distinct": 0, "bytes_per_char": 0}
#: A document stays if its probability of label 1 is at least this.
KEEP = 0.3


def statistics(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(documents x BASE, documents x FEATURES) of a string column; null counts as empty."""
    w = split(texts)
    n = len(w.offsets) - 1
    words = np.diff(w.first)

    def per_doc(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[w.offsets[1:]] - total[w.offsets[:-1]]

    heads = (w.data & 0xC0) != 0x80
    chars = per_doc(heads)
    spaces = per_doc(np.isin(w.data, [0x20, *range(0x09, 0x0E)]))
    base = np.zeros((n, 5), np.int64)
    base[:, 0], base[:, 1], base[:, 2] = words, chars - spaces, per_doc(SYMBOLS[w.data])
    windows, distinct, lines = grams(w.hash, 3), np.zeros(n), np.zeros(n)
    for i, text in enumerate(texts.to_pylist()):
        a, b = w.first[i], w.first[i + 1]
        if a == b:
            continue
        cut = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        lines[i] = len(cut)
        base[i, 3] = len(cut) - len(set(cut))
        distinct[i] = len(np.unique(w.hash[a:b]))
        if b - a >= 3:
            _, back, times = np.unique(windows[a : b - 2], return_inverse=True, return_counts=True)
            twice = times[back] >= 2
            if twice.any():
                covered = np.zeros(b - a, bool)
                for k in range(3):
                    covered[k : b - a - 2 + k] |= twice
                base[i, 4] = covered.sum()
    some, letters = np.maximum(words, 1), np.maximum(base[:, 1], 1)
    x = np.column_stack([np.log1p(words), base[:, 1] / some, base[:, 2] / some, base[:, 3] / np.maximum(lines, 1), base[:, 4] / some, per_doc(_UPPER[w.data]) / letters, per_doc(_LOUD[w.data]) / some, per_doc(_DIGIT[w.data]) / letters, per_doc(_STOP[w.data]) / some, distinct / some, np.diff(w.offsets) / np.maximum(chars, 1)])
    return base, x


@dataclass
class Forest:
    """Flattened trees: node k splits on feature[k] <= threshold[k] to left[k] or right[k]; a leaf points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        if not len(self.roots):
            return np.full(len(x), 1 / (1 + np.exp(-self.bias)))
        at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return 1 / (1 + np.exp(-np.clip(self.bias + self.value[at].sum(1), -40, 40)))


def fit_forest(x: np.ndarray, y: np.ndarray, signs, trees: int = 60, depth: int = 3, rate: float = 0.2, ridge: float = 1.0, least: float = 5.0, bins: int = 64) -> Forest:
    """Boosted trees for log-loss; classes weigh the same. signs: 1 rising, -1 falling, 0 free, per feature."""
    node = {k: [] for k in ("feature", "threshold", "left", "right", "value")}
    roots: list[int] = []
    if len(np.unique(y)) < 2:
        return Forest(*[np.zeros(0, int)] * 6, 0, 4.0 if len(y) == 0 or y[0] == 1 else -4.0)
    weight = np.where(y == 1, len(y) / (2 * (y == 1).sum()), len(y) / (2 * (y == 0).sum()))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)])
    margin = np.zeros(len(y))

    def leaf(g: float, h: float, low: float, high: float) -> float:
        return float(np.clip(-g / (h + ridge), low, high))

    def grow(rows: np.ndarray, level: int, low: float, high: float) -> int:
        k = len(node["value"])
        g, h = grad[rows], hess[rows]
        total_g, total_h = g.sum(), h.sum()
        for name, v in (("feature", 0), ("threshold", 0.0), ("left", k), ("right", k), ("value", rate * leaf(total_g, total_h, low, high))):
            node[name].append(v)
        best = None
        for j in range(x.shape[1]) if level < depth else ():
            gl, hl = (np.cumsum(np.bincount(binned[rows, j], v, len(edges[j]) + 1))[:-1] for v in (g, h))
            gr, hr = total_g - gl, total_h - hl
            gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - total_g**2 / (total_h + ridge)
            left, right = np.clip(-gl / (hl + ridge), low, high), np.clip(-gr / (hr + ridge), low, high)
            gain[(hl < least / 4) | (hr < least / 4) | (signs[j] * (right - left) < 0)] = -1
            if len(gain) and (top := int(np.argmax(gain))) is not None and gain[top] > 1e-6 and (best is None or gain[top] > best[0]):
                best = (gain[top], j, top, left[top], right[top])
        if best:
            _, j, cut, wl, wr = best
            goes = binned[rows, j] <= cut
            middle = (wl + wr) / 2
            bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[signs[j]]
            node["feature"][k], node["threshold"][k] = j, float(edges[j][cut])
            node["left"][k] = grow(rows[goes], level + 1, *bounds[0])
            node["right"][k] = grow(rows[~goes], level + 1, *bounds[1])
        return k

    flat = None
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = weight * (p - y), weight * p * (1 - p)
        roots.append(grow(np.arange(len(y)), 0, -np.inf, np.inf))
        flat = Forest(*(np.array(node[k]) for k in node), np.array(roots), depth, 0.0)
        one = Forest(flat.feature, flat.threshold, flat.left, flat.right, flat.value, flat.roots[-1:], depth, 0.0)
        at = np.clip(one.probability(x), 1e-15, 1 - 1e-15)
        margin = margin + np.log(at / (1 - at))
    return flat


def fit_rules(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Forest:
    """Fits on at most per_class documents of each label; without both labels nothing is rejected by the trees."""
    width = len(FEATURES)
    schema = T.StructType([T.StructField("doc_id", T.StringType()), T.StructField("y", T.LongType()), *[T.StructField(f, T.DoubleType()) for f in FEATURES]])

    @tidy
    def measure(batches):
        for batch in batches:
            for a, b in slices(batch.column(1)):
                _, x = statistics(batch.column(1)[a:b])
                yield pa.record_batch([batch.column(0)[a:b], batch.column(2)[a:b], *[pa.array(x[:, j]) for j in range(width)]], names=schema.names)

    rows = training_rows(docs, labels, per_class).select(F.col("doc_id").cast("string").alias("doc_id"), "text", F.col("y").cast("long").alias("y"))
    found = rows.mapInArrow(measure, schema).toPandas().sort_values("doc_id")  # at most 2 x per_class rows of numbers
    return fit_forest(found[list(FEATURES)].to_numpy(float), found["y"].to_numpy(int), list(FEATURES.values()))


def judge_texts(texts: pa.Array, forest: Forest, keep: float = KEEP, min_words: int = 50, max_repeat: int = 50) -> tuple:
    """(base statistics, base_failed, score, kept) of a string column."""
    base, x = statistics(texts)
    score = forest.probability(x)
    failed = (base[:, 0] < min_words) | (100 * base[:, 4] > max_repeat * base[:, 0])
    return base, failed, score, ~failed & (score >= keep)


def passes(texts: pa.Array, forest: Forest, keep: float = KEEP) -> np.ndarray:
    return judge_texts(texts, forest, keep)[3]


def apply_rules(docs: DataFrame, forest: Forest, keep: float = KEEP, min_words: int = 50, max_repeat: int = 50) -> DataFrame:
    """(doc_id, the five base statistics, base_failed, score, kept) of every document.

    A null or empty text has no words and fails the base rules. Repeated rows are judged each; other columns are
    ignored; an empty table gives no rows. One map, no shuffle.
    """
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), *[T.StructField(c, T.LongType()) for c in BASE], T.StructField("base_failed", T.BooleanType()), T.StructField("score", T.DoubleType()), T.StructField("kept", T.BooleanType())])

    @tidy
    def judge(batches):
        for batch in batches:
            for a, b in slices(batch.column(1)):
                base, failed, score, kept = judge_texts(batch.column(1)[a:b], forest, keep, min_words, max_repeat)
                yield pa.record_batch([batch.column(0)[a:b], *[pa.array(base[:, j]) for j in range(5)], pa.array(failed), pa.array(score), pa.array(kept)], names=schema.names)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(judge, schema)
