"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE words. Every passage of the whole text is described by numbers, encoded by
a learned layer, weighed by gated attention that is learned from document labels alone, and the weighted mean of the
encodings is scored.
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
from .words import mix, slices, split

PASSAGE = 48
BUCKETS = 16
#: Passages of a training document that enter the fit at most, evenly spaced; scoring always reads all.
FIT_PASSAGES = 64
_FLAGS = [np.isin(np.arange(256), list(x)).astype(np.int32) for x in (b"#*$%&|<>", range(65, 91), b"!", range(48, 58), b".,;:?", b"\n", range(128, 256))]
WIDTH = 5 + len(_FLAGS) + BUCKETS


def passages(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(passages x WIDTH, first passage of each document and the end). A document without words has one passage of zeros."""
    w = split(texts, lower=True)
    words = np.diff(w.first)
    count = np.maximum(-(-words // PASSAGE), 1)
    first = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
    out = np.zeros((int(first[-1]), WIDTH), np.float32)
    if not len(w.hash):
        return out, first
    place = np.arange(len(w.doc)) - w.first[w.doc]
    of = first[w.doc] + place // PASSAGE
    heads = np.flatnonzero(place % PASSAGE == 0)
    tails = np.append(heads[1:], len(of)) - 1
    own = of[heads]
    n = (tails - heads + 1).astype(np.float64)
    size = np.add.reduceat(w.length, heads)
    begin, end = w.start[heads], w.start[tails] + w.length[tails]
    out[own, 0], out[own, 1] = np.log1p(n), size / n
    for k, flags in enumerate(_FLAGS):
        total = np.concatenate([[0], np.cumsum(flags[w.data], dtype=np.int64)])
        out[own, 2 + k] = (total[end] - total[begin]) / (size if k in (1, 3, 6) else n)
    k = 2 + len(_FLAGS)
    same = np.concatenate([[False], (w.hash[1:] == w.hash[:-1]) & (of[1:] == of[:-1])])
    out[own, k] = np.add.reduceat(same, heads, dtype=np.int64) / n
    _, at = np.unique(mix(w.hash + of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
    out[own, k + 1] = np.bincount(of[at], minlength=len(out))[own] / n
    out[own, k + 2] = 1.0
    bucket = of * BUCKETS + (w.hash & np.uint64(BUCKETS - 1)).astype(np.int64)
    sign = 1.0 - 2.0 * ((w.hash >> np.uint64(20)) & np.uint64(1)).astype(np.float64)
    out[:, -BUCKETS:] = np.bincount(bucket, sign, len(out) * BUCKETS).reshape(-1, BUCKETS)
    out[own, -BUCKETS:] /= np.sqrt(n)[:, None].astype(np.float32)
    return out, first


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class AttentionModel:
    mean: np.ndarray
    scale: np.ndarray
    p: dict[str, np.ndarray] | None

    def forward(self, x: np.ndarray, first: np.ndarray) -> tuple:
        p, heads = self.p, first[:-1]
        h = np.tanh(x @ p["enc"] + p["enc0"])
        a, g = np.tanh(h @ p["v"]), _sigmoid(h @ p["u"])
        s = (a * g) @ p["w"]
        doc = np.repeat(np.arange(len(heads)), np.diff(first))
        e = np.exp(s - np.maximum.reduceat(s, heads)[doc])
        att = e / np.add.reduceat(e, heads)[doc]
        z = np.add.reduceat(att[:, None] * h, heads, axis=0)
        return h, a, g, att, z, doc, _sigmoid(z @ p["c"] + p["c0"])

    def score(self, texts: pa.Array) -> np.ndarray:
        """Probability of label 1 of each text; 0.5 for all where the labels allow no fit."""
        if not len(texts):
            return np.zeros(0)
        x, first = passages(texts)
        if self.p is None:
            return np.full(len(texts), 0.5)
        return self.forward((x - self.mean) / self.scale, first)[-1].astype(float)


def fit_bags(bags: list[np.ndarray], y: np.ndarray, hidden: int = 24, gates: int = 12, steps: int = 150, rate: float = 0.02, seed: int = 7) -> AttentionModel:
    """Full-batch Adam on log-loss with equal class weights."""
    if len(np.unique(y)) < 2:
        return AttentionModel(np.zeros(WIDTH), np.ones(WIDTH), None)
    x = np.concatenate(bags)
    first = np.concatenate([[0], np.cumsum([len(b) for b in bags])]).astype(np.int64)
    heads = first[:-1]
    mean, scale = x.mean(0), x.std(0) + 1e-3
    x = (x - mean) / scale
    rng = np.random.default_rng(seed)
    draw = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s).astype(np.float32)
    p = {"enc": draw(WIDTH, hidden), "enc0": np.zeros(hidden, np.float32), "v": draw(hidden, gates), "u": draw(hidden, gates), "w": draw(gates), "c": draw(hidden), "c0": np.zeros(1, np.float32)}
    model = AttentionModel(mean, scale, p)
    m1, m2 = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    weight = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    for t in range(1, steps + 1):
        h, a, g, att, z, doc, out = model.forward(x, first)
        d_out = (weight * (out - y)).astype(np.float32)
        d_z = d_out[:, None] * p["c"]
        spread = d_z[doc]
        d_att = (spread * h).sum(1)
        d_h = att[:, None] * spread
        d_s = att * (d_att - np.add.reduceat(att * d_att, heads)[doc])
        d_ag = d_s[:, None] * p["w"]
        d_a, d_g = d_ag * g * (1 - a * a), d_ag * a * g * (1 - g)
        d_h = (d_h + d_a @ p["v"].T + d_g @ p["u"].T) * (1 - h * h)
        grads = {"enc": x.T @ d_h, "enc0": d_h.sum(0), "v": h.T @ d_a, "u": h.T @ d_g, "w": (a * g).T @ d_s, "c": z.T @ d_out, "c0": d_out.sum(keepdims=True)}
        for k, gr in grads.items():
            gr = gr + 1e-5 * p[k]
            m1[k] = 0.9 * m1[k] + 0.1 * gr
            m2[k] = 0.999 * m2[k] + 0.001 * gr * gr
            p[k] -= (rate * (m1[k] / (1 - 0.9**t)) / (np.sqrt(m2[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return model


def fit_classifier(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> AttentionModel:
    """Fits on at most per_class documents of each label, at most FIT_PASSAGES passages of each.

    Null and empty texts are bags of one zero passage. Rows that share a doc_id count once, with the smallest text and label; other columns are
    ignored. Without documents of both labels the model scores everything 0.5.
    """

    @tidy
    def measure(batches):
        for batch in batches:
            for a, b in slices(batch.column(1)):
                x, first = passages(batch.column(1)[a:b])
                some = [x[i:j][np.unique(np.linspace(0, j - i - 1, min(j - i, FIT_PASSAGES)).astype(int))].tobytes() for i, j in zip(first[:-1], first[1:], strict=True)]
                yield pa.record_batch([batch.column(0)[a:b], batch.column(2)[a:b], pa.array(some, pa.binary())], names=["doc_id", "y", "x"])

    rows = training_rows(docs, labels, per_class).select(F.col("doc_id").cast("string").alias("doc_id"), "text", F.col("y").cast("long").alias("y"))
    found = rows.mapInArrow(measure, "doc_id string, y long, x binary").toPandas().sort_values("doc_id")  # of bounded size
    return fit_bags([np.frombuffer(b, np.float32).reshape(-1, WIDTH) for b in found["x"]], found["y"].to_numpy(int))


def classify(docs: DataFrame, model: AttentionModel, threshold: float = 0.3) -> DataFrame:
    """(doc_id, score, predicted) of every document; predicted is 1 where score >= threshold.

    A null or empty text is a bag of one zero passage and is scored too. Repeated rows are scored each; other columns
    are ignored; an empty table gives no rows. One map, no shuffle.
    """
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    @tidy
    def judge(batches):
        for batch in batches:
            for a, b in slices(batch.column(1)):
                score = model.score(batch.column(1)[a:b])
                yield pa.record_batch([batch.column(0)[a:b], pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=schema.names)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(judge, schema)
