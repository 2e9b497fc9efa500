"""The attention classifier's encoding, attention and score, computed again word by word."""

import math

import numpy as np
import pyarrow as pa


def described(text):
    """The passages of a text as lists of numbers, by loops over words and bytes."""
    from strandlake.llm.mil import BUCKETS, PASSAGE
    from strandlake.llm.words import split

    blank = b" \t\n\x0b\x0c\r"
    data, spans, i = (text or "").encode(), [], 0
    while i < len(data):
        if data[i] in blank:
            i += 1
            continue
        j = i
        while j < len(data) and data[j] not in blank:
            j += 1
        spans.append((i, j))
        i = j
    lower = lambda w: bytes(b + 32 if 65 <= b <= 90 else b for b in w)
    out = []
    for k in range(0, len(spans), PASSAGE):
        own = spans[k : k + PASSAGE]
        words = [lower(data[a:b]) for a, b in own]
        inside = data[own[0][0] : own[-1][1]]
        n, size = len(own), sum(b - a for a, b in own)
        row = [math.log1p(n), size / n]
        classes = (b"#*$%&|<>", bytes(range(65, 91)), b"!", b"0123456789", b".,;:?", b"\n", bytes(range(128, 256)))
        row += [sum(c in x for c in inside) / (size if m in (1, 3, 6) else n) for m, x in enumerate(classes)]
        row += [sum(a == b for a, b in zip(words, words[1:], strict=False)) / n, len(set(words)) / n, 1.0]
        buckets = [0.0] * BUCKETS
        for w in words:
            h = int(split(pa.array([w.decode()])).hash[0])
            buckets[h % BUCKETS] += -1.0 if h >> 20 & 1 else 1.0
        out.append(row + [b / math.sqrt(n) for b in buckets])
    return out or [[0.0] * (len(row) if spans else 12 + BUCKETS)]


def scored(rows, model):
    p = {k: v.astype(float) for k, v in model.p.items()}
    hidden, weights = [], []
    for row in rows:
        x = [(v - m) / s for v, m, s in zip(row, model.mean, model.scale, strict=True)]
        h = [math.tanh(sum(a * b for a, b in zip(x, p["enc"][:, j], strict=True)) + p["enc0"][j]) for j in range(len(p["enc0"]))]
        t = 0.0
        for g in range(len(p["w"])):
            gate = 1 / (1 + math.exp(-sum(a * b for a, b in zip(h, p["u"][:, g], strict=True))))
            t += math.tanh(sum(a * b for a, b in zip(h, p["v"][:, g], strict=True))) * gate * p["w"][g]
        hidden.append(h)
        weights.append(math.exp(t))
    z = [sum(w * h[j] for w, h in zip(weights, hidden, strict=True)) / sum(weights) for j in range(len(hidden[0]))]
    return 1 / (1 + math.exp(-(sum(a * b for a, b in zip(z, p["c"], strict=True)) + p["c0"][0])))


def test_scores_word_by_word():
    from strandlake.llm.mil import fit_bags, passages

    rng = np.random.default_rng(4)
    words = ["Alpha", "beta", "G4MMA!", "d#lta", "é", "字字", "zz.", "zz.", "1,2"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", "\n", "\t ", "  "]) for _ in range(int(n))) for n in rng.integers(1, 300, 30)] + ["", None, "one", " \n", "x" * 5000]
    for t in texts:
        got, first = passages(pa.array([t], pa.string()))
        assert np.allclose(got, described(t), atol=1e-5) and first.tolist() == [0, len(got)]
    model = fit_bags([passages(pa.array([t], pa.string()))[0] for t in texts], np.array([i % 2 for i in range(len(texts))]))
    got = model.score(pa.array(texts, pa.string()))
    assert np.allclose(got, [scored(described(t), model) for t in texts], atol=1e-4) and got.min() < 0.4 < 0.6 < got.max()
