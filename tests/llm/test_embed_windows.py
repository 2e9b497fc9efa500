"""Windows of the sorted passes over cuts, and recall on labels much larger than the window, against brute force."""

import numpy as np
import pytest


def _components(n, links):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def _frame(spark, x):
    return spark.createDataFrame([(i, v, 1) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>, label int")


def test_windows_cross_cuts(spark, monkeypatch):
    from strandlake.llm import embed_dedup as ed

    monkeypatch.setattr(ed, "BLOCK", 32, raising=False)
    angle = np.linspace(0, 2.5, 300)
    x = np.column_stack([np.cos(angle), np.sin(angle)])
    unit = ed._units([v.tobytes() for v in x], 2)
    mean = np.rint(unit * ed.UNIT).sum(axis=0) / (300 * ed.UNIT)
    order = np.lexsort((np.arange(300), ed.project(unit, mean, 1, 3)[:, 0]))
    links = [(order[i], order[j]) for i in range(300) for j in range(i + 1, min(i + 6, 300)) if x[order[i]] @ x[order[j]] >= 0.93]
    want = _components(300, links)
    more = {"recall": 0.0} if hasattr(ed, "RECALL") else {}
    got = {r.vec_id: r.component_id for r in ed.dedup_embeddings(_frame(spark, x), passes=1, window=5, **more).collect()}
    assert got == dict(enumerate(want))


def test_recall_on_a_label_much_larger_than_the_window(spark):
    from strandlake.llm.embed_dedup import dedup_embeddings

    rng = np.random.default_rng(11)
    n, window = 3000, 4
    base = rng.normal(size=(n, 32))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = rng.normal(size=(n, 32))
    side -= (side * base).sum(1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    x = np.concatenate([base, 0.931 * base + np.sqrt(1 - 0.931**2) * side])  # pairs just above the threshold
    good = x @ x.T >= 0.93
    np.fill_diagonal(good, False)
    rows = dedup_embeddings(_frame(spark, x), window=window).collect()
    found = sum(r.n_links for r in rows) / good.sum()
    print("recall", found, "links", int(good.sum()))
    assert found >= 0.99


def _planted(rng, n, crowding, pairs, dim=64, cosine=0.935):
    """Unit vectors of a mean cosine, the last `pairs` of which lie at a cosine to the first ones."""
    base = rng.normal(size=(n, dim))
    base = np.sqrt(1 - crowding) * base / np.linalg.norm(base, axis=1, keepdims=True)
    base[:, 0] += np.sqrt(crowding)
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    # The partner stays in the crowd: it moves against what sets the vector apart from the mean.
    way = np.sqrt(1 - crowding) * rng.normal(size=(pairs, dim)) / np.sqrt(dim)
    way[:, 0] += np.sqrt(crowding)
    way -= (way * base[:pairs]).sum(1, keepdims=True) * base[:pairs]
    way /= np.linalg.norm(way, axis=1, keepdims=True)
    return np.concatenate([base[: n - pairs], cosine * base[:pairs] + np.sqrt(1 - cosine**2) * way])


@pytest.mark.parametrize("n,crowding", [(100_000, 0.0), (100_000, 0.5), (100_000, 0.7), (400_000, 0.7)])
def test_recall_on_crowded_labels(spark, n, crowding):
    """Pairs at the default threshold, window and recall that some pass compares; the orders are those of the operator's keys."""
    from pyspark.sql import functions as F

    from strandlake.llm import embed_dedup as ed

    x = _planted(np.random.default_rng(7), n, crowding, 1000).astype(np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    mean = np.rint(x * ed.UNIT).sum(axis=0) / (n * ed.UNIT)
    passes = spark.range(1).select(ed.passes_for(F.lit(n), F.lit(float(mean @ mean + 2 * (x @ mean).std())), 0.93, ed.WINDOW, ed.RECALL, ed.PASSES)).first()[0]
    planes, weight = ed._planes(64, passes, 3), 1 << np.arange(ed.BITS - 1, -1, -1, dtype=np.int64)
    met = np.zeros(1000, bool)
    for p in range(passes):
        keys = ((x - mean).astype(np.float32) @ planes[:, p * ed.BITS : (p + 1) * ed.BITS].astype(np.float32) > 0) @ weight
        place = np.empty(n, np.int64)
        place[np.lexsort((np.arange(n), keys))] = np.arange(n)
        met |= np.abs(place[:1000] - place[n - 1000 :]) <= ed.WINDOW
    print(n, crowding, "passes", passes, "recall", met.mean())
    assert met.mean() >= 0.99


def test_a_crowded_label_whole(spark):
    """All links of a crowded label against brute force, with a small window; the same rows over other partitions."""
    from strandlake.llm.embed_dedup import dedup_embeddings

    x = _planted(np.random.default_rng(3), 4000, 0.7, 1500, dim=32, cosine=0.96)
    good = x @ x.T >= 0.95
    np.fill_diagonal(good, False)
    df = _frame(spark, x)
    rows = {r.vec_id: (r.n_links, r.component_id) for r in dedup_embeddings(df, threshold=0.95, window=8).collect()}
    print("recall", sum(n for n, _ in rows.values()) / good.sum(), "links", int(good.sum()))
    assert sum(n for n, _ in rows.values()) >= 0.99 * good.sum()
    again = {r.vec_id: (r.n_links, r.component_id) for r in dedup_embeddings(df.repartition(7, "vec_id"), threshold=0.95, window=8).collect()}
    assert again == rows


def test_a_label_too_crowded_for_passes_is_compared_whole(spark):
    from strandlake.llm.embed_dedup import dedup_embeddings

    x = _planted(np.random.default_rng(5), 1500, 0.94, 200)
    good = x @ x.T >= 0.945
    np.fill_diagonal(good, False)
    rows = {r.vec_id: r for r in dedup_embeddings(_frame(spark, x), threshold=0.945, window=4).collect()}
    want = _components(1500, np.argwhere(np.triu(good)).tolist())
    assert [rows[i].component_id for i in range(1500)] == want and [rows[i].n_links for i in range(1500)] == good.sum(1).tolist()


def test_passes_grow_with_the_label(spark):
    from pyspark.sql import functions as F

    from strandlake.llm.embed_dedup import passes_for

    def passes(n, crowding, least, threshold=0.93):
        return spark.range(1).select(passes_for(F.lit(n), F.lit(crowding), threshold, 100, 0.995, least)).first()[0]

    assert passes(100, 0.0, 12) == 12 and passes(10**9, 0.0, 12, 1.0) == 12 and passes(10**9, 1.0, 12) == 1 << 30
    for n in (27_000, 500_000, 1_600_000):
        for crowding in (0.0, 0.6):
            met = (1 - np.arccos(1 - 0.07 / (1 - crowding)) / np.pi) ** np.log2(n / 100)
            assert 1 - (1 - met) ** passes(n, crowding, 12) >= 0.995 > 1 - (1 - met) ** (passes(n, crowding, 1) - 1)
