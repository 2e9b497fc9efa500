"""The Jaccard join against exact sets, with long lists, several components in a list and every round reached."""

import random
from collections import Counter, defaultdict

import pytest


def brute(texts, n=5):
    sets = []
    for t in texts:
        w = (t or "").split()
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    lists = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            lists[g].append(i)
    both = Counter()
    for own in lists.values():
        for x in range(len(own)):
            for y in range(x):
                both[own[x], own[y]] += 1
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n_both in both.items():
        if 100 * n_both >= 80 * (len(sets[a]) + len(sets[b]) - n_both):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return [len(s) for s in sets], [root(i) for i in range(len(texts))]


def corpus():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    common = [word() for _ in range(40)]
    texts = [None, "", "  ", "one two", "two one", "one two"]
    for _ in range(60):  # families of near copies at several distances, chained
        base = [word() for _ in range(rng.randrange(20, 120))]
        for _ in range(rng.randrange(1, 14)):
            texts.append(" ".join(base))
            base = list(base)
            for _ in range(rng.randrange(0, 4)):
                base[rng.randrange(len(base))] = word()
    for k in range(250):  # unlike texts that share one passage, whose shingles get into their prefixes
        texts.append(" ".join(common + [word() for _ in range(k % 60)]))
    for k in range(120):  # the same passage cut short
        texts.append(" ".join(common[k % 20 : 40 - k % 7]))
    big = [word() for _ in range(100)]
    for _ in range(200):
        own = list(big)
        for _ in range(rng.randrange(0, 5)):
            own[rng.randrange(len(own))] = word()
        texts.append(" ".join(own))
    texts += [" ".join(word() for _ in range(30)) for _ in range(300)]
    return texts


@pytest.mark.parametrize("small", [True, False])
def test_components_are_exact(spark, monkeypatch, small):
    from strandlake.llm import ngram_join

    texts = corpus()
    assert len(texts) > 1200
    reached = []
    if small:
        for name, value in (("SHORT", 4), ("BLOCK", 6), ("REACH", 12), ("HOT", 60), ("SEEN", 20)):
            monkeypatch.setattr(ngram_join, name, value)
    across = ngram_join._across
    monkeypatch.setattr(ngram_join, "_across", lambda *a: reached.append(across(*a)) or reached[-1])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    sizes, want = brute(texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(docs).collect()}
    assert got == {i: (sizes[i], want[i]) for i in range(len(texts))}
    assert reached and reached[0].count() > 0


def test_one_of_each_keeps_a_defined_row(spark):
    from strandlake.llm.ngram_join import one_of_each

    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text, "b", 1), (1, "another text", "a", 1), (2, text, "c", 1), (None, text, "d", 1), (None, None, "e", 1), (3, None, "f", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, k int")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.source) for r in one_of_each(docs.repartition(3)).collect())
    assert got == [(False, 1, "a"), (False, 3, "f"), (True, 0, "d"), (True, 0, "e")]
    assert one_of_each(docs.limit(0)).count() == 0


def test_components_broadcast_nothing(spark):
    """A driver that runs many rounds has no broadcast of each: its joins are merge joins, however small the tables are."""
    from strandlake.llm.components import connected_components

    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    links = spark.createDataFrame([(i + 1, i) for i in range(20)] + [(40, 41), (50, 50)], "a long, b long")
    got = {tuple(r) for r in connected_components(links).collect()}
    assert got == {(i, 0) for i in range(21)} | {(40, 40), (41, 40)}
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    plans = store.executionsList()
    said = [plans.apply(i).physicalPlanDescription() for i in range(before, plans.size())]
    assert any("SortMergeJoin" in x for x in said) and not any("BroadcastHashJoin" in x for x in said)
    assert connected_components(links.limit(0)).count() == 0
