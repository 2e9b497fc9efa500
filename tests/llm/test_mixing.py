"""Targets, draws, permutation and words of the mix against plain Python."""

import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F


def targets(sizes, weights=(5.0, 2.0, 1.0), share=1.5, most=2.0):
    """Shares by weight; what is above a cap goes to the others until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if level * w[s] > most * sizes[s]}
        if not over:
            return out | {s: level * w[s] for s in open_}
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def test_targets(spark):
    from strandlake.llm.mixing import plan_targets

    rng = random.Random(1)
    for n in (1, 2, 5, 9):
        sizes = {s: rng.choice([0, 3, 50, 1000, 40_000]) for s in [None, *(f"s{i}" for i in range(n - 1))]}
        df = spark.createDataFrame([(s, x) for s, x in sizes.items()], "source string, source_size long")
        want = targets(sizes)
        for r in plan_targets(df).collect():
            assert abs(r.target - want[r.source]) <= 1e-6 * max(1, want[r.source])


def test_swap_or_not_permutes(spark):
    from strandlake.llm.mixing import permuted

    for n in (1, 2, 3, 10, 257):
        rows = spark.range(n).withColumn("n", F.lit(n).cast("long")).crossJoin(spark.range(3).withColumnRenamed("id", "key"))
        got = defaultdict(list)
        for r in rows.select("key", "id", permuted(F.col("id"), F.col("n"), "key", F.lit(5)).alias("p")).collect():
            got[r.key].append((r.id, r.p))
        assert all(sorted(p for _, p in own) == list(range(n)) for own in got.values())
        if n == 257:
            assert len({tuple(sorted(own)) for own in got.values()}) == 3
            moved = [abs(a - b) for a, b in zip([p for _, p in sorted(got[0])], [p for _, p in sorted(got[0])][1:])]
            assert len(set(moved)) > 60  # no arithmetic progression


def test_shards_draw_and_targets_are_met(spark):
    from strandlake.llm.mixing import mix_sources, slot_counts

    stats = spark.createDataFrame([("a", 6000.0), ("b", 3000.0), ("c", 1000.0), ("d", 0.0)], "k string, want double")
    got = Counter()
    per_shard = defaultdict(int)
    spread = []
    for r in slot_counts(stats, 100, 3).collect():
        got[r.k] += r.n
        per_shard[r.shard] += r.n
        spread += [r.n] if r.k == "a" else []
    assert set(per_shard.values()) == {100} and len(per_shard) == 100
    for k, p in (("a", 0.6), ("b", 0.3), ("c", 0.1)):
        assert abs(got[k] - 10_000 * p) < 5 * (10_000 * p * (1 - p)) ** 0.5
    sd = (sum((x - 60) ** 2 for x in spread) / len(spread)) ** 0.5
    assert 3 < sd < 7.5  # binomial: 4.9, where rounded shares would have none

    rng = random.Random(2)
    rows = [(i, " ".join("w" * (1 + i % 3) for _ in range(rng.randrange(0, 400))), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(600)]
    rows += [(600 + i, None, "b") for i in range(3)] + rows[:4]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    mix = mix_sources(docs, block=8, slots=64)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    want, taken = targets(sizes), Counter()
    source = {i: s for i, _, s in rows}
    for r in mix.per_doc.collect():
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[source[r.doc_id]]
        taken[source[r.doc_id]] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * 8 + 1
    # No block is taken twice in a round, and each round but a source's last takes all its blocks.
    blocks = defaultdict(list)
    for r in mix.slots.collect():
        blocks[r.k, r["round"]].append(r["index"])
    assert all(len(x) == len(set(x)) for x in blocks.values())
    for (k, turn), x in blocks.items():
        assert turn < 2 and (turn + 1 >= max(t for s, t in blocks if s == k) + 0 or len(x) == -(-sizes[None if k == "null" else k[1:]] // 8))


def test_mixed_documents_hold_the_words(spark):
    from strandlake.llm.mixing import mix_sources, mixed_documents

    texts = [f"  a{i}\n" + " ".join(f"w{i}x{j}" for j in range(i * 7 % 90)) for i in range(60)]
    rows = [(i, t, f"s{i % 2}", "x", 1, 2, 3) for i, t in enumerate(texts)] + [(None, "no id here at all", "s0", "x", 1, 2, 3), (99, None, "s1", "x", 1, 2, 3)]
    rows.append(rows[5])
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _w string, _parts int, _tie int, n_chars long")
    mix = mix_sources(docs, block=8, slots=32)
    taken = Counter()
    for r in mix.per_doc.collect():
        taken[r.doc_id] += r.taken
    made = mixed_documents(docs, mix)
    assert made.columns == docs.columns
    held = Counter()
    for r in made.collect():
        own = (texts[r.doc_id] if r.doc_id is not None else "no id here at all").split()
        at, n = 0, len(r.text.split())
        for w in r.text.split():  # in order, with the row's copies one after the other
            at = (own + own).index(w, at) + 1
        held[r.doc_id] += n
        assert r.n_chars == len(r.text) and r._w == "x"
    assert held == +taken
    assert mixed_documents(docs.limit(0), mix_sources(docs.limit(0))).count() == 0
