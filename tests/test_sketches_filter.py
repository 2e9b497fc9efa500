"""Suppression of k-mers that occur once, and sketches kept by tasks, against plain counts."""

import numpy as np
import pytest


def rows(spark):
    rng = np.random.default_rng(8)
    base = "".join(rng.choice(list("ACGT"), 4000))
    seqs = [base, base[1000:2000], "".join(rng.choice(list("ACGT"), 5000)), base[500:900].lower(), "ACGTN" * 30, "", None, "ACG"]
    return spark.createDataFrame([(f"s{i % 3}", s, "clash") for i, s in enumerate(seqs)] + [(None, base[:300], "clash")], "file string, seq string, code string").repartition(5)


@pytest.mark.parametrize("bits", [1 << 17, 1 << 22])
def test_suppressed_counts_are_counts_from_two_on(spark, bits):
    from strandlake.operators import kmers as km

    df = rows(spark)
    for k, least, keep, squeeze in ((21, 2, (), False), (5, 3, ("file",), False), (15, 2, ("file",), True), (31, 2, (), False)):
        want = sorted(map(tuple, km.packed_counts(df, k, least, keep, squeeze).collect()), key=str)
        got = sorted(map(tuple, km.suppressed_counts(df, k, least, keep, squeeze, bits).collect()), key=str)
        assert got == want and want
    held = km.repeated_filter(df, 21, bits=bits)
    once = np.array([r.code for r in km.packed_counts(df, 21).where("n = 1").collect()])
    at = km.slots(once, bits)
    passed = (held[at >> 3] >> (at & 7).astype(np.uint8) & 1).mean()
    assert passed < (0.15 if bits == 1 << 17 else 0.01)
    assert km.suppressed_counts(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        km.suppressed_counts(df, least=1)


def test_smallest_of_each_key(spark):
    from strandlake.operators.sketches import smallest

    rng = np.random.default_rng(9)
    made = [(None if rng.random() < 0.1 else f"k{int(rng.integers(0, 3))}", int(rng.integers(-300, 300))) for _ in range(3000)] + [("few", 1), ("few", 1), ("k0", None)]
    df = spark.createDataFrame(made, "file string, hash long").repartition(7)
    want = {}
    for key, h in made:
        if h is not None:
            want.setdefault(key, set()).add(h)
    got = {}
    for r in smallest(df, 40, "file", 3).collect():
        got.setdefault(r.file, []).append(r.hash)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v)[:40] for k, v in want.items()}
    assert smallest(df.limit(0), 40, "file").count() == 0
