"""The pileup against a walk over every base."""

import re
from collections import Counter

import numpy as np
import pytest


@pytest.mark.parametrize("chunk", [50, 4_000_000])
def test_counts_of_every_base(spark, monkeypatch, chunk):
    from strandlake.operators import pileup

    monkeypatch.setattr(pileup, "CHUNK", chunk)
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(300):
        cigar = "".join(f"{int(rng.integers(1, 40))}{rng.choice(list('MIDNSHP=X'))}" for _ in range(int(rng.integers(1, 8))))
        rows.append((str(rng.choice(["c1", "c2"])), int(rng.integers(1, 900)), cigar, "".join(rng.choice(list("ACGTacgtN"), int(rng.integers(0, 160))))))
    rows += [rows[0]] * 50 + [("c1", 255, "600M", "A" * 600), (None, 5, "3M", "ACG"), ("c1", None, "3M", "ACG"), ("c1", 5, None, "ACG"), ("c1", 5, "3M", None), ("c1", 5, "*", "ACG"), ("c1", 5, "3M", "*"), ("c1", 2**30, "2M", "GT")]
    want = Counter()
    for contig, pos, cigar, seq in rows:
        if pos is None or cigar is None or seq is None:
            continue
        q, t = 0, pos
        for n, op in re.findall(r"(\d+)([MIDNSHP=X])", cigar):
            for _ in range(int(n)):
                if op in "M=X" and q < len(seq) and seq[q].upper() in "ACGT":
                    want[contig, t, seq[q].upper()] += 1
                q += op in "M=XIS"
                t += op in "M=XDN"
    df = spark.createDataFrame([(*r, 1) for r in rows], "contig string, pos int, cigar string, seq string, tile int").repartition(4)
    got = {(r.contig, r.pos): (r.a, r.c, r.g, r.t) for r in pileup.base_pileup(df).collect()}
    places = {k[:2] for k in want}
    assert got == {p: tuple(want[(*p, b)] for b in "ACGT") for p in places}
    assert pileup.base_pileup(df.limit(0)).count() == 0
