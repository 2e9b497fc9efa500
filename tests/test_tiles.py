"""Tiled sequences against plain Python, over tile borders, repeats, nulls and a long sequence."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F


def made(spark, rows):
    return spark.createDataFrame(rows, "name string, seq string, bases string").drop("bases") if rows and len(rows[0]) == 3 else spark.createDataFrame(rows, "name string, seq string")


def random_sequences(rng):
    rows = [(f"c{i}", "".join(rng.choice(list("ACGTN"), int(rng.integers(0, 60))))) for i in range(12)]
    return [*rows, ("c3", rows[3][1]), ("c4", "ACGT" * 9), ("empty", ""), ("none", None), (None, "ACGTACGT")]


@pytest.mark.parametrize("width", [3, 8, 1000])
def test_tiles_and_back(spark, width):
    from strandlake.operators.tiles import tiled, untiled

    rows = random_sequences(np.random.default_rng(1))
    tiles = tiled(made(spark, rows), width)
    assert all(len(r.bases or "") <= width for r in tiles.collect())
    assert sorted(map(tuple, untiled(tiles).collect()), key=str) == sorted(rows, key=str)
    assert untiled(tiled(made(spark, []), width)).count() == 0


@pytest.mark.parametrize("width", [3, 8, 1000])
def test_mask_and_extract(spark, width):
    from strandlake.operators.tiles import extract, mask

    rng = np.random.default_rng(width)
    rows = random_sequences(rng)
    spans, merged = [], []
    for name, _ in dict(rows).items():
        cuts = np.unique(rng.integers(0, 70, 6)).tolist()
        merged += [(name, a, b) for a, b in zip(cuts[:-1:2], cuts[1::2], strict=False)]
        spans += [(name, int(a), int(a + n), "t") for a, n in zip(rng.integers(0, 70, 5), rng.integers(0, 40, 5), strict=True)]
    merged += [("c1", 2**40, 2**41), ("unknown", 1, 5)]
    spans += [spans[0], ("c1", 2**40, 2**41, None), ("unknown", 1, 5, "t")]
    bed = spark.createDataFrame(merged, "contig string, start_pos long, end_pos long")
    got = sorted(map(tuple, mask(made(spark, rows), bed, width).collect()), key=str)

    def hidden(name, seq):
        out = list(seq or "")
        for c, a, b in merged:
            if c == name and name is not None:
                out[a:b] = "N" * len(out[a:b])
        return name, None if seq is None else "".join(out)

    assert got == sorted((hidden(*r) for r in rows), key=str)
    asked = spark.createDataFrame(spans, "contig string, start_pos long, end_pos long, tile string")
    want = [(c, a, b, t, None if s is None else s[a:b]) for c, a, b, t in spans for n, s in rows if n == c and c is not None]
    named = asked.withColumnRenamed("tile", "label")
    assert sorted(map(tuple, extract(made(spark, rows), named, width).select("name", "start_pos", "end_pos", "label", "seq").collect()), key=str) == sorted(want, key=str)
    assert mask(made(spark, []), bed, width).count() == 0 and extract(made(spark, rows), named.limit(0), width).count() == 0


def edited(seq, variants):
    best = {}
    for pos, ref, alt in variants:
        best[pos] = min(best.get(pos, (ref, alt)), (ref, alt))
    out, at, free, n = [], 0, 1, 0
    for pos in sorted(best):
        ref, alt = best[pos]
        if seq[pos - 1 : pos - 1 + len(ref)] == ref and pos - 1 + len(ref) <= len(seq) and pos >= free:
            out += [seq[at : pos - 1], alt]
            at, free, n = pos - 1 + len(ref), pos + len(ref), n + 1
    return "".join([*out, seq[at:]]), n


@pytest.mark.parametrize("width,stretch", [(3, 7), (8, 20), (1000, 1_000_000)])
def test_edits(spark, monkeypatch, width, stretch):
    from strandlake.operators import tiles

    monkeypatch.setattr(tiles, "STRETCH", stretch)
    rng = np.random.default_rng(width)
    rows = random_sequences(rng)
    variants = []
    for name, seq in dict(rows).items():
        for _ in range(14):
            if seq:
                p, n = int(rng.integers(0, len(seq))), int(rng.integers(1, 9))
                ref = seq[p : p + n] if rng.random() < 0.8 else "A" * n
                variants.append((name, p + 1, ref, "".join(rng.choice(list("ACGT"), int(rng.integers(0, 5))))))
    variants += [("c1", 2**33, "A", "C"), ("unknown", 1, "A", "C"), ("c2", 5, None, "A")]
    got = tiles.apply_edits(made(spark, rows), spark.createDataFrame(variants, "contig string, pos long, ref string, alt string"), width)
    want = []
    for name, seq in rows:
        own = [v[1:] for v in variants if v[0] == name and name is not None and v[2] is not None]
        want.append((name, *(edited(seq, own) if seq is not None else (None, 0))))
    assert sorted(map(tuple, got.select("name", "seq", "applied").collect()), key=str) == sorted(want, key=str)


def test_reference_bases(spark):
    from strandlake.operators.tiles import bases_at

    sites = spark.createDataFrame([("c", p, "x") for p in (0, 1, 3, 4, 8, 9, 2**40, None)] + [("d", 1, "x")], "contig string, pos long, bases_ string")
    got = {r.pos: r.ref for r in bases_at(sites, made(spark, [("c", "acgtACGT")]), 3).collect()}
    assert got == {1: "A", 3: "G", 4: "T", 8: "T"}


def test_a_long_sequence_in_seconds(spark):
    from strandlake.operators.tiles import apply_edits, extract, mask

    rng = np.random.default_rng(4)
    seq = np.frombuffer(b"ACGT", np.uint8)[rng.integers(0, 4, 50_000_000)].tobytes().decode()
    starts = np.sort(rng.choice(49_000, 10_000, replace=False)) * 1000
    long = made(spark, [("chr", seq)])
    bed = spark.createDataFrame([("chr", int(a), int(a) + 500) for a in starts], "contig string, start_pos long, end_pos long")
    began = time.time()
    masked = mask(long, bed).select(F.length("seq"), F.length(F.replace("seq", F.lit("N"), F.lit("")))).first()
    cut = {r.start_pos: r.seq for r in extract(long, bed).collect()}
    variants = bed.select("contig", (F.col("start_pos") + 1).alias("pos")).join(spark.createDataFrame([(int(a) + 1, seq[a : a + 3]) for a in starts.tolist()], "pos long, ref string"), "pos").withColumn("alt", F.lit("A"))
    done = apply_edits(long, variants).select(F.length("seq"), "applied").first()
    took = time.time() - began
    print("mask, extract and edits of 50 Mb:", round(took, 1), "s")
    assert tuple(masked) == (50_000_000, 45_000_000) and len(cut) == 10_000 and all(cut[int(a)] == seq[a : a + 500] for a in starts[::97].tolist())
    assert tuple(done) == (50_000_000 - 20_000, 10_000) and took < 60
