"""k-mers that travel as stretches of sequence, and queries that finish within a bucket, against plain counts."""

import random
import re
from collections import Counter

import numpy as np
import pytest


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def canonical(seq, k):
    for x in (seq[i : i + k] for i in range(len(seq) - k + 1)):
        if "N" not in x:
            yield min(x, x[::-1].translate(str.maketrans("ACGT", "TGCA")))


def texts(r, n=40):
    """Sequences with common parts, repeats of one base, copies and gaps."""
    base = "".join(r.choice("ACGT") for _ in range(700))
    return [base[a : a + r.randrange(200)] + r.choice(["N", "", "A" * 50]) + base[: r.randrange(90)] for a in (r.randrange(500) for _ in range(n))] + [base[:300]] * 5 + [""]


@pytest.mark.parametrize("k", [1, 5, 11, 21, 30, 31])
def test_stretches_are_the_kmers(k):
    from strandlake.operators import kmers as km

    rng = np.random.default_rng(k)
    bases = rng.integers(0, 4, 3000).astype(np.uint8)
    bases[rng.integers(0, 3000, 20)], bases[100:200] = 4, 0
    bases = np.concatenate([bases, [4], np.where(bases > 3, 4, 3 - bases)[::-1]]).astype(np.uint8)  # and the other strand
    start, code = km.canonical_codes(bases, k)
    at, count, least, word = km.stretches(bases, k)
    got, of = km._expanded(word, count.astype(np.uint8), k)
    assert got.tolist() == code.tolist() and count.max() <= 33 - k
    assert len({*zip(got.tolist(), least[of].tolist(), strict=True)}) == len({*got.tolist()})
    if k == 21:
        assert 5 * len(word) < len(code)
    assert km.spelled_codes(got[:50], k).to_pylist() == ["".join("ACGT"[c >> 2 * (k - 1 - i) & 3] for i in range(k)) for c in got[:50].tolist()]
    assert not len(km.stretches(bases[: k - 1], k)[3]) and not len(km.stretches(np.full(90, 4, np.uint8), k)[3])


def test_union_counts_in_one_shuffle(spark, monkeypatch):
    """counts of the databases are added up in their bucket; the plan has one exchange, of blocks, and no aggregate."""
    from strandlake import catalog
    from strandlake.operators import kmers as km

    monkeypatch.setattr(km, "SORTED", 300)
    seqs = [(str(i % 3 - 1), s) for i, s in enumerate(texts(random.Random(1)))] + [(None, "ACGTTGCAACGGTTACCAGTACGGT"), ("2", None)]
    want = Counter(x for _, s in seqs for x in canonical(s or "", 21))
    got = km.union_counts(spark.createDataFrame(seqs, "role string, seq string").repartition(5))
    rows = got.collect()
    assert len(rows) == len(want) and {r.kmer: r.n for r in rows} == want
    for df in (got, catalog.queries()["kmer_union_sum"](spark, "/root/testdata/sf0.001")):
        assert len(re.findall(r"\bExchange\b", plan_of(df).split("Initial Plan")[0])) == 1 + (df is got) and "Aggregate" not in plan_of(df)


def test_containment_over_one_shuffle(spark, monkeypatch):
    """against sets, with null and empty keys and ties; all k-mers are shuffled once, as blocks, and met twice."""
    from strandlake.operators import kmers as km
    from strandlake.operators import sketches as sk

    monkeypatch.setattr(km, "SORTED", 300)
    r = random.Random(2)
    same = "".join(r.choice("ACGT") for _ in range(60))
    rows = [(r.choice(["a", "b", "c c", "", None]), r.random() < 0.3, s) for s in texts(r)] + [("t1", False, same), ("t2", True, same), ("t2", True, None), ("lone", None, "ACCA" * 9)]
    sets, read = {}, set()
    for f, flag, s in rows:
        made = set(canonical(s or "", 21))
        sets.setdefault(f, set()).update(made)
        read |= made if flag else set()
    share = {f: len(x & read) / len(x) for f, x in sets.items()}
    won = Counter(min((-share[f], f) for f in sets if f is not None and x in sets[f]) for x in read if any(x in sets[f] for f in sets if f is not None))
    won = {f: n for (_, f), n in won.items()}
    df = spark.createDataFrame(rows, "file string, reads boolean, seq string").repartition(5)
    got = sk.containment_counts(df)
    found = got.collect()
    assert {x.file: (x.hashes, x.found, x.won, x.share) for x in found} == {f: (len(x), len(x & read), won.get(f, 0), share[f]) for f, x in sets.items() if share[f]}
    assert len(found) == 7 and won["t1"] == 40 and "t2" not in won
    ran = plan_of(got).split("Initial Plan")[0]
    assert len(re.findall(r"MapInArrow cut", ran)) == 1 and len(re.findall(r"MapInArrow merge", ran)) == 2 and "code" not in ran


@pytest.mark.parametrize("cap", [None, 0.5, 2.0])
def test_sites_by_rule_are_those_of_a_table(spark, monkeypatch, cap):
    """sums by sample and site as from the join with a table of the same k-mers; sequences are read once."""
    from pyspark.sql import functions as F

    from strandlake import catalog_genome as cg
    from strandlake.operators import kmers as km
    from strandlake.operators import sketches as sk

    monkeypatch.setattr(sk, "HELD", 20)
    monkeypatch.setattr(sk, "OWNERS", 6)
    r = random.Random(3)
    rows = [(r.choice(["a", "b", "c", "", None]), s + "AAAA" + s[:60]) for s in texts(r)] + [("d", None), (None, "AAACCGGTTACGTACCATTGA"), ("d", "CCC" * 20)]
    df = spark.createDataFrame(rows, "sample string, seq string").repartition(3)
    got = sk.site_rule_counts(df, cg.site_rule, cap=cap)
    found = sorted(map(tuple, got.withColumn("site", km.spelled(F.col("site"), 8)).collect()), key=str)
    sites = cg.sites_of(df)
    want = sorted(map(tuple, sk.site_kmer_counts(km.packed_counts(df, keep=("sample",)), sites, cap).collect()), key=str)
    assert found == want and len(want) > 20 and any(x[2] for x in want) and any(x[3] for x in want)
    total, names = Counter(), {x[:2] for x in want}
    for f, s in rows:
        for x in canonical(s or "", 21):
            if x.startswith("AAA"):
                total[f, x[4:12], x[12] in "GT"] += 1
    if cap is None:
        assert {(f, x): (total[f, x, False], total[f, x, True]) for f, x in names} == {x[:2]: x[2:] for x in want} and len({k[:2] for k in total}) == len(names)
    else:
        got.collect()
        assert plan_of(got).split("Initial Plan")[0].count("MapInArrow count") == 1


def test_sex_markers_by_rule_are_those_of_a_table(spark, monkeypatch):
    """counts as from the join with a table of the same k-mers; a row per contig is shuffled, and none is a k-mer."""
    from pyspark.sql import functions as F

    from strandlake import catalog
    from strandlake import catalog_genome as cg
    from strandlake.operators import kmers as km
    from strandlake.operators import sketches as sk

    monkeypatch.setattr(km, "PIECE", 150)
    r = random.Random(4)
    rows = [(f"s{i % 30}" if i % 9 else None, s) for i, s in enumerate(texts(r, 60))] + [("none", "GGG" * 20), ("short", "ACG"), ("null", None), ("gap", "N" * 300)]
    df = spark.createDataFrame(rows, "name string, seq string").repartition(3)
    want: dict = {}
    for f, s in rows:
        for x in canonical(s or "", 21):
            if x[:2] in ("AA", "AC", "CA"):
                want.setdefault(f, [0, 0, 0])[("AA", "AC", "CA").index(x[:2])] += 1
    want = {f: (x, y, p, 1 if y > x else 2 if x > y else None) for f, (x, y, p) in want.items()}
    got = sk.kmer_sex_rule(df, cg.sex_rule)
    assert {x[0]: tuple(x[1:]) for x in got.collect()} == want and got.count() == len(want) > 20
    markers = cg._spelled(km.packed_counts(df)).withColumn("chrom", F.expr(cg._CHROM)).where("chrom is not null").select("code", "chrom")
    assert {x[0]: tuple(x[1:]) for x in sk.kmer_sex_group(df, markers).collect()} == want
    known = catalog.queries()["kmer_sex_group"](spark, "/root/testdata/sf0.001")
    assert known.columns == got.columns and not re.search("code|bucket|Join", plan_of(known))


def test_hapmers_over_one_shuffle(spark, monkeypatch):
    """against counts in memory and the form over tables; the k-mers are shuffled once, as blocks."""
    from pyspark.sql import functions as F

    from strandlake.operators import kmers as km

    monkeypatch.setattr(km, "SORTED", 300)
    r = random.Random(5)
    own = ["".join(r.choice("ACGT") for _ in range(400)) for _ in range(3)]
    rows = [(r.choice("01"), s) for s in texts(r)] + [(str(i % 2), own[i % 2][: r.randrange(60, 400)]) for i in range(14)] + [("2", own[0][:200] + "N" + own[1]), ("3", own[0]), (None, own[1]), ("2", None)]
    rows += [("2", s) for s in texts(r, 8)]
    count = {x: Counter(y for f, s in rows if f == x for y in canonical(s or "", 21)) for x in "012"}
    want = set()
    for me, other, parent in (("0", "1", "mat"), ("1", "0", "pat")):
        sizes = sorted(Counter(count[me].values()).items())
        least = next((n for (n, d), (_, e) in zip(sizes, sizes[1:], strict=False) if d <= e), 1)
        want |= {(x, parent) for x, n in count[me].items() if n >= least and x not in count[other] and x in count["2"]}
    df = spark.createDataFrame(rows, "role string, seq string").repartition(3)
    got = km.hapmer_counts(df)
    found = [tuple(x) for x in got.collect()]
    assert len(found) == len(want) and set(found) == want and {p for _, p in want} == {"mat", "pat"}
    part = [km.packed_counts(df.where(F.col("role") == x)) for x in "012"]
    assert {(x.kmer, x.parent) for x in km.hapmers(*part).select(km.spelled(F.col("code"), 21).alias("kmer"), "parent").collect()} == want
    ran = plan_of(got).split("Initial Plan")[0]
    assert ran.count("MapInArrow cut") == 1 and ran.count("MapInArrow merge") == 2 and "code" not in ran
    assert km.hapmer_counts(df.limit(0)).count() == 0
