"""Operators against brute force where SQL says little: stretches, pileups, adapters, sketches, kinetics, files."""

import math
import random

import pytest
from pyspark.sql import functions as F


def test_intervals_in_stretches(spark, monkeypatch):
    from strandlake.operators import alignments, intervals

    monkeypatch.setattr(intervals, "STRETCH", 50)
    rng = random.Random(1)
    rows = [(f"c{rng.randrange(3)}", a := rng.randrange(0, 600), a + rng.randrange(1, 90), rng.choice("xyz")) for _ in range(120)]
    contigs = {"c0": 700, "c1": 500, "c2": 650, "c3": 120}
    df = spark.createDataFrame(rows, "contig string, start_pos long, end_pos long, source string").repartition(3)
    want = set()
    for c in contigs:
        for a, b, s in sorted((a, b, s) for x, a, b, s in rows if x == c):
            last = [w for w in want if w[0] == c]
            top = max(last, key=lambda w: w[2], default=None)
            if top and a <= top[2] + 5:
                want.remove(top)
                want.add((c, top[1], max(b, top[2]), "".join(sorted(set(top[3] + s)))))
            else:
                want.add((c, a, b, s))
    got = {(r.contig, r.start_pos, r.end_pos, r.source.replace(";", "")) for r in intervals.merge(df, 5, ("source",)).collect()}
    assert got == want
    sizes = spark.createDataFrame(list(contigs.items()), "contig string, length long")
    depth = {}
    for c, n in contigs.items():
        end = max([n, *[b for x, _, b, _ in rows if x == c]])
        at = [0] * end
        for x, a, b, _ in rows:
            if x == c:
                for i in range(a, b):
                    at[i] += 1
        for d in at:
            depth[c, d] = depth.get((c, d), 0) + 1
    assert {(r.contig, r.depth): r.bases for r in intervals.depth(df, sizes).collect()} == depth

    sites = sorted({rng.randrange(0, 3000) for _ in range(200)})
    runs, run = [], [sites[0]]
    for a, b in zip(sites, sites[1:], strict=False):
        if b - a > 12:
            runs.append(run)
            run = []
        run.append(b)
    runs.append(run)
    made = alignments.variant_clusters(spark.createDataFrame([("c", x) for x in sites], "contig string, pos long"), 12, 3)
    assert sorted((r.start_pos, r.end_pos, r.sites) for r in made.collect()) == [(x[0], x[-1] + 1, len(x)) for x in runs if len(x) >= 3]


@pytest.mark.parametrize("k,compress", [(5, False), (21, False), (7, True)])
def test_kmers_over_pieces(spark, monkeypatch, k, compress):
    from collections import Counter

    from strandlake.operators import kmers

    monkeypatch.setattr(kmers, "PIECE", 40)
    rng = random.Random(k)
    seqs = [None, "", "ACG", "N" * 60] + ["".join(rng.choice("ACGTacgtN" if i % 3 else "AC") for _ in range(rng.randrange(1, 200))) for i in range(40)]
    want = Counter()
    for s in seqs:
        s = (s or "").upper()
        if compress:
            s = "".join(c for i, c in enumerate(s) if not i or c != s[i - 1])
        for i in range(len(s) - k + 1):
            x = s[i : i + k]
            if "N" not in x:
                want[min(x, x.translate(str.maketrans("ACGT", "TGCA"))[::-1])] += 1
    df = spark.createDataFrame([(f"s{i}", s) for i, s in enumerate(seqs)], "name string, seq string").repartition(2)
    assert {r.kmer: r.n for r in kmers.kmer_count(df, k, compress=compress).collect()} == dict(want)
    by_name = kmers.packed_counts(df, k, keep=("name",), compress=compress)
    assert by_name.agg(F.sum("n")).first()[0] == (sum(want.values()) or None)


def test_sketches(spark):
    from strandlake.operators import kmers, sketches

    rng = random.Random(9)
    base = "".join(rng.choice("ACGT") for _ in range(3000))
    rows = [("a", base), ("b", base[:2000] + "".join(rng.choice("ACGT") for _ in range(1000))), ("c", base[1000:]), ("d", "".join(rng.choice("ACGT") for _ in range(3000)))]
    df = spark.createDataFrame(rows, "file string, seq string")
    hashes = {}
    for r in kmers.packed_counts(df, 15, keep=("file",)).select("file", sketches.code_hash(F.col("code")).alias("h")).collect():
        hashes.setdefault(r.file, set()).add(r.h)
    made = sketches.minhash_sketch(df, 15, 300)
    got = {}
    for r in made.collect():
        got.setdefault(r.file, set()).add(r.hash)
    assert got == {f: set(sorted(h)[:300]) for f, h in hashes.items()}
    for r in sketches.minhash_dist(made, 15, 300).collect():
        union = sorted(got[r.a] | got[r.b])[:300]
        shared = sum(h in got[r.a] and h in got[r.b] for h in union)
        j = shared / len(union)
        assert (r.shared, r.merged) == (shared, len(union)) and math.isclose(r.distance, -math.log(2 * j / (1 + j)) / 15)
    ranks = {r.file: (r.found, r.won) for r in sketches.containment_screen(made, made.where("file = 'a'")).collect()}
    assert ranks["a"] == (300, 300) and ranks["b"][1] == 0


def test_adapters_with_errors(spark):
    from strandlake.operators.reads import discard_adapter_reads

    rng = random.Random(5)
    adapter = "ACGTTGCAACGGTTACCAGT"

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
        return row[-1]

    def bad(seq):
        back = adapter.translate(str.maketrans("ACGT", "TGCA"))[::-1]
        for a in (adapter, back):
            if any(distance(seq[i : i + n], a) <= 2 for i in range(len(seq)) for n in range(18, 23)):
                return True
            if any(distance(seq[:n], a[-n:]) <= int(0.1 * n) or distance(seq[-n:], a[:n]) <= int(0.1 * n) for n in range(14, 20)):
                return True
        return False

    seqs = ["", "ACGT"]
    for i in range(60):
        s = [rng.choice("ACGT") for _ in range(rng.randrange(30, 900 if i < 6 else 120))]
        if i % 2:
            own = list(adapter)
            for _ in range(i % 5):
                own[rng.randrange(len(own))] = rng.choice(["A", "C", "", "GT"])
            at = rng.choice([0, len(s), rng.randrange(len(s))])
            s[at:at] = own[: rng.choice([20, 20, 15])]
        seqs.append("".join(s))
    reads = spark.createDataFrame(list(enumerate(seqs)), "read_id int, seq string")
    assert {r.read_id for r in discard_adapter_reads(reads, (adapter,), 0.1, 14).collect()} == {i for i, s in enumerate(seqs) if not bad(s)}


def test_methylation(spark):
    from strandlake.operators.calls import methyl_pileup

    # + strand: Cs at 1, 4, 7 of ACGACCTCGA... ; the second C named is skipped once.
    rows = [("c", 11, "+", "8M", "ACGTCGCC", "C+m,0,0;", [250, 10]), ("c", 11, "+", "2S6M", "ACGTCGCC", "C+m,1;", [250]), ("c", 11, "-", "8M", "ACGTCGCC", "C+m,0;", [255]), ("c", 11, "+", "3M2D5M", "ACGTCGCC", None, None)]
    df = spark.createDataFrame(rows, "contig string, pos int, strand string, cigar string, seq string, mm string, ml array<int>")
    got = {r.pos: (r.coverage, r.modified) for r in methyl_pileup(df).collect()}
    # First read: C at 1 (CpG, 250: modified) at 11, C at 4 (CpG, 10: plain) at 14. Second: the C at 1 is clipped, that at 4 is
    # modified at 12. Third: Gs from the end on: that at 5 is modified, its C lies at 14; that at 2 plain at 11. Fourth:
    # all plain: 11 and, past the deletion, 16.
    assert got == {11: (3, 1), 14: (2, 1), 12: (1, 1), 16: (1, 0)}


def test_kinetics(spark):
    from strandlake.operators.reads import trim_counters, trim_kinetics

    rows = [("ok", 5, 2, 1, list(range(8)), {"MM": "x", "rq": "y"}), ("skip", 5, 0, 0, [1], {"MM": "x"}), ("long", 1, 5, 5, list(range(8)), {}), ("odd", 9, 1, 1, list(range(8)), {}), ("none", 5, 1, 1, None, {}), ("empty", 5, 2, 1, [], {}), ("null", 5, None, 1, list(range(6)), {})]
    df = spark.createDataFrame([(n, m, a, b, x, x, x, x, t) for n, m, a, b, x, t in rows], "read_id string, read_len int, left_trim int, right_trim int, fi array<int>, fp array<int>, ri array<int>, rp array<int>, tags map<string,string>")
    got = {r.read_id: r for r in trim_kinetics(df).collect()}
    assert {k: r.status for k, r in got.items()} == {"ok": "fixed", "skip": "skipped", "long": "failed", "odd": "failed", "none": "failed", "empty": "fixed", "null": "failed"}
    assert got["ok"].fi == [2, 3, 4, 5, 6] and got["ok"].rp == [1, 2, 3, 4, 5] and got["ok"].tags == {"rq": "y"}
    assert got["skip"].tags == {"MM": "x"} and got["empty"].fi == [] and got["odd"].fi == list(range(8))
    assert trim_counters(trim_kinetics(df)).first().failed == 4
    with pytest.raises(Exception, match="kinetics do not fit"):
        trim_kinetics(df, strict=True).collect()


def test_switches_over_windows(spark):
    from strandlake.operators.assembly import switch_hamming

    rng = random.Random(2)
    rows = [("c", rng.randrange(0, 5_000_000), rng.choice(["mat", "mat", "pat"])) for _ in range(300)]
    order = [p for _, _, p in sorted(set(rows))]
    got = switch_hamming(spark.createDataFrame(sorted(set(rows)), "contig string, pos long, parent string")).first()
    assert (got.markers, got.switches, got.minority) == (len(order), sum(a != b for a, b in zip(order, order[1:], strict=False)), min(order.count("mat"), order.count("pat")))


def test_files(spark, tmp_path):
    from strandlake.sources import readers, writers

    fasta = tmp_path / "a.fa"
    fasta.write_text(">s1 first one\r\nACGT\r\nAC\r\n>s2\n\n>s3 x\nGG>T\n")
    assert sorted((r.file, r.name, r.description, r.seq, r.length) for r in readers.read_fasta(spark, str(fasta)).collect()) == [("a.fa", "s1", "first one", "ACGTAC", 6), ("a.fa", "s2", "", "", 0), ("a.fa", "s3", "x", "GG>T", 4)]
    reads = [(f"r{i}", "ACGTN"[i % 5] * (1 + i % 50), "@+I#5"[i % 5] * (1 + i % 50)) for i in range(400)]
    (tmp_path / "q").mkdir()
    text = "".join(f"@{n} x\n{s}\n+\n{q}\n" for n, s, q in reads)
    (tmp_path / "q/plain.fastq").write_text(text + "@cut\nAC\n")
    import gzip

    (tmp_path / "q/zip.fastq.gz").write_bytes(gzip.compress(text.encode()))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")  # records lie across splits
    try:
        got = [(r.file, r.read_id, r.seq, r.qual) for r in readers.read_fastq(spark, str(tmp_path / "q")).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(got) == sorted((f, *r) for f in ("plain.fastq", "zip.fastq.gz") for r in reads)
    out = str(tmp_path / "w")
    writers.write_fastq(spark.createDataFrame(reads, "read_id string, seq string, qual string"), out, gzip=True)
    assert sorted(tuple(r) for r in readers.read_fastq(spark, out).select("read_id", "seq", "qual").collect()) == sorted(reads)
    (tmp_path / "v.vcf").write_text("##x\n#CHROM\nc\t5\t.\tA\tG\t.\tPASS\tDP=3;FLAG\tGT:GQ\t0/1:9\nc\t6\t.\tA\tG\t7.5\t.\t.\n")
    a, b = readers.read_vcf(spark, str(tmp_path / "v.vcf")).orderBy("pos").collect()
    assert (a.info, a.format, a.qual) == ({"DP": "3", "FLAG": None}, {"GT": "0/1", "GQ": "9"}, None) and (b.info, b.format, b.qual) == (None, None, 7.5)
    (tmp_path / "m.txt").write_text("a\tb\nc\n\n")
    assert sorted(tuple(r) for r in readers.read_manifest(spark, str(tmp_path / "m.txt")).collect()) == [("a", "b"), ("c", None)]
    (tmp_path / "bad.txt").write_text("a\tb\tc\n")
    with pytest.raises(Exception, match="bad manifest line"):
        readers.read_manifest(spark, str(tmp_path / "bad.txt")).collect()
    (tmp_path / "l.fai").write_text("a\t7\t0\t60\t61\n")
    (tmp_path / "l.txt").write_text("12\n76\n")
    assert sorted(r.length for r in readers.read_lengths(spark, [str(tmp_path / "l.fai"), str(tmp_path / "l.txt")]).collect()) == [7, 12, 76]


def test_golden_read_statistics(spark):
    from strandlake.operators.lengths import length_histogram, read_stats

    lengths = [12] * 9 + [22] + [76] * 12
    got = read_stats(spark.createDataFrame([("f", x) for x in lengths], "file string, length long")).where("file = 'f'").first()
    assert (got.total_reads, got.total_bp, got.min_length, got.max_length, got.mean_length, got.q25, got.q50, got.q75, got.n25, got.n50, got.n75) == (22, 1042, 12, 76, 47, 12, 76, 76, 76, 76, 76)
    values = spark.createDataFrame([(x,) for x in (0, 5, 10, 95, 100, 101, -1)], "length long")
    assert [r.n for r in length_histogram(values, 0, 100, 10).orderBy("bin").collect()] == [2, 1, 0, 0, 0, 0, 0, 0, 0, 2]
    assert [r.n for r in length_histogram(values, 0, 100, 10, unbounded=True).orderBy("bin").collect()] == [3, 1, 0, 0, 0, 0, 0, 0, 0, 3]


def test_shared_folder_is_asked_for_on_a_cluster():
    from strandlake.sources.scratch import shared_dir

    class Fake:
        class conf:
            get = staticmethod(lambda *a: None)

        class sparkContext:
            master = "spark://host:7077"
            getConf = staticmethod(dict)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Fake)


def test_no_query_is_empty_or_keeps_all(spark):
    from strandlake import catalog

    sf = "/root/testdata/sf0.001"
    known = catalog.queries()
    for name in ("hapmers", "kmer_high_freq", "kmer_qv", "alignment_ignore_filter", "vcf_drop_star", "homozygous_regions", "sv_merge"):
        assert not known[name](spark, sf).isEmpty(), name
    from strandlake.plans.fixtures import view

    for name, source in (("alignment_ignore_filter", "fx_paf"), ("vcf_drop_star", "fx_variants")):
        assert known[name](spark, sf).count() < view(spark, sf, source).count()
