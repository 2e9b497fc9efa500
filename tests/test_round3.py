"""Findings of round 3: SQL without ties, names of large keys, reports in bundles."""

import duckdb
import pytest

from strandlake import catalog

SF = "/root/testdata/sf0.1"


def test_merge_sql_breaks_ties():
    """Rows of equal places and unlike labels lie in the island that their place gives, as a sweep of the rows shows."""
    db = duckdb.connect()
    db.execute(f"create view lineitem as select * from '{SF}/lineitem.parquet'")
    sql = catalog.oracle_sql()["interval_merge"]
    got = sorted(db.execute(sql).fetchall())
    rows = db.execute(sql[: sql.index(", e as (")] + " select * from d order by all").fetchall()
    want, end = [], None
    for contig, a, b, source, hit in rows:
        if end is None or want[-1][0] != contig or a > end + 5:
            want.append([contig, a, b, {source}, {hit}])
            end = b
        else:
            end = max(end, b)
            want[-1][2] = end
            want[-1][3].add(source)
            want[-1][4].add(hit)
    assert got == sorted((c, a, b, ";".join(sorted(s)), ";".join(sorted(h))) for c, a, b, s, h in want)


@pytest.fixture(scope="module")
def large_keys(tmp_path_factory):
    """Customers and orders whose keys have five and six digits with the same beginning."""
    folder = tmp_path_factory.mktemp("keys")
    db = duckdb.connect()
    db.execute(f"copy (select * replace (c_custkey * 10 + 12340 + (c_custkey % 7) * 111100 as c_custkey, c_custkey % 25 as c_nationkey) from '{SF}/customer.parquet' where c_custkey < 40 union all select * replace (12345 as c_custkey, 3 as c_nationkey) from '{SF}/customer.parquet' where c_custkey = 0 union all select * replace (1234500 + c_custkey as c_custkey, c_custkey % 4 as c_nationkey) from '{SF}/customer.parquet' where c_custkey < 10) to '{folder}/customer.parquet'")
    db.execute(f"copy (select * replace (case when o_orderkey % 2 = 0 then 12345 else 1234500 + o_orderkey % 12 end as o_custkey) from '{SF}/orders.parquet' where o_orderkey < 60) to '{folder}/orders.parquet'")
    return str(folder)


def same_rows(spark, folder, name):
    db = duckdb.connect()
    for t in ("customer", "orders"):
        db.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    made = catalog.queries()[name](spark, folder)
    want = db.execute(f"select {', '.join(made.columns)} from ({catalog.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, map(tuple, made.collect()))) == sorted(map(repr, want))
    return want


def test_overrides_of_large_keys(spark, large_keys):
    same_rows(spark, large_keys, "overlay_overrides")


def test_launch_table_of_large_keys(spark, large_keys):
    same_rows(spark, large_keys, "launch_table")


def test_sex_info_of_large_keys(spark, large_keys):
    same_rows(spark, large_keys, "sex_info_join")


def test_reports_of_large_keys(spark, large_keys):
    assert len(same_rows(spark, large_keys, "scan_pigeon_summary")) == 51
    same_rows(spark, large_keys, "kinnex_qc_summary")


def test_report_bundle(spark, tmp_path):
    """Names and lines come back, empty ones too, from fewer files than reports."""
    from strandlake.sources.readers import report_bundle_lines
    from strandlake.sources.writers import write_report_bundle

    path = f"file://{tmp_path}/bundle"
    reports = [(f"dir/n {k}%=é", f"a{k}\n\n b\t{k}\n") for k in range(200)] + [(None, "x"), ("empty", "")]
    write_report_bundle(spark.createDataFrame(reports, "file string, text string"), path)
    got = sorted(report_bundle_lines(spark, path).collect(), key=lambda r: (r.file or "", r.line_no))
    want = sorted(((f, k, x) for f, t in reports for k, x in enumerate(t.split("\n"), 1)), key=lambda r: (r[0] or "", r[1]))
    assert list(map(tuple, got)) == want
    assert len(list((tmp_path / "bundle").glob("part-*"))) < 10


def test_many_reports_in_few_files(spark, tmp_path, monkeypatch):
    """genbank_contamination_summary writes far fewer files than contigs."""
    from strandlake import catalog_files

    monkeypatch.setattr(catalog_files, "shared_dir", lambda spark: f"file://{tmp_path}/reports")
    contigs = spark.range(500).selectExpr("concat('c', id) as contig", "1000 + id as length")
    assert catalog_files._contamination(contigs).count() == 1500
    assert len(list(tmp_path.rglob("part-*"))) < 20


def test_codes_and_hashes(spark):
    """Windows of every size against letters; the array's hash against Spark's."""
    import numpy as np
    from pyspark.sql import functions as F

    from strandlake.operators import kmers, sketches

    bases = np.random.default_rng(5).choice(5, 300, p=[0.24, 0.24, 0.24, 0.24, 0.04]).astype(np.uint8)
    number = lambda x: int("".join(map(str, x)), 4)
    for k in range(1, 32):
        at, code = kmers.canonical_codes(bases, k)
        want = [(i, min(number(w), number([3 - c for c in w[::-1]]))) for i in range(300 - k + 1) if max(w := bases[i : i + k].tolist()) < 4]
        assert list(zip(at.tolist(), code.tolist(), strict=True)) == want
    codes = np.append(np.random.default_rng(6).integers(0, 1 << 62, 50), 0)
    rows = spark.createDataFrame([(int(c),) for c in codes], "c long").select(sketches.code_hash(F.col("c"))).collect()
    assert sketches.hashed_codes(codes).tolist() == [r[0] for r in rows]


def test_sketch_moves_no_kmers(spark):
    """A task leaves the smallest hashes of its sequences, not a row for each k-mer, and loses none when it holds many keys."""
    import random

    from strandlake.operators import kmers, sketches

    rng = random.Random(4)
    rows = [(f"f{i % 7}" if i % 11 else None, "".join(rng.choice("ACGTN") if rng.random() < 0.02 else rng.choice("ACGT") for _ in range(3000))) for i in range(60)]
    df = spark.createDataFrame(rows, "file string, seq string").repartition(3)
    made = sketches.minhash_sketch(df, 15, 200)
    want = {}
    for r in kmers.packed_counts(df, 15, keep=("file",)).select("file", sketches.code_hash("code").alias("h")).collect():
        want.setdefault(r.file, []).append(r.h)
    assert sorted(map(tuple, made.collect()), key=repr) == sorted(((f, h) for f, x in want.items() for h in sorted(x)[:200]), key=repr)
    assert "HashAggregate" not in made._jdf.queryExecution().toString()


def test_sections_over_stretches(spark):
    """Sections that begin in another stretch than their lines, end in one, or go on over several; against a loop over the lines."""
    from strandlake.operators import reports

    n, rng = reports.LINES, __import__("random").Random(3)
    places = sorted({0, 1, n - 1, n, n + 1, 3 * n, 3 * n + 7, 9 << 32, *(rng.randrange(6 * n) for _ in range(400))})
    rows = [(f, p, rng.choice(["== A ==", "", "x", "y", "z", "== B C ==", " "] if rng.random() < 0.3 else ["x"])) for f in ("f", "g", None) for p in places]
    want, at = [], {}
    for f, p, line in rows:
        if line.startswith("=="):
            at[f] = line[3:-3]
        elif not line.strip():
            at[f] = ""
        elif at.get(f):
            want.append((f, p, line, at[f]))
    made = reports.sections(spark.createDataFrame(rows, "file string, line_no long, line string"))
    assert sorted(map(tuple, made.collect()), key=repr) == sorted(want, key=repr)
    assert "stretch" in made._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize(("k", "least"), [(3, 1), (21, 1), (31, 2)])
def test_counts_travel_in_blocks(spark, monkeypatch, k, least):
    """k-mers of several tasks and chunks meet in their bucket; the shuffle has a row for each block, and nothing aggregates rows of k-mers."""
    import random
    from collections import Counter

    from strandlake.operators import kmers as km

    monkeypatch.setattr(km, "SORTED", 500)
    r = random.Random(k)
    base = "".join(r.choice("ACGT") for _ in range(700))
    rows = [(None if i % 5 == 0 else f"f{i % 3}", base[a : a + 300] + r.choice("Nn") + base[: r.randrange(90)].lower()) for i in range(40) if (a := r.randrange(400)) >= 0] + [("f1", None), (None, "")]
    want = Counter()
    for name, seq in rows:
        seq = (seq or "").upper()
        for x in (seq[i : i + k] for i in range(len(seq) - k + 1)):
            if "N" not in x:
                want[name, min(x, x[::-1].translate(str.maketrans("ACGT", "TGCA")))] += 1
    got = km.packed_counts(spark.createDataFrame(rows, "file string, seq string").repartition(4), k, least, ("file",))
    assert "Aggregate" not in got._jdf.queryExecution().executedPlan().toString()
    spelled = got.select("file", km.spelled(got["code"], k).alias("kmer"), "n").collect()
    assert len(spelled) == len({(x.file, x.kmer) for x in spelled})
    assert {(x.file, x.kmer): x.n for x in spelled} == {g: n for g, n in want.items() if n >= least}


def test_methylation_counts_in_tiles(spark, monkeypatch):
    """Calls against a loop over the bases, nulls and short lists too; neither a base nor a call is a row."""
    import random
    import re
    from collections import Counter

    from strandlake.operators import pileup
    from strandlake.operators.calls import methyl_pileup

    monkeypatch.setattr(pileup, "CHUNK", 300)
    monkeypatch.setattr(pileup, "HELD", 2)
    r, rows, want = random.Random(8), [], Counter()
    for _ in range(150):
        n = r.randrange(60)
        seq = "".join(r.choice("ACGTCGCGcgN" + "é" * (n % 9 == 0)) for _ in range(n))
        cigar = "".join(f"{r.randrange(15)}{r.choice('MIDNSHP=XMMM')}" for _ in range(r.randrange(6)))
        mm = r.choice([None, "", "A+a,0;", "C+m," + ",".join(str(r.randrange(3)) for _ in range(r.randrange(6))) + ";"])
        ml = None if r.random() < 0.2 else [r.choice([0, 100, 127, 128, 204, 205, 255, None]) for _ in range(r.randrange(6))]
        rows.append((r.choice(["a", "b", None]), r.choice([1, 250, 10**10, None]), r.choice("++-") if r.random() < 0.9 else None, r.choice([cigar, cigar, cigar, None]), r.choice([seq, seq, seq, None]), mm, ml))
        contig, pos, strand, cigar, seq, mm, ml = rows[-1]
        seq, place, q, t = (seq or "").upper(), {}, 0, 0
        for k, op in re.findall(r"(\d+)([MIDNSHP=X])", cigar or ""):
            if op in "M=X":
                place |= {q + i: t + i for i in range(int(k))}
            q, t = q + int(k) * (op in "MIS=X"), t + int(k) * (op in "MDN=X")
        own = [i for i, c in enumerate(seq) if c == ("G" if strand == "-" else "C")][:: -1 if strand == "-" else 1]
        skips = [int(x) for x in mm[4:-1].split(",") if x] if (mm or "").startswith("C+m,") else []
        named = {sum(skips[: k + 1]) + k: k for k in range(len(skips))}
        for k, i in enumerate(own):
            beside = i > 0 and seq[i - 1] == "C" if strand == "-" else seq[i + 1 : i + 2] == "G"
            p = 0 if k not in named else (ml[named[k]] + 0.5) / 256 if ml and named[k] < len(ml) and ml[named[k]] is not None else None
            if beside and i in place and p is not None and (p >= 0.8 or p <= 0.5):
                want[contig, None if pos is None else pos - 1 + place[i] - (strand == "-"), p >= 0.8] += 1
    df = spark.createDataFrame(rows, "contig string, pos long, strand string, cigar string, seq string, mm string, ml array<int>").repartition(2)
    made = methyl_pileup(df)
    got = {(x.contig, x.pos): (x.coverage, x.modified, x.percent) for x in made.collect()}
    keys = {k[:2] for k in want}
    assert len(keys) > 50 and got == {k: (n := want[*k, True] + want[*k, False], want[*k, True], 100 * want[*k, True] / n) for k in keys}
    assert "Generate" not in made._jdf.queryExecution().optimizedPlan().toString()


def test_phasing_tables_make_each_side_once(spark, monkeypatch):
    """Equal stretches of cs strings as a loop finds them; pairs are read once, and the alignments come from a written table."""
    from strandlake.operators import assembly as am
    from strandlake.plans import workflows as wf

    assert am.equal_stretches(":5*ac:7+acg:9-tt:6", 6) == [(13, 13, 7), (25, 22, 9), (31, 30, 6)]
    assert am.equal_stretches(None, 1) == am.equal_stretches("", 1) == []
    pairs = spark.createDataFrame([("a", 100, 10, "b", 90, 5, ":20*ac:30+gg:5"), ("a", 100, 10, "b", 90, 5, ":20*ac:30+gg:5"), ("a", 100, 0, "b", 90, 0, None)], "query string, query_length long, query_start long, target string, target_length long, target_start long, cs string")
    found = am.homozygous_regions(pairs, 20, 3)
    assert sorted(map(tuple, found.collect())) == [("a", 7, 33, "b", 2, 28), ("a", 28, 64, "b", 23, 59)]
    both = am.stack_haplotype_intervals(found)
    assert sorted(map(tuple, both.collect())) == [("a", 7, 33), ("a", 28, 64), ("b", 2, 28), ("b", 23, 59)]
    assert "Union" not in both._jdf.queryExecution().optimizedPlan().toString()
    written = []
    monkeypatch.setattr(wf, "materialise", lambda df, name: written.append(name) or df)
    records = spark.createDataFrame([("r1", 0, "a", 20, 7, "10M", "NM:i:0"), ("r2", 0, "a", 65, 7, "10M", "NM:i:0"), ("r3", 0, "b", 20, 7, "10M", "NM:i:9")], "read_id string, flag int, contig string, pos long, mapq int, cigar string, tags string")
    out = wf.polish_phasing_tables(pairs, records, 20, 3, 0.5)
    assert sorted((r.read_id, r.mapq) for r in out.collect()) == [("r1", 60), ("r2", 7)] and written == ["regions", "good"]


def test_matched_calls_are_written_once(spark, monkeypatch):
    """The calls' ranges are sought once: what later steps read again comes from written tables."""
    from strandlake.operators import haplotypes as hp

    runs = spark.sparkContext.accumulator(0)
    seen = []
    real = hp.materialise
    monkeypatch.setattr(hp, "materialise", lambda df, name: seen.append(name) or real(df, name))
    reference = spark.createDataFrame([("c", "ACGTTTTTACGA")], "name string, seq string").mapInArrow(lambda batches: (runs.add(b.num_rows) or b for b in batches), "name string, seq string")
    truth = spark.createDataFrame([("c", 4, "T", "TT"), ("c", 10, "C", "G")], "contig string, pos long, ref string, alt string")
    query = spark.createDataFrame([("c", 7, "T", "TT"), ("c", 11, "G", "A")], "contig string, pos long, ref string, alt string")
    out = hp.match_calls(truth, query, reference)
    assert sorted((r.pos, r.side, r.matched) for r in out.collect()) == [(4, "truth", True), (7, "query", True), (10, "truth", False), (11, "query", False)]
    assert runs.value == 1 and seen == ["reference", "calls", "near", "good", "segments"]
