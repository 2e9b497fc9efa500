"""Golden values and properties of the genome operators."""

from strandlake import catalog
from strandlake.operators import intervals as iv
from strandlake.operators import lengths as le
from strandlake.operators import sequences as sq


def test_read_stats_golden(spark):
    reads = spark.createDataFrame([("a", n) for n in [12] * 9 + [22] + [76] * 12], "file string, length long")
    row = le.read_stats(reads).where("file = 'a'").first()
    assert (row.total_reads, row.total_bp, row.mean_length) == (22, 1042, 47)
    assert (row.q25, row.q50, row.q75, row.n25, row.n50, row.n75) == (12, 76, 76, 76, 76, 76)


def test_histogram_edges(spark):
    reads = spark.createDataFrame([(x,) for x in (0, 5, 10, 99, 100, -1, 101)], "length long")
    inside = {r.bin: r.n for r in le.length_histogram(reads, 0, 100, 10).collect()}
    assert inside[0] == 2 and inside[1] == 1 and inside[9] == 2 and sum(inside.values()) == 5 and len(inside) == 10
    every = {r.bin: r.n for r in le.length_histogram(reads, 0, 100, 10, unbounded=True).collect()}
    assert every[0] == 3 and every[9] == 3


def test_merge_is_idempotent(spark):
    rows = spark.createDataFrame([("c", 0, 5), ("c", 5, 7), ("c", 9, 12), ("d", 1, 2)], "contig string, start_pos long, end_pos long")
    once = iv.merge(rows)
    assert sorted(map(tuple, once.collect())) == [("c", 0, 7), ("c", 9, 12), ("d", 1, 2)]
    assert sorted(map(tuple, iv.merge(once).collect())) == sorted(map(tuple, once.collect()))


def test_overlap_join_equals_nested_loop(spark):
    a = [("c", s, s + 7) for s in range(0, 60, 5)]
    b = [("c", s, s + 3) for s in range(1, 60, 11)]
    schema = "contig string, start_pos long, end_pos long"
    got = iv.overlaps(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), width=4).collect()
    want = [(*x, y[1], y[2]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
    assert sorted(map(tuple, got)) == sorted(want)


def test_chunks_lift_back(spark):
    seqs = spark.createDataFrame([("s", "ACGTA" * 50), ("short", "ACG")], "name string, seq string")
    chunks = sq.chunk_records(seqs, 100, 10)
    lifted = sq.lift_chunks(chunks.selectExpr("name", "cast(0 as bigint) as start_pos", "cast(length(seq) as bigint) as end_pos"), 100)
    assert sorted(map(tuple, lifted.collect())) == [("s", 0, 110), ("s", 100, 210), ("s", 200, 250)]


def test_every_query_has_sql():
    # Joining in order of distance is no SQL: test_align.py holds that query's operator against brute force.
    assert set(catalog.queries()) == {*catalog.oracle_sql(), "sv_merge_forest"}


def test_mask_and_extract(spark):
    seqs = spark.createDataFrame([("a", "ACGTACGTAC"), ("b", "ACG"), ("c", ""), ("d", None)], "name string, seq string")
    spans = spark.createDataFrame([("a", 2, 4), ("a", 6, 20), ("b", 0, 1), ("c", 0, 5), ("d", 0, 5)], "contig string, start_pos long, end_pos long")
    assert dict(sq.mask(seqs, spans).collect()) == {"a": "ACNNACNNNN", "b": "NCG", "c": "", "d": None}
    assert dict(sq.mask(seqs, spans.limit(0)).collect())["a"] == "ACGTACGTAC"
    got = {(r.name, r.start_pos): r.seq for r in sq.extract(seqs, spans).collect()}
    assert got["a", 2] == "GT" and got["a", 6] == "GTAC" and got["b", 0] == "A"


def test_resolve_overlaps_keeps_ties(spark):
    rows = spark.createDataFrame([("c", 0, 10, 5), ("c", 5, 15, 7), ("c", 12, 20, 7), ("c", 20, 30, 1)], "contig string, start_pos long, end_pos long, score int")
    assert sorted(r.start_pos for r in iv.resolve_overlaps(rows).collect()) == [5, 12, 20]
