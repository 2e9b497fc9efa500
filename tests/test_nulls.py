"""Nulls, repeats and empty tables in operators of one line."""


def test_filters_drop_what_they_cannot_judge(spark):
    from strandlake.operators import alignments as al
    from strandlake.operators import reads as rd
    from strandlake.operators import variants as va

    hits = spark.createDataFrame([(98.0, 50, "x"), (98.0, 50, "x"), (97.9, 99, "x"), (94.0, 100, "x"), (90.0, 200, "x"), (None, 500, "x"), (99.0, None, "x")], "pident double, length long, match string")
    assert sorted(r.length for r in al.blast_tier_filter(hits).collect()) == [50, 50, 100, 200] and al.blast_tier_filter(hits.limit(0)).count() == 0
    sam = spark.createDataFrame([(0,), (4,), (16,), (20,), (None,), (16,)], "flag int")
    assert sorted(r.flag for r in al.flag_filter(sam, 4).collect()) == [0, 16, 16] and sorted(r.flag for r in al.flag_filter(sam, 4, 16).collect()) == [16, 16]
    calls = spark.createDataFrame([("A",), ("*",), ("A,*",), (None,), ("",)], "alt string")
    assert sorted(r.alt for r in va.drop_star(calls).collect()) == ["", "A"]
    paf = spark.createDataFrame([(2, 0, 42), (3, 0, 99), (2, 0, 41), (None, 0, 99), (1, None, 99)], "nm int, query_start long, query_end long")
    assert [tuple(r) for r in rd.paf_adapter_filter(paf).collect()] == [(2, 0, 42)]
    records = spark.createDataFrame([(10, "50M"), (10, "10D49M"), (9, "99M"), (None, "99M"), (60, None), (60, "20S20I10M5D")], "mapq int, cigar string")
    assert sorted(r.cigar for r in rd.sam_quality_filter(records, 10, 50).collect()) == ["20S20I10M5D", "50M"]


def test_tables(spark):
    from strandlake.operators import alignments as al
    from strandlake.operators import tables as tb

    paf = spark.createDataFrame([("t", 100, 0, 10, 5, 9), ("t", 100, 0, 10, 5, 9), ("t", 100, None, 10, 1, 2), (None, 7, 0, 3, 0, 3)], "target string, target_length long, target_start long, target_end long, query_start long, query_end long")
    got = {r.target: tuple(r)[1:] for r in al.chrom_mapping_stats(paf).collect()}
    assert got == {"t": (20, 9, 100, 10), None: (3, 3, 7, 3)} and al.chrom_mapping_stats(paf.limit(0)).count() == 0
    a, b = spark.createDataFrame([("x", 1), ("x", 2), (None, 3)], "k string, a int"), spark.createDataFrame([("x", 5), ("x", 5), (None, 6), ("y", 7)], "k string, b int")
    assert sorted(map(tuple, tb.paste_columns(a, b, "k").collect())) == [("x", 1, 5), ("x", 1, 5), ("x", 2, 5), ("x", 2, 5)]
    assert tuple(tb.sum_max(a, "a").first()) == (6, 3) and tuple(tb.sum_max(a.limit(0), "a").first()) == (None, None)
    both = tb.diploid_concat(a.withColumn("hap", a["a"]), a.limit(1).withColumn("hap", a["a"]))
    assert sorted(r.hap for r in both.collect()) == [1, 1, 1, 2] and tb.diploid_concat(a.limit(0), a.limit(0)).count() == 0
