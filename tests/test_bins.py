"""Overlaps over levels of bins against brute force, with intervals of every length."""

import numpy as np


def test_overlaps_of_every_length(spark):
    from strandlake.operators.intervals import intersect_left, overlaps

    rng = np.random.default_rng(12)

    def some(n, longest):
        start = rng.integers(0, 5_000_000, n)
        size = (10 ** rng.uniform(0, longest, n)).astype(int) - 1
        return [(f"c{int(c)}", int(s), int(s + m), int(i)) for i, (c, s, m) in enumerate(zip(rng.integers(0, 3, n), start, size, strict=True))]

    fields = "contig string, start_pos long, end_pos long, {} long"
    for la, lb in ((3, 3), (7.5, 3), (3, 7.9), (7, 7)):
        a, b = some(300, la), some(200, lb)
        a += [a[0], (None, 5, 9, 1), ("c1", 7, 7, 2)]
        want = [(*x, *y[1:]) for x in a for y in b if x[0] == y[0] and x[1] < y[2] and y[1] < x[2]]
        left, right = spark.createDataFrame(a, fields.format("level")), spark.createDataFrame(b, fields.format("bin"))
        assert sorted(map(tuple, overlaps(left, right.withColumnRenamed("bin", "x")).collect()), key=str) == sorted(want, key=str)
        lone = [(*x, None, None, None) for x in set(a) if not any(x[0] == y[0] and x[1] < y[2] and y[1] < x[2] for y in b)]
        once = {*want, *lone}
        assert sorted(map(tuple, intersect_left(left, right.withColumnRenamed("bin", "x")).collect()), key=str) == sorted(once, key=str)


def test_a_long_interval_is_few_rows(spark):
    from pyspark.sql import functions as F

    from strandlake.operators.intervals import _binned

    top = spark.range(1).select(F.lit(5).alias("top level"))
    for start, size in ((123_456, 50_000_000), (0, 10), (4095, 2), (77, 3_000_000_000), (5, 16_385)):
        df = spark.createDataFrame([("c", start, start + size)], "contig string, start_pos long, end_pos long")
        assert _binned(df, 4096, top).count() <= 30
