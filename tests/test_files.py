"""FASTQ ranges, ordered shards and numbered lines."""

import gzip

import numpy as np
import pytest


def fastq(rng, n, end="\n"):
    rows = []
    for i in range(n):
        m = int(rng.integers(0, 60))
        rows.append((f"r{i}", "".join(rng.choice(list("ACGTN"), m)), "".join(rng.choice(list("@+I#F"), m))))
    return rows, "".join(f"@{a} some words{end}{s}{end}+{'' if i % 2 else a}{end}{q}{end}" for i, (a, s, q) in enumerate(rows))


def test_ranges_cut_anywhere(tmp_path):
    import io

    from strandlake.sources import fastq as fq

    for seed, end in ((1, "\n"), (2, "\r\n")):
        rows, text = fastq(np.random.default_rng(seed), 60, end)
        data = text.encode()
        (tmp_path / f"{seed}.fastq").write_bytes(data)
        for size in (1, 7, 50, 333, 10**6):
            reader = fq.Reader([(f"file://{tmp_path}/{seed}.fastq", len(data))], size)
            got = [tuple(r.values())[1:4] for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
            assert got == rows
    assert sum(b.num_rows for b in fq.batches(io.BytesIO(data + b"@cut\nACGT\n+\n"), "f", 0, None)) == 60
    assert sum(b.num_rows for b in fq.batches(io.BytesIO(data[:-2]), "f", 0, None)) == 60


@pytest.mark.parametrize("block", [64, 8 << 20])
def test_scan_fastq(spark, tmp_path, monkeypatch, block):
    from strandlake.sources import fastq as fq

    monkeypatch.setattr(fq, "BLOCK", block)
    want = []
    for k in range(3):
        rows, text = fastq(np.random.default_rng(10 + k), 200 * k)
        want += [(f"{k}.fastq" + (".gz" if k == 2 else ""), *r, len(r[1])) for r in rows]
        (tmp_path / f"{k}.fastq").write_text(text) if k < 2 else (tmp_path / f"{k}.fastq.gz").write_bytes(gzip.compress(text.encode()))
    df = fq.scan_fastq(spark, f"file://{tmp_path}", 1000)
    assert sorted(map(tuple, df.collect())) == sorted(want)
    assert "Exchange" not in df._jdf.queryExecution().toString() and df.rdd.getNumPartitions() > 5
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "a.fastq").write_text("")
    assert fq.scan_fastq(spark, f"file://{tmp_path}/none").count() == 0


def test_shards_keep_the_order(spark, tmp_path):
    from strandlake.sources.writers import write_sharded

    rng = np.random.default_rng(3)
    rows = [(f"n{i:04d}", int(rng.integers(0, 90)), i) for i in range(500)] + [("n0003", 5, 3), ("zz", None, 9), (None, 7, 8)]
    df = spark.createDataFrame(rows, "name string, length long, slot_ int").repartition(6)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0))
    for size in ({"shard_bases": 1000}, {"shard_records": 37}):
        path = f"file://{tmp_path}/{next(iter(size))}"
        write_sharded(df, path, order=("name", "length"), **size)
        got = sorted(map(tuple, spark.read.parquet(path).select("number", "shard", "name", "length").collect()))
        sums = np.cumsum([0, *[r[1] or 0 for r in order]])
        want = [(i, int(sums[i]) // 1000 if "shard_bases" in size else i // 37, r[0], r[1]) for i, r in enumerate(order)]
        assert got == want
    with pytest.raises(ValueError):
        write_sharded(df, path)


def test_report_lines(spark, tmp_path):
    from strandlake.sources.readers import report_lines

    for name in ("a b", "c"):
        (tmp_path / f"file={name}").mkdir()
        (tmp_path / f"file={name}" / "x.txt").write_text(f"{name} 0\n\nlast\r\n")
    got = sorted(map(tuple, report_lines(spark, f"file://{tmp_path}/*", "file").collect()))
    assert got == [("a b", 0, "a b 0"), ("a b", 1, ""), ("a b", 2, "last"), ("c", 0, "c 0"), ("c", 1, ""), ("c", 2, "last")]
    assert {r.file for r in report_lines(spark, f"file://{tmp_path}/*").collect()} == {"x.txt"}
