"""Statistics over length records. Order statistics work on (key, length, frequency) histograms, never on raw rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def length_distribution(reads: DataFrame, keys: list[str] = ()) -> DataFrame:
    """(keys, length, freq)."""
    return reads.groupBy(*keys, "length").agg(F.count("*").alias("freq"))


def _running(hist: DataFrame, key: str, descending: bool = False) -> DataFrame:
    whole = Window.partitionBy(key)
    order = whole.orderBy(F.desc("length") if descending else "length").rowsBetween(Window.unboundedPreceding, 0)
    bases = F.col("length") * F.col("freq")
    return hist.withColumns({"c": F.sum("freq").over(order), "b": F.sum(bases).over(order), "n": F.sum("freq").over(whole), "bases": F.sum(bases).over(whole)})


def read_stats(reads: DataFrame, total_label: str = "ALL") -> DataFrame:
    """(file, length) -> one row per file and one for the union. Quartile q: smallest length whose running count exceeds
    q n. Nx counts bases upward from the shortest read: smallest length whose running bases reach x B."""
    one = length_distribution(reads, ["file"])
    hist = one.unionByName(one.groupBy("length").agg(F.sum("freq").alias("freq")).withColumn("file", F.lit(total_label)))
    run = _running(hist, "file")
    at = lambda ok: F.min(F.when(ok, F.col("length")))
    out = run.groupBy("file").agg(
        F.first("n").alias("total_reads"), F.first("bases").alias("total_bp"), F.min("length").alias("min_length"), F.max("length").alias("max_length"),
        *[at(F.col("c") > q * F.col("n")).alias(f"q{int(100 * q)}") for q in (0.25, 0.5, 0.75)],
        *[at(F.col("b") >= x * F.col("bases")).alias(f"n{int(100 * x)}") for x in (0.25, 0.5, 0.75)])
    return out.withColumns({"total_gbp": F.col("total_bp") / 1e9, "mean_length": F.expr("total_bp div total_reads")})


def length_histogram(reads: DataFrame, start: int, stop: int, bins: int, unbounded: bool = False) -> DataFrame:
    """(bin, n) for all bins of [start, stop]; the upper edge falls in the last bin; lengths outside are dropped or, if
    unbounded, fall in the end bins."""
    if stop <= start:
        raise ValueError("stop must exceed start")
    size = (stop - start) / bins
    b = F.when(F.col("length") == stop, bins - 1).otherwise(F.floor((F.col("length") - start) / size))
    b = F.greatest(F.lit(0), F.least(F.lit(bins - 1), b)) if unbounded else b
    rows = reads if unbounded else reads.where(F.col("length").between(start, stop))
    counted = rows.groupBy(b.cast("long").alias("bin")).agg(F.count("*").alias("n"))
    return reads.sparkSession.range(bins).withColumnRenamed("id", "bin").join(counted, "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def length_histogram_auto(reads: DataFrame, bins: int) -> DataFrame:
    """(bin, from_length, n, share): as many bins between the smallest and the largest length, which must differ; share of all."""
    edge = reads.agg(F.min("length").alias("low"), F.max("length").alias("high"), F.count("*").alias("all"))  # one row
    size = (F.col("high") - F.col("low")) / bins
    checked = F.when(F.col("high") > F.col("low"), size).otherwise(F.raise_error(F.lit("all lengths are equal")))
    at = F.when(F.col("length") == F.col("high"), bins - 1).otherwise(F.floor((F.col("length") - F.col("low")) / checked)).cast("long")
    counted = reads.select("length").join(F.broadcast(edge)).groupBy(at.alias("bin")).agg(F.count("*").alias("n"))
    every = reads.sparkSession.range(bins).withColumnRenamed("id", "bin").join(F.broadcast(edge)).where("all > 0")
    return every.join(counted, "bin", "left").select("bin", (F.col("low") + F.col("bin") * size).alias("from_length"), F.coalesce("n", F.lit(0)).alias("n"), (F.coalesce("n", F.lit(0)) / F.col("all")).alias("share"))


def lx(contigs: DataFrame, key: str = "file") -> DataFrame:
    """(key, x, lx) for x = 10, 20, ..., 100: the least number of contigs, longest first, that hold x percent of the bases."""
    run = _running(length_distribution(contigs, [key]), key, descending=True)
    each = run.select("*", F.explode(F.sequence(F.lit(10), F.lit(100), F.lit(10))).alias("x")).where(F.col("b") * 100 >= F.col("x") * F.col("bases"))
    need = F.ceil((F.col("x") * F.col("bases") / 100 - (F.col("b") - F.col("length") * F.col("freq"))) / F.col("length"))
    return each.groupBy(key, "x").agg(F.min(F.col("c") - F.col("freq") + F.greatest(need, F.lit(1))).cast("long").alias("lx"))


def nx_lx_aun(contigs: DataFrame, key: str = "file") -> DataFrame:
    """Per key: contigs, total, Nx for x = 0, 10, ..., 100 from the longest down, L50 and auN."""
    run = _running(length_distribution(contigs, [key]), key, descending=True)
    nx = [F.max(F.when(F.col("b") * 100 >= x * F.col("bases"), F.col("length"))).alias(f"n{x}") for x in range(0, 101, 10)]
    need = F.ceil((F.col("bases") / 2 - (F.col("b") - F.col("length") * F.col("freq"))) / F.col("length"))
    l50 = F.min(F.when(F.col("b") * 2 >= F.col("bases"), F.col("c") - F.col("freq") + need))
    return run.groupBy(key).agg(F.first("n").alias("contigs"), F.first("bases").alias("total"), *nx, l50.cast("long").alias("l50"), (F.sum(F.col("length").cast("double") * F.col("length") * F.col("freq")) / F.first("bases")).alias("aun"))


def cumulative_nx_curve(contigs: DataFrame, key: str = "file") -> DataFrame:
    """Step curve: (key, length, fraction of bases in contigs at least as long)."""
    run = _running(length_distribution(contigs, [key]), key, descending=True)
    return run.select(key, "length", (F.col("b") / F.col("bases")).alias("fraction"))


def base_count(reads: DataFrame, key: str = "file", genome_sizes: dict[str, float] | None = None) -> DataFrame:
    """Bases, reads and coverage at each genome size."""
    out = reads.groupBy(key).agg(F.sum("length").alias("bases"), F.count("*").alias("reads"))
    return out.withColumns({f"coverage_{n}": F.col("bases") / g for n, g in (genome_sizes or {"hic": 3.1e9, "wgs": 3.3e9}).items()})


def ont_run_stats(summary: DataFrame, genome: float = 3.3e9, min_q: float = 10.0) -> DataFrame:
    """Run summary -> per file and class (pass, fail): N50 from the longest down, Gb, coverage, coverage by length cut-off,
    reads of 1 Mb and more. A class without reads has zeros."""
    cls = F.when(F.col("mean_qscore") >= min_q, "pass").otherwise("fail")
    hist = summary.withColumn("class", cls).groupBy("file", "class", F.col("sequence_length").alias("length")).agg(F.count("*").alias("freq"))
    run = _running(hist.withColumn("k", F.struct("file", "class")), "k", descending=True)
    over = lambda x: F.sum(F.when(F.col("length") >= x, F.col("length") * F.col("freq")).otherwise(0)) / genome
    out = run.groupBy("file", "class").agg(F.max(F.when(F.col("b") * 2 >= F.col("bases"), F.col("length"))).alias("n50"), (F.first("bases") / 1e9).alias("gb"), (F.first("bases") / genome).alias("coverage"), *[over(x).alias(f"cov_{x // 1000}kb") for x in (100_000, 200_000, 300_000, 400_000, 500_000, 1_000_000)], F.sum(F.when(F.col("length") >= 1_000_000, F.col("freq")).otherwise(0)).alias("reads_1mb"))
    every = summary.select("file").distinct().withColumn("class", F.explode(F.array(F.lit("pass"), F.lit("fail"))))
    return every.join(out, ["file", "class"], "left").na.fill(0)


def first_records(reads: DataFrame, n: int = 100, key: str = "file", order: str = "read_id", ties: tuple[str, ...] = ("length",)) -> DataFrame:
    """The first n records of each file; each task keeps its own first n before the shuffle."""
    at = F.row_number().over(Window.partitionBy(key).orderBy(order, *ties))
    return reads.withColumn("at", at).where(F.col("at") <= n).drop("at")


def ont_qc_summary(summary: DataFrame) -> DataFrame:
    """One row per file: the statistics of passed and of failed reads side by side."""
    stats = ont_run_stats(summary)
    names = [c for c in stats.columns if c not in ("file", "class")]
    return stats.groupBy("file").agg(*[F.max(F.when(F.col("class") == k, F.col(c))).alias(f"{k}_{c}") for k in ("pass", "fail") for c in names])


def filter_short_reads(reads: DataFrame, length: int) -> DataFrame:
    """Reads longer than length, not equal to it."""
    return reads.where(F.col("length") > length)


def pass_fail(summary: DataFrame, min_q: float = 10.0) -> DataFrame:
    """(file, class, reads, bases) of reads whose mean quality reaches min_q (pass) or not (fail)."""
    cls = F.when(F.col("mean_qscore") >= min_q, "pass").otherwise("fail")
    return summary.groupBy("file", cls.alias("class")).agg(F.count("*").alias("reads"), F.sum("sequence_length").alias("bases"))
