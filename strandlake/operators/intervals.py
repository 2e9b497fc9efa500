"""Interval algebra on half-open, 0-based intervals (contig, start_pos, end_pos)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: Bases of a contig that one window orders at first; what is left of each stretch is put together afterwards.
STRETCH = 1_000_000


def islands(rows: DataFrame, keys: list[str], start: str, end: str, gap: int, *sums) -> DataFrame:
    """(keys, start, end, sums) of runs of rows in which each begins at most gap after all before it in the run end. sums:
    aggregates that may be taken of themselves, as (name, column function). Runs are found within stretches of a contig,
    then over what they leave, so that a large contig is not one task's."""

    def runs_of(df: DataFrame, by: list[str]) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(start, end)
        reach = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
        marked = df.withColumn("new", F.when(F.col(start) <= reach + gap, 0).otherwise(1))
        return marked.withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))

    collect = [F.min(start).alias(start), F.max(end).alias(end), *[f(F.col(n)).alias(n) for n, f in sums]]
    stretch = runs_of(rows.withColumn("stretch", F.floor(F.col(start) / STRETCH)), [*keys, "stretch"])
    local = stretch.groupBy(*keys, "stretch", "island").agg(*collect).drop("stretch", "island")
    return runs_of(local, keys).groupBy(*keys, "island").agg(*collect).drop("island")


def merge(intervals: DataFrame, gap: int = 0, labels: tuple[str, ...] = ()) -> DataFrame:
    """Unions intervals that overlap, touch or lie within gap; labels become sorted distinct lists joined by ;."""
    rows = intervals.distinct().select("contig", "start_pos", "end_pos", *[F.array_compact(F.array(c)).alias(c) for c in labels])
    found = islands(rows, ["contig"], "start_pos", "end_pos", gap, *[(c, lambda x: F.array_distinct(F.flatten(F.collect_list(x)))) for c in labels])
    return found.select("contig", "start_pos", "end_pos", *[F.array_join(F.array_sort(c), ";").alias(c) for c in labels])


def flank(intervals: DataFrame, contigs: DataFrame, d: int) -> DataFrame:
    """The d bases on either side of each interval, inside the contig; empty flanks are left out."""
    met = intervals.join(contigs.withColumnRenamed("length", "size"), "contig")
    sides = F.array(F.struct(F.lit("left").alias("side"), F.greatest(F.col("start_pos") - d, F.lit(0)).alias("s"), F.least("start_pos", "size").alias("e")), F.struct(F.lit("right").alias("side"), F.least("end_pos", "size").alias("s"), F.least(F.col("end_pos") + d, F.col("size")).alias("e")))
    return met.withColumn("f", F.explode(sides)).where("f.s < f.e").select("contig", F.col("f.side").alias("side"), F.col("f.s").alias("start_pos"), F.col("f.e").alias("end_pos"))


#: Widths of bins grow by this factor from level to level; an interval lies in the level where it meets five bins at most.
FACTOR, LEVELS = 16, 6


def _level(width: int):
    """The level of an interval."""
    size = F.col("end_pos") - F.col("start_pos")
    out = F.lit(LEVELS - 1)
    for k in range(LEVELS - 2, -1, -1):
        out = F.when(size <= 4 * width * FACTOR**k, k).otherwise(out)
    return out


def _binned(df: DataFrame, width: int, top: DataFrame | None = None) -> DataFrame:
    """df with `own level`, `bin level` and `bin no`: a row for each bin of its own level that an interval meets and, for the sake of longer
    intervals of the other side, two at most for each level above, up to that side's highest (`top level`, one row)."""
    size = F.lit(width) * F.pow(F.lit(FACTOR), F.col("bin level")).cast("long")
    last = F.greatest(F.col("end_pos") - 1, F.col("start_pos"))
    rows = df.withColumn("own level", _level(width))
    rows = rows.withColumn("top level", F.col("own level")) if top is None else rows.join(F.broadcast(top))  # one row
    each = rows.withColumn("bin level", F.explode(F.sequence("own level", F.greatest("own level", "top level")))).drop("top level")
    return each.withColumn("bin no", F.explode(F.sequence(F.floor(F.col("start_pos") / size), F.floor(last / size))))


def overlaps(a: DataFrame, b: DataFrame, width: int = 4096) -> DataFrame:
    """All overlapping pairs; b's columns get the prefix b_. An equi-join on (contig, level, bin): a pair is kept in the higher of its two
    levels, in the bin where its overlap begins, so a large contig is dealt by bin, a long interval is few rows and no pair appears twice."""
    highest = lambda df: df.agg(F.coalesce(F.max(_level(width)), F.lit(0)).alias("top level"))
    left = _binned(a, width, highest(b)).withColumnRenamed("own level", "level of a")
    right = _binned(b, width, highest(a)).select("contig", "bin level", "bin no", F.col("own level").alias("level of b"), *[F.col(c).alias("b_" + c) for c in b.columns if c != "contig"])
    met = left.join(right, ["contig", "bin level", "bin no"]).where("start_pos < b_end_pos and b_start_pos < end_pos")
    size = F.lit(width) * F.pow(F.lit(FACTOR), F.col("bin level")).cast("long")
    met = met.where((F.col("bin level") == F.greatest("level of a", "level of b")) & (F.col("bin no") == F.floor(F.greatest("start_pos", "b_start_pos") / size)))
    return met.select(*a.columns, *["b_" + c for c in b.columns if c != "contig"])


def intersect_left(a: DataFrame, b: DataFrame, width: int = 4096) -> DataFrame:
    """All overlaps, and rows of a without one with nulls. Equal rows of a are one row. Rows are dealt once by a hash of 128 bits, by which
    those without an overlap are found: only hashes of the others travel."""
    hashed = ["hash 1", "hash 2"]
    one = a.withColumns({hashed[0]: F.xxhash64(*a.columns), hashed[1]: F.xxhash64(F.lit(1), *reversed(a.columns))}).repartition(*hashed)
    one = one.groupBy(*hashed, *a.columns).agg(F.lit(1).alias("one")).drop("one")
    found = overlaps(one, b, width)
    lone = one.join(found.select(*hashed).distinct(), hashed, "left_anti")
    return found.unionByName(lone, allowMissingColumns=True).drop(*hashed)


def intersect_semi(a: DataFrame, regions: DataFrame, width: int = 4096) -> DataFrame:
    """Distinct rows of a that overlap any region; regions are merged first."""
    return overlaps(a.distinct(), merge(regions.select("contig", "start_pos", "end_pos")), width).select(*a.columns).distinct()


def depth(intervals: DataFrame, contigs: DataFrame) -> DataFrame:
    """(contig, depth, bases, fraction): a sweep over +1/-1 events, depth 0 included. Events are swept within stretches of a
    contig; each begins at the depth that the stretches before it add up to."""
    known = intervals.join(contigs.select("contig"), "contig", "left_semi")
    events = known.select("contig", F.explode(F.array(F.struct(F.col("start_pos").alias("pos"), F.lit(1).alias("d")), F.struct(F.col("end_pos").alias("pos"), F.lit(-1).alias("d")))).alias("e")).select("contig", "e.pos", "e.d")
    # Intervals may reach beyond the contig.
    reach = contigs.join(known.groupBy("contig").agg(F.max("end_pos").alias("last")), "contig", "left").select("contig", F.greatest("length", F.coalesce("last", F.lit(0))).alias("reach"))
    borders = reach.select("contig", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("reach") / STRETCH))).alias("stretch")).select("contig", (F.col("stretch") * STRETCH).alias("pos"), F.lit(0).alias("d"))
    step = events.unionByName(borders).groupBy("contig", "pos").agg(F.sum("d").alias("d")).withColumn("stretch", F.floor(F.col("pos") / STRETCH))
    sums = step.groupBy("contig", "stretch").agg(F.sum("d").alias("sum"))
    before = sums.select("contig", "stretch", (F.sum("sum").over(Window.partitionBy("contig").orderBy("stretch")) - F.col("sum")).alias("before"))
    order = Window.partitionBy("contig", "stretch").orderBy("pos")
    met = step.join(before, ["contig", "stretch"]).join(reach, "contig")
    upto = F.coalesce(F.lead("pos").over(order), F.least("reach", (F.col("stretch") + 1) * STRETCH))
    run = met.select("contig", (F.col("before") + F.sum("d").over(order.rowsBetween(Window.unboundedPreceding, 0))).alias("depth"), (upto - F.col("pos")).alias("bases")).where("bases > 0")
    return run.groupBy("contig", "depth").agg(F.sum("bases").alias("bases")).join(contigs, "contig").select("contig", "depth", "bases", (F.col("bases") / F.col("length")).alias("fraction"))


def contamination(intervals: DataFrame, contigs: DataFrame, discard: float = 0.95) -> DataFrame:
    """Per contig with hits: merged bases over length, sorted distinct sources joined by a comma, and whether to discard it."""
    covered = merge(intervals.select("contig", "start_pos", "end_pos")).groupBy("contig").agg(F.sum(F.col("end_pos") - F.col("start_pos")).alias("covered"))
    sources = intervals.groupBy("contig").agg(F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"))
    out = covered.join(sources, "contig").join(contigs, "contig").withColumn("fraction", F.col("covered") / F.col("length"))
    return out.select("contig", "covered", "fraction", "sources", (F.col("fraction") >= discard).alias("discard"))


def contig_regions(contigs: DataFrame) -> DataFrame:
    """One region per contig."""
    return contigs.where("length > 0").select("contig", F.lit(0).cast("long").alias("start_pos"), F.col("length").alias("end_pos"))


def annotation_counts(intervals: DataFrame, annotation: DataFrame) -> DataFrame:
    """(label, n): overlaps of distinct intervals with annotations of each label."""
    return overlaps(intervals.distinct(), annotation).groupBy(F.col("b_label").alias("label")).agg(F.count("*").alias("n"))


def annotation_counts_wide(counts: DataFrame, labels: list[str]) -> DataFrame:
    """One row: the count of each label as text, NA where there is none."""
    return counts.agg(*[F.coalesce(F.max(F.when(F.col("label") == x, F.col("n"))).cast("string"), F.lit("NA")).alias(x) for x in labels])


def genome_windows(contigs: DataFrame, width: int) -> DataFrame:
    """Tiles of each contig."""
    tiles = F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("length") / width) - 1)).alias("i")
    return contigs.where("length > 0").select("contig", "length", tiles).select("contig", (F.col("i") * width).alias("start_pos"), F.least((F.col("i") + 1) * width, F.col("length")).alias("end_pos"))


def summary(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """Intervals, distinct contigs and bases per key."""
    return intervals.groupBy(*keys).agg(F.count("*").alias("n"), F.countDistinct("contig").alias("contigs"), F.sum(F.col("end_pos") - F.col("start_pos")).alias("bases"))


def alignment_ignore_filter(alignments: DataFrame, regions: DataFrame) -> DataFrame:
    """Alignments whose target has no ignored region, or that extend beyond any of them: beyond the smallest end or the
    largest start is beyond one, so two numbers per target decide."""
    edge = regions.groupBy(F.col("contig").alias("target")).agg(F.max("start_pos").alias("last_start"), F.min("end_pos").alias("first_end"))
    met = alignments.join(edge, "target", "left")
    return met.where("last_start is null or target_start < last_start or target_end > first_end").drop("last_start", "first_end")


def resolve_overlaps(annotations: DataFrame, score: str = "score", width: int = 4096) -> DataFrame:
    """Annotations that no overlapping one outscores; equal scores both stay."""
    rows = annotations.distinct()
    beaten = overlaps(rows, rows.select("contig", "start_pos", "end_pos", score), width).where(F.col("b_" + score) > F.col(score))
    return rows.join(beaten.select(*rows.columns).distinct(), rows.columns, "left_anti")


def list_difference(a: DataFrame, b: DataFrame, key: str = "contig") -> DataFrame:
    """Keys of one list alone, with the side that has them."""
    left, right = (x.select(key).distinct().withColumn(n, F.lit(True)) for x, n in ((a, "l"), (b, "r")))
    met = left.join(right, key, "full_outer").where("l is null or r is null")
    return met.select(key, F.when(F.col("l"), "left").otherwise("right").alias("side"))
