"""Alignment, hit and read tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .intervals import alignment_ignore_filter, islands


def blast_tier_filter(hits: DataFrame) -> DataFrame:
    """Hits of 98 % over 50 bases, 94 % over 100 or 90 % over 200, as they are; one whose identity or length is null goes."""
    return hits.where("(pident >= 98 and length >= 50) or (pident >= 94 and length >= 100) or (pident >= 90 and length >= 200)")


def mito_hit_rollup(hits: DataFrame, longest: float = 10, least_ratio: float = 80, least_match: float = 70) -> DataFrame:
    """Per query: share of the query in hits; lengths come from the query's first hit in (sseqid, qstart, qend) order."""
    each = hits.groupBy("qseqid").agg(F.sum(F.col("length") * 100 / F.col("qlen")).alias("match"), F.min(F.struct("sseqid", "qstart", "qend", "qlen", "slen")).alias("f"))
    out = each.select("qseqid", "match", F.col("f.qlen").alias("qlen"), F.col("f.slen").alias("slen"))
    return out.where(f"qlen < {longest} * slen and qlen * 100 / slen > {least_ratio} and match > {least_match}")


def best_hit(paf: DataFrame, key: str = "query") -> DataFrame:
    """Highest alignment score, then fewest mismatches, then the remaining columns in order: one row per key."""
    rest = [c for c in paf.columns if c not in (key, "as_score", "nm")]
    best = paf.groupBy(key).agg(F.min(F.struct((-F.col("as_score")).alias("s"), "nm", *rest)).alias("m"))
    return best.select(key, *[(-F.col("m.s")).alias("as_score") if c == "as_score" else F.col(f"m.{c}").alias(c) for c in paf.columns if c != key])


def primary_target(paf: DataFrame) -> DataFrame:
    """Per query: the target with the largest summed block length over query length; ties by target name."""
    cover = paf.groupBy("query", "target").agg((F.sum("block_len") / F.max("query_length")).alias("coverage"))
    best = cover.groupBy("query").agg(F.min(F.struct((-F.col("coverage")).alias("c"), "target")).alias("m"), F.count("*").alias("targets"))
    return best.select("query", F.col("m.target").alias("target"), (-F.col("m.c")).alias("coverage"), "targets")


def flag_filter(sam: DataFrame, exclude: int = 0, require: int = 0) -> DataFrame:
    """Records with none of the excluded bits and all of the required ones; a null flag goes."""
    return sam.where((F.col("flag").bitwiseAND(exclude) == 0) & (F.col("flag").bitwiseAND(require) == require))


def multi_primary_ids(sam: DataFrame) -> DataFrame:
    """Reads with several primary records or any supplementary one."""
    return sam.groupBy("read_id").agg(F.count_if(F.col("flag").bitwiseAND(0x900) == 0).alias("primary_records"), F.count_if(F.col("flag").bitwiseAND(0x800) != 0).alias("supplementary")).where("primary_records > 1 or supplementary > 0")


def misjoin_breaks(paf: DataFrame) -> DataFrame:
    """Consecutive alignments of a query on different targets."""
    order = Window.partitionBy("query").orderBy("query_start", "query_end", "target", "target_start", "target_end")
    step = paf.distinct().withColumns({"before": F.lag("target").over(order), "before_end": F.lag("query_end").over(order)})
    return step.where("before != target").select("query", F.col("before").alias("from_target"), F.col("target").alias("to_target"), F.col("before_end").alias("break_start"), F.col("query_start").alias("break_end"))


def misjoin_breaks_outside(paf: DataFrame, regions: DataFrame) -> DataFrame:
    """Misjoin breaks among alignments that listed regions (contig, start_pos, end_pos) do not hold."""
    return misjoin_breaks(alignment_ignore_filter(paf, regions))


def chrom_mapping_stats(paf: DataFrame) -> DataFrame:
    """Per target: bases of target and query in alignments, repeats counted, its length and the longest alignment. Null places add nothing; a null
    target is one of its own."""
    span = F.col("target_end") - F.col("target_start")
    return paf.groupBy("target").agg(F.sum(span).alias("target_span"), F.sum(F.col("query_end") - F.col("query_start")).alias("query_span"), F.max("target_length").alias("target_length"), F.max(span).alias("longest"))


def chr_completeness(paf: DataFrame, least_block: int, least_query: int) -> DataFrame:
    """Per target: distinct queries, their summed and largest length as percent of the target."""
    pairs = paf.where(F.col("block_len") > least_block).select("query", "target", "query_length", "target_length").distinct().where(F.col("query_length") > least_query)
    share = F.col("query_length") / F.col("target_length") * 100
    return pairs.groupBy("target").agg(F.count("*").alias("n"), F.sum(share).alias("percent"), F.max(share).alias("largest"), F.max("query").alias("last_query"))


def top_two_alleles(counts: DataFrame) -> DataFrame:
    s = F.sort_array(F.array("a", "c", "g", "t"), asc=False)
    return counts.select("contig", "pos", s[0].alias("first"), s[1].alias("second"))


def variant_clusters(sites: DataFrame, gap: int = 500, least: int = 5) -> DataFrame:
    """Runs of at least so many sites with no gap above so many bases."""
    rows = sites.select("contig", "pos").distinct().select("contig", F.col("pos").alias("start_pos"), F.col("pos").alias("end_pos"), F.lit(1).cast("long").alias("sites"))
    found = islands(rows, ["contig"], "start_pos", "end_pos", gap, ("sites", F.sum))
    return found.where(F.col("sites") >= least).select("contig", "start_pos", (F.col("end_pos") + 1).alias("end_pos"), "sites")
