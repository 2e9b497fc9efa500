"""Pileups, consensus, methylation and variant sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .pileup import base_pileup, methyl_counts  # noqa: F401
from .tiles import bases_at


def haploid_consensus_calls(pileup: DataFrame, reference: DataFrame, least: int = 1) -> DataFrame:
    """(contig, pos, ref, alt, depth, support) where the commonest base (ties: the first of ACGT) is not the reference's."""
    count = lambda b: F.col(b.lower())
    best = F.greatest(*[count(b) for b in "ACGT"])
    alt = F.coalesce(*[F.when(count(b) == best, b) for b in "ACGT"])
    called = pileup.select("contig", "pos", alt.alias("alt"), F.expr("a + c + g + t").alias("depth"), best.alias("support")).where(F.col("depth") >= least)
    return bases_at(called, reference).where("alt != ref").select("contig", "pos", "ref", "alt", "depth", "support")


def methyl_pileup(records: DataFrame, least_modified: float = 0.8, least_plain: float = 0.5) -> DataFrame:
    """(contig, pos, coverage, modified, percent) per CpG, 0-based, from records (contig, pos from 1, strand, cigar, seq, mm, ml).

    mm lists, in the read's own direction, how many Cs to skip before each modified one ("C+m,5,12;"), ml the
    probabilities times 256. A call counts as modified from least_modified on, as plain up to 1 - least_plain, else not
    at all; Cs that mm does not name are plain. seq is as aligned: on the - strand the read's Cs are its Gs from the end
    on, and their place is that of the C before them.
    """
    out = methyl_counts(records, least_modified, least_plain)
    return out.withColumn("percent", 100 * F.col("modified") / F.col("coverage"))


def vcf_concat(*calls: DataFrame) -> DataFrame:
    """All calls by position; overlaps stay."""
    out = calls[0]
    for c in calls[1:]:
        out = out.unionByName(c)
    return out.orderBy("contig", "pos", "ref", "alt")


def vcf_merge_callers(first: DataFrame, second: DataFrame) -> DataFrame:
    """One row per allele (contig, pos, ref, alt) of either caller: source, and the first caller's filter and gq where it has
    the allele. Of repeated calls of an allele the one with the largest gq counts."""
    key = ["contig", "pos", "ref", "alt"]
    one = lambda c, x: c.groupBy(*key).agg(F.max(F.struct("gq", "filter")).alias(x))
    met = one(first, "x").join(one(second, "y"), key, "full_outer")
    source = F.when(F.col("x").isNotNull() & F.col("y").isNotNull(), "both").when(F.col("x").isNotNull(), "first").otherwise("second")
    return met.select(*key, source.alias("source"), F.coalesce("x.gq", "y.gq").alias("gq"), F.coalesce("x.filter", "y.filter").alias("filter"))


def sv_merge(calls: DataFrame, reach: int = 500, least_identity: float = 0.3, least_support: int = 3) -> DataFrame:
    """Merged structural variants: (contig, kind, strand, first, last, callers, support, alt).

    Supported calls of equal contig, kind and strand follow one another by position; a new group begins after a gap above
    reach, at a caller that the call just before also has, and, for insertions, where the inserted sequence is not as like
    the one before as least_identity (1 - edits over the longer). The call with most support (ties: the smallest position,
    caller and sequence) gives the alt.
    """
    good = calls.where(F.col("support") >= least_support).groupBy("contig", "kind", "strand", "pos", "caller", "alt").agg(F.max("support").alias("support"))
    order = Window.partitionBy("contig", "kind", "strand").orderBy("pos", "caller", "alt")
    like = 1 - F.levenshtein("alt", F.lag("alt").over(order)) / F.greatest(F.length("alt"), F.length(F.lag("alt").over(order)), F.lit(1))
    new = F.lag("pos").over(order).isNull() | (F.col("pos") - F.lag("pos").over(order) > reach) | (F.col("caller") == F.lag("caller").over(order)) | ((F.col("kind") == "INS") & (like < least_identity))
    grouped = good.withColumn("new", new.cast("int")).withColumn("island", F.sum("new").over(order))
    out = grouped.groupBy("contig", "kind", "strand", "island").agg(F.min("pos").alias("first"), F.max("pos").alias("last"), F.countDistinct("caller").alias("callers"), F.sum("support").alias("support"), F.min(F.struct((-F.col("support")).alias("s"), "pos", "caller", "alt"))["alt"].alias("alt"))
    return out.drop("island")
