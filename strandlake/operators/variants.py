"""Variant tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def exclude(variants: DataFrame, expression: str = "vaf <= 0.5 or gq <= 30", passing: bool = True, drop_indels: bool = False) -> DataFrame:
    """Drops what a SQL expression names; passing keeps PASS alone."""
    out = variants.where(f"not ({expression})")
    out = out.where("filter = 'PASS'") if passing else out
    return out.where("length(ref) = 1 and length(alt) = 1") if drop_indels else out


def tiered_gq(variants: DataFrame, insertion: int = 20, deletion: int = 12, other: int = 5) -> DataFrame:
    """One-base insertions and deletions have thresholds of their own."""
    size = F.length("alt") - F.length("ref")
    return variants.where(F.when(size == 1, F.col("gq") > insertion).when(size == -1, F.col("gq") > deletion).otherwise(F.col("gq") > other))


def drop_star(variants: DataFrame) -> DataFrame:
    """Variants without a * in alt; a null alt goes."""
    return variants.where("not contains(alt, '*')")


def stats(variants: DataFrame) -> DataFrame:
    """Records, SNVs, indels, transitions and transversions per contig."""
    snv = (F.length("ref") == 1) & (F.length("alt") == 1) & (F.col("ref") != F.col("alt"))
    ts = F.concat("ref", "alt").isin("AG", "GA", "CT", "TC")
    return variants.groupBy("contig").agg(F.count("*").alias("records"), F.count_if(snv).alias("snvs"), F.count_if(F.length("ref") != F.length("alt")).alias("indels"), F.count_if(snv & ts).alias("ts"), F.count_if(snv & ~ts).alias("tv"))


def compare(truth: DataFrame, query: DataFrame) -> DataFrame:
    """Allele-exact comparison per contig: shared, only in truth, only in query, precision and recall."""
    key = ["contig", "pos", "ref", "alt"]
    both = truth.select(*key).distinct().withColumn("t", F.lit(1)).join(query.select(*key).distinct().withColumn("q", F.lit(1)), key, "full_outer")
    out = both.groupBy("contig").agg(F.count_if(F.col("t").isNotNull() & F.col("q").isNotNull()).alias("shared"), F.count_if(F.col("q").isNull()).alias("only_truth"), F.count_if(F.col("t").isNull()).alias("only_query"))
    return out.withColumns({"precision": F.col("shared") / F.nullif(F.col("shared") + F.col("only_query"), F.lit(0)), "recall": F.col("shared") / F.nullif(F.col("shared") + F.col("only_truth"), F.lit(0))})


def indel_lengths(variants: DataFrame) -> DataFrame:
    """(contig, change, n): records by the difference of allele lengths, where there is one."""
    change = F.length("alt") - F.length("ref")
    return variants.where(change != 0).groupBy("contig", change.alias("change")).agg(F.count("*").alias("n"))


def quality_distribution(variants: DataFrame) -> DataFrame:
    """(contig, gq, n)."""
    return variants.groupBy("contig", "gq").agg(F.count("*").alias("n"))
