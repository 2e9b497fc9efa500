"""Assemblies: chromosomes, telomeres, breaks, contamination, genes, phasing, edits."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import intervals as iv
from .tiles import apply_edits  # noqa: F401


def mapping_filters(paf: DataFrame, least_identity: float = 99, least_span: int = 500_000, least_query: int = 0, least_block: int = 0) -> DataFrame:
    """Mappings above an identity (percent) and a span of the query, with long enough queries and blocks."""
    return paf.where((F.col("identity") > least_identity) & (F.col("query_end") - F.col("query_start") > least_span) & (F.col("query_length") > least_query) & (F.col("block_len") > least_block))


def t2t_both_ends(ends: DataFrame, lengths: DataFrame, ns: DataFrame, mapping: DataFrame) -> DataFrame:
    """(contig, length, ns, chrom, kind): contigs whose two ends are telomeric. ends: (name) contig_start or contig_end; kind:
    contig without an N, else scaffold."""
    cut = ends.select(F.regexp_extract("name", "^(.*)_(?:start|end)$", 1).alias("contig"), "name").distinct()
    both = cut.groupBy("contig").agg(F.count("*").alias("ends")).where("ends = 2")
    met = both.join(lengths, "contig").join(ns, "contig").join(mapping, "contig")
    return met.select("contig", "length", "ns", "chrom", F.when(F.col("ns") == 0, "contig").otherwise("scaffold").alias("kind"))


def chromosome_end_breaks(flanks: DataFrame, mapping: DataFrame, telomeric: DataFrame, reach: int = 1_000_000) -> DataFrame:
    """Flanks (contig, side, ...) without those at true chromosome ends: the left ones of contigs that map within reach of the
    target's start and have a telomeric start, and the right ones likewise at the end."""
    near = mapping.select("contig", F.explode(F.array(F.struct(F.lit("left").alias("side"), F.lit("start").alias("end_name"), (F.col("target_start") < reach).alias("near")), F.struct(F.lit("right").alias("side"), F.lit("end").alias("end_name"), (F.col("target_length") - F.col("target_end") < reach).alias("near")))).alias("e")).where("e.near")
    true_ends = near.select("contig", "e.side", F.col("e.end_name").alias("end_name")).join(telomeric, ["contig", "end_name"], "left_semi").select("contig", "side").distinct()
    return flanks.join(true_ends, ["contig", "side"], "left_anti")


def hits_to_bed(hits: DataFrame, screens: DataFrame) -> DataFrame:
    """(contig, start_pos, end_pos, source, hit, description) from hits with a source (1-based ends) and vector screen rows
    (contig, first, last, kind)."""
    a = hits.select(F.col("qseqid").alias("contig"), (F.col("qstart") - 1).alias("start_pos"), F.col("qend").alias("end_pos"), "source", F.col("sseqid").alias("hit"), "description")
    b = screens.select("contig", (F.col("first") - 1).alias("start_pos"), F.col("last").alias("end_pos"), F.lit("vecscreen").alias("source"), F.col("kind").alias("hit"), F.col("kind").alias("description"))
    return a.unionByName(b)


def blast_len_filter(hits: DataFrame, limits: DataFrame) -> DataFrame:
    """Hits (source, length, ...) at least as long as their source's limit (source, least); sources without one go."""
    return hits.join(limits, "source").where("length >= least").drop("least")


_CS = re.compile(r":(\d+)|\*[a-z]{2}|([+-])([a-z]+)")


def equal_stretches(cs: str | None, least: int) -> list[tuple[int, int, int]]:
    """(end in the query, end in the target, bases) of the stretches of a cs string that are equal on both sides for at least so many bases."""
    out, q, t = [], 0, 0
    for op in _CS.finditer(cs or ""):
        same, sign, bases = op.groups()
        n = int(same) if same else len(bases) if sign else 1
        q, t = q + n * (sign != "-"), t + n * (sign != "+")
        if same and n >= least:
            out.append((q, t, n))
    return out


def homozygous_regions(paf: DataFrame, least: int = 20_000, extend: int = 50_000) -> DataFrame:
    """Stretches of a cs string (:n equal bases, *xy a change, +x and -x insertions and deletions in the query) that are equal
    on both sides for at least so many bases, extended: (query, query_start, query_end, target, target_start, target_end)
    inside both sequences. Forward alignments only."""
    names = [c for c in paf.columns if c != "cs"]
    schema = T.StructType([*[T.StructField(c, paf.schema[c].dataType) for c in names], *[T.StructField(c, T.LongType()) for c in ("q", "t", "q_end", "t_end")]])

    def walk(batches):
        for batch in batches:
            found = [equal_stretches(cs, least) for cs in batch.column(batch.schema.get_field_index("cs")).to_pylist()]
            row = np.repeat(np.arange(len(found)), [len(x) for x in found])
            q, t, n = np.array([y for x in found for y in x], np.int64).reshape(-1, 3).T
            yield pa.record_batch([*batch.select(names).take(pa.array(row)).columns, *[pa.array(x) for x in (n, n, q, t)]], names=schema.names)

    placed = paf.distinct().mapInArrow(walk, schema).withColumns({x + "_end": F.col(f"{y}_start") + F.col(x + "_end") for x, y in (("q", "query"), ("t", "target"))})
    ends = lambda x, length: (F.greatest(F.col(f"{x}_end") - F.col(x) - extend, F.lit(0).cast("long")), F.least(F.col(f"{x}_end") + extend, F.col(length)))
    (qs, qe), (ts, te) = ends("q", "query_length"), ends("t", "target_length")
    return placed.select("query", qs.alias("query_start"), qe.alias("query_end"), "target", ts.alias("target_start"), te.alias("target_end"))


def stack_haplotype_intervals(pairs: DataFrame) -> DataFrame:
    """The target's intervals below the query's: (contig, start_pos, end_pos)."""
    one = lambda x: F.struct(F.col(x).alias("contig"), F.col(f"{x}_start").alias("start_pos"), F.col(f"{x}_end").alias("end_pos"))
    return pairs.select(F.inline(F.array(one("query"), one("target"))))


def gene_completeness(hits: DataFrame, least_identity: float = 0.99, least_cover: float = 0.99) -> DataFrame:
    """(gene, state) of genes with one full hit in the reference: full_sgl, full_dup, frag (half covered), part (a tenth) or
    missing in the assembly. hits: (query, query_length, side ref or asm, matches, block_len, query_start, query_end)."""
    cover = (F.col("query_end") - F.col("query_start")) / F.col("query_length")
    good = F.col("matches") / F.col("block_len") >= least_identity
    full = good & (cover >= least_cover)
    ref, asm = F.col("side") == "ref", F.col("side") == "asm"
    each = hits.groupBy(F.col("query").alias("gene")).agg(F.count_if(full & ref).alias("in_ref"), F.count_if(full & asm).alias("in_asm"), F.coalesce(F.max(F.when(asm & good, cover)), F.lit(0.0)).alias("best"))
    state = F.when(F.col("in_asm") == 1, "full_sgl").when(F.col("in_asm") > 1, "full_dup").when(F.col("best") >= 0.5, "frag").when(F.col("best") >= 0.1, "part").otherwise("missing")
    return each.where("in_ref = 1").select("gene", state.alias("state"))


def switch_hamming(markers: DataFrame) -> DataFrame:
    """Per contig, over its markers (contig, pos, parent mat or pat) in order: markers, switches between neighbours, and those
    of the rarer parent, with both rates. Markers are put in order within windows of a contig; a window's first and last
    parent tell whether it switches at its border."""
    width = 1_000_000
    dealt = markers.withColumn("window", F.floor(F.col("pos") / width))
    order = Window.partitionBy("contig", "window").orderBy("pos", "parent")
    step = dealt.withColumn("switch", (F.col("parent") != F.lag("parent").over(order)).cast("int"))
    one = step.groupBy("contig", "window").agg(F.count("*").alias("n"), F.count_if(F.col("parent") == "mat").alias("mat"), F.coalesce(F.sum("switch"), F.lit(0)).alias("inner"), F.min(F.struct("pos", "parent")).alias("first"), F.max(F.struct("pos", "parent")).alias("last"))
    border = Window.partitionBy("contig").orderBy("window")
    joined = one.withColumn("at_border", F.coalesce((F.col("first.parent") != F.lag("last.parent").over(border)).cast("int"), F.lit(0)))
    out = joined.groupBy("contig").agg(F.sum("n").alias("markers"), F.sum(F.col("inner") + F.col("at_border")).alias("switches"), F.sum("mat").alias("mat"))
    rarer = F.least("mat", F.col("markers") - F.col("mat"))
    rate = lambda x, n: F.coalesce(x / F.nullif(n, F.lit(0)), F.lit(0.0))
    return out.select("contig", "markers", "switches", rarer.alias("minority"), rate(F.col("switches"), F.col("markers") - 1).alias("switch_rate"), rate(rarer, F.col("markers")).alias("hamming_rate"))


def chr_report(completeness: DataFrame, least: float = 95) -> DataFrame:
    """Targets that one query covers by more than so many percent."""
    return completeness.where((F.col("n") == 1) & (F.col("percent") > least)).select(F.col("last_query").alias("query"), "target", "percent")


def assign_chromosomes(paf: DataFrame, regions: DataFrame, telomeres: DataFrame, gaps: DataFrame, edge: int = 10_000, least: float = 0.95) -> DataFrame:
    """(id, alias, chrom, level, t2t, gaps, gap_bases) of every mapped sequence.

    Valid alignments are those that the ignored regions leave. None: chrUn_id. A sequence is T2T if its primary target
    covers more than `least` of it, it has one valid target, and its telomere intervals (contig, start_pos, end_pos), two
    at least, begin and end near its ends. Name: the chromosome if T2T, chrom_id_random with one target, else chrUn_id.
    """
    valid = iv.alignment_ignore_filter(paf, regions)
    cover = valid.groupBy("query", "target").agg((F.sum("block_len") / F.max("query_length")).alias("coverage"))
    best = cover.groupBy("query").agg(F.min(F.struct((-F.col("coverage")).alias("c"), "target")).alias("m"), F.count("*").alias("targets"))
    ends = telomeres.groupBy(F.col("contig").alias("query")).agg(F.count("*").alias("telomeres"), F.min(F.struct("start_pos", "end_pos"))["start_pos"].alias("first"), F.max(F.struct("start_pos", "end_pos"))["end_pos"].alias("last"))
    holes = gaps.groupBy(F.col("contig").alias("query")).agg(F.count("*").alias("gaps"), F.sum(F.col("end_pos") - F.col("start_pos")).alias("gap_bases"))
    every = paf.groupBy("query").agg(F.max("query_length").alias("query_length"))
    met = every.join(best, "query", "left").join(ends, "query", "left").join(holes, "query", "left")
    t2t = F.coalesce((-F.col("m.c") > least) & (F.col("targets") == 1) & (F.col("telomeres") >= 2) & (F.col("first") < edge) & (F.col("last") > F.col("query_length") - edge), F.lit(False))
    alias = F.when(t2t, F.col("m.target")).when(F.col("targets") == 1, F.concat_ws("_", "m.target", "query", F.lit("random"))).otherwise(F.concat(F.lit("chrUn_"), "query"))
    return met.select(F.col("query").alias("id"), alias.alias("alias"), F.col("m.target").alias("chrom"), F.when(F.coalesce("gaps", F.lit(0)) > 0, "scaffold").otherwise("contig").alias("level"), t2t.alias("t2t"), F.coalesce("gaps", F.lit(0)).alias("gaps"), F.coalesce("gap_bases", F.lit(0)).alias("gap_bases"))


def contamination_report(hits: DataFrame, screens: DataFrame, limits: DataFrame, descriptions: DataFrame, contigs: DataFrame, discard: float = 0.95) -> DataFrame:
    """Hits of all sources, filtered by their limits, with descriptions, as merged intervals: the covered share of each contig,
    its sources and whether to discard it."""
    from .tables import annotate_subject

    bed = hits_to_bed(annotate_subject(blast_len_filter(hits, limits), descriptions), screens)
    return iv.contamination(bed, contigs, discard)


def report_text(metrics: DataFrame, key: str) -> DataFrame:
    """(key, report): one text per key from contigs, total, n50, full_sgl, full_dup, qv, switch_rate and hamming_rate; what is
    null is Not_Calc."""
    mega = F.when(F.col("n50").isNotNull(), F.format_string("%.2f", F.col("n50") / 1e6))
    lines = [F.concat(F.lit(f"{n}: "), F.coalesce(x, F.lit("Not_Calc"))) for n, x in (
        ("Contigs", F.col("contigs").cast("string")), ("Total Gb", F.when(F.col("total").isNotNull(), F.format_string("%.4f", F.col("total") / 1e9))), ("N50 Mb", mega), ("Single genes", F.col("full_sgl").cast("string")), ("Double genes", F.col("full_dup").cast("string")),
        ("QV", F.when(F.col("qv").isNotNull(), F.format_string("%.3f", F.col("qv")))), ("Switch %", F.when(F.col("switch_rate").isNotNull(), F.format_string("%.4f", F.col("switch_rate") * 100))), ("Hamming %", F.when(F.col("hamming_rate").isNotNull(), F.format_string("%.4f", F.col("hamming_rate") * 100))))]
    return metrics.select(key, F.concat_ws("\n", F.concat(F.lit("-"), F.col(key).cast("string")), *lines).alias("report"))

