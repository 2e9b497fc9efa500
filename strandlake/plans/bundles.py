"""Quality bundles of assemblies in their variants, reports by section, and track files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import alignments as al
from ..operators import assembly as am
from ..operators import calls as ca
from ..operators import haplotypes as hp
from ..operators import intervals as iv
from ..operators import reads as rd
from ..operators import sequences as sq
from ..operators import tables as tb
from ..operators.kmers import kmer_qv
from ..sources import writers as ww
from ..sources.scratch import materialise
from . import workflows as wf

#: What each variant of the bundle is given beside lengths and genes.
VARIANTS = {"trio": ("qv", "phasing"), "trio_no_qv": ("phasing",), "nontrio": ("qv",), "haploid": ("qv", "one"), "full": ("qv", "phasing", "kmers")}


def quality_values(parts: dict[str, DataFrame], reads: DataFrame, key: str = "file") -> DataFrame:
    """(key, qv, completeness) of assemblies by their k-mer counts against those of the reads; a null qv where no k-mer is wrong."""
    return tb.union_all(*[kmer_qv(counts, reads).select(F.lit(name).alias(key), F.round("qv", 9).alias("qv"), F.round("completeness", 9).alias("completeness")) for name, counts in parts.items()])


def standard_qc(variant: str, lengths: DataFrame, genes: DataFrame, qv: DataFrame | None = None, phasing: DataFrame | None = None, haplotype: str | None = None, key: str = "file") -> DataFrame:
    """(variant, key, contigs, total, n50, l50, full_sgl, full_dup, qv, switch_rate, hamming_rate, completeness) of one of VARIANTS.

    trio has parents: QV and phasing; trio_no_qv phasing alone; nontrio QV alone; haploid one haplotype, without phasing; full also the k-mer
    completeness. What a variant lacks is null.
    """
    given = VARIANTS[variant]
    only = lambda df: df.where(F.col(key) == haplotype) if "one" in given else df
    made = wf.assembly_metrics(only(lengths), only(genes), qv.select(key, "qv") if "qv" in given else None, phasing if "phasing" in given else None, key)
    if "kmers" in given:
        made = made.join(qv.select(key, "completeness"), key, "left")
    else:
        made = made.withColumn("completeness", F.lit(None).cast("double"))
    # A key of all files is no haplotype.
    made = made.where(F.col(key) != "ALL") if "one" in given else made
    return made.select(F.lit(variant).alias("variant"), key, "contigs", "total", "n50", "l50", "full_sgl", "full_dup", F.col("qv").cast("double").alias("qv"), "switch_rate", "hamming_rate", "completeness")


def contamination_text(hits: DataFrame, screens: DataFrame) -> DataFrame:
    """(section, rank, contig, start_pos, end_pos, line): the lines of a report, in this order: a title for each source (rank 0), its distinct hits (1), a
    blank (2), then a section of all sources' merged intervals. hits as of hits_to_bed, screens (contig, start_pos, end_pos)."""
    bed = hits.select("contig", "start_pos", "end_pos", "source", F.coalesce("description", F.lit("N/A")).alias("said"))
    bed = bed.unionByName(screens.select("contig", "start_pos", "end_pos", F.lit("vecscreen").alias("source"), F.lit("VecScreen").alias("said"))).distinct()
    merged = iv.merge(bed.select("contig", "start_pos", "end_pos")).select("contig", "start_pos", "end_pos", F.lit("zz_merged").alias("source"), F.lit("merged").alias("said"))
    rows = bed.unionByName(merged)
    line = F.concat_ws("\t", F.concat(F.lit("# "), "said"), "contig", F.col("start_pos").cast("string"), F.col("end_pos").cast("string"))
    body = rows.select(F.col("source").alias("section"), F.lit(1).alias("rank"), "contig", "start_pos", "end_pos", line.alias("line"))
    title = F.concat(F.lit("========== "), F.regexp_replace("source", "^zz_", ""), F.lit(" =========="))
    place = [F.lit(None).cast("string").alias("contig"), *[F.lit(None).cast("long").alias(c) for c in ("start_pos", "end_pos")]]
    names = rows.select("source").distinct()
    frame = names.select(F.col("source").alias("section"), F.explode(F.array(F.struct(F.lit(0).alias("rank"), title.alias("line")), F.struct(F.lit(2).alias("rank"), F.lit("").alias("line")))).alias("x"))
    return body.unionByName(frame.select("section", "x.rank", *place, "x.line"))


def write_report(lines: DataFrame, path: str) -> None:
    """The lines of contamination_text as text files: sections in order, each whole over consecutive files."""
    order = ["section", "rank", "contig", "start_pos", "end_pos", "line"]
    lines.repartitionByRange(*order).sortWithinPartitions(*order).select(F.col("line").alias("value")).write.mode("overwrite").text(path)


def breakpoint_tables(paf: DataFrame, sequences: DataFrame, flanks: DataFrame, annotation: DataFrame, edge: int = 1000, least: int = 400, motif: str = "TTAGGG|CCCTAA", least_span: int = 500_000, least_query: int = 0) -> dict[str, DataFrame]:
    """Tables beside the annotated flanks: orientation (query, strand), telomeres (name, at_start, at_end), t2t (contig, length, ns, chrom, kind),
    chromosomes (target, n, percent) and annotated (label, n). paf has query, target, strand and lengths, sequences (name, seq)."""
    ends = sq.telomere_ends(sequences, edge, least, motif)
    named = ends.select(F.explode(F.filter(F.array(F.when(F.col("at_start"), F.concat("name", F.lit("_start"))), F.when(F.col("at_end"), F.concat("name", F.lit("_end")))), lambda x: x.isNotNull())).alias("name"))
    counts = sq.count_ns(sequences)
    chroms = paf.groupBy(F.col("query").alias("contig")).agg(F.min("target").alias("chrom"))
    return {
        "orientation": rd.orientation_split(paf),
        "telomeres": ends,
        "t2t": am.t2t_both_ends(named, counts.select(F.col("name").alias("contig"), "length"), counts.select(F.col("name").alias("contig"), "ns"), chroms),
        "chromosomes": al.chr_completeness(paf, least_span, least_query).select("target", "n", F.format_string("%.3f", "percent").alias("percent")),
        "annotated": iv.annotation_counts(flanks, annotation),
    }


def stacked(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, row): the rows of all tables as text, fields joined by tabs, null as NA."""
    text = lambda df: F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in df.columns])
    return tb.union_all(*[df.select(F.lit(name).alias("table"), text(df).alias("row")) for name, df in tables.items()])


def nucfreq_tracks(records: DataFrame, folder: str, least_second: int = 2, gap: int = 500, least: int = 5, exclude: int = 0x904) -> DataFrame:
    """Writes the tracks first and second, the counts of the commonest and second allele at each place, as bedGraph below folder, and returns the
    clusters of places whose second allele has least_second reads."""
    two = al.top_two_alleles(ca.base_pileup(al.flag_filter(records, exclude)))
    for name in ("first", "second"):
        ww.write_bedgraph(two.select("contig", (F.col("pos") - 1).alias("start_pos"), F.col("pos").alias("end_pos"), name), f"{folder}/{name}", name)
    return al.variant_clusters(two.where(F.col("second") >= least_second), gap, least)


def methylation_files(records: DataFrame, haplotypes: DataFrame, folder: str, least_mapq: int = 10) -> list[str]:
    """Writes a bedGraph of the percent of modified CpGs for each haplotype of (contig, hap) below folder; their paths. Haplotypes are 1 and 2."""
    rows = materialise(wf.methylation_tracks(records, haplotypes, least_mapq), "methylation")  # counted once for both
    paths = []
    for hap in (1, 2):
        own = rows.where(F.col("hap") == hap).select("contig", F.col("pos").alias("start_pos"), (F.col("pos") + 1).alias("end_pos"), F.round("percent", 3).alias("percent"))
        ww.write_bedgraph(own, f"{folder}/hap{hap}", "percent")
        paths.append(f"{folder}/hap{hap}")
    return paths


def alignment_qc_inputs(first: DataFrame, second: DataFrame, sets: dict[str, DataFrame], **options) -> tuple[DataFrame, DataFrame]:
    """(the diploid sequences (name, seq, hap), clusters of second alleles for each set of records over contigs that the diploid has)."""
    diploid = tb.diploid_concat(first, second)
    known = diploid.select(F.col("name").alias("contig"), "hap").distinct()
    clusters = [wf.nucfreq_clusters(records.join(known.select("contig"), "contig", "left_semi"), **options).join(known, "contig").withColumn("set", F.lit(name)) for name, records in sets.items()]
    return diploid, tb.union_all(*clusters)


def stranded_homozygous_regions(paf: DataFrame, least: int = 20_000, extend: int = 50_000) -> DataFrame:
    """homozygous_regions of alignments on either strand (strand, query_end beside its columns): on the - strand the operations of cs run along
    the target, and down the query from its end."""
    back = paf.where("strand = '-'")
    plain = [c for c in paf.columns if c not in ("strand", "query_end")]
    # The query turned round: its places count from the other end.
    turned = back.withColumn("query_start", F.col("query_length") - F.col("query_end")).select(*plain)
    found = am.homozygous_regions(turned.withColumn("query", F.concat_ws("\x01", "query", F.col("query_length").cast("string"))), least, extend)
    name, size = F.split("query", "\x01")[0], F.split("query", "\x01")[1].cast("long")
    again = found.select(name.alias("query"), (size - F.col("query_end")).alias("query_start"), (size - F.col("query_start")).alias("query_end"), "target", "target_start", "target_end")
    return am.homozygous_regions(paf.where("strand = '+'").select(*plain), least, extend).unionByName(again)


def trim_totals(before: DataFrame, after: DataFrame) -> DataFrame:
    """trim_counters and how many MM and ML tags the trimming took out. Reads have a map of tags; before and after are the same reads (read_id)."""
    has = lambda tag: F.coalesce(F.map_contains_key("tags", F.lit(tag)), F.lit(False))
    count = lambda df, sign: df.select(*[(has(t).cast("long") * sign).alias(t) for t in ("MM", "ML")])
    lost = count(before, 1).unionByName(count(after, -1)).agg(F.coalesce(F.sum("MM"), F.lit(0)).alias("mm_removed"), F.coalesce(F.sum("ML"), F.lit(0)).alias("ml_removed"))
    return rd.trim_counters(after).join(F.broadcast(lost))  # one row


def merge_labelled_callers(first: DataFrame, second: DataFrame, reference: DataFrame) -> DataFrame:
    """One row per allele of either caller, guided by how the callers compare: of alleles that spell one sequence the first caller's stand for both,
    what either has alone is kept. (contig, pos, ref, alt, source, gq, filter); source: both, first or second."""
    label = hp.match_calls(first, second, reference)
    key = ["contig", "pos", "ref", "alt"]
    one = lambda calls: calls.withColumn("pos", F.col("pos").cast("long")).groupBy(*key).agg(F.max(F.struct("gq", "filter")).alias("x"))
    side = lambda name: label.where(F.col("side") == name).select(*key, "matched")
    a = one(first).join(side("truth"), key).withColumn("source", F.when(F.col("matched"), "both").otherwise("first"))
    b = one(second).join(side("query").where("not matched"), key).withColumn("source", F.lit("second"))
    return a.unionByName(b).select(*key, "source", "x.gq", "x.filter")


def description_counts(hits: DataFrame, lines: DataFrame) -> DataFrame:
    """One row: hits with a description and without, and lines of the description table (value: id, tab, description) that are malformed, which
    have no tab or nothing before it."""
    f = F.split("value", "\t", 2)
    good = (F.size(f) == 2) & (f[0] != "")
    table = lines.where(good).select(f[0].alias("sseqid"), f[1].alias("description"))
    counts = tb.annotation_counts(tb.annotate_subject(hits, table))
    return counts.join(F.broadcast(lines.agg(F.count_if(~good | F.col("value").isNull()).alias("malformed"))))  # one row


def moved_to_other_haplotype(issues: DataFrame, assignments: DataFrame, placements: DataFrame, sequences: DataFrame, haplotype: Column) -> DataFrame:
    """(name, hap, seq): each haplotype's sequences with those of lookup_chain appended to the one that gets them. haplotype: that of a row of sequences,
    1 or 2."""
    own = sequences.select("name", haplotype.cast("int").alias("hap"), "seq")
    return own.unionByName(tb.lookup_chain(issues, assignments, placements, sequences).select("name", F.col("to_hap").alias("hap"), "seq"))
