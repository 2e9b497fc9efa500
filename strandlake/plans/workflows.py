"""Workflows that put several operators together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import alignments as al
from ..operators import assembly as am
from ..operators import calls as ca
from ..operators import intervals as iv
from ..operators import lengths as le
from ..operators import reads as rd
from ..operators import reports as rp
from ..operators import sequences as sq
from ..operators import sketches as sk
from ..operators import tables as tb
from ..operators import variants as va
from ..sources.scratch import materialise


def hifi_qc_summary(records: DataFrame, headers: DataFrame | None = None) -> DataFrame:
    """Per file: read statistics and which tags its first records hold."""
    lengths = records.select("file", rd.query_span(F.col("cigar")).alias("length"))
    return tb.paste_columns(le.read_stats(lengths).where("file != 'ALL'"), rd.presence_flags(records, headers), "file")


def coverage_summary(reads: DataFrame, genome: float) -> DataFrame:
    """Per file: bases, reads and coverage to two decimals."""
    return le.base_count(reads, genome_sizes={"all": genome}).select("file", "bases", "reads", F.round("coverage_all", 2).alias("coverage"))


def sample_swap_report(counts: DataFrame, least: int = 1) -> DataFrame:
    """Allele counts per file (sample is the file's name) -> the swap summary, with the share of unequal genotypes as score."""
    pairs = sk.pairwise_sample_eval(counts, least)
    return rp.sample_swap_summary(pairs.select(F.col("a").alias("sample1"), F.col("b").alias("sample2"), (1 - F.col("same") / F.col("sites")).alias("score")))


def adapter_mask(sequences: DataFrame, *evidence: DataFrame, gap: int = 5) -> DataFrame:
    """Sequences with N for the merged intervals of all evidence."""
    beds = tb.union_all(*[e.select("contig", "start_pos", "end_pos") for e in evidence])
    return sq.mask(sequences, iv.merge(beds, gap))


def contigs_to_drop(lines: DataFrame, titles: tuple[str, ...], mito: tuple[str, ...]) -> DataFrame:
    """(file, contig, mito, review) once per contig that a section of these titles lists: whether mitochondrial sections alone do,
    without MT in the line, and whether another section does."""
    listed = rp.sections(lines).where(F.col("section").isin(*titles) & ~F.startswith("line", F.lit("#")))
    rows = listed.select("file", F.split("line", "\t").alias("f"), "section", "line").where("size(f) > 1")
    return rows.groupBy("file", F.col("f")[1].alias("contig")).agg(F.bool_and(F.col("section").isin(*mito) & ~F.contains("line", F.lit("MT"))).alias("mito"), F.bool_or(~F.col("section").isin(*mito)).alias("review"))


def find_breakpoints(breaks: DataFrame, contigs: DataFrame, mapping: DataFrame, telomeric: DataFrame, annotation: DataFrame, width: int = 100, reach: int = 1_000_000) -> DataFrame:
    """(label, n): annotations in the flanks of breaks that lie at no true chromosome end."""
    flanks = am.chromosome_end_breaks(iv.flank(breaks, contigs, width), mapping, telomeric, reach)
    return iv.annotation_counts(flanks, annotation)


def assembly_metrics(lengths: DataFrame, genes: DataFrame, qv: DataFrame | None = None, phasing: DataFrame | None = None, key: str = "file") -> DataFrame:
    """Per key: contigs, total, n50, l50, single and double genes, and where they are given QV and phasing rates, else null.
    genes: (key, gene, state); qv: (key, qv); phasing: (key, switch_rate, hamming_rate)."""
    out = le.nx_lx_aun(lengths, key).select(key, "contigs", "total", "n50", "l50")
    counts = genes.groupBy(key).agg(*[F.count_if(F.col("state") == s).alias(s) for s in ("full_sgl", "full_dup")])
    out = out.join(counts, key, "left")
    out = out.join(qv, key, "left") if qv is not None else out.withColumn("qv", F.lit(None).cast("double"))
    return out.join(phasing, key, "left") if phasing is not None else out.withColumns({c: F.lit(None).cast("double") for c in ("switch_rate", "hamming_rate")})


def clean_assembly(sequences: DataFrame, drop: DataFrame, strands: DataFrame, chromosomes: DataFrame, mito: DataFrame) -> DataFrame:
    """Sequences without dropped ones, as their strand has them, labelled by chromosome, with the mitochondrial one added; of
    equal sequences the first by header stays."""
    kept = sq.subset_by_names(sequences.select("name", "seq"), drop, drop=True)
    one = strands.groupBy("query").agg(F.min("strand").alias("strand"))
    turned = rd.oriented(kept, one)
    named = turned.join(tb.add_chrom_labels(turned.select("name"), chromosomes), "name").select("header", "seq")
    every = named.unionByName(mito.select(F.col("name").alias("header"), "seq"))
    return sq.dedup_by_sequence(every.withColumnRenamed("header", "name")).select("name", "copies", "digest")


def polish_post(sequences: DataFrame, *calls: DataFrame) -> DataFrame:
    """Sequences with the calls put in that hold no * and pass the tiered qualities."""
    return am.apply_edits(sequences, va.tiered_gq(va.drop_star(tb.union_all(*calls))))


def nucfreq_clusters(records: DataFrame, least_second: int = 2, gap: int = 500, least: int = 5, exclude: int = 0x904) -> DataFrame:
    """Clusters of positions whose second allele has at least so many reads."""
    two = al.top_two_alleles(ca.base_pileup(al.flag_filter(records, exclude)))
    return al.variant_clusters(two.where(F.col("second") >= least_second), gap, least)


def methylation_tracks(records: DataFrame, haplotypes: DataFrame, least_mapq: int = 10, least_length: int = 0) -> DataFrame:
    """Percent of modified CpGs by position, with the haplotype of the contig."""
    return tb.split_by_haplotype(ca.methyl_pileup(rd.sam_quality_filter(records, least_mapq, least_length)), haplotypes)


def mito_contig_final(paf: DataFrame, sequences: DataFrame, sample: str, hap: int) -> DataFrame:
    """(header, seq): the part of each target that a query's best hit covers, in the query's direction, under a new header."""
    best = al.best_hit(paf).select(F.col("target").alias("contig"), F.col("target_start").alias("start_pos"), F.col("target_end").alias("end_pos"), "strand", "query")
    cut = sq.extract(sequences, best)
    turned = F.when(F.col("strand") == "-", sq.reverse_complement(F.col("seq"))).otherwise(F.col("seq"))
    return cut.select(tb.rewrite_header(F.col("query"), sample, hap).alias("header"), turned.alias("seq"))


def genbank_contamination_summary(rows: DataFrame, unmapped: DataFrame) -> DataFrame:
    """(id, trims, excluded, unmapped) of contigs that a submission report or the list of unmapped contigs names."""
    said = rows.groupBy(tb.genbank_id(F.col("contig")).alias("id")).agg(F.count_if(F.col("kind") == "Trim").alias("trims"), F.bool_or(F.col("kind") == "Exclude").alias("excluded"))
    listed = unmapped.select(tb.genbank_id(F.col("contig")).alias("id")).distinct().withColumn("unmapped", F.lit(True))
    return said.join(listed, "id", "full_outer").select("id", F.coalesce("trims", F.lit(0)).alias("trims"), F.coalesce("excluded", F.lit(False)).alias("excluded"), F.coalesce("unmapped", F.lit(False)).alias("unmapped"))


def launch_table(assemblies: DataFrame, samples: DataFrame, pedigree: DataFrame, overrides: DataFrame) -> DataFrame:
    """Complete rows of assemblies with their samples' attributes, overrides laid over them."""
    return tb.drop_incomplete_rows(tb.overlay_overrides(tb.sex_info_join(assemblies, samples, pedigree), overrides, "sample"))


def comparison_qc(sequences: DataFrame, least: int = 200_000, broken: bool = False, key: str = "file") -> DataFrame:
    """Length statistics per key of sequences at least so long, broken at N first if asked for."""
    rows = sequences
    if broken:
        rows = sq.break_at_n(sequences.select(F.concat_ws("\x01", key, "name").alias("name"), "seq")).select(F.split("name", "\x01")[0].alias(key), "seq")
    return le.nx_lx_aun(rows.select(key, F.length("seq").cast("long").alias("length")).where(F.col("length") >= least), key)


def alignment_qc(records: DataFrame, sets: dict[str, str], **options) -> DataFrame:
    """Clusters of second alleles per named set of alignments, each set a condition on the records."""
    made = [nucfreq_clusters(records.where(where), **options).withColumn("set", F.lit(name)) for name, where in sets.items()]
    return tb.union_all(*made)


def assembly_read_prep(hifi: DataFrame, ultralong: DataFrame, adapters: tuple[str, ...], error_rate: float = 0.05, overlap: int = 35, least_q: float = 10, least_length: int = 100_000) -> DataFrame:
    """(kind, reads, bases) that an assembler gets: hifi reads without adapters, ultralong ones of length and quality."""
    clean = rd.discard_adapter_reads(hifi, adapters, error_rate, overlap).select(F.lit("hifi").alias("kind"), "seq")
    long = rd.filter_read_quality(ultralong, least_q, least_length).select(F.lit("ultralong").alias("kind"), "seq")
    return clean.unionByName(long).groupBy("kind").agg(F.count("*").alias("reads"), F.sum(F.length("seq")).alias("bases"))


def polish_phasing_tables(pairs: DataFrame, records: DataFrame, least: int = 20_000, extend: int = 50_000, most_divergence: float = 0.02) -> DataFrame:
    """Alignments with few changes; those in regions that are alike on both haplotypes, of both, have the mapq that the table
    of such alignments gives. Writes two tables to the shared folder when called."""
    # The join by place reads both sides twice: each is made once, and of the regions only their union is needed.
    regions = materialise(iv.merge(am.stack_haplotype_intervals(am.homozygous_regions(pairs, least, extend))), "regions")
    good = materialise(rd.correct_alignments(records, most_divergence=most_divergence), "good")
    table = rd.mapq_table(good, regions).withColumn("mapq", F.lit(60))
    return rd.correct_alignments(good, mapq=table, primary_only=False)


def kmer_qc_bundle(parts: dict[str, DataFrame], reads: DataFrame, markers: DataFrame | None = None) -> DataFrame:
    """(hap, total, only_assembly, error, qv, completeness[, switches, markers]) of haplotypes by their k-mer counts."""
    from ..operators.kmers import kmer_qv

    made = tb.union_all(*[kmer_qv(p, reads).withColumn("hap", F.lit(name)) for name, p in parts.items()])
    if markers is None:
        return made
    phased = am.switch_hamming(markers).groupBy().agg(F.sum("switches").alias("switches"), F.sum("markers").alias("markers"))
    return made.join(F.broadcast(phased))  # one row

