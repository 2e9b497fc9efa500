"""Queries that write a view as files of a format and read them back, each with the DuckDB SQL of the view."""

from __future__ import annotations

from pyspark.sql import functions as F

from .operators import reports as rp
from .sources import fastq as fq
from .sources import readers as rr
from .sources import writers as ww
from .sources.scratch import shared_dir


def _through(df, write, read):
    """read(spark, folder) of what write(df, folder) leaves in a new folder."""
    spark, folder = df.sparkSession, shared_dir(df.sparkSession)
    write(df, folder)
    return read(spark, folder)


def _text(df, expression: str, path: str) -> None:
    df.select(F.expr(expression).alias("value")).write.mode("overwrite").text(path)


def _round(expression: str, read):
    return lambda df: _through(df, lambda d, p: _text(d, expression, p), read)


_KINNEX = """concat_ws('\\n', 'Results', concat('Input reads: ', n_in), concat('Passed reads: ', n_ok, ' (', pct, '%)'), concat('Unique genes: ', genes), concat('Unique transcripts: ', tr), '', 'Classifications, by isoform', concat('Full splice match: ', fsm, ' (', pct, '%)'), concat('Incomplete splice match: ', ism), '', 'Classifications, by read', concat('Full splice match: ', n_ok, ' (', pct, '%)'), '', 'Junctions', 'Filter reasons', concat('Intrapriming: ', ism, ' (', pct, '%)'), '')"""
_KINNEX_COLUMNS = "cast(c_custkey * 100 as string) as n_in, cast(c_custkey * 70 as string) as n_ok, cast(c_custkey % 100 as string) || '.5' as pct, cast(c_nationkey as string) as genes, cast(c_nationkey * 3 as string) as tr, cast(c_custkey % 37 as string) as fsm, cast(c_custkey % 11 as string) as ism"


def _reports(df, text: str):
    """Writes a report for each row, under the name in column file, and gives the lines read back."""
    return _through(df.select("file", F.expr(text).alias("text")), ww.write_report_bundle, rr.report_bundle_lines)


def _pigeon(metrics):
    made = metrics.select(F.col("sample").alias("file"), F.substr("sample", F.lit(3)).cast("bigint").alias("k"))
    made = made.selectExpr("file", *[x.replace("c_custkey", "k").replace("c_nationkey", "(k % 25)") for x in _KINNEX_COLUMNS.split(", ")])
    return rp.pigeon_summary(_reports(made, _KINNEX))


def _contamination(contigs):
    """Submission reports with trims of two spans and exclusions, read back."""
    text = "concat_ws('\\n', 'Trim:', 'Sequence name, length, span(s), apparent source', concat_ws('\\t', contig, length, concat('10..', length % 50 + 20, ',400..500'), 'adaptor:NGB'), '', 'Exclude:', 'Sequence name, length, apparent source', concat_ws('\\t', contig, length, 'mitochondrion not cleaned'), '')"
    return rp.contamination_rows(_reports(contigs.withColumn("file", F.col("contig")), text))


def register(add) -> None:
    fasta = " select name, coalesce(regexp_extract(description, '^\\s*(.*)$', 1), '') as description, coalesce(seq, '') as seq, length(coalesce(seq, '')) as length from fx_sequences where name is not null"
    clean = lambda s: s.where("name is not null").withColumn("seq", F.coalesce("seq", F.lit("")))
    add("scan_fasta", ("fx_sequences",), lambda s: _through(clean(s), lambda d, p: ww.write_fasta(d, p, 60), lambda k, p: rr.read_fasta(k, p).drop("file")), fasta)
    add("write_fasta", ("fx_sequences",), lambda s: _through(clean(s), lambda d, p: ww.write_fasta(d, p, gzip=True), lambda k, p: rr.read_fasta(k, p).drop("file")), fasta)
    add("scan_fastq", ("fx_reads",), lambda r: _through(r.where("seq != ''"), lambda d, p: ww.write_fastq(d, p), lambda s, p: rr.read_fastq(s, p).drop("file")), " select read_id, seq, qual, length(seq) as length from fx_reads where seq <> ''")
    add("scan_fastq_ranges", ("fx_reads",), lambda r: _through(r.where("seq != ''"), lambda d, p: ww.write_fastq(d, p), lambda s, p: fq.scan_fastq(s, p, 300_000).drop("file")), " select read_id, seq, qual, length(seq) as length from fx_reads where seq <> ''")
    add("scan_lengths", ("fx_contigs",), _round("concat_ws('\t', contig, length, '0', '60', '61')", lambda s, p: rr.read_lengths(s, p).select("name", "length")), " select contig as name, length from fx_contigs")
    add("scan_bed", ("fx_intervals",), _round("concat_ws('\t', contig, start_pos, end_pos, source, hit_id)", lambda s, p: rr.read_bed(s, p, ("source", "hit_id"))), " select * from fx_intervals")
    tagged = "concat_ws('\t', query, query_length, query_start, query_end, strand, target, target_length, target_start, target_end, block_len, block_len, mapq, concat('NM:i:', nm), concat('AS:i:', as_score))"
    add("scan_paf", ("fx_paf",), _round(tagged, lambda s, p: rr.read_paf(s, p).withColumns({"nm": F.col("tags")["NM"].cast("int"), "as_score": F.col("tags")["AS"].cast("long")}).drop("tags", "matches")), " select * replace (cast(nm as int) as nm) from fx_paf")
    add("scan_blast", ("fx_blast",), _round("concat('# Fields: of a search\n', concat_ws('\t', qseqid, sseqid, pident, length, 0, 0, qstart, qend, 1, 9, '1e-30', 50, qlen, slen))", lambda s, p: rr.read_blast(s, p).select("qseqid", "sseqid", "pident", "length", "qstart", "qend", "qlen", "slen")), " select * from fx_blast")
    sam = "concat_ws('\t', read_id, flag, contig, pos, mapq, cigar, '*', 0, 0, seq, '*', tags)"
    add("scan_sam", ("fx_records",), _round(f"concat('@HD\tVN:1.6\n', {sam})", lambda s, p: rr.read_sam(s, p)[1].select("read_id", "flag", "contig", "pos", "mapq", "cigar", "seq", F.col("tags")["NM"].cast("int").alias("nm"))), " select read_id, cast(flag as int) as flag, contig, pos, mapq, cigar, seq, cast(regexp_extract(tags, 'NM:i:(\\d+)', 1) as int) as nm from fx_records")
    vcf = "concat('##fileformat=VCFv4.2\n#CHROM\tPOS\n', concat_ws('\t', contig, pos, '.', ref, alt, '50', filter, concat('DP=', gq, ';SOMATIC'), 'GT:GQ:VAF', concat('0/1:', gq, ':', vaf)))"
    add("scan_vcf", ("fx_variants",), _round(vcf, lambda s, p: rr.read_vcf(s, p).select("contig", "pos", "ref", "alt", "filter", F.col("format")["GQ"].cast("int").alias("gq"), F.col("format")["VAF"].cast("double").alias("vaf"), F.col("info")["DP"].cast("int").alias("dp"))), " select contig, pos, ref, alt, filter, cast(gq as int) as gq, vaf, cast(gq as int) as dp from fx_variants")
    add("scan_run_summary", ("fx_run_summary",), lambda r: _through(r, lambda d, p: _text(d, "concat('read_id\tmean_qscore_template\tsequence_length_template\n', concat_ws('\t', read_id, mean_qscore, sequence_length))", p), lambda s, p: rr.read_run_summary(s, p).drop("file").withColumn("read_id", F.col("read_id").cast("long"))), " select read_id, sequence_length, mean_qscore from fx_run_summary")

    def gfa(s, p):
        segments, placed = rr.read_gfa(s, p)
        return segments.select(F.lit("S").alias("kind"), "name", "length", F.lit(None).cast("long").alias("from_pos"), F.lit(None).cast("long").alias("to_pos")).unionByName(placed.select(F.lit("A").alias("kind"), "name", F.lit(None).cast("long").alias("length"), F.col("start_pos").alias("from_pos"), F.col("end_pos").alias("to_pos")))

    add("scan_gfa", ("fx_gfa",), _round("if(kind = 'S', concat_ws('\t', 'S', name, '*', concat('LN:i:', length)), concat_ws('\t', 'A', name, from_pos, '+', 'read', 0, to_pos - from_pos))", gfa), " select * from fx_gfa")
    add("scan_read_manifest", ("fx_paths",), _round("concat_ws('\t', path, if(length(path) % 2 = 0, 'second', null))", lambda s, p: rr.read_manifest(s, p)), " select path, case when length(path) % 2 = 0 then 'second' end as second from fx_paths")
    pairs = lambda df: df.groupBy("file").agg(F.count("*").cast("string").alias("reads"), F.sum("sequence_length").cast("string").alias("bases"))
    add("scan_summaries_glob", ("fx_run_summary",), lambda r: _through(pairs(r), lambda d, p: ww.write_summary_tsv(d.withColumnRenamed("file", "sample"), p, "sample"), lambda s, p: rr.read_summaries(s, p, "*.csv").drop("file")), " select file as sample, cast(count(*) as varchar) as reads, cast(cast(sum(sequence_length) as bigint) as varchar) as bases from fx_run_summary group by 1")
    add("write_summary_tsv", ("fx_run_summary",), lambda r: _through(pairs(r).withColumnRenamed("file", "sample"), lambda d, p: ww.write_summary_tsv(d, p, "sample"), lambda s, p: s.read.options(header=True, sep="\t").schema("sample string, reads string, bases string, part string").csv(p).select("sample", "reads", "bases")), " select file as sample, cast(count(*) as varchar) as reads, cast(cast(sum(sequence_length) as bigint) as varchar) as bases from fx_run_summary group by 1")
    k = "cast(substr(sample, 3) as bigint)"
    put = _KINNEX_COLUMNS.replace("c_custkey", k).replace("c_nationkey", f"({k} % 25)").replace(" as string)", " as varchar)")
    add("scan_pigeon_summary", ("fx_metrics",), _pigeon, f", r as (select sample as file, {put} from fx_metrics) select file, n_in as flnc_input_reads, n_ok as passed_reads, pct as passed_pct, genes as unique_genes, tr as unique_transcripts, fsm as fsm_isoforms, pct as fsm_isoform_pct, ism as ism_isoforms, 'NA' as ism_isoform_pct, 'NA' as nic_isoforms, 'NA' as nic_isoform_pct, 'NA' as nnc_isoforms, 'NA' as nnc_isoform_pct, pct as fsm_read_pct, pct as intrapriming_pct, 'NA' as rt_switching_pct from r")
    add("scan_contamination_report", ("fx_contigs",), _contamination, """ select contig as file, 'Trim' as kind, contig, length as size, cast(10 as bigint) as first, length % 50 + 20 as last, 'adaptor:NGB' as source from fx_contigs
union all select contig, 'Trim', contig, length, 400, 500, 'adaptor:NGB' from fx_contigs union all select contig, 'Exclude', contig, length, null, null, 'mitochondrion not cleaned' from fx_contigs""")

    add("write_bed_sorted", ("fx_intervals", "fx_regions"), lambda a, b: _through(a.select("contig", "start_pos", "end_pos"), lambda d, p: ww.write_bed_sorted(p, d, b.select("contig", "start_pos", "end_pos")), rr.read_bed), " select contig, start_pos, end_pos from fx_intervals union all select contig, start_pos, end_pos from fx_regions")
    add("write_bedgraph", ("fx_base_counts",), lambda b: _through(b.select("contig", (F.col("pos") - 1).alias("start_pos"), F.col("pos").alias("end_pos"), F.greatest("a", "c", "g", "t").alias("first")), lambda d, p: ww.write_bedgraph(d, p, "first"), lambda s, p: rr.read_bed(s, p, ("first:long",))), " select contig, pos - 1 as start_pos, pos as end_pos, greatest(a, c, g, t) as first from fx_base_counts")

    def sharded(df, **size):
        named = df.select(F.concat_ws("/", "file", F.col("read_id").cast("string")).alias("name"), "length")
        return _through(named, lambda d, p: ww.write_sharded(d, p, order=("name", "length"), **size), lambda s, p: s.read.schema("name string, length long, number long, shard long").parquet(p))

    order = "select file || '/' || cast(read_id as varchar) as name, length, row_number() over (order by file || '/' || cast(read_id as varchar), length) - 1 as number from fx_read_lengths"
    add("write_sharded", ("fx_read_lengths",), lambda r: sharded(r, shard_bases=20_000_000), f" select *, cast((sum(length) over (order by number) - length) // 20000000 as bigint) as shard from ({order})")
    add("write_sharded_records", ("fx_read_lengths",), lambda r: sharded(r, shard_records=7000), f" select *, number // 7000 as shard from ({order})")
    add("write_entity_table", ("fx_samples",), lambda s: _through(s, ww.write_entity_table, lambda k, p: k.read.parquet(p)), " select * from fx_samples")
