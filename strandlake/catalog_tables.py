"""Queries over reads, records, sample tables and names, each with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .operators import align as ag
from .operators import assembly as am
from .operators import calls as ca
from .operators import intervals as iv
from .operators import lengths as le
from .operators import reads as rd
from .operators import reports as rp
from .operators import sequences as sq
from .operators import tables as tb

ADAPTER = "TTACTAGCACTTTA"
_BACK = ADAPTER.translate(str.maketrans("ACGT", "TGCA"))[::-1]
_Q = "-10 * log10(list_sum(list_transform(regexp_extract_all(qual, '.'), lambda c: pow(10, (33 - ascii(c)) / 10.0))) / nullif(length(qual), 0))"
_SPAN = lambda letters: f"coalesce(list_sum(list_transform(regexp_extract_all(cigar, '(\\d+)[{letters}]', 1), lambda x: cast(x as bigint))), 0)"
_TAG = lambda name: f"case when contains(chr(9) || tags, chr(9) || '{name}:') then regexp_extract(tags, '(?:^|\\t){name}:[^:\\t]*:([^\\t]*)', 1) end"
_SOURCE = "CASE WHEN length % 3 = 0 THEN 'mitochondria' WHEN length % 3 = 1 THEN 'plastids' ELSE 'rrna' END"
_LEAST = "CASE source WHEN 'mitochondria' THEN 300 WHEN 'plastids' THEN 200 ELSE 100 END"
_DRAW = "pmod(read_id * 48271, 2147483647) / 2147483647"
_MARKS = {"f0": "--all-kinetics", "f1": "--keep-kinetics", "f2": "--hifi-kinetics", "f3": "PP:primrose"}


def _limits(hits):
    return hits.select("source").distinct().withColumn("least", F.expr(_LEAST))


def _headers(records):
    """Header lines that name one switch for some of the files."""
    said = F.create_map(*[F.lit(x) for kv in _MARKS.items() for x in kv])
    return records.select("file").distinct().select("file", F.concat(F.lit("@PG "), F.coalesce(said[F.col("file")], F.lit(""))).alias("value"))


def _t2t_inputs(o, s):
    ends = o.select(F.concat("query", F.when(F.col("strand") == "+", "_start").otherwise("_end")).alias("name"))
    ns = sq.count_ns(s)
    return ends, ns.select(F.col("name").alias("contig"), "length"), ns.select(F.col("name").alias("contig"), "ns"), o.groupBy(F.col("query").alias("contig")).agg(F.min("target").alias("chrom"))


def _edits(s):
    """Variants at fixed places of sequences of 100 bases and more: a substitution, a deletion, one inside it, one whose ref is
    wrong, an insertion."""
    long = s.where("length(seq) >= 100")
    sites = "array(named_struct('pos', 10, 'n', 1, 'alt', 'GG'), named_struct('pos', 11, 'n', 3, 'alt', 'T'), named_struct('pos', 12, 'n', 1, 'alt', 'A'), named_struct('pos', 40, 'n', 2, 'alt', 'C'), named_struct('pos', 60, 'n', 0, 'alt', 'AA'))"
    rows = long.select("name", "seq", F.explode(F.expr(sites)).alias("v"))
    return rows.select(F.col("name").alias("contig"), "v.pos", F.when(F.col("v.n") == 0, "ZZ").otherwise(F.substring("seq", F.col("v.pos"), F.col("v.n"))).alias("ref"), "v.alt")


def register(add) -> None:
    add("mean_read_q", ("fx_reads",), lambda r: r.select("read_id", F.round(rd.mean_read_q(F.col("qual")), 6).alias("q")), f" select read_id, round({_Q}, 6) as q from fx_reads")
    add("filter_read_quality", ("fx_reads",), lambda r: rd.filter_read_quality(r, 12.25, 1000), f" select * from fx_reads where length(seq) >= 1000 and {_Q} >= 12.25")
    windows = " or ".join(f"levenshtein(substr(seq, i, {n}), '{a}') <= 1" for a in (ADAPTER, _BACK) for n in (13, 14, 15))
    add("discard_adapter_reads", ("fx_reads",), lambda r: rd.discard_adapter_reads(r, (ADAPTER,), 0.08, len(ADAPTER)).select("read_id"), f" select read_id from fx_reads where len(list_filter(range(1, length(seq) + 1), lambda i: {windows})) = 0")
    part = " or ".join(x for a in (ADAPTER, _BACK) for x in (*[f"left(seq, {n}) = '{a[-n:]}' or right(seq, {n}) = '{a[:n]}'" for n in (10, 11, 12)], *[f"levenshtein(left(seq, {n}), '{a[1:]}') <= 1 or levenshtein(right(seq, {n}), '{a[:-1]}') <= 1" for n in (12, 13, 14)]))
    add("discard_adapter_parts", ("fx_reads",), lambda r: ag.discard_adapters(r.select("read_id", "seq"), (ADAPTER,), 0.08, 10).select("read_id"), f" select read_id from fx_reads where len(list_filter(range(1, length(seq) + 1), lambda i: {windows})) = 0 and not ({part})")
    add("exclude_lines", ("fx_reads",), lambda r: rd.exclude_lines(r, ADAPTER[:8], ("seq", "read_id")), f" select * from fx_reads where not contains(seq, '{ADAPTER[:8]}') and not contains(read_id, '{ADAPTER[:8]}')")
    add("blast_len_filter", ("fx_blast",), lambda h: am.blast_len_filter(h.withColumn("source", F.expr(_SOURCE)), _limits(h.withColumn("source", F.expr(_SOURCE)))), f", h as (select *, {_SOURCE} as source from fx_blast) select * from h where length >= {_LEAST}")
    add("paf_adapter_filter", ("fx_paf",), rd.paf_adapter_filter, " select * from fx_paf where nm <= 2 and query_end - query_start >= 42")
    add("sam_quality_filter", ("fx_records",), lambda r: rd.sam_quality_filter(r, 10, 150), f" select * from fx_records where mapq >= 10 and {_SPAN('MIS=X')} >= 150")
    add("tag_filter_and_drop", ("fx_records",), rd.tag_filter_and_drop, f" select * replace (array_to_string(list_filter(string_split(tags, chr(9)), lambda t: split_part(t, ':', 1) not in ('fi', 'ri', 'fp', 'rp')), chr(9)) as tags) from fx_records where cast({_TAG('rq')} as double) >= 0.88")
    identity = "100 - nm * 0.3"
    add("mapping_filters", ("fx_paf",), lambda p: am.mapping_filters(p.withColumn("identity", F.expr(f"cast({identity} as double)")), 99, 300, 20_500, 300), f", p as (select *, cast({identity} as double) as identity from fx_paf) select * from p where identity > 99 and query_end - query_start > 300 and query_length > 20500 and block_len > 300")
    add("orientation_split", ("fx_orientation",), rd.orientation_split, " select distinct query, strand from fx_orientation")
    add("drop_incomplete_rows", ("fx_samples",), tb.drop_incomplete_rows, " select * from fx_samples where sample is not null and sex is not null and cohort is not null and balance is not null")
    add("project_columns", ("fx_samples",), lambda s: tb.project_columns(s, {"sample": "name", "cohort": "batch"}, {"kind": "trio"}), " select sample as name, cohort as batch, 'trio' as kind from fx_samples")
    add("overlay_overrides", ("fx_samples",), lambda s: tb.overlay_overrides(s, s.where("cohort = 3").select("sample", F.lit("M").alias("sex"), F.when(F.col("balance") > 0, 99).alias("cohort")), "sample"), " select s.sample, coalesce(o.sex, s.sex) as sex, coalesce(o.cohort, s.cohort) as cohort, balance from fx_samples s left join (select sample, 'M' as sex, case when balance > 0 then 99 end as cohort from fx_samples where cohort = 3) o on o.sample = s.sample")

    add("annotate_subject", ("fx_blast", "fx_descriptions"), lambda h, d: tb.annotate_subject(h, d, "nt"), " select fx_blast.*, coalesce('(nt) ' || description, 'N/A') as description from fx_blast left join (select sseqid, min(description) as description from fx_descriptions group by 1) using (sseqid)")
    add("annotate_subject_counts", ("fx_blast", "fx_descriptions"), lambda h, d: tb.annotation_counts(tb.annotate_subject(h, d)), " select count(*) filter (description is not null) as found, count(*) filter (description is null) as missing from fx_blast left join (select sseqid, min(description) as description from fx_descriptions group by 1) using (sseqid)")
    add("sex_info_join", ("fx_assemblies", "fx_samples"), lambda a, s: tb.sex_info_join(a.select("sample", "haplotype", "assembly"), s.where("cohort < 20").select("sample", "cohort"), s.where("sex is not null").select("sample", "sex")), " select a.sample, cohort, sex, haplotype, assembly from fx_assemblies a left join (select k.sample, k.cohort, p.sex from fx_samples k left join (select sample, sex from fx_samples where sex is not null) p on p.sample = k.sample where k.cohort < 20) k on k.sample = a.sample")
    per = lambda a: a.groupBy("sample", "haplotype").agg(F.count("*").alias("n"), F.max("assembly").alias("last"))
    add("haplotype_self_merge", ("fx_assemblies",), lambda a: tb.haplotype_self_merge(per(a), ["sample"]), ", g as (select sample, haplotype, count(*) as n, max(assembly) as last from fx_assemblies group by 1, 2) select m.sample, m.n as n_mat, m.last as last_mat, p.n as n_pat, p.last as last_pat from g m join g p using (sample) where m.haplotype = 'mat' and p.haplotype = 'pat'")
    add("add_chrom_labels", ("fx_sequences", "fx_orientation"), lambda s, o: tb.add_chrom_labels(s.select("name"), o.groupBy(F.col("query").alias("name")).agg(F.min("target").alias("chrom"))), " select name, name || coalesce(' [location=chromosome][chromosome=' || replace(chrom, 'chr', '') || ']', '') as header from fx_sequences left join (select query as name, min(target) as chrom from fx_orientation group by 1) using (name)")
    add("split_by_haplotype", ("fx_intervals", "fx_contigs"), lambda a, c: tb.split_by_haplotype(a, c.select("contig", (F.col("length") % 2 + 1).alias("hap"))), " select a.*, c.length % 2 + 1 as hap from fx_intervals a join fx_contigs c using (contig)")
    add("paste_columns", ("fx_read_lengths",), lambda r: tb.paste_columns(le.base_count(r).select("file", "bases"), r.groupBy("file").agg(F.max("length").alias("longest")), "file"), " select file, cast(sum(length) as bigint) as bases, max(length) as longest from fx_read_lengths group by 1")
    add("lookup_chain", ("fx_assemblies", "fx_sequences"), lambda a, s: tb.lookup_chain(a.where("total > 200000").select(F.concat(F.lit("u"), F.col("assembly").cast("string")).alias("unitig")), a.select(F.concat(F.lit("u"), F.col("assembly").cast("string")).alias("unitig"), F.upper("haplotype").alias("side")), a.select(F.concat(F.lit("u"), F.col("assembly").cast("string")).alias("unitig"), F.concat(F.lit("ctg"), (F.col("assembly") % 1000).cast("string")).alias("name")), s), ", f as (select distinct 'ctg' || cast(assembly % 1000 as varchar) as name, case haplotype when 'mat' then 1 else 2 end as to_hap from fx_assemblies where assembly in (select assembly from fx_assemblies where total > 200000)) select name, to_hap, seq from fx_sequences join f using (name)")
    line = "concat('path ', sample, chr(9), location, ' ', CASE WHEN assembly % 2 = 0 THEN 'utig4-' ELSE 'end-' END, CAST(assembly AS STRING))"
    add("rename_map", ("fx_assemblies",), lambda a: tb.rename_map(a.select(F.expr(line.replace("chr(9)", "'\\t'")).alias("value"))), " select sample as name, 'utig4-' || cast(assembly as varchar) as new_name from fx_assemblies where assembly % 2 = 0")

    kind = "CASE WHEN file LIKE 'A%' THEN 'hic' ELSE 'wgs' END"
    genomes = lambda r: r.select("kind").distinct().withColumn("genome", F.when(F.col("kind") == "hic", 3.1e6).otherwise(3.3e6))

    def coverage(r):
        bases = le.base_count(r, genome_sizes={}).select("file", F.expr(kind).alias("kind"), "bases")
        return tb.coverage_from_bases(bases, genomes(bases))

    add("coverage_from_bases", ("fx_read_lengths",), coverage, f", b as (select file, {kind} as kind, cast(sum(length) as bigint) as bases from fx_read_lengths group by 1, 2) select kind, file, bases, round(bases / case kind when 'hic' then 3.1e6 else 3.3e6 end, 2) as coverage from b")
    add("t2t_both_ends", ("fx_orientation", "fx_sequences"), lambda o, s: am.t2t_both_ends(*_t2t_inputs(o, s)), """, e as (select query as contig, count(distinct strand) as n, min(target) as chrom from fx_orientation group by 1),
s as (select name as contig, length(seq) as length, length(seq) - length(replace(seq, 'N', '')) as ns from fx_sequences) select contig, length, ns, chrom, case when ns = 0 then 'contig' else 'scaffold' end as kind from e join s using (contig) where n = 2""")
    add("gfa_coverage", ("fx_gfa",), lambda g: tb.gfa_coverage(g.where("kind = 'S'").select("name", "length"), g.where("kind = 'A'").select("name", F.col("from_pos").alias("start_pos"), F.col("to_pos").alias("end_pos"))), ", p as (select name, sum(to_pos - from_pos) as bases from fx_gfa where kind = 'A' group by 1) select name, coalesce(bases, 0) / length as coverage from (select name, length from fx_gfa where kind = 'S') left join p using (name)")
    add("sum_max", ("fx_contigs",), lambda c: tb.sum_max(c, "length"), " select cast(sum(length) as bigint) as total, max(length) as largest from fx_contigs")
    marks = ", ".join(f"bool_or(contains(tags, '{m}')) as has_{n}" for n, m in rd.TAG_MARKS.items())
    heads = ", ".join(f"file = '{f}' as {n}" for f, n in zip(_MARKS, rd.HEADER_MARKS, strict=True))
    add("presence_flags", ("fx_records",), lambda r: rd.presence_flags(r, _headers(r), 100), f", f as (select * from fx_records qualify row_number() over (partition by file order by read_id, flag, contig, pos, tags) <= 100) select *, {heads} from (select file, {marks} from f group by 1)")
    good, cover = "matches / block_len >= 0.99", "(query_end - query_start) / query_length"
    add("gene_completeness", ("fx_genes",), am.gene_completeness, f""", g as (select query as gene, count(*) filter ({good} and {cover} >= 0.99 and side = 'ref') as r, count(*) filter ({good} and {cover} >= 0.99 and side = 'asm') as a, coalesce(max({cover}) filter ({good} and side = 'asm'), 0) as best from fx_genes group by 1)
select gene, case when a = 1 then 'full_sgl' when a > 1 then 'full_dup' when best >= 0.5 then 'frag' when best >= 0.1 then 'part' else 'missing' end as state from g where r = 1""")
    status = "case when left_trim = 0 and right_trim = 0 then 'skipped' when len(fi) > 0 and (left_trim + right_trim >= len(fi) or len(fi) - left_trim - right_trim <> read_len) then 'failed' else 'fixed' end"
    add("trim_counters", ("fx_kinetics",), lambda k: rd.trim_counters(rd.trim_kinetics(k)), f", s as (select {status} as status from fx_kinetics) select count(*) as reads, count(*) filter (status = 'fixed') as fixed, count(*) filter (status = 'skipped') as skipped, count(*) filter (status = 'failed') as failed from s")
    ends = lambda a, front, back: f"fi[1 + {front}] as {a}_first, fi[len(fi) - {back}] as {a}_last"
    add("trim_kinetics", ("fx_kinetics",), lambda k: rd.trim_kinetics(k).select("read_id", "status", F.size("fi").cast("long").alias("n"), *[x for a in ("fi", "rp") for x in (F.col(a)[0].alias(f"{a}_first"), F.element_at(a, -1).alias(f"{a}_last"))]), f", s as (select *, {status} as status from fx_kinetics) select read_id, status, cast(len(fi) - left_trim - right_trim as bigint) as n, {ends('fi', 'left_trim', 'right_trim')}, {ends('rp', 'right_trim', 'left_trim')} from s")
    parent = "CASE WHEN CAST(round(vaf * 100) AS BIGINT) % 5 < 3 THEN 'mat' ELSE 'pat' END"
    add("switch_hamming", ("fx_variants",), lambda v: am.switch_hamming(v.select("contig", "pos", F.expr(parent).alias("parent"))), f""", m as (select contig, pos, {parent} as parent from fx_variants), s as (select *, parent <> lag(parent) over (partition by contig order by pos, parent) as sw from m),
g as (select contig, count(*) as markers, count(*) filter (sw) as switches, least(count(*) filter (parent = 'mat'), count(*) filter (parent = 'pat')) as minority from s group by 1) select *, coalesce(switches / nullif(markers - 1, 0), 0) as switch_rate, minority / markers as hamming_rate from g""")
    add("sort_contig_start", ("fx_intervals",), lambda a: tb.range_sorted(a, "contig", "start_pos", "end_pos", "source", "hit_id"), " select * from fx_intervals order by contig, start_pos, end_pos, source, hit_id")

    near = "length % 3000 as target_start, length - length % 2000 as target_end, length as target_length"
    mapped = lambda c: c.select("contig", *[F.expr(x) for x in near.split(", ")])
    telo = lambda c: c.where("length % 2 = 0").select("contig", F.lit("start").alias("end_name")).union(c.where("length % 3 = 0").select("contig", F.lit("end").alias("end_name")))
    add("chromosome_end_breaks", ("fx_intervals", "fx_contigs"), lambda a, c: am.chromosome_end_breaks(iv.flank(a, c, 100), mapped(c), telo(c), 1500), """, f as (select contig, 'left' as side, greatest(start_pos - 100, 0) as start_pos, least(start_pos, length) as end_pos from fx_intervals join fx_contigs using (contig)
  union all select contig, 'right', least(end_pos, length), least(end_pos + 100, length) from fx_intervals join fx_contigs using (contig)),
x as (select contig, 'left' as side from fx_contigs where length % 3000 < 1500 and length % 2 = 0 union all select contig, 'right' from fx_contigs where length % 2000 < 1500 and length % 3 = 0)
select * from f where start_pos < end_pos and not exists (select 1 from x where x.contig = f.contig and x.side = f.side)""")
    add("hits_to_bed", ("fx_blast", "fx_report_lines"), lambda h, r: am.hits_to_bed(h.withColumns({"source": F.expr(_SOURCE), "description": F.lit("N/A")}), rp.adapter_sections_to_bed(r).select("contig", (F.col("start_pos") + 1).alias("first"), F.col("end_pos").alias("last"), F.lit("Strong").alias("kind"))), f""" select qseqid as contig, qstart - 1 as start_pos, qend as end_pos, {_SOURCE} as source, sseqid as hit, 'N/A' as description from fx_blast
union all select split_part(line, chr(9), 2), cast(split_part(line, chr(9), 3) as bigint) - 1, cast(split_part(line, chr(9), 4) as bigint), 'vecscreen', 'Strong', 'Strong' from fx_report_lines where regexp_matches(line, '^VecScreen_(Strong|Moderate)\\t')""")
    add("homozygous_regions", ("fx_cs",), lambda p: am.homozygous_regions(p, 600, 100), """, d as (select distinct * from fx_cs), o as (select *, regexp_extract_all(cs, ':\\d+|\\*[a-z]{2}|\\+[a-z]+|-[a-z]+') as ops from d), e as (select * exclude (ops), unnest(ops) as op, generate_subscripts(ops, 1) as place from o),
z as (select *, case left(op, 1) when ':' then cast(substr(op, 2) as bigint) when '*' then 1 else length(op) - 1 end as n, left(op, 1) as kind from e),
p as (select *, query_start + sum(case when kind <> '-' then n else 0 end) over w as qe, target_start + sum(case when kind <> '+' then n else 0 end) over w as te from z window w as (partition by query, query_length, query_start, target, target_length, target_start, cs order by place))
select query, cast(greatest(qe - n - 100, 0) as bigint) as query_start, cast(least(qe + 100, query_length) as bigint) as query_end, target, cast(greatest(te - n - 100, 0) as bigint) as target_start, cast(least(te + 100, target_length) as bigint) as target_end from p where kind = ':' and n >= 600""")
    add("stack_haplotype_intervals", ("fx_paf",), am.stack_haplotype_intervals, " select query as contig, query_start as start_pos, query_end as end_pos from fx_paf union all select target, target_start, target_end from fx_paf")

    bed = ["contig", "start_pos", "end_pos"]
    add("union_all_beds", ("fx_intervals", "fx_regions"), lambda a, b: tb.union_all(a.select(*bed), b.select(*bed)), " select contig, start_pos, end_pos from fx_intervals union all select contig, start_pos, end_pos from fx_regions")
    add("concat_frames", ("fx_intervals", "fx_regions"), tb.union_all, " select contig, start_pos, end_pos, source, hit_id, null as label from fx_intervals union all select contig, start_pos, end_pos, null, null, label from fx_regions")
    add("vcf_concat", ("fx_variants",), lambda v: ca.vcf_concat(v.where("filter = 'PASS'"), v.where("gq > 10")), " select * from fx_variants where filter = 'PASS' union all select * from fx_variants where gq > 10")
    add("diploid_concat", ("fx_sequences",), lambda s: tb.diploid_concat(s.where("length(seq) % 2 = 0"), s.where("length(seq) % 2 = 1")), " select *, length(seq) % 2 + 1 as hap from fx_sequences where seq is not null")
    second = "contig, pos, ref, alt, filter, gq + 1 as gq"
    add("vcf_merge_callers", ("fx_variants",), lambda v: ca.vcf_merge_callers(v.where("filter = 'PASS'"), v.where("gq > 10").withColumn("gq", F.col("gq") + 1)), f""", a as (select contig, pos, ref, alt, max(gq) as gq, arg_max(filter, gq) as filter from fx_variants where filter = 'PASS' group by all), b as (select contig, pos, ref, alt, max(gq) as gq, arg_max(filter, gq) as filter from (select {second} from fx_variants where gq > 10) group by all)
select contig, pos, ref, alt, case when a.gq is not null and b.gq is not null then 'both' when a.gq is not null then 'first' else 'second' end as source, coalesce(a.gq, b.gq) as gq, coalesce(a.filter, b.filter) as filter from a full join b using (contig, pos, ref, alt)""")
    add("merge_alignments", ("fx_records",), lambda r: tb.range_sorted(tb.union_all(r.where("flag < 256"), r.where("flag >= 256")), "contig", "pos", "read_id"), " select * from fx_records")

    add("parse_tag_int", ("fx_records",), lambda r: r.select("read_id", rd.parse_tag(F.col("tags"), "NM").cast("int").alias("nm")), f" select read_id, cast({_TAG('NM')} as int) as nm from fx_records")
    add("cigar_lengths", ("fx_records",), lambda r: r.select("read_id", rd.query_span(F.col("cigar")).alias("query_span"), rd.reference_span(F.col("cigar")).alias("reference_span")), f" select read_id, cast({_SPAN('MIS=X')} as bigint) as query_span, cast({_SPAN('MDN=X')} as bigint) as reference_span from fx_records")
    add("file_type_from_name", ("fx_pairs",), lambda p: p.select("sample1", rp.file_type(F.col("sample1")).alias("kind")), " select sample1, case when contains(sample1, 'hifi') then 'hifi' when contains(sample1, 'ont') then 'ont' when contains(sample1, 'hic') then 'hic' when contains(sample1, 'kinnex') then 'kinnex' else 'other' end as kind from fx_pairs")
    add("genbank_id", ("fx_metrics",), lambda m: m.select("accession", tb.genbank_id(F.col("accession")).alias("id")), " select accession, coalesce(nullif(split_part(accession, '#', 3), ''), string_split(accession, '#')[-1]) as id from fx_metrics")
    add("rewrite_headers", ("fx_metrics",), lambda m: m.select("accession", tb.rewrite_header(F.concat(F.lit("lcl|"), "accession", F.lit(" Homo sapiens chromosome")), "HG1", 1).alias("header")), " select accession, 'HG1#1#' || accession as header from fx_metrics")
    add("path_parts", ("fx_assemblies",), lambda a: a.select("location", *[c.alias(n) for n, c in tb.path_parts(F.col("location")).items()], tb.move_prefix(F.col("location"), "./data/", "store/raw/").alias("moved")), " select location, sample as sample_part, haplotype as hap_part, case haplotype when 'pat' then 1 else 2 end as mat_pat_int, replace(location, './data/', 'store/raw/') as moved from fx_assemblies")
    add("clean_metric_string", ("fx_metrics",), lambda m: m.select("sample", tb.clean_metric(F.col("raw")).alias("value")), " select sample, string_split(rtrim(raw), ' ')[-1] as value from fx_metrics")
    count, percent = (lambda k: lambda m: tb.count_percent(F.col("class_line"))[k])(0), (lambda k: lambda m: tb.count_percent(F.col("class_line"))[k])(1)
    add("count_pct_regex", ("fx_metrics",), lambda m: m.select("sample", count(m).alias("count"), percent(m).alias("percent")), " select sample, coalesce(nullif(regexp_extract(class_line, ':\\s+(\\d+)', 1), ''), 'NA') as count, coalesce(nullif(regexp_extract(class_line, ':\\s+(\\d+)\\s+\\(([0-9.]+)%\\)', 2), ''), 'NA') as percent from fx_metrics")
    add("phase_color_map", ("fx_metrics",), lambda m: tb.phase_colors(m.select(F.col("sample").alias("node"), "phase")), " select sample as node, case phase when 1 then 100000 else 0 end as mat, case phase when 1 then 0 else 100000 end as pat, case phase when 1 then '100000:0' else '0:100000' end as counts, case phase when 1 then '#FF8888' else '#8888FF' end as color from fx_metrics where phase <> 0")
    add("apply_edits", ("fx_sequences",), lambda s: am.apply_edits(s, _edits(s)), " select name, case when length(seq) >= 100 then left(seq, 9) || 'GGT' || substr(seq, 14, 26) || 'C' || substr(seq, 42) else seq end as seq, case when length(seq) >= 100 then 3 else 0 end as applied from fx_sequences")

    add("downsample_coverage", ("fx_read_lengths",), lambda r: rd.downsample_coverage(r, 100, 1e6, F.expr(_DRAW)), " select * from fx_read_lengths where ((read_id * 48271) % 2147483647) / 2147483647 < (select 1e8 / sum(length) from fx_read_lengths)")
    overlap = "exists (select 1 from fx_regions g where g.contig = s.contig and s.start_pos < g.end_pos and g.start_pos < s.end_pos)"
    add("mapq_table", ("fx_records", "fx_regions"), rd.mapq_table, f", s as (select distinct read_id, contig, pos, mapq, pos - 1 as start_pos, pos - 1 + {_SPAN('MDN=X')} as end_pos from fx_records) select read_id, contig, pos, mapq from s where {overlap}")
    add("correct_alignments", ("fx_records",), lambda r: rd.correct_alignments(r, r.where("flag = 2048").select("read_id"), r.where("mapq < 20").select("read_id", "contig", "pos", F.lit(60).alias("mapq")), r.where("flag = 256").select("read_id"), 60, 60, 0.03), f""", a as (select *, {_SPAN('M=X')} as m from fx_records), f as (select * replace (case when read_id in (select read_id from fx_records where flag = 256) and flag & 2048 = 0 then flag # 256 else flag end as flag) from a where {_SPAN('MIS=X')} >= 60 and m >= 60 and cast({_TAG('NM')} as double) <= 0.03 * m)
select * exclude (m) replace (case when exists (select 1 from fx_records r where r.mapq < 20 and r.read_id = f.read_id and r.contig = f.contig and r.pos = f.pos) then 60 else mapq end as mapq) from f where flag & 2304 = 0 and read_id not in (select read_id from fx_records where flag = 2048)""".replace("flag # 256", "xor(flag, 256)"))
    add("mito_read_selection", ("fx_sequences", "fx_orientation"), lambda s, o: rd.mito_read_selection(s, o.select("query", "block_len"), 12_000), " select * from fx_sequences where name in (select query from fx_orientation where block_len >= 12000)")
