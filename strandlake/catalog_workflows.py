"""Queries over whole workflows. Their DuckDB SQL is put together from that of the operators' queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .catalog_files import _contamination, _pigeon, _through
from .catalog_genome import PILED, methyl_sql
from .catalog_tables import _BACK, _LEAST, _Q, _SOURCE, _SPAN, _TAG, ADAPTER, _headers, _limits
from .operators import assembly as am
from .operators import kmers as km
from .operators import reads as rd
from .operators import reports as rp
from .operators import sequences as sq
from .operators import tables as tb
from .plans import workflows as wf
from .plans.fixtures import ctes
from .sources import readers as rr
from .sources import writers as ww


def register(add) -> None:
    from . import catalog

    def rest(name: str, *views: str) -> str:
        """A query's SQL without its views."""
        return catalog._SQL[name].removeprefix(ctes(*views))

    def inside(head: str, name: str, *views: str) -> str:
        """A query's SQL over other common table expressions than its views."""
        return f"(with {head} {rest(name, *views)})"

    spans = f"fx_read_lengths as (select file, read_id, cast({_SPAN('MIS=X')} as bigint) as length from fx_records)"
    add("hifi_qc_summary", ("fx_records",), lambda r: wf.hifi_qc_summary(r, _headers(r)), f" select * from {inside(spans, 'read_stats', 'fx_read_lengths')} join {inside('z as (select 1)', 'presence_flags', 'fx_records')} using (file) where file <> 'ALL'")
    for name, genome in (("hic_qc_summary", 3.1e6), ("wgs_qc_summary", 3.3e6)):
        add(name, ("fx_read_lengths",), lambda r, g=genome: wf.coverage_summary(r, g), f" select file, cast(sum(length) as bigint) as bases, count(*) as reads, round(sum(length) / {genome}, 2) as coverage from fx_read_lengths group by 1")
    add("kinnex_qc_summary", ("fx_metrics",), lambda m: _pigeon(m).withColumnRenamed("file", "file_name"), f" select * exclude (file), file as file_name from {inside('z as (select 1)', 'scan_pigeon_summary', 'fx_metrics')}")
    label = "'HG1000' || cast(cast(floor(cast(substr({x}, 2) as bigint) / 2) as bigint) as varchar) || '_hifi_' || {x}"
    rename = "concat('HG1000', cast(cast(floor(cast(substr(sample, 2) as bigint) / 2) as bigint) as string), '_hifi_', sample)"
    add("sample_swap_report", ("fx_alleles",), lambda a: wf.sample_swap_report(a.withColumn("sample", F.expr(rename))), f" select * from (with fx_pairs as (select {label.format(x='a')} as sample1, {label.format(x='b')} as sample2, 1 - same / sites as score from {inside('z as (select 1)', 'pairwise_sample_eval', 'fx_alleles')}) {rest('sample_swap_summary', 'fx_pairs')})")
    beds = f"""fx_intervals as (select qseqid as contig, qstart - 1 as start_pos, qend as end_pos, {_SOURCE} as source from (select *, {_SOURCE} as source from fx_blast) where length >= {_LEAST}), fx_contigs as (select distinct qseqid as contig, qlen as length from fx_blast)"""
    none = lambda h: h.select(F.lit("").alias("contig"), F.lit(1).cast("long").alias("first"), F.lit(1).cast("long").alias("last"), F.lit("").alias("kind")).where("false")
    add("contamination_report", ("fx_blast", "fx_descriptions"), lambda h, d: am.contamination_report((x := h.withColumn("source", F.expr(_SOURCE))), none(h), _limits(x), d, h.select(F.col("qseqid").alias("contig"), F.col("qlen").alias("length")).distinct()), f" select * from {inside(beds, 'contig_contamination', 'fx_intervals', 'fx_contigs')}")

    places = lambda s: s.where("length(seq) % 2 = 0").select(F.col("name").alias("contig"), F.lit(10).cast("long").alias("start_pos"), F.lit(60).cast("long").alias("end_pos"))
    masked = """, e as (select split_part(line, chr(9), 2) as contig, cast(split_part(line, chr(9), 3) as bigint) - 1 as start_pos, cast(split_part(line, chr(9), 4) as bigint) as end_pos from fx_report_lines where regexp_matches(line, '^VecScreen_(Strong|Moderate)\\t')
  union all select name, 10, 60 from fx_sequences where length(seq) % 2 = 0),
w as (select *, max(end_pos) over (partition by contig order by start_pos, end_pos rows between unbounded preceding and 1 preceding) as reach from (select distinct * from e)),
i as (select *, sum(case when start_pos <= reach + 5 then 0 else 1 end) over (partition by contig order by start_pos, end_pos rows unbounded preceding) as island from w), m as (select contig, min(start_pos) as s, max(end_pos) as t from i group by contig, island),
c as (select name, sum(length(replace(substr(seq, cast(s + 1 as bigint), cast(t - s as bigint)), 'N', ''))) as more from fx_sequences join m on m.contig = name group by 1)
select name, length(seq) as length, cast(length(seq) - length(replace(seq, 'N', '')) + coalesce(more, 0) as bigint) as ns from fx_sequences left join c using (name)"""
    add("adapter_mask", ("fx_sequences", "fx_report_lines"), lambda s, r: sq.count_ns(wf.adapter_mask(s, rp.adapter_sections_to_bed(r), places(s))), masked)
    add("contigs_to_drop", ("fx_report_lines",), lambda r: wf.contigs_to_drop(r, ("USER", "SYSTEM"), ("SYSTEM",)), f", s as (select * from {inside('z as (select 1)', 'scan_sections', 'fx_report_lines')}) select file, split_part(line, chr(9), 2) as contig, bool_and(section = 'SYSTEM' and not contains(line, 'MT')) as mito, bool_or(section <> 'SYSTEM') as review from s where section in ('USER', 'SYSTEM') and contains(line, chr(9)) and not starts_with(line, '#') group by 1, 2")
    near = ("contig", "length % 3000 as target_start", "length - length % 2000 as target_end", "length as target_length")
    telo = lambda c: c.where("length % 2 = 0").select("contig", F.lit("start").alias("end_name")).union(c.where("length % 3 = 0").select("contig", F.lit("end").alias("end_name")))
    add("find_breakpoints", ("fx_intervals", "fx_contigs", "fx_regions"), lambda a, c, g: wf.find_breakpoints(a, c, c.selectExpr(*near), telo(c), g, 100, 1500), f", q as (select distinct * from {inside('z as (select 1)', 'chromosome_end_breaks', 'fx_intervals', 'fx_contigs')}) select b.label, count(*) as n from q join fx_regions b on q.contig = b.contig and q.start_pos < b.end_pos and b.start_pos < q.end_pos group by 1")

    target = "CASE WHEN query_length % 4 = 0 THEN target ELSE concat('chr', CAST(query_length % 24 AS STRING)) END"
    one = lambda p, where, *spans_: p.where(where).select("query", "query_length").distinct().select(F.col("query").alias("contig"), F.explode(F.array(*[F.struct(F.expr(a).cast("long").alias("start_pos"), F.expr(b).cast("long").alias("end_pos")) for a, b in spans_])).alias("x")).select("contig", "x.start_pos", "x.end_pos")
    add("assign_chromosomes", ("fx_paf", "fx_ignored"), lambda p, g: am.assign_chromosomes(p.withColumn("target", F.expr(target)), g, one(p, "query_length % 2 = 1", ("0", "500"), ("query_length - 400", "query_length")), one(p, "query_length % 3 = 0", ("5000", "5100")), 10_000, 0.4), f""", p as (select * replace ({target} as target) from fx_paf), v as (select * from p where not exists (select 1 from fx_ignored r where r.contig = p.target) or exists (select 1 from fx_ignored r where r.contig = p.target and (p.target_start < r.start_pos or p.target_end > r.end_pos))),
c as (select query, target, sum(block_len) / max(query_length) as coverage from v group by 1, 2), b as (select distinct on (query) query, target, coverage, count(*) over (partition by query) as targets from c order by query, coverage desc, target),
e as (select p.query, max(p.query_length) as len, any_value(b.target) as chrom, any_value(coverage) as coverage, any_value(targets) as targets from p left join b using (query) group by 1),
t as (select *, coalesce(coverage > 0.4 and targets = 1 and len % 2 = 1, false) as t2t, len % 3 = 0 as gap from e)
select query as id, case when t2t then chrom when targets = 1 then chrom || '_' || query || '_random' else 'chrUn_' || query end as alias, chrom, case when gap then 'scaffold' else 'contig' end as level, t2t, cast(case when gap then 1 else 0 end as bigint) as gaps, cast(case when gap then 100 else 0 end as bigint) as gap_bases from t""")

    file_of = "CASE CAST(substr(gene, 2) AS BIGINT) % 3 WHEN 0 THEN 'AF' WHEN 1 THEN 'NO' ELSE 'RF' END"
    hap_of = "CASE WHEN CAST(substr(contig, 4) AS BIGINT) % 2 = 0 THEN 'AF' ELSE 'NO' END"
    parent = "CASE WHEN CAST(round(vaf * 100) AS BIGINT) % 5 < 3 THEN 'mat' ELSE 'pat' END"

    hap = """(with a as (select distinct kmer from c where role = {r}), b as (select kmer, count(*) as n from c where role = 2 group by 1), t as (select count(a.kmer) as total, count(*) filter (a.kmer is not null and b.kmer is null) as only_assembly, count(*) filter (b.n >= 2) as solid, count(*) filter (b.n >= 2 and a.kmer is not null) as found from a full join b using (kmer)),
e as (select *, 1 - power(1 - only_assembly / nullif(total, 0), 1.0 / 21) as error from t) select 'hap{h}' as hap, total, only_assembly, round(error, 9) as error, round(case when error > 0 then -10 * log10(error) end, 9) + 0.0 as qv, round(found / nullif(solid, 0), 9) as completeness from e)"""

    def quality(s):
        """QV of the sequences of role 0 and 1, as files AF and NO, against those of role 2."""
        from .catalog import _roles
        from .plans.bundles import quality_values

        one, two, reads = _roles(s)
        return quality_values({"AF": one, "NO": two}, reads)

    def phasing(v):
        phased = am.switch_hamming(v.select("contig", "pos", F.expr(parent).alias("parent"))).withColumn("file", F.expr(hap_of))
        return phased.groupBy("file").agg((F.sum("switches") / F.sum(F.col("markers") - 1)).alias("switch_rate"), (F.sum("minority") / F.sum("markers")).alias("hamming_rate"))

    def metrics(r, g, v, s):
        genes = am.gene_completeness(g).withColumn("file", F.expr(file_of))
        return wf.assembly_metrics(r, genes, quality(s).select("file", "qv"), phasing(v))

    table = catalog._kmer_sql() + f""", n as (select * from {inside('z as (select 1)', 'nx_lx_aun', 'fx_read_lengths')}), s as (select *, {file_of} as file from {inside('z as (select 1)', 'gene_completeness', 'fx_genes')}), h as (select {hap_of} as file, sum(switches) / sum(markers - 1) as switch_rate, sum(minority) / sum(markers) as hamming_rate from {inside('z as (select 1)', 'switch_hamming', 'fx_variants')} group by 1),
gk as (select file, count(*) filter (state = 'full_sgl') as full_sgl, count(*) filter (state = 'full_dup') as full_dup from s group by 1),
qv as (select 'AF' as file, qv, completeness from {hap.format(r=0, h=1)} union all select 'NO', qv, completeness from {hap.format(r=1, h=2)}),
metrics as (select file, contigs, total, n50, l50, full_sgl, full_dup, qv, switch_rate, hamming_rate from n left join gk using (file) left join h using (file) left join qv using (file)) """
    views = ("fx_read_lengths", "fx_genes", "fx_variants", "fx_sequences")
    add("assembly_metrics_table", views, metrics, table + "select * from metrics")
    said = " || chr(10) || ".join(f"'{n}: ' || coalesce({x}, 'Not_Calc')" for n, x in (("Contigs", "cast(contigs as varchar)"), ("Total Gb", "printf('%.4f', total / 1e9)"), ("N50 Mb", "printf('%.2f', n50 / 1e6)"), ("Single genes", "cast(full_sgl as varchar)"), ("Double genes", "cast(full_dup as varchar)"), ("QV", "printf('%.3f', qv)"), ("Switch %", "printf('%.4f', switch_rate * 100)"), ("Hamming %", "printf('%.4f', hamming_rate * 100)")))
    add("qc_text_report", views, lambda *f: am.report_text(metrics(*f), "file"), table + f"select file, '-' || file || chr(10) || {said} as report from metrics")
    add("standard_qc", ("fx_read_lengths", "fx_genes"), lambda r, g: wf.assembly_metrics(r, am.gene_completeness(g).withColumn("file", F.expr(file_of))), f", n as (select * from {inside('z as (select 1)', 'nx_lx_aun', 'fx_read_lengths')}), k as (select {file_of} as file, count(*) filter (state = 'full_sgl') as full_sgl, count(*) filter (state = 'full_dup') as full_dup from {inside('z as (select 1)', 'gene_completeness', 'fx_genes')} group by 1) select file, contigs, total, n50, l50, full_sgl, full_dup, cast(null as double) as qv, cast(null as double) as switch_rate, cast(null as double) as hamming_rate from n left join k using (file)")
    # Without parents there are no error rates.
    bare = "(select * replace (cast(null as double) as switch_rate, cast(null as double) as hamming_rate) from metrics)"
    add("short_qc", views, lambda r, g, v, s: am.report_text(wf.assembly_metrics(r, am.gene_completeness(g).withColumn("file", F.expr(file_of)), quality(s).select("file", "qv")), "file"), table + f"select file, '-' || file || chr(10) || {said} as report from {bare}")

    def variants(r, g, v, s):
        from .plans.bundles import VARIANTS, standard_qc

        genes, qv, rates = am.gene_completeness(g).withColumn("file", F.expr(file_of)), quality(s), phasing(v)
        return tb.union_all(*[standard_qc(name, r, genes, qv, rates, "AF") for name in VARIANTS])

    empty = "cast(null as double)"
    one_of = lambda name, qv, rates, full, where: f"select '{name}' as variant, file, contigs, total, n50, l50, full_sgl, full_dup, {qv} as qv, {'switch_rate' if rates else empty} as switch_rate, {'hamming_rate' if rates else empty} as hamming_rate, {'completeness' if full else empty} as completeness from (select m.*, qv.completeness from metrics m left join qv using (file)) where {where}"
    add("standard_qc_variants", views, variants, table + " union all ".join([one_of("trio", "qv", True, False, "true"), one_of("trio_no_qv", empty, True, False, "true"), one_of("nontrio", "qv", False, False, "true"), one_of("haploid", "qv", False, False, "file = 'AF'"), one_of("full", "qv", True, True, "true")]))
    keyed = "coalesce(regexp_extract(description, '^([^ ]*)', 1), 'none')"
    add("comparison_qc", ("fx_sequences",), lambda s: wf.comparison_qc(s.withColumn("file", F.expr(keyed)), 1000), f" select * from {inside(f'fx_read_lengths as (select {keyed} as file, length(seq) as length from fx_sequences where length(seq) >= 1000)', 'nx_lx_aun', 'fx_read_lengths')}")
    add("comparison_qc_broken", ("fx_sequences",), lambda s: wf.comparison_qc(s.withColumn("file", F.expr(keyed)), 50, broken=True), f" select * from {inside(f'p as (select {keyed} as file, unnest(regexp_split_to_array(seq, {chr(39)}[nN]+{chr(39)})) as x from fx_sequences), fx_read_lengths as (select file, length(x) as length from p where length(x) >= 50)', 'nx_lx_aun', 'fx_read_lengths')}")

    drop, mt = "length(seq) % 5 = 0", "ACGTACGTTTGA"
    add("clean_assembly", ("fx_sequences", "fx_orientation"), lambda s, o: wf.clean_assembly(s, s.where(drop), o, o.groupBy(F.col("query").alias("name")).agg(F.min("target").alias("chrom")), s.sparkSession.range(1).select(F.lit("MT").alias("name"), F.lit(mt).alias("seq"))), f""", o as (select query as name, min(strand) as strand, min(target) as chrom from fx_orientation group by 1), k as (select name || ' [location=chromosome][chromosome=' || replace(chrom, 'chr', '') || ']' as name, case strand when '-' then reverse(translate(seq, 'ACGT', 'TGCA')) else seq end as seq from fx_sequences join o using (name) where name not in (select name from fx_sequences where {drop})
  union all select 'MT', '{mt}') select sha256(seq) as digest, min(name) as name, count(*) as copies from k group by seq""")

    def calls(s):
        from .catalog_tables import _edits

        return _edits(s).withColumn("gq", F.when(F.col("pos") == 40, 12).otherwise(21))

    add("polish_post", ("fx_sequences",), lambda s: wf.polish_post(s, calls(s), s.where("length(seq) >= 100").select(F.col("name").alias("contig"), F.lit(50).alias("pos"), F.substring("seq", 50, 1).alias("ref"), F.lit("*").alias("alt"), F.lit(99).alias("gq"))), " select name, case when length(seq) >= 100 then left(seq, 9) || 'GGT' || substr(seq, 14) else seq end as seq, case when length(seq) >= 100 then 2 else 0 end as applied from fx_sequences")
    clusters = """, s2 as (select distinct contig, pos from piled where list_reverse_sort([a, c, g, t])[2] >= {least}), nn as (select *, case when pos - lag(pos) over (partition by contig order by pos) <= 40 then 0 else 1 end as new from s2),
ii as (select *, sum(new) over (partition by contig order by pos) as i from nn) select contig, min(pos) as start_pos, max(pos) + 1 as end_pos, count(*) as sites{more} from ii group by contig, i having count(*) >= 5"""
    piled = lambda where: PILED.replace("from fx_records)", f"from fx_records where {where})", 1)
    add("nucfreq_tracks", ("fx_records",), lambda r: wf.nucfreq_clusters(r, 3, 40), piled("flag & 2308 = 0") + clusters.format(least=3, more=""))
    sets = {"hifi": "mapq >= 30", "ont": "mapq < 30"}
    add("alignment_qc_inputs", ("fx_records",), lambda r: wf.alignment_qc(r, sets, least_second=2, gap=40), " select * from (" + ") union all select * from (".join(f"with none as (select 1) {piled(f'flag & 2308 = 0 and {w}')}" + clusters.format(least=2, more=f", '{n}' as set") for n, w in sets.items()) + ")")
    mm = "concat('C+m,', CAST(length(seq) % 3 AS STRING), ',', CAST(length(seq) % 2 AS STRING), ',1;')"
    add("methylation_tracks", ("fx_records",), lambda r: wf.methylation_tracks(r.select("contig", "pos", "mapq", F.when(F.col("flag").bitwiseAND(16) != 0, "-").otherwise("+").alias("strand"), "cigar", "seq", F.expr(mm).alias("mm"), F.array(F.lit(250), F.lit(20), F.lit(160)).alias("ml")), r.select("contig").distinct().withColumn("hap", F.when(F.col("contig") < "chr2", 1).otherwise(2))), methyl_sql("length(seq) % 3", "length(seq) % 2", "mapq >= 10") + "select *, 100 * modified / coverage as percent, case when contig < 'chr2' then 1 else 2 end as hap from called")
    add("mito_contig_final", ("fx_paf", "fx_reference"), lambda p, f: wf.mito_contig_final(p, f, "HG1", 1), f", b as (select * from {inside('z as (select 1)', 'best_hit', 'fx_paf')}), x as (select query, strand, substr(seq, target_start + 1, target_end - target_start) as seq from b join fx_reference f on f.name = b.target) select 'HG1#1#' || query as header, case strand when '-' then reverse(translate(seq, 'ACGT', 'TGCA')) else seq end as seq from x")
    add("genbank_contamination_summary", ("fx_contigs",), lambda c: wf.genbank_contamination_summary(_contamination(c), c.where("length % 3 = 0").select("contig").union(c.where("length % 7 = 0").select(F.concat(F.lit("HG#1#x"), "contig")))), """, u as (select contig as id from fx_contigs where length % 3 = 0 union select 'x' || contig from fx_contigs where length % 7 = 0)
select id, case when contig is null then 0 else 2 end as trims, contig is not null as excluded, u.id is not null as unmapped from (select contig as id, contig from fx_contigs) full join u using (id)""")
    add("launch_table", ("fx_assemblies", "fx_samples"), lambda a, s: wf.launch_table(a.select("sample", "haplotype", "assembly"), s.select("sample", "cohort"), s.select("sample", "sex"), s.where("cohort = 3").select("sample", F.lit("F").alias("sex"))), " select * from (select a.sample, a.haplotype, a.assembly, k.cohort, coalesce(o.sex, k.sex) as sex from fx_assemblies a left join (select s.sample, s.cohort, p.sex from fx_samples s left join (select sample, sex from fx_samples) p on p.sample = s.sample) k on k.sample = a.sample left join (select sample, 'F' as sex from fx_samples where cohort = 3) o on o.sample = a.sample) where sample is not null and haplotype is not null and assembly is not null and cohort is not null and sex is not null")
    add("aggregate_summaries", ("fx_run_summary",), lambda r: _through(r.groupBy(F.col("file").alias("sample")).agg(F.count("*").cast("string").alias("reads"), F.max("mean_qscore").cast("string").alias("best")), lambda d, p: ww.write_summary_tsv(d, p, "sample"), lambda s, p: rr.read_summaries(s, p, "*.csv").drop("file")), " select file as sample, cast(count(*) as varchar) as reads, cast(max(mean_qscore) as varchar) as best from fx_run_summary group by 1")

    def bundle(s, v):
        from .catalog import _ROLE

        counts = km.packed_counts(s.withColumn("role", F.expr(_ROLE)), keep=("role",))
        part = lambda r: counts.where(F.col("role") == r).drop("role")
        made = wf.kmer_qc_bundle({"hap1": part("0"), "hap2": part("1")}, part("2"), v.select("contig", "pos", F.expr(parent).alias("parent")))
        return made.withColumns({c: F.round(c, 9) for c in ("error", "qv", "completeness")})

    add("kmer_qc_bundle", ("fx_sequences", "fx_variants"), bundle, catalog._kmer_sql() + f" select * from ({hap.format(r=0, h=1)} union all {hap.format(r=1, h=2)}), (select cast(sum(switches) as bigint) as switches, cast(sum(markers) as bigint) as markers from {inside('z as (select 1)', 'switch_hamming', 'fx_variants')})")
    add("assembly_read_prep", ("fx_reads",), lambda r: wf.assembly_read_prep(r, r, (ADAPTER,), 0.0, len(ADAPTER), 12.25, 1000), f" select 'hifi' as kind, count(*) as reads, cast(sum(length(seq)) as bigint) as bases from fx_reads where not contains(seq, '{ADAPTER}') and not contains(seq, '{_BACK}') union all select 'ultralong', count(*), cast(sum(length(seq)) as bigint) from fx_reads where length(seq) >= 1000 and {_Q} >= 12.25")
    add("kinetics_fix", ("fx_kinetics",), lambda k: rd.trim_counters(rd.trim_kinetics(k, strict=True)), f" select * from {inside('z as (select 1)', 'trim_counters', 'fx_kinetics')}")
    add("break_assembly", ("fx_sequences",), lambda s: _through(sq.break_at_n(s.select("name", "seq")), lambda d, p: ww.write_fasta(d, p, 60), lambda k, p: rr.read_fasta(k, p).select("name", "seq")), f" select * from {inside('z as (select 1)', 'break_at_n', 'fx_sequences')}")
    alike = f"(select *, {_SPAN('M=X')} as m, pos - 1 as s, pos - 1 + {_SPAN('MDN=X')} as e from fx_records)"
    add("polish_phasing_tables", ("fx_cs", "fx_records"), lambda p, r: wf.polish_phasing_tables(p.withColumns({"query": F.regexp_replace("query", "h1_.*", "chr1"), "target": F.regexp_replace("target", "h2_.*", "chr2")}).where("length(cs) % 7 = 0"), r, 600, 100, 0.05), f""", hr as (select * from {inside('fx_cs2 as (select 1)', 'homozygous_regions', 'fx_cs').replace('from fx_cs)', "from fx_cs where length(cs) % 7 = 0)")}),
g as (select 'chr1' as contig, query_start as s, query_end as t from hr union select 'chr2', target_start, target_end from hr), a as (select * from {alike} where cast({_TAG('NM')} as double) <= 0.05 * m and flag & 2304 = 0), k as (select distinct read_id, contig, pos from a where exists (select 1 from g where g.contig = a.contig and a.s < g.t and g.s < a.e))
select * exclude (m, s, e) replace (case when exists (select 1 from k where k.read_id = a.read_id and k.contig = a.contig and k.pos = a.pos) then 60 else mapq end as mapq) from a""")
