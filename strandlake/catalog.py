"""Registry of the queries over the reference's operators, each with the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import catalog_bundles, catalog_files, catalog_genome, catalog_tables, catalog_workflows
from .operators import alignments as al
from .operators import assembly as am
from .operators import intervals as iv
from .operators import kmers as km
from .operators import lengths as le
from .operators import reports as rp
from .operators import sequences as sq
from .operators import tables as tb
from .operators import variants as va
from .plans.fixtures import ctes, view

_MADE: dict = {}
_SQL: dict[str, str] = {}


def _add(name: str, views: tuple[str, ...], build, sql: str | None = None) -> None:
    """build takes the views as DataFrames; sql follows their common table expressions."""
    _MADE[name] = lambda spark, sf_dir: build(*[view(spark, sf_dir, v) for v in views])
    if sql:
        _SQL[name] = f"{ctes(*views)}{sql}"


_HIST = """, h1 as (select file, length, count(*) as freq from fx_read_lengths group by 1, 2),
h as (select * from h1 union all select 'ALL', length, sum(freq) from h1 group by length),
"""
_ASC = """r as (select *, sum(freq) over (partition by file order by length) as c, sum(length * freq) over (partition by file order by length) as b,
  sum(freq) over (partition by file) as n, sum(length * freq) over (partition by file) as t from h)
"""
_DESC = """r as (select *, sum(freq) over (partition by file order by length desc) as c, sum(length * freq) over (partition by file order by length desc) as b,
  sum(freq) over (partition by file) as n, sum(length * freq) over (partition by file) as t from h1)
"""
_add("read_stats", ("fx_read_lengths",), le.read_stats, _HIST + _ASC + """select file, cast(max(n) as bigint) as total_reads, cast(max(t) as bigint) as total_bp, min(length) as min_length, max(length) as max_length,
  min(length) filter (c > 0.25 * n) as q25, min(length) filter (c > 0.5 * n) as q50, min(length) filter (c > 0.75 * n) as q75,
  min(length) filter (b >= 0.25 * t) as n25, min(length) filter (b >= 0.5 * t) as n50, min(length) filter (b >= 0.75 * t) as n75,
  max(t) / 1e9 as total_gbp, cast(max(t) // max(n) as bigint) as mean_length from r group by file""")
_add("length_distribution", ("fx_read_lengths",), le.length_distribution, " select length, count(*) as freq from fx_read_lengths group by length")
_add("length_histogram", ("fx_read_lengths",), lambda r: le.length_histogram(r, 0, 100_000, 500), """, b as (select case when length = 100000 then 499 else cast(floor(length / 200.0) as bigint) end as bin, count(*) as n
  from fx_read_lengths where length between 0 and 100000 group by 1) select range as bin, coalesce(n, 0) as n from range(500) left join b on range = bin""")
_add("nx_lx_aun", ("fx_read_lengths",), le.nx_lx_aun, _HIST + _DESC + "select file, cast(max(n) as bigint) as contigs, cast(max(t) as bigint) as total, " + ", ".join(f"max(length) filter (b * 100 >= {x} * t) as n{x}" for x in range(0, 101, 10)) + """,
  cast(min(c - freq + ceil((t / 2 - (b - length * freq)) / length)) filter (b * 2 >= t) as bigint) as l50, sum(cast(length as double) * length * freq) / max(t) as aun from r group by file""")
_add("cumulative_nx_curve", ("fx_read_lengths",), le.cumulative_nx_curve, _HIST + _DESC + "select file, length, b / t as fraction from r")
_add("base_count", ("fx_read_lengths",), le.base_count, " select file, cast(sum(length) as bigint) as bases, count(*) as reads, sum(length) / 3.1e9 as coverage_hic, sum(length) / 3.3e9 as coverage_wgs from fx_read_lengths group by file")
_add("ont_run_stats", ("fx_run_summary",), le.ont_run_stats, """, f as (select *, case when mean_qscore >= 10 then 'pass' else 'fail' end as class from fx_run_summary),
k as (select file, class from (select distinct file from f), (values ('pass'), ('fail')) v(class)),
w as (select file, class, sequence_length as l, sum(sequence_length) over (partition by file, class order by sequence_length desc) as b, sum(sequence_length) over (partition by file, class) as t from f),
s as (select file, class, max(l) filter (b * 2 >= t) as n50, max(t) / 1e9 as gb, max(t) / 3.3e9 as coverage, """ + ", ".join(f"coalesce(sum(l) filter (l >= {x}), 0) / 3.3e9 as cov_{x // 1000}kb" for x in (100_000, 200_000, 300_000, 400_000, 500_000, 1_000_000)) + """,
  count(*) filter (l >= 1000000) as reads_1mb from w group by 1, 2)
select file, class, coalesce(n50, 0) as n50, coalesce(gb, 0) as gb, coalesce(coverage, 0) as coverage, """ + ", ".join(f"coalesce(cov_{x}kb, 0) as cov_{x}kb" for x in (100, 200, 300, 400, 500, 1000)) + ", coalesce(reads_1mb, 0) as reads_1mb from k left join s using (file, class)")
_add("filter_short_reads", ("fx_read_lengths",), lambda r: le.filter_short_reads(r, 50_000), " select * from fx_read_lengths where length > 50000")
_add("run_summary_pass_fail", ("fx_run_summary",), le.pass_fail, " select file, case when mean_qscore >= 10 then 'pass' else 'fail' end as class, count(*) as reads, cast(sum(sequence_length) as bigint) as bases from fx_run_summary group by 1, 2")

_ISLANDS = """, d as (select distinct {cols} from fx_intervals), e as (select *, max(end_pos) over (partition by contig order by start_pos, end_pos{ties} rows between unbounded preceding and 1 preceding) as reach from d),
i as (select *, sum(case when start_pos <= reach + {gap} then 0 else 1 end) over (partition by contig order by start_pos, end_pos{ties} rows unbounded preceding) as island from e),
m as (select contig, min(start_pos) as start_pos, max(end_pos) as end_pos{labels} from i group by contig, island) """
_add("interval_merge", ("fx_intervals",), lambda a: iv.merge(a, 5, ("source", "hit_id")), _ISLANDS.format(cols="*", ties=", source, hit_id", gap=5, labels=", array_to_string(list_sort(list_distinct(list(source))), ';') as source, array_to_string(list_sort(list_distinct(list(hit_id))), ';') as hit_id") + "select contig, start_pos, end_pos, source, hit_id from m")
_add("interval_flank", ("fx_intervals", "fx_contigs"), lambda a, c: iv.flank(a, c, 100), """, f as (select contig, 'left' as side, greatest(start_pos - 100, 0) as start_pos, least(start_pos, length) as end_pos from fx_intervals join fx_contigs using (contig)
  union all select contig, 'right', least(end_pos, length), least(end_pos + 100, length) from fx_intervals join fx_contigs using (contig)) select * from f where start_pos < end_pos""")
_LOJ = " select a.*, b.start_pos as b_start_pos, b.end_pos as b_end_pos, b.label as b_label from (select distinct * from fx_intervals) a {} join fx_regions b on a.contig = b.contig and a.start_pos < b.end_pos and b.start_pos < a.end_pos"
_add("interval_intersect", ("fx_intervals", "fx_regions"), lambda a, b: iv.overlaps(a.distinct(), b), _LOJ.format("inner"))
_add("interval_intersect_loj", ("fx_intervals", "fx_regions"), iv.intersect_left, _LOJ.format("left"))
_add("interval_semi", ("fx_intervals", "fx_regions"), iv.intersect_semi, " select distinct * from fx_intervals a where exists (select 1 from fx_regions b where a.contig = b.contig and a.start_pos < b.end_pos and b.start_pos < a.end_pos)")
_add("break_annotation_counts", ("fx_intervals", "fx_regions"), iv.annotation_counts, " select b.label, count(*) as n from (select distinct * from fx_intervals) a join fx_regions b on a.contig = b.contig and a.start_pos < b.end_pos and b.start_pos < a.end_pos group by 1")
_add("interval_coverage", ("fx_intervals", "fx_contigs"), iv.depth, """, v as (select contig, start_pos as pos, 1 as d from fx_intervals semi join fx_contigs using (contig) union all select contig, end_pos, -1 from fx_intervals semi join fx_contigs using (contig) union all select contig, 0, 0 from fx_contigs union all select contig, length, 0 from fx_contigs),
s as (select contig, pos, sum(d) as d from v group by 1, 2), r as (select contig, sum(d) over w as depth, lead(pos) over w - pos as bases from s window w as (partition by contig order by pos))
select contig, cast(depth as bigint) as depth, cast(sum(bases) as bigint) as bases, sum(bases) / max(length) as fraction from r join fx_contigs using (contig) where bases > 0 group by 1, 2""")
_add("contig_contamination", ("fx_intervals", "fx_contigs"), iv.contamination, _ISLANDS.format(cols="contig, start_pos, end_pos", ties="", gap=0, labels="") + """, s as (select contig, array_to_string(list_sort(list_distinct(list(source))), ',') as sources from fx_intervals group by 1),
c as (select contig, cast(sum(end_pos - start_pos) as bigint) as covered from m group by 1)
select contig, covered, covered / length as fraction, sources, covered / length >= 0.95 as discard from c join s using (contig) join fx_contigs using (contig)""")
_add("genome_windows", ("fx_contigs",), lambda c: iv.genome_windows(c, 5000), " select contig, cast(i * 5000 as bigint) as start_pos, least((i + 1) * 5000, length) as end_pos from fx_contigs, range(0, 1000) t(i) where i * 5000 < length")
_add("interval_summary", ("fx_intervals",), lambda a: iv.summary(a, ["source", "hit_id"]), " select source, hit_id, count(*) as n, count(distinct contig) as contigs, cast(sum(end_pos - start_pos) as bigint) as bases from fx_intervals group by 1, 2")
_add("alignment_ignore_filter", ("fx_paf", "fx_ignored"), iv.alignment_ignore_filter, " select * from fx_paf p where not exists (select 1 from fx_ignored r where r.contig = p.target) or exists (select 1 from fx_ignored r where r.contig = p.target and (p.target_start < r.start_pos or p.target_end > r.end_pos))")

_add("reverse_complement", ("fx_sequences",), lambda s: s.select("name", sq.reverse_complement(F.col("seq")).alias("seq")), " select name, reverse(translate(seq, 'ACGTacgt', 'TGCAtgca')) as seq from fx_sequences")
_add("break_at_n", ("fx_sequences",), sq.break_at_n, """, p as (select name, list_filter(regexp_split_to_array(seq, '[nN]+'), lambda x: x <> '') as p from fx_sequences),
e as (select name, len(p) as k, unnest(p) as seq, generate_subscripts(p, 1) - 1 as j from p) select case when k > 1 then name || '_' || j else name end as name, seq from e""")
_add("edge_bases", ("fx_sequences",), lambda s: sq.edge_bases(s, 100), " select name || '_start' as name, left(seq, 100) as seq from fx_sequences union all select name || '_end', right(seq, 100) from fx_sequences")
_add("count_ns", ("fx_sequences",), sq.count_ns, " select name, length(seq) as length, length(seq) - length(replace(seq, 'N', '')) as ns from fx_sequences")
_add("chunk_records", ("fx_sequences",), lambda s: sq.chunk_records(s, 1000, 50), """, c as (select name, seq, length(seq) as n, cast(greatest(ceil((length(seq) - 1050) / 1000.0), 0) as bigint) + 1 as k from fx_sequences where length(seq) >= 11)
select name || '.chunk_' || (i + 1) as name, cast(i * 1000 as bigint) as "offset", substr(seq, i * 1000 + 1, case when i = k - 1 then n - i * 1000 else 1050 end) as seq from c, range(0, 100000) t(i) where i < k""")
_add("n_gaps", ("fx_sequences",), lambda s: sq.n_gaps(s, 1), """, r as (select name, regexp_extract_all(seq, '[nN]+|[^nN]+') as p from fx_sequences), e as (select name, unnest(p) as x, generate_subscripts(p, 1) as i from r),
o as (select *, sum(length(x)) over (partition by name order by i) as e from e) select name, cast(e - length(x) as bigint) as start_pos, cast(e as bigint) as end_pos from o where upper(left(x, 1)) = 'N'""")
_add("rotate_circular", ("fx_sequences",), lambda s: sq.rotate_circular(s, 37), " select name || '_rot37' as name, substr(seq, 37 % greatest(length(seq), 1) + 1) || left(seq, 37 % greatest(length(seq), 1)) as seq from fx_sequences")
_add("self_concat", ("fx_sequences",), sq.self_concat, " select name, seq || seq as seq from fx_sequences")
_add("dedup_by_sequence", ("fx_sequences",), sq.dedup_by_sequence, " select sha256(seq) as digest, min(name) as name, count(*) as copies from fx_sequences group by seq")

_add("lift_chunk_coords", ("fx_sequences",), lambda s: sq.lift_chunks(sq.chunk_records(s, 1000, 50).select("name", F.lit(0).cast("long").alias("start_pos"), F.length("seq").cast("long").alias("end_pos")), 1000), """, c as (select name, length(seq) as n, cast(greatest(ceil((length(seq) - 1050) / 1000.0), 0) as bigint) + 1 as k from fx_sequences where length(seq) >= 11)
select name, cast(i * 1000 as bigint) as start_pos, case when i = k - 1 then n else i * 1000 + 1050 end as end_pos from c, range(0, 100000) t(i) where i < k""")

_add("blast_tier_filter", ("fx_blast",), al.blast_tier_filter, " select * from fx_blast where (pident >= 98 and length >= 50) or (pident >= 94 and length >= 100) or (pident >= 90 and length >= 200)")
_add("mito_hit_rollup", ("fx_blast",), lambda h: al.mito_hit_rollup(h, 10, 1, 70), """, a as (select qseqid, sum(length * 100 / qlen) as match from fx_blast group by 1),
f as (select distinct on (qseqid) qseqid, qlen, slen from fx_blast order by qseqid, sseqid, qstart, qend, qlen, slen)
select qseqid, match, qlen, slen from a join f using (qseqid) where qlen < 10 * slen and qlen * 100 / slen > 1 and match > 70""")
_add("best_hit", ("fx_paf",), al.best_hit, " select distinct on (query) * from fx_paf order by query, as_score desc, nm, query_length, query_start, query_end, strand, target, target_length, target_start, target_end, block_len, mapq")
_add("primary_target", ("fx_paf",), al.primary_target, """, c as (select query, target, sum(block_len) / max(query_length) as coverage from fx_paf group by 1, 2),
b as (select distinct on (query) * from c order by query, coverage desc, target) select query, target, coverage, (select count(*) from c where c.query = b.query) as targets from b""")
_add("misjoin_breaks", ("fx_paf",), al.misjoin_breaks, """, d as (select distinct * from fx_paf), s as (select *, lag(target) over w as b, lag(query_end) over w as e from d window w as (partition by query order by query_start, query_end, target, target_start, target_end))
select query, b as from_target, target as to_target, e as break_start, query_start as break_end from s where b <> target""")
_add("chrom_mapping_stats", ("fx_paf",), al.chrom_mapping_stats, " select target, cast(sum(target_end - target_start) as bigint) as target_span, cast(sum(query_end - query_start) as bigint) as query_span, max(target_length) as target_length, max(target_end - target_start) as longest from fx_paf group by 1")
_add("chr_completeness", ("fx_paf",), lambda p: al.chr_completeness(p, 500, 20_500), """, d as (select distinct query, target, query_length, target_length from fx_paf where block_len > 500 and query_length > 20500)
select target, count(*) as n, sum(query_length / target_length * 100) as percent, max(query_length / target_length * 100) as largest, max(query) as last_query from d group by 1""")
_add("sam_flag_filter", ("fx_sam",), lambda s: al.flag_filter(s, 0x904), " select * from fx_sam where flag & 2308 = 0")
_add("multi_primary_ids", ("fx_sam",), al.multi_primary_ids, " select read_id, count(*) filter (flag & 2304 = 0) as primary_records, count(*) filter (flag & 2048 <> 0) as supplementary from fx_sam group by 1 having count(*) filter (flag & 2304 = 0) > 1 or count(*) filter (flag & 2048 <> 0) > 0")
_add("top_two_alleles", ("fx_base_counts",), al.top_two_alleles, " select contig, pos, list_reverse_sort([a, c, g, t])[1] as first, list_reverse_sort([a, c, g, t])[2] as second from fx_base_counts")
_add("variant_clusters", ("fx_variants",), al.variant_clusters, """, d as (select distinct contig, pos from fx_variants), n as (select *, case when pos - lag(pos) over (partition by contig order by pos) <= 500 then 0 else 1 end as new from d),
i as (select *, sum(new) over (partition by contig order by pos) as i from n) select contig, min(pos) as start_pos, max(pos) + 1 as end_pos, count(*) as sites from i group by contig, i having count(*) >= 5""")
_add("vcf_exclude_expr", ("fx_variants",), va.exclude, " select * from fx_variants where not (vaf <= 0.5 or gq <= 30) and filter = 'PASS'")
_add("vcf_tiered_gq", ("fx_variants",), va.tiered_gq, " select * from fx_variants where case length(alt) - length(ref) when 1 then gq > 20 when -1 then gq > 12 else gq > 5 end")
_add("vcf_stats", ("fx_variants",), va.stats, """, v as (select *, length(ref) = 1 and length(alt) = 1 and ref <> alt as snv, ref || alt in ('AG', 'GA', 'CT', 'TC') as ts from fx_variants)
select contig, count(*) as records, count(*) filter (snv) as snvs, count(*) filter (length(ref) <> length(alt)) as indels, count(*) filter (snv and ts) as ts, count(*) filter (snv and not ts) as tv from v group by 1""")
_add("vcf_compare", ("fx_variants",), lambda v: va.compare(v.where("filter = 'PASS'"), v.where("gq > 10")), """, t as (select distinct contig, pos, ref, alt, 1 as t from fx_variants where filter = 'PASS'), q as (select distinct contig, pos, ref, alt, 1 as q from fx_variants where gq > 10),
c as (select contig, count(*) filter (t is not null and q is not null) as shared, count(*) filter (q is null) as only_truth, count(*) filter (t is null) as only_query from t full join q using (contig, pos, ref, alt) group by contig)
select *, shared / nullif(shared + only_query, 0) as precision, shared / nullif(shared + only_truth, 0) as recall from c""")

_add("scan_sections", ("fx_report_lines",), rp.sections, """, h as (select *, case when regexp_matches(line, '^=+ (.*?) =+$') then regexp_extract(line, '^=+ (.*?) =+$', 1) when trim(line) = '' then '' end as title from fx_report_lines),
s as (select *, last_value(title ignore nulls) over (partition by file order by line_no rows unbounded preceding) as section from h) select file, line_no, line, section from s where title is null and section <> ''""")
_add("adapter_sections_to_bed", ("fx_report_lines",), rp.adapter_sections_to_bed, " select split_part(line, chr(9), 2) as contig, cast(split_part(line, chr(9), 3) as bigint) - 1 as start_pos, cast(split_part(line, chr(9), 4) as bigint) as end_pos from fx_report_lines where regexp_matches(line, '^VecScreen_(Strong|Moderate)\\t')")
_add("sample_id_from_path", ("fx_paths",), lambda p: p.select("path", rp.sample_id(F.col("path")).alias("sample_id")), """, x as (select path, regexp_extract(path, '[^/]*$') as base, regexp_replace(regexp_extract(path, '((?:HG|NA|PG)\\d{5})', 1), '^PG', 'HG') as id from fx_paths)
select path, case when id = '' or starts_with(base, id) then base else id || '_' || base end as sample_id from x""")
_add("sample_swap_summary", ("fx_pairs",), rp.sample_swap_summary, """, p as (select *, left(sample1, 7) as s1, left(sample2, 7) as s2 from fx_pairs), f as (select s1 as sample, sample1 as file from p union select s2, sample2 from p),
c as (select sample, count(*) as n_files, """ + ", ".join(f"count(*) filter (contains(file, '_{k}_')) as n_{k}" for k in ("hifi", "ont", "hic", "kinnex")) + """, cast(0 as bigint) as n_other from f group by 1),
s as (select s1 as sample, 'w' as k, score from p where s1 = s2 union all select s1, 'c', score from p where s1 <> s2 union all select s2, 'c', score from p where s1 <> s2),
a as (select sample, """ + ", ".join(f"{fn} filter (k = '{k}') as {n}_{w}" for k, w in (("w", "within"), ("c", "cross")) for n, fn in (("n", "count(*)"), ("min", "min(score)"), ("mean", "avg(score)"), ("max", "max(score)"))) + """ from s group by 1)
select a.*, c.* exclude (sample), n_files * (n_files - 1) // 2 as expected_within, cast(n_files * ((select sum(n_files) from c) - n_files) as bigint) as expected_cross,
  case when min_within > 0 and max_within < 0.5 and min_cross > 0.5 then 'PASS' else 'FAIL' end as verdict from a join c using (sample) where n_within > 0 and n_cross > 0""")

_PAIR = "from (select name, seq, length(seq) as n from fx_sequences)"
_spans = lambda s: s.select(F.col("name").alias("contig"), F.explode(F.array(*[F.struct(F.lit(a).cast("long").alias("start_pos"), F.lit(b).cast("long").alias("end_pos")) for a, b in ((10, 60), (40, 90))])).alias("x")).select("contig", "x.start_pos", "x.end_pos")
_add("mask_sequence", ("fx_sequences",), lambda s: sq.mask(s, iv.merge(_spans(s))), f" select name, case when n > 10 then left(seq, 10) || repeat('N', least(n, 90) - 10) || substr(seq, 91) else seq end as seq {_PAIR}")
_add("extract_sequence", ("fx_sequences",), lambda s: sq.extract(s, _spans(s)), " select name, cast(a as bigint) as start_pos, cast(b as bigint) as end_pos, substr(seq, a + 1, b - a) as seq from fx_sequences, (values (10, 60), (40, 90)) v(a, b)")
_add("telomere_ends", ("fx_sequences",), lambda s: sq.telomere_ends(s, 1000, 6), " select name, " + ", ".join(f"coalesce(list_max(list_transform(regexp_extract_all({side}(seq, 1000), '(?:TTAGGG|CCCTAA)+'), lambda x: length(x))), 0) >= 6 as at_{end}" for side, end in (("left", "start"), ("right", "end"))) + " from fx_sequences")
_add("subset_by_names", ("fx_sequences",), lambda s: sq.subset_by_names(s, s.where("length(seq) % 3 = 0")), " select * from fx_sequences where length(seq) % 3 = 0")
_add("drop_by_names", ("fx_sequences",), lambda s: sq.subset_by_names(s, s.where("length(seq) % 3 = 0"), drop=True), " select * from fx_sequences where not coalesce(length(seq) % 3 = 0, false)")
_add("filter_len_fasta", ("fx_sequences",), lambda s: sq.filter_length(s, 1000), " select * from fx_sequences where length(seq) >= 1000")
_add("unmask_upper", ("fx_sequences",), sq.unmask, " select name, description, upper(seq) as seq from fx_sequences")
_add("overlap_resolution", ("fx_intervals",), lambda a: iv.resolve_overlaps(a.withColumn("score", F.col("end_pos") - F.col("start_pos"))), """, s as (select distinct *, end_pos - start_pos as score from fx_intervals)
select * from s a where not exists (select 1 from s b where a.contig = b.contig and a.start_pos < b.end_pos and b.start_pos < a.end_pos and b.score > a.score)""")
_add("dropped_vs_unmapped", ("fx_contigs", "fx_variants"), iv.list_difference, " select contig, case when a.contig is null then 'right' else 'left' end as side from (select distinct contig from fx_contigs) a full join (select distinct contig from fx_variants) b using (contig) where a.contig is null or b.contig is null")
_add("intersect_ids", ("fx_contigs", "fx_variants"), lambda c, r: tb.common_keys(c, r, "contig"), " select contig from fx_contigs intersect select contig from fx_variants")
_add("except_ids", ("fx_contigs", "fx_variants"), lambda c, r: tb.other_keys(c, r, "contig"), " select contig from fx_contigs except select contig from fx_variants")
_add("union_distinct_ids", ("fx_contigs", "fx_variants"), lambda c, r: tb.distinct_union(c, r, "contig"), " select contig from fx_contigs union select contig from fx_variants")
_add("first_n_records", ("fx_read_lengths",), le.first_records, " select * from fx_read_lengths qualify row_number() over (partition by file order by read_id, length) <= 100")
_add("ont_qc_summary", ("fx_run_summary",), le.ont_qc_summary, None)
_SQL["ont_qc_summary"] = "select file, " + ", ".join(f"max({c}) filter (class = '{k}') as {k}_{c}" for k in ("pass", "fail") for c in ("n50", "gb", "coverage", *[f"cov_{x}kb" for x in (100, 200, 300, 400, 500, 1000)], "reads_1mb")) + f" from ({_SQL['ont_run_stats']}) group by file"
_add("natural_sort", ("fx_contigs",), lambda c: c.select("contig", *rp.natural_key(F.col("contig"))).orderBy("prefix", "number", "rest"), " select contig, regexp_extract(contig, '^(\\D*)', 1) as prefix, cast(regexp_extract(contig, '(\\d+)', 1) as bigint) as number, regexp_extract(contig, '^\\D*\\d*(.*)$', 1) as rest from fx_contigs order by 2, 3, 4")
_add("melt_metrics", ("fx_base_counts",), lambda b: rp.melt(b, ["contig", "pos"], ["a", "c", "g", "t"]), " " + " union all ".join(f"select contig, pos, '{x}' as metric, {x} as value from fx_base_counts" for x in "acgt"))
_add("metric_mean_stdev", ("fx_variants",), lambda v: rp.metric_mean_stdev(v.withColumn("m", F.when(F.col("filter") == "RefCall", "Not_Calc").otherwise(F.col("gq").cast("string"))), "contig", "m").withColumns({"mean": F.round("mean", 6), "stdev": F.round("stdev", 6)}), " select contig, count(*) filter (filter <> 'RefCall') as n, round(avg(gq) filter (filter <> 'RefCall'), 6) as mean, round(stddev_samp(gq) filter (filter <> 'RefCall'), 6) as stdev from fx_variants group by 1")
_add("vcf_drop_star", ("fx_variants",), va.drop_star, " select * from fx_variants where not contains(alt, '*')")

# Every document has one of three roles; a sequence without a number has role 0.
_ROLE = "coalesce(try_cast(substr(name, 4) as bigint), 0) % 3"


def _roles(s):
    """k-mer counts of the sequences of role 0, 1 and 2, from one pass."""
    counts = km.packed_counts(s.withColumn("role", F.expr(_ROLE)), keep=("role",))
    return [counts.where(F.col("role") == r).drop("role") for r in "012"]


def _kmer_sql(k: int = 21, seq: str = "seq") -> str:
    """Common table expression c (role, n_bases, kmer): a row per canonical k-mer."""
    return f""", q as (select {_ROLE} as role, length(seq) as n_bases, {seq} as seq from fx_sequences), k as (select role, n_bases, substr(seq, i, {k}) as x from (select role, n_bases, seq, unnest(range(1, length(seq) - {k - 2})) as i from q where length(seq) >= {k})),
c as (select role, n_bases, least(x, reverse(translate(x, 'ACGT', 'TGCA'))) as kmer from k where not contains(x, 'N')) """


_SQUEEZED = "seq"
for _b in "ACGTN":
    _SQUEEZED = f"regexp_replace({_SQUEEZED}, '{_b}+', '{_b}', 'g')"
_add("kmer_count", ("fx_sequences",), lambda s: km.kmer_count(s, 21, 2), _kmer_sql() + "select kmer, count(*) as n from c group by kmer having count(*) >= 2")
_add("kmer_count_suppressed", ("fx_sequences",), lambda s: km.suppressed_counts(s, bits=1 << 25).select(km.spelled(F.col("code"), 21).alias("kmer"), "n"), _kmer_sql() + "select kmer, count(*) as n from c group by kmer having count(*) >= 2")
_add("kmer_count_compressed", ("fx_sequences",), lambda s: km.kmer_count(s, 30, 2, compress=True), _kmer_sql(30, _SQUEEZED) + "select kmer, count(*) as n from c group by kmer having count(*) >= 2")
_add("kmer_union_sum", ("fx_sequences",), lambda s: km.union_counts(s.withColumn("role", F.expr(_ROLE))), _kmer_sql() + "select kmer, count(*) as n from c group by kmer")
_VALLEY = """, t as (select role, kmer, count(*) as n from c group by 1, 2), h as (select role, n, count(*) as d from t group by 1, 2), l as (select *, lead(d) over (partition by role order by n) as e from h),
v as (select role, coalesce(min(n) filter (d <= e), 1) as least from l group by 1), good as (select t.* from t join v using (role) where n >= least) """
_add("hapmers", ("fx_sequences",), lambda s: km.hapmer_counts(s.withColumn("role", F.expr(_ROLE))), _kmer_sql() + _VALLEY + """select kmer, case role when 0 then 'mat' else 'pat' end as parent from good g where role < 2
  and not exists (select 1 from t where t.kmer = g.kmer and t.role = 1 - g.role) and exists (select 1 from t where t.kmer = g.kmer and t.role = 2)""")
_add("kmer_high_freq", ("fx_sequences",), lambda s: km.high_frequency(km.packed_counts(s)).select(km.spelled(F.col("code"), 21).alias("kmer"), "n"), _kmer_sql() + """, k2 as (select kmer, count(*) as n from c group by 1), h as (select n, count(*) as d from k2 group by 1),
r as (select n, sum(d) over (order by n) as c, sum(d) over () as t from h) select kmer, n from k2 where n > (select min(n) from r where c >= 0.9998 * t)""")


def _qv(s):
    long = s.withColumn("role", F.expr(_ROLE))
    return km.kmer_qv(km.packed_counts(long.where("role = 0 and length(seq) >= 1000")), km.packed_counts(long.where("role != 0"))).withColumns({c: F.round(c, 9) for c in ("error", "qv", "completeness")})


_add("kmer_qv", ("fx_sequences",), _qv, _kmer_sql() + """, a as (select distinct kmer from c where role = 0 and n_bases >= 1000), b as (select kmer, count(*) as n from c where role <> 0 group by 1),
t as (select count(a.kmer) as total, count(*) filter (a.kmer is not null and b.kmer is null) as only_assembly, count(*) filter (b.n >= 2) as solid, count(*) filter (b.n >= 2 and a.kmer is not null) as found from a full join b using (kmer)),
e as (select *, 1 - power(1 - only_assembly / nullif(total, 0), 1.0 / 21) as error from t) select total, only_assembly, round(error, 9) as error, round(case when error > 0 then -10 * log10(error) end, 9) + 0.0 as qv, round(found / nullif(solid, 0), 9) as completeness from e""")
_add("length_histogram_auto", ("fx_read_lengths",), lambda r: le.length_histogram_auto(r, 50), """, e as (select min(length) as low, max(length) as high, count(*) as n_all from fx_read_lengths), b as (select cast(case when length = high then 49 else floor((length - low) / ((high - low) / 50)) end as bigint) as bin, count(*) as n from fx_read_lengths, e group by 1)
select range as bin, low + range * ((high - low) / 50) as from_length, coalesce(n, 0) as n, coalesce(n, 0) / n_all as share from range(50) cross join e left join b on range = bin""")
_add("lx", ("fx_read_lengths",), le.lx, """, r as (select file, length, row_number() over (partition by file order by length desc) as k, sum(length) over (partition by file order by length desc rows unbounded preceding) as b, sum(length) over (partition by file) as t from fx_read_lengths)
select file, cast(x as int) as x, min(k) as lx from r, range(10, 101, 10) v(x) where b * 100 >= x * t group by 1, 2""")
_add("chr_completeness_report", ("fx_paf",), lambda p: am.chr_report(al.chr_completeness(am.mapping_filters(p.withColumn("identity", F.expr("cast(100 - nm * 0.3 as double)")), 99, 500).withColumn("target", F.concat("target", F.lit("_"), F.col("query_length").cast("string"))), 0, 20_500), 95), """, p as (select *, target || '_' || cast(query_length as varchar) as t from fx_paf where 100 - nm * 0.3 > 99 and query_end - query_start > 500), d as (select distinct query, t, query_length, target_length from p where query_length > 20500)
select max(query) as query, t as target, sum(query_length / target_length * 100) as percent from d group by t having count(*) = 1 and sum(query_length / target_length * 100) > 95""")
_LABELS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "no such label")
_add("break_annotation_counts_wide", ("fx_intervals", "fx_regions"), lambda a, b: iv.annotation_counts_wide(iv.annotation_counts(a, b), list(_LABELS)), ", c as (select b.label, count(*) as n from (select distinct * from fx_intervals) a join fx_regions b on a.contig = b.contig and a.start_pos < b.end_pos and b.start_pos < a.end_pos group by 1) select " + ", ".join(f"""coalesce(cast(max(n) filter (label = '{x}') as varchar), 'NA') as "{x}\"""" for x in _LABELS) + " from c")
_add("misjoin_breaks_outside", ("fx_paf", "fx_ignored"), al.misjoin_breaks_outside, """, v as (select * from fx_paf p where not exists (select 1 from fx_ignored r where r.contig = p.target) or exists (select 1 from fx_ignored r where r.contig = p.target and (p.target_start < r.start_pos or p.target_end > r.end_pos))),
d as (select distinct * from v), s as (select *, lag(target) over w as b, lag(query_end) over w as e from d window w as (partition by query order by query_start, query_end, target, target_start, target_end)) select query, b as from_target, target as to_target, e as break_start, query_start as break_end from s where b <> target""")
_add("contig_regions", ("fx_contigs",), iv.contig_regions, " select contig, cast(0 as bigint) as start_pos, length as end_pos from fx_contigs where length > 0")
_add("vcf_indel_lengths", ("fx_variants",), va.indel_lengths, " select contig, cast(length(alt) - length(ref) as int) as change, count(*) as n from fx_variants where length(alt) <> length(ref) group by 1, 2")
_add("vcf_quality_distribution", ("fx_variants",), va.quality_distribution, " select contig, gq, count(*) as n from fx_variants group by 1, 2")
_add("duplicate_list", ("fx_sequences",), sq.duplicate_list, ", f as (select seq, min(name) as first from fx_sequences group by 1 having count(*) > 1) select sha256(seq) as digest, name, first from fx_sequences join f using (seq) where name <> first")


for _module in (catalog_tables, catalog_files, catalog_genome, catalog_workflows, catalog_bundles):
    _module.register(_add)


def queries() -> dict:
    return dict(_MADE)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
