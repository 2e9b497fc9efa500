"""Queries over bundles, reports by section and track files, each with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .catalog_files import _through
from .catalog_genome import PILED, _spelled_calls, methyl_sql
from .catalog_tables import _LEAST, _SOURCE, _limits
from .operators import assembly as am
from .operators import intervals as iv
from .operators import reads as rd
from .operators import reports as rp
from .operators import tables as tb
from .plans import bundles as bd
from .sources import readers as rr
from .sources.scratch import shared_dir


def register(add) -> None:
    hits = lambda h, d: am.hits_to_bed(tb.annotate_subject(am.blast_len_filter((x := h.withColumn("source", F.expr(_SOURCE))), _limits(x)), d), h.select(F.lit("").alias("contig"), F.lit(1).cast("long").alias("first"), F.lit(1).cast("long").alias("last"), F.lit("").alias("kind")).where("false"))
    bed = f""", hb as (select distinct qseqid as contig, qstart - 1 as start_pos, qend as end_pos, source, coalesce(description, 'N/A') as said from (select *, {_SOURCE} as source from fx_blast) left join (select sseqid, min(description) as description from fx_descriptions group by 1) using (sseqid) where length >= {_LEAST}
  union select split_part(line, chr(9), 2), cast(split_part(line, chr(9), 3) as bigint) - 1, cast(split_part(line, chr(9), 4) as bigint), 'vecscreen', 'VecScreen' from fx_report_lines where regexp_matches(line, '^VecScreen_(Strong|Moderate)\\t')),
w as (select *, max(end_pos) over (partition by contig order by start_pos, end_pos rows between unbounded preceding and 1 preceding) as reach from (select distinct contig, start_pos, end_pos from hb)),
i as (select *, sum(case when start_pos <= reach then 0 else 1 end) over (partition by contig order by start_pos, end_pos rows unbounded preceding) as island from w), m as (select contig, min(start_pos) as start_pos, max(end_pos) as end_pos from i group by contig, island) """
    text = bed + """, r as (select * from hb union all select contig, start_pos, end_pos, 'zz_merged', 'merged' from m)
select source as section, 1 as rank, contig, start_pos, end_pos, '# ' || said || chr(9) || contig || chr(9) || start_pos || chr(9) || end_pos as line from r
union all select distinct source, 0, null, null, null, '========== ' || regexp_replace(source, '^zz_', '') || ' ==========' from r union all select distinct source, 2, null, null, null, '' from r"""
    add("contamination_text", ("fx_blast", "fx_descriptions", "fx_report_lines"), lambda h, d, r: bd.contamination_text(hits(h, d), rp.adapter_sections_to_bed(r)), text)
    sections = lambda lines: rp.sections(lines).groupBy("section").agg(F.count("*").alias("n"))

    def read_back(h, d, r):
        """Lines of each section of the written report: files in order are one report."""
        rows = _through(bd.contamination_text(hits(h, d), rp.adapter_sections_to_bed(r)), bd.write_report, rr.report_lines)
        return sections(rows.select(F.lit("report").alias("file"), (F.regexp_extract("file", r"part-(\d+)", 1).cast("long") * (1 << 32) + F.col("line_no")).alias("line_no"), "line"))

    add("contamination_text_sections", ("fx_blast", "fx_descriptions", "fx_report_lines"), read_back, bed + "select source as section, count(*) as n from hb group by 1 union all select 'merged', count(*) from m")
    size = "contigs as (select contig, max(length) as length from (select qseqid as contig, qlen as length from fx_blast union all select split_part(line, chr(9), 2), cast(split_part(line, chr(9), 4) as bigint) + 500 from fx_report_lines where regexp_matches(line, '^VecScreen_(Strong|Moderate)\\t')) group by 1)"
    screens = lambda r: rp.adapter_sections_to_bed(r).select("contig", (F.col("start_pos") + 1).alias("first"), F.col("end_pos").alias("last"), F.lit("VecScreen").alias("kind"))
    lengths = lambda h, r: h.select(F.col("qseqid").alias("contig"), F.col("qlen").alias("length")).unionByName(rp.adapter_sections_to_bed(r).select("contig", (F.col("end_pos") + 500).alias("length"))).groupBy("contig").agg(F.max("length").alias("length"))
    add("contamination_report_screens", ("fx_blast", "fx_descriptions", "fx_report_lines"), lambda h, d, r: am.contamination_report((x := h.withColumn("source", F.expr(_SOURCE))), screens(r), _limits(x), d, lengths(h, r)), bed + f""", {size}, s as (select contig, array_to_string(list_sort(list_distinct(list(source))), ',') as sources from hb group by 1), c as (select contig, cast(sum(end_pos - start_pos) as bigint) as covered from m group by 1)
select contig, covered, covered / length as fraction, sources, covered / length >= 0.95 as discard from c join s using (contig) join contigs using (contig)""")

    named = "concat('ctg', CAST((query_length - 20000) % 1000 AS STRING))"
    ends = {side: f"coalesce(list_max(list_transform(regexp_extract_all({side}(seq, 1000), '(?:TTAGGG|CCCTAA)+'), lambda x: length(x))), 0) >= 6" for side in ("left", "right")}

    def tables(p, s, a, c, g):
        paf = p.withColumn("query", F.expr(named))
        return bd.stacked(bd.breakpoint_tables(paf, s, iv.flank(a, c, 100), g, least=6, least_span=300, least_query=20_100))

    add("find_breakpoints_tables", ("fx_paf", "fx_sequences", "fx_intervals", "fx_contigs", "fx_regions"), tables, f""", p as (select * replace ({named} as query) from fx_paf), e as (select name, {ends['left']} as a, {ends['right']} as b from fx_sequences), s as (select name as contig, length(seq) as length, length(seq) - length(replace(seq, 'N', '')) as ns from fx_sequences),
ch as (select query as contig, min(target) as chrom from p group by 1), d as (select distinct query, target, query_length, target_length from p where block_len > 300 and query_length > 20100),
f as (select distinct * from (select contig, 'left' as side, greatest(start_pos - 100, 0) as start_pos, least(start_pos, length) as end_pos from fx_intervals join fx_contigs using (contig) union all select contig, 'right', least(end_pos, length), least(end_pos + 100, length) from fx_intervals join fx_contigs using (contig)) where start_pos < end_pos)
select 'orientation' as "table", query || chr(9) || strand as row from (select distinct query, strand from p) union all select 'telomeres', name || chr(9) || a || chr(9) || b from e
union all select 't2t', contig || chr(9) || length || chr(9) || ns || chr(9) || chrom || chr(9) || case when ns = 0 then 'contig' else 'scaffold' end from e join s on s.contig = e.name join ch using (contig) where a and b
union all select 'chromosomes', target || chr(9) || count(*) || chr(9) || printf('%.3f', sum(query_length / target_length * 100)) from d group by target
union all select 'annotated', b.label || chr(9) || count(*) from f join fx_regions b on f.contig = b.contig and f.start_pos < b.end_pos and b.start_pos < f.end_pos group by b.label""")

    def tracks(r):
        folder = shared_dir(r.sparkSession)
        clusters = bd.nucfreq_tracks(r, folder, 3, 40)
        read = lambda name: rr.read_bed(r.sparkSession, f"{folder}/{name}", ("value:long",)).withColumn("track", F.lit(name))
        return tb.union_all(read("first"), read("second"), clusters.select("contig", "start_pos", "end_pos", F.col("sites").alias("value"), F.lit("clusters").alias("track")))

    piled = PILED.replace("from fx_records)", "from fx_records where flag & 2308 = 0)", 1)
    add("nucfreq_track_files", ("fx_records",), tracks, piled + """, two as (select contig, pos, list_reverse_sort([a, c, g, t])[1] as first, list_reverse_sort([a, c, g, t])[2] as second from piled where a + c + g + t > 0),
s2 as (select contig, pos from two where second >= 3), nn as (select *, case when pos - lag(pos) over (partition by contig order by pos) <= 40 then 0 else 1 end as new from s2), ii as (select *, sum(new) over (partition by contig order by pos) as i from nn)
select contig, pos - 1 as start_pos, pos as end_pos, first as value, 'first' as track from two union all select contig, pos - 1, pos, second, 'second' from two
union all select contig, min(pos), max(pos) + 1, count(*), 'clusters' from ii group by contig, i having count(*) >= 5""")
    mm = "concat('C+m,', CAST(length(seq) % 3 AS STRING), ',', CAST(length(seq) % 2 AS STRING), ',1;')"

    def methylation(r):
        folder = shared_dir(r.sparkSession)
        records = r.select("contig", "pos", "mapq", F.when(F.col("flag").bitwiseAND(16) != 0, "-").otherwise("+").alias("strand"), "cigar", "seq", F.expr(mm).alias("mm"), F.array(F.lit(250), F.lit(20), F.lit(160)).alias("ml"))
        haps = r.select("contig").distinct().withColumn("hap", F.when(F.col("contig") < "chr2", 1).otherwise(2))
        paths = bd.methylation_files(records, haps, folder)
        return tb.union_all(*[rr.read_bed(r.sparkSession, p, ("percent:double",)).withColumn("hap", F.lit(k)) for k, p in enumerate(paths, 1)])

    add("methylation_track_files", ("fx_records",), methylation, methyl_sql("length(seq) % 3", "length(seq) % 2", "mapq >= 10") + "select contig, pos as start_pos, pos + 1 as end_pos, round(100 * modified / coverage, 3) as percent, case when contig < 'chr2' then 1 else 2 end as hap from called")

    def diploid(r, f):
        even = F.substring("name", 4, 9).cast("int") % 2 == 0
        return bd.alignment_qc_inputs(f.where(even), f.where(~even), {"hifi": r.where("mapq >= 30"), "ont": r.where("mapq < 30")}, least_second=2, gap=40)[1]

    known = lambda where, name: f"select c.*, '{name}' as set, case when cast(substr(f.name, 4) as int) % 2 = 0 then 1 else 2 end as hap from (with none as (select 1) {PILED.replace('from fx_records)', f'from fx_records where flag & 2308 = 0 and {where})', 1)}" + """, s2 as (select distinct contig, pos from piled where list_reverse_sort([a, c, g, t])[2] >= 2), nn as (select *, case when pos - lag(pos) over (partition by contig order by pos) <= 40 then 0 else 1 end as new from s2),
ii as (select *, sum(new) over (partition by contig order by pos) as i from nn) select contig, min(pos) as start_pos, max(pos) + 1 as end_pos, count(*) as sites from ii group by contig, i having count(*) >= 5) c join fx_reference f on f.name = c.contig"""  # noqa: E731
    add("alignment_qc_diploid", ("fx_records", "fx_reference"), diploid, " " + known("mapq >= 30", "hifi") + " union all " + known("mapq < 30", "ont"))

    used = "aggregate(transform(regexp_extract_all(cs, '([:+][a-z0-9]+|[*][a-z]{2})', 1), x -> CASE left(x, 1) WHEN ':' THEN CAST(substr(x, 2) AS BIGINT) WHEN '*' THEN 1L ELSE CAST(length(x) - 1 AS BIGINT) END), 0L, (a, x) -> a + x)"
    add("homozygous_regions_stranded", ("fx_cs",), lambda p: bd.stranded_homozygous_regions(p.withColumns({"strand": F.expr("if(length(cs) % 2 = 0, '-', '+')"), "query_end": F.expr(f"query_start + {used}")}), 600, 100), """, d as (select distinct *, case when length(cs) % 2 = 0 then '-' else '+' end as strand from fx_cs), o as (select *, row_number() over () as r, regexp_extract_all(cs, ':\\d+|\\*[a-z]{2}|\\+[a-z]+|-[a-z]+') as ops from d), e as (select * exclude (ops), unnest(ops) as op, generate_subscripts(ops, 1) as place from o),
z as (select *, case left(op, 1) when ':' then cast(substr(op, 2) as bigint) when '*' then 1 else length(op) - 1 end as n, left(op, 1) as kind from e),
p as (select *, sum(case when kind <> '-' then n else 0 end) over w as qu, sum(case when kind <> '-' then n else 0 end) over (partition by r) as qa, target_start + sum(case when kind <> '+' then n else 0 end) over w as te from z window w as (partition by r order by place)),
x as (select *, case strand when '+' then query_start + qu - n else query_start + qa - qu end as qs from p where kind = ':' and n >= 600)
select query, cast(greatest(qs - 100, 0) as bigint) as query_start, cast(least(qs + n + 100, query_length) as bigint) as query_end, target, cast(greatest(te - n - 100, 0) as bigint) as target_start, cast(least(te + 100, target_length) as bigint) as target_end from x""")

    tagged = "map_from_entries(filter(array(if(read_id % 2 = 0, struct('MM', 'C+m'), null), if(read_id % 3 = 0, struct('ML', 'B:C'), null), struct('RG', 'x')), x -> x is not null))"
    status = "case when left_trim = 0 and right_trim = 0 then 'skipped' when len(fi) > 0 and (left_trim + right_trim >= len(fi) or len(fi) - left_trim - right_trim <> read_len) then 'failed' else 'fixed' end"
    add("trim_totals", ("fx_kinetics",), lambda k: bd.trim_totals((t := k.withColumn("tags", F.expr(tagged))), rd.trim_kinetics(t)), f", s as (select *, {status} as status from fx_kinetics) select count(*) as reads, count(*) filter (status = 'fixed') as fixed, count(*) filter (status = 'skipped') as skipped, count(*) filter (status = 'failed') as failed, count(*) filter (status = 'fixed' and read_id % 2 = 0) as mm_removed, count(*) filter (status = 'fixed' and read_id % 3 = 0) as ml_removed from s")

    call = lambda q: lambda s: _spelled_calls(s, q).withColumns({"gq": F.col("pos") + int(q), "filter": F.lit("PASS")})
    rows = [("true", 50, 2, "CATGA", "", "case when b then 'first' else 'both' end", 0), ("true", 20, 1, "CATGA", "", "'first'", 0), ("a", 70, 1, "", " || substr(seq, 70, 1)", "'both'", 0), ("true", 110, 1, "CATGA", "", "'first'", 0), ("b", 50, 1, "CATGA", "", "'second'", 1), ("not a", 69, 1, "", " || substr(seq, 70, 1)", "'second'", 1), ("e", 90, 1, "CATGA", "", "'second'", 1), ("true", 110, 1, "GTACC", "", "'second'", 1)]
    said = lambda p, n, to, more: (f"translate(substr(seq, {p}, {n}), 'ACGTN', '{to}')" if to else f"substr(seq, {p}, {n})") + more
    add("vcf_merge_labelled", ("fx_sequences",), lambda s: bd.merge_labelled_callers(call(False)(s), call(True)(s), s), ", k as (select name as contig, seq, length(seq) % 3 = 0 as a, length(seq) % 5 = 0 as b, length(seq) % 2 = 0 as e from fx_sequences where length(seq) >= 120) " + " union all ".join(f"select contig, cast({p} as bigint) as pos, substr(seq, {p}, {n}) as ref, {said(p, n, to, more)} as alt, {source} as source, {p + q} as gq, 'PASS' as filter from k where {where}" for where, p, n, to, more, source, q in rows))

    value = "CASE WHEN length(description) % 7 = 0 THEN description WHEN length(description) % 11 = 0 THEN concat(chr(9), description) ELSE concat(sseqid, chr(9), description) END"
    add("annotate_subject_malformed", ("fx_blast", "fx_descriptions"), lambda h, d: bd.description_counts(h, d.select(F.expr(value).alias("value"))), ", g as (select distinct sseqid from fx_descriptions where length(description) % 7 <> 0 and length(description) % 11 <> 0), m as (select count(*) as malformed from fx_descriptions where length(description) % 7 = 0 or length(description) % 11 = 0) select (select count(*) from fx_blast where sseqid in (select sseqid from g)) as found, (select count(*) from fx_blast where sseqid not in (select sseqid from g)) as missing, malformed from m")
    unitig = lambda a: F.concat(F.lit("u"), F.col("assembly").cast("string")).alias("unitig")
    add("lookup_chain_appended", ("fx_assemblies", "fx_sequences"), lambda a, s: bd.moved_to_other_haplotype(a.where("total > 200000").select(unitig(a)), a.select(unitig(a), F.upper("haplotype").alias("side")), a.select(unitig(a), F.concat(F.lit("ctg"), (F.col("assembly") % 1000).cast("string")).alias("name")), s, F.length("seq") % 2 + 1), ", f as (select distinct 'ctg' || cast(assembly % 1000 as varchar) as name, case haplotype when 'mat' then 1 else 2 end as hap from fx_assemblies where assembly in (select assembly from fx_assemblies where total > 200000)) select name, cast(length(seq) % 2 + 1 as int) as hap, seq from fx_sequences union all select name, hap, seq from fx_sequences join f using (name)")
    add("comparison_lengths", ("fx_sequences",), lambda s: s.select(F.coalesce(F.regexp_extract("description", "^([^ ]*)", 1), F.lit("none")).alias("file"), "name", F.length("seq").cast("long").alias("length")).where("length >= 1000"), " select coalesce(regexp_extract(description, '^([^ ]*)', 1), 'none') as file, name, length(seq) as length from fx_sequences where length(seq) >= 1000")
