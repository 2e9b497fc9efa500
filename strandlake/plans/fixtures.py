"""Views that project the driver's tables into genome-production schemas, one SQL text for Spark and DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "conversations")

VIEWS = {
    "fx_read_lengths": """SELECT concat(l_returnflag, l_linestatus) AS file, l_orderkey * 10 + l_linenumber AS read_id, CAST(floor(l_extendedprice) AS BIGINT) AS length
FROM lineitem""",
    "fx_contigs": """SELECT concat('chr', CAST(s_suppkey AS STRING)) AS contig, CAST(21000 + s_suppkey AS BIGINT) AS length
FROM supplier""",
    "fx_intervals": """SELECT concat('chr', CAST(l_suppkey AS STRING)) AS contig, CAST((l_partkey % 2000) * 10 AS BIGINT) AS start_pos, CAST((l_partkey % 2000) * 10 AS BIGINT) + CAST(l_quantity AS BIGINT) AS end_pos, l_returnflag AS source, l_linestatus AS hit_id
FROM lineitem""",
    "fx_regions": """SELECT concat('chr', CAST(o_custkey % 100 AS STRING)) AS contig, CAST((o_orderkey % 2000) * 10 AS BIGINT) AS start_pos, CAST((o_orderkey % 2000) * 10 + 5 + o_orderkey % 40 AS BIGINT) AS end_pos, o_orderpriority AS label
FROM orders""",
    "fx_paf": """SELECT concat('q', CAST(o.o_custkey AS STRING)) AS query, CAST(20000 + o.o_custkey AS BIGINT) AS query_length, CAST(l.l_linenumber * 1000 AS BIGINT) AS query_start, CAST(l.l_linenumber * 1000 + l.l_quantity * 15 AS BIGINT) AS query_end, CASE WHEN l.l_returnflag = 'R' THEN '-' ELSE '+' END AS strand, concat('chr', CAST(l.l_suppkey % 24 AS STRING)) AS target, CAST(21000 AS BIGINT) AS target_length, CAST((l.l_partkey % 2000) * 10 AS BIGINT) AS target_start, CAST((l.l_partkey % 2000) * 10 + l.l_quantity * 15 AS BIGINT) AS target_end, CAST(l.l_quantity * 15 AS BIGINT) AS block_len, CAST(l.l_orderkey % 61 AS INT) AS mapq, l.l_linenumber AS nm, CAST(floor(l.l_extendedprice / 100) AS BIGINT) AS as_score
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "fx_blast": """SELECT concat('q', CAST(l_orderkey % 500 AS STRING)) AS qseqid, concat('s', CAST(l_partkey % 50 AS STRING)) AS sseqid, 90 + CAST(l_partkey % 10 AS DOUBLE) AS pident, CAST(l_quantity * 8 AS BIGINT) AS length, CAST(l_suppkey * 10 + 1 AS BIGINT) AS qstart, CAST(l_suppkey * 10 + l_quantity * 8 AS BIGINT) AS qend, CAST(3000 + l_orderkey % 500 AS BIGINT) AS qlen, CAST(400 + l_partkey % 50 AS BIGINT) AS slen
FROM lineitem""",
    "fx_run_summary": """SELECT concat('run', CAST(user_id % 5 AS STRING)) AS file, event_id AS read_id, CAST(floor(value * 2500) AS BIGINT) AS sequence_length, CAST(event_id % 21 AS DOUBLE) AS mean_qscore
FROM events""",
    "fx_sam": """SELECT concat('r', CAST(event_id % 4000 AS STRING)) AS read_id, CASE event_type WHEN 'error' THEN 4 WHEN 'signup' THEN 256 WHEN 'click' THEN 2048 WHEN 'view' THEN 16 ELSE 0 END AS flag, concat('chr', CAST(user_id % 24 AS STRING)) AS contig, CAST(floor(value * 40) AS BIGINT) + 1 AS pos, CAST(event_id % 61 AS INT) AS mapq, CAST(100 + event_id % 900 AS BIGINT) AS read_len
FROM events""",
    "fx_variants": """SELECT concat('chr', CAST(p_size % 24 AS STRING)) AS contig, CAST(p_partkey * 10 + 1 AS BIGINT) AS pos, substr('ACGT', CAST(p_partkey % 4 AS INT) + 1, 1 + CAST(p_size % 2 AS INT)) AS ref, CASE WHEN p_partkey % 11 = 0 THEN '*' ELSE substr('TGCA', CAST(p_partkey % 3 AS INT) + 1, 1 + CAST(p_partkey % 2 AS INT)) END AS alt, CASE WHEN p_partkey % 7 = 0 THEN 'RefCall' ELSE 'PASS' END AS filter, p_size AS gq, CAST(p_partkey % 100 AS DOUBLE) / 100 AS vaf
FROM part""",
    "fx_base_counts": """SELECT concat('chr', CAST(l_suppkey % 24 AS STRING)) AS contig, CAST(l_orderkey AS BIGINT) AS pos, CAST(sum(l_quantity) AS BIGINT) AS a, CAST(sum(l_linenumber) AS BIGINT) AS c, CAST(sum(l_partkey % 40) AS BIGINT) AS g, CAST(sum(l_orderkey % 30) AS BIGINT) AS t
FROM lineitem GROUP BY l_suppkey % 24, l_orderkey""",
    # Each file with the next ones: a sample has six files, so its own files and those of the next sample meet.
    "fx_pairs": """SELECT concat('HG', lpad(CAST(10000 + CAST(floor(a.c_custkey / 6) AS BIGINT) % 80000 AS STRING), 5, '0'), CASE a.c_custkey % 3 WHEN 0 THEN '_hifi_' WHEN 1 THEN '_ont_' ELSE '_hic_' END, CAST(a.c_custkey AS STRING)) AS sample1, concat('HG', lpad(CAST(10000 + CAST(floor(b.c_custkey / 6) AS BIGINT) % 80000 AS STRING), 5, '0'), CASE b.c_custkey % 3 WHEN 0 THEN '_hifi_' WHEN 1 THEN '_ont_' ELSE '_hic_' END, CAST(b.c_custkey AS STRING)) AS sample2, CASE WHEN floor(a.c_custkey / 6) = floor(b.c_custkey / 6) THEN CAST(1 + (a.c_custkey + b.c_custkey) % 50 AS DOUBLE) / 100 ELSE 0.4 + CAST((a.c_custkey * 31 + b.c_custkey) % 200 AS DOUBLE) / 100 END AS score
FROM (SELECT c_custkey, c_custkey + 1 AS other FROM customer UNION ALL SELECT c_custkey, c_custkey + 2 AS other FROM customer UNION ALL SELECT c_custkey, c_custkey + 3 AS other FROM customer UNION ALL SELECT c_custkey, c_custkey + 4 AS other FROM customer UNION ALL SELECT c_custkey, c_custkey + 5 AS other FROM customer UNION ALL SELECT c_custkey, c_custkey + 7 AS other FROM customer) a JOIN customer b ON b.c_custkey = a.other""",
    "fx_report_lines": """SELECT CAST(conv_id AS STRING) AS file, turn AS line_no, CASE WHEN role = 'system' OR turn % 5 = 0 THEN concat('========== ', upper(role), ' ==========') WHEN turn % 5 = 4 THEN '' ELSE concat('VecScreen_', CASE WHEN turn % 2 = 0 THEN 'Strong' ELSE 'Weak' END, chr(9), 'ctg', CAST(conv_id AS STRING), chr(9), CAST(turn * 10 + 1 AS STRING), chr(9), CAST(turn * 10 + 9 AS STRING)) END AS line
FROM conversations""",
    "fx_kinetics": """SELECT vec_id AS read_id, 64 - (vec_id % 5) - (vec_id % 3) AS read_len, vec_id % 5 AS left_trim, vec_id % 3 AS right_trim, embedding AS fi, embedding AS fp, embedding AS ri, embedding AS rp
FROM embeddings""",
    "fx_paths": """SELECT concat('/data/', CASE WHEN c_custkey % 4 = 0 THEN 'PG' WHEN c_custkey % 4 = 1 THEN 'NA' WHEN c_custkey % 4 = 2 THEN 'HG' ELSE 'XX' END, CASE WHEN c_custkey < 100000 THEN lpad(CAST(c_custkey AS STRING), 5, '0') ELSE CAST(c_custkey AS STRING) END, '/m', CAST(c_nationkey AS STRING), '.hifi_reads.bam') AS path
FROM customer""",
    "fx_tags": """SELECT event_id, props AS tags_json
FROM events""",
    "fx_sequences": """SELECT concat('ctg', CAST(doc_id AS STRING)) AS name, concat(source, ' ', lang) AS description, regexp_replace(translate(text, 'abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ.', 'ACGTACGTACGTACGTACGTACGTACACGTACGTACGTACGTACGTACGTACN'), '[^ACGTN]', '') AS seq FROM documents""",
    "fx_reads": """SELECT coalesce(source, 'none') AS file, concat('r', CAST(doc_id AS STRING)) AS read_id, seq, translate(seq, 'ACGTN', 'I?5+#') AS qual
FROM (SELECT source, doc_id, regexp_replace(translate(text, 'abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ.', 'ACGTACGTACGTACGTACGTACGTACACGTACGTACGTACGTACGTACGTACN'), '[^ACGTN]', '') AS seq FROM documents) x WHERE doc_id IS NOT NULL AND seq IS NOT NULL""",
    "fx_records": """SELECT concat('f', CAST(l_suppkey % 5 AS STRING)) AS file, concat('r', CAST(l_orderkey AS STRING), '/', CAST(l_linenumber AS STRING)) AS read_id, CASE WHEN l_linenumber = 1 THEN 0 WHEN l_linenumber % 3 = 0 THEN 2048 WHEN l_linenumber % 5 = 0 THEN 256 ELSE 16 END AS flag, concat('chr', CAST(l_suppkey % 24 AS STRING)) AS contig, CAST((l_partkey % 2000) * 10 + 1 AS BIGINT) AS pos, CAST(l_orderkey % 61 AS INT) AS mapq, concat(CAST(l_linenumber AS STRING), 'S', CAST(CAST(l_quantity AS BIGINT) AS STRING), 'M2I', CAST(CAST(l_quantity AS BIGINT) * 3 AS STRING), 'M', CAST(l_linenumber AS STRING), 'D7=1X', CASE WHEN l_linenumber % 2 = 0 THEN '4H' ELSE '' END) AS cigar, concat('NM:i:', CAST(l_linenumber AS STRING), chr(9), 'rq:f:', CAST(CAST(80 + l_partkey % 20 AS BIGINT) AS STRING), 'e-2', CASE WHEN l_linenumber % 2 = 0 THEN concat(chr(9), 'fi:B:C,1,2') ELSE '' END, CASE WHEN l_partkey % 3 = 0 THEN concat(chr(9), 'MM:Z:C+m') ELSE '' END) AS tags, substr(repeat('ACGTTGCA', 40), 1 + CAST(l_partkey % 8 AS INT), CAST(l_linenumber + 4 * l_quantity + 10 AS INT)) AS seq
FROM lineitem""",
    "fx_reference": """SELECT concat('chr', CAST(n_nationkey AS STRING)) AS name, repeat('ACGTTGCA', 2600) AS seq
FROM nation""",
    "fx_ignored": """SELECT concat('chr', CAST(n_nationkey AS STRING)) AS contig, CAST(0 AS BIGINT) AS start_pos, CAST(12000 AS BIGINT) AS end_pos, n_name AS label
FROM nation WHERE n_nationkey % 2 = 0""",
    "fx_orientation": """SELECT concat('ctg', CAST(l_orderkey % 500 AS STRING)) AS query, CASE WHEN l_partkey % 3 = 0 THEN '-' ELSE '+' END AS strand, concat('chr', CAST(l_suppkey % 24 AS STRING)) AS target, CAST(l_quantity * 300 AS BIGINT) AS block_len
FROM lineitem""",
    "fx_descriptions": """SELECT concat('s', CAST(p_partkey AS STRING)) AS sseqid, p_name AS description
FROM part""",
    "fx_cs": """SELECT concat('h1_', CAST(l_orderkey AS STRING)) AS query, CAST(21000 AS BIGINT) AS query_length, CAST(l_linenumber * 100 AS BIGINT) AS query_start, concat('h2_', CAST(l_suppkey AS STRING)) AS target, CAST(22000 AS BIGINT) AS target_length, CAST(l_partkey AS BIGINT) AS target_start, concat(':', CAST(CAST(l_quantity AS BIGINT) * 30 AS STRING), '*ac:', CAST(CAST(l_quantity AS BIGINT) * 20 AS STRING), '+acc:', CAST(l_linenumber * 150 AS STRING), '-gg:', CAST(l_suppkey AS STRING)) AS cs
FROM lineitem""",
    "fx_samples": """SELECT concat('HG', CASE WHEN c_custkey < 100000 THEN lpad(CAST(c_custkey AS STRING), 5, '0') ELSE CAST(c_custkey AS STRING) END) AS sample, CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS sex, c_nationkey AS cohort, c_acctbal AS balance
FROM customer""",
    "fx_assemblies": """SELECT concat('HG', CASE WHEN o_custkey < 100000 THEN lpad(CAST(o_custkey AS STRING), 5, '0') ELSE CAST(o_custkey AS STRING) END) AS sample, CASE WHEN o_orderkey % 2 = 0 THEN 'mat' ELSE 'pat' END AS haplotype, o_orderkey AS assembly, concat('./data/', 'GCA_', CAST(o_orderkey AS STRING), '_HG', CASE WHEN o_custkey < 100000 THEN lpad(CAST(o_custkey AS STRING), 5, '0') ELSE CAST(o_custkey AS STRING) END, '.f1.', CASE WHEN o_orderkey % 2 = 0 THEN 'mat' ELSE 'pat' END, '.fna') AS location, o_totalprice AS total
FROM orders""",
    "fx_metrics": """SELECT concat('HG', CASE WHEN c_custkey < 100000 THEN lpad(CAST(c_custkey AS STRING), 5, '0') ELSE CAST(c_custkey AS STRING) END) AS sample, concat('All statistics  N50 ', CAST(c_custkey * 7 AS STRING), ' ') AS raw, concat('  Full splice match: ', CAST(c_custkey AS STRING), CASE WHEN c_custkey % 3 = 0 THEN '' ELSE concat(' (', CAST(c_custkey % 100 AS STRING), '.5%)') END) AS class_line, concat(CASE WHEN c_custkey % 2 = 0 THEN 'HG#1#' ELSE '' END, 'JAHEOS01', CAST(c_custkey AS STRING), '.1') AS accession, CAST(c_custkey % 3 AS INT) - 1 AS phase
FROM customer""",
    "fx_alleles": """SELECT concat('s', CAST(l_suppkey % 6 AS STRING)) AS sample, CAST(l_partkey AS BIGINT) AS site, CAST(sum(CASE WHEN l_linenumber % 2 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS ref_n, CAST(sum(CASE WHEN l_linenumber % 2 = 1 THEN 1 ELSE 0 END) AS BIGINT) AS alt_n
FROM lineitem GROUP BY l_suppkey % 6, l_partkey""",
    "fx_genes": """SELECT concat('g', CAST(l_orderkey AS STRING)) AS query, CAST(500 + l_orderkey % 300 AS BIGINT) AS query_length, CASE WHEN l_linenumber <= 2 THEN 'ref' ELSE 'asm' END AS side, CAST(l_quantity * 21 AS BIGINT) AS matches, CAST(l_quantity * 21 + l_linenumber AS BIGINT) AS block_len, CAST(0 AS BIGINT) AS query_start, CAST(l_quantity * 21 AS BIGINT) AS query_end
FROM lineitem""",
    "fx_sv": """SELECT concat('c', CAST(l_linenumber % 3 AS STRING)) AS caller, concat('chr', CAST(l_suppkey % 24 AS STRING)) AS contig, CAST(l_partkey * 90 AS BIGINT) AS pos, CASE WHEN l_returnflag = 'A' THEN 'INS' WHEN l_returnflag = 'N' THEN 'DEL' ELSE 'DUP' END AS kind, '+' AS strand, CAST(l_quantity AS BIGINT) AS support, repeat(substr('ACGT', CAST(l_partkey % 4 AS INT) + 1, 1), CAST(floor(5 + l_quantity / 5) AS INT)) AS alt
FROM lineitem""",
    "fx_gfa": """SELECT 'S' AS kind, concat('u', CAST(o_orderkey AS STRING)) AS name, CAST(o_custkey + 1000 AS BIGINT) AS length, CAST(NULL AS BIGINT) AS from_pos, CAST(NULL AS BIGINT) AS to_pos FROM orders
UNION ALL SELECT 'A', concat('u', CAST(l_orderkey AS STRING)), CAST(NULL AS BIGINT), CAST(l_linenumber * 10 AS BIGINT), CAST(l_linenumber * 10 + l_quantity * 20 AS BIGINT) FROM lineitem""",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view over the Parquet tables of sf_dir; columns that a query leaves out are not read."""
    tables = "|".join(TABLES)
    return spark.sql(re.sub(rf"\b(FROM|JOIN) ({tables})\b", lambda m: f"{m[1]} parquet.`{sf_dir}/{m[2]}.parquet`", VIEWS[name]))


def ctes(*names: str) -> str:
    """The same views as the head of a DuckDB query."""
    return "with " + ", ".join(f"{n} as ({VIEWS[n]})" for n in names).replace("'[^ACGTN]', '')", "'[^ACGTN]', '', 'g')")
