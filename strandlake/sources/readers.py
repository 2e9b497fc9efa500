"""Readers of sequence, interval, alignment, variant and report files as DataFrames.

Paths are what Spark reads: files, folders or globs in any store. Lines that a format leaves out (comments, blanks, repeated
headers) are dropped; a field that is missing or not a number is null. Positions stay as the format has them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _file() -> Column:
    return F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)


def _lines(spark: SparkSession, path, **options) -> DataFrame:
    return spark.read.options(**options).text(path).select(_file().alias("file"), F.regexp_replace("value", "\r$", "").alias("value"))


def _fields(lines: DataFrame, names: list[str], separator: str = "\t") -> DataFrame:
    """Columns named name:type from the fields of each line; a type in the name is what it is cast to."""
    cut = lines.withColumn("f", F.split("value", separator))
    made = []
    for i, spec in enumerate(names):
        name, _, kind = spec.partition(":")
        made.append(F.try_element_at("f", F.lit(i + 1)).try_cast(kind or "string").alias(name))
    return cut.select("file", *made, "f")


def tag_map(tags: Column) -> Column:
    """Map of tag to value from fields name:type:value; fields of another form are left out, the first of a name counts."""
    pairs = F.transform(tags, lambda t: F.struct(F.regexp_extract(t, "^([^:]*):[^:]*:(.*)$", 1).alias("k"), F.regexp_extract(t, "^([^:]*):[^:]*:(.*)$", 2).alias("v")))
    named = F.filter(pairs, lambda p: p["k"] != "")
    first = F.filter(named, lambda p, i: ~F.exists(F.slice(named, 1, F.greatest(i, F.lit(0))), lambda q: q["k"] == p["k"]))
    return F.map_from_entries(first)


def read_fasta(spark: SparkSession, path) -> DataFrame:
    """(file, name, description, seq, length): a row per sequence, of any number of lines."""
    parts = _lines(spark, path, lineSep="\n>").withColumn("value", F.regexp_replace("value", "^>", ""))
    head = F.regexp_extract("value", "^([^\r\n]*)", 1)
    seq = F.regexp_replace(F.regexp_replace("value", "^[^\n]*\n?", ""), "[\r\n]", "")
    out = parts.select("file", F.regexp_extract(head, r"^(\S*)", 1).alias("name"), F.regexp_extract(head, r"^\S*\s+(.*)$", 1).alias("description"), seq.alias("seq"))
    return out.where("name != '' or seq != ''").withColumn("length", F.length("seq").cast("long"))


def numbered_lines(spark: SparkSession, path) -> DataFrame:
    """(file, line_no, value), line_no from 0 in each file: lines are counted in each split, and the counts added up over a
    file's splits, a row each."""
    schema = "file string, block long, at long, value string"
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")

    def number(batches):
        import numpy as np
        import pyarrow as pa

        last, at = None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            file, block = batch.column(0).dictionary_encode().indices.to_numpy(), batch.column(1).to_numpy()
            heads = np.flatnonzero(np.append(True, (file[1:] != file[:-1]) | (block[1:] != block[:-1])))
            out = np.arange(n) - np.repeat(heads, np.diff(np.append(heads, n)))
            if (batch.column(0)[0].as_py(), block[0]) == last:
                out[: heads[1] if len(heads) > 1 else n] += at
            last, at = (batch.column(0)[n - 1].as_py(), block[n - 1]), int(out[-1]) + 1
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(out.astype(np.int64)), batch.column(2)], names=["file", "block", "at", "value"])

    lines = raw.mapInArrow(number, schema)
    counts = raw.groupBy("file", "block").agg(F.count("*").alias("n"))
    base = counts.select("file", "block", (F.sum("n").over(Window.partitionBy("file").orderBy("block")) - F.col("n")).alias("base"))
    return lines.join(base, ["file", "block"]).select("file", (F.col("base") + F.col("at")).alias("line_no"), F.regexp_replace("value", "\r$", "").alias("value"))


def read_fastq(spark: SparkSession, path) -> DataFrame:
    """(file, read_id, seq, qual, length): every four lines of a file are a read; an incomplete one at the end is left out."""
    lines = numbered_lines(spark, path)
    part = lambda k: F.max(F.when(F.col("line_no") % 4 == k, F.col("value")))
    reads = lines.groupBy("file", F.expr("line_no div 4").alias("record")).agg(part(0).alias("head"), part(1).alias("seq"), part(3).alias("qual"))
    short = F.element_at(F.split("file", "/"), -1).alias("file")
    return reads.where("qual is not null").select(short, F.regexp_extract("head", r"^@?(\S*)", 1).alias("read_id"), "seq", "qual", F.length("seq").cast("long").alias("length"))


def read_lengths(spark: SparkSession, path) -> DataFrame:
    """(file, name, length): an index of name, length, ... per line, or one length per line."""
    cut = _lines(spark, path).withColumn("f", F.split("value", "\t")).where("value != ''")
    name = F.when(F.size("f") > 1, F.col("f")[0])
    return cut.select("file", name.alias("name"), F.when(F.size("f") > 1, F.try_element_at("f", F.lit(2))).otherwise(F.col("f")[0]).try_cast("long").alias("length"))


def read_bed(spark: SparkSession, path, extra: tuple[str, ...] = ()) -> DataFrame:
    """(contig, start_pos, end_pos, extra ...): fields between white space; comments, track and browser lines are left out."""
    lines = _lines(spark, path).where(r"value != '' and not value rlike '^(#|track|browser)'")
    return _fields(lines.withColumn("value", F.trim("value")), ["contig", "start_pos:long", "end_pos:long", *extra], r"\s+").drop("file", "f")


PAF = ["query", "query_length:long", "query_start:long", "query_end:long", "strand", "target", "target_length:long", "target_start:long", "target_end:long", "matches:long", "block_len:long", "mapq:int"]


def read_paf(spark: SparkSession, path) -> DataFrame:
    """The twelve fixed fields and the rest, of any number, as a map of tags."""
    return _fields(_lines(spark, path).where("value != ''"), PAF).withColumn("tags", tag_map(F.slice("f", 13, F.greatest(F.size("f"), F.lit(1))))).drop("file", "f")


BLAST = ["qseqid", "sseqid", "pident:double", "length:long", "mismatch:long", "gapopen:long", "qstart:long", "qend:long", "sstart:long", "send:long", "evalue:double", "bitscore:double"]


def read_blast(spark: SparkSession, path, extra: tuple[str, ...] = ("qlen:long", "slen:long")) -> DataFrame:
    """Tabular hits; lines of comments and blank ones are left out."""
    return _fields(_lines(spark, path).where("trim(value) != '' and not value like '#%'"), [*BLAST, *extra]).drop("file", "f")


SAM = ["read_id", "flag:int", "contig", "pos:long", "mapq:int", "cigar", "mate_contig", "mate_pos:long", "template_length:long", "seq", "qual"]


def read_sam(spark: SparkSession, path) -> tuple[DataFrame, DataFrame]:
    """(header lines, records with a map of tags)."""
    lines = _lines(spark, path).where("value != ''")
    records = _fields(lines.where("not value rlike '^@[A-Z][A-Z](\t|$)'"), SAM).withColumn("tags", tag_map(F.slice("f", 12, F.greatest(F.size("f"), F.lit(1))))).drop("f")
    return lines.where("value rlike '^@[A-Z][A-Z](\t|$)'"), records


def read_vcf(spark: SparkSession, path) -> DataFrame:
    """(contig, pos, id, ref, alt, qual, filter, info, format): info as a map (a flag's value is null), format as a map of the
    first sample's values."""
    lines = _lines(spark, path).where("value != '' and not value like '#%'")
    cut = _fields(lines, ["contig", "pos:long", "id", "ref", "alt", "qual:double", "filter", "info"])
    sample = F.when(F.size("f") >= 10, F.map_from_arrays(F.split(F.col("f")[8], ":"), F.slice(F.concat(F.split(F.col("f")[9], ":"), F.array_repeat(F.lit(None).cast("string"), F.size(F.split(F.col("f")[8], ":")))), F.lit(1), F.size(F.split(F.col("f")[8], ":")))))
    return cut.withColumns({"info": F.when(F.col("info") != ".", F.expr("str_to_map(info, ';', '=')")), "format": sample}).drop("file", "f")


def read_run_summary(spark: SparkSession, path, length: str = "sequence_length_template", quality: str = "mean_qscore_template") -> DataFrame:
    """(file, read_id, sequence_length, mean_qscore): columns by the names in the file's header, which may be repeated."""
    lines = _lines(spark, path).where("value != ''").withColumn("f", F.split("value", "\t"))
    heads = lines.where(F.array_contains("f", length)).groupBy("file").agg(F.min("f").alias("head"))  # a row a file
    met = lines.where(~F.array_contains("f", length)).join(heads, "file")
    at = lambda name: F.try_element_at("f", F.array_position("head", name).cast("int"))
    named = lambda name: F.when(F.array_contains("head", name), at(name))
    return met.select("file", named("read_id").alias("read_id"), named(length).try_cast("long").alias("sequence_length"), named(quality).try_cast("double").alias("mean_qscore"))


def read_gfa(spark: SparkSession, path) -> tuple[DataFrame, DataFrame]:
    """(segments (name, seq, length), placements (name, start_pos, end_pos)). A segment without sequence has its LN:i: length."""
    cut = _lines(spark, path).withColumn("f", F.split("value", "\t"))
    seq = F.when(F.col("f")[2] != "*", F.col("f")[2])
    ln = F.regexp_extract("value", r"\tLN:i:(\d+)", 1).try_cast("long")
    segments = cut.where("f[0] = 'S'").select(F.col("f")[1].alias("name"), seq.alias("seq"), F.coalesce(F.length(seq).cast("long"), ln).alias("length"))
    number = lambda k: F.try_element_at("f", F.lit(k)).try_cast("long")
    placed = cut.where("f[0] = 'A'").select(F.col("f")[1].alias("name"), number(3).alias("start_pos"), (number(3) + number(7) - number(6)).alias("end_pos"))
    return segments, placed


def read_summaries(spark: SparkSession, path, pattern: str = "*.summary.tsv") -> DataFrame:
    """The first data row of each file below path, columns by the header that all share, and the file's path. Files without a
    data row give no row."""
    found = spark.read.options(header=True, sep="\t", recursiveFileLookup=True, pathGlobFilter=pattern).csv(path)
    names = found.columns
    first = found.select(F.col("_metadata.file_path").alias("file"), F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id(), *names).alias("row"))
    return first.groupBy("file").agg(F.min("row").alias("row")).select("file", *[F.col("row")[n].alias(n) for n in names])


def read_manifest(spark: SparkSession, path, fields: int = 2) -> DataFrame:
    """(path, second): a line of one or two fields per read file; another number of fields is an error."""
    cut = _lines(spark, path).where("trim(value) != ''").withColumn("f", F.split("value", "\t"))
    checked = F.when(F.size("f").between(1, fields), F.col("f")[0]).otherwise(F.raise_error(F.concat(F.lit("bad manifest line: "), F.col("value"))))
    return cut.select(checked.alias("path"), F.try_element_at("f", F.lit(2)).alias("second"))


def report_lines(spark: SparkSession, path, folder: str | None = None) -> DataFrame:
    """(file, line_no, line) of text reports. file: the file's name, or what follows folder= in its path."""
    name = F.element_at(F.split("file", "/"), -1) if folder is None else F.url_decode(F.regexp_extract("file", f"/{folder}=([^/]*)/", 1))
    return numbered_lines(spark, path).select(name.alias("file"), "line_no", F.col("value").alias("line"))


def report_bundle_lines(spark: SparkSession, path) -> DataFrame:
    """(file, line_no, line) of the reports that write_report_bundle wrote; a part file may be split between reports."""
    cut = spark.read.option("lineSep", "\x1e").text(path).select(F.split("value", "\n").alias("lines"))
    placed = cut.select(F.nullif(F.url_decode(F.col("lines")[0]), F.lit("")).alias("file"), F.posexplode("lines").alias("line_no", "line"))
    return placed.where("line_no > 0").select("file", F.col("line_no").cast("long").alias("line_no"), "line")
