"""Writers of sequence, interval, track and table files. Each writes a folder of part files, one per task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import shared_dir


def _text(lines: DataFrame, path: str, gzip: bool = False) -> None:
    lines.write.mode("overwrite").options(compression="gzip" if gzip else "none").text(path)


def fasta_records(sequences: DataFrame, width: int = 0):
    """Text of each record, in lines of at most width bases if width is given."""
    body = F.regexp_replace("seq", f"(.{{{width}}})(?=.)", "$1\n") if width else F.col("seq")
    head = F.concat(F.lit(">"), "name", F.when(F.coalesce("description", F.lit("")) != "", F.concat(F.lit(" "), "description")).otherwise("")) if "description" in sequences.columns else F.concat(F.lit(">"), "name")
    return F.concat(head, F.lit("\n"), body)


def write_fasta(sequences: DataFrame, path: str, width: int = 0, gzip: bool = False) -> None:
    _text(sequences.select(fasta_records(sequences, width).alias("value")), path, gzip)


def write_fastq(reads: DataFrame, path: str, gzip: bool = False) -> None:
    _text(reads.select(F.concat(F.lit("@"), "read_id", F.lit("\n"), "seq", F.lit("\n+\n"), "qual").alias("value")), path, gzip)


def _tsv(df: DataFrame) -> DataFrame:
    return df.select(F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in df.columns]).alias("value"))


def write_tsv(df: DataFrame, path: str, gzip: bool = False) -> None:
    """All columns as text fields without a header; null is NA."""
    _text(_tsv(df), path, gzip)


def write_bed_sorted(path: str, *beds: DataFrame) -> None:
    """All intervals in order of contig and start: part files are in order, and rows within them."""
    every = beds[0]
    for b in beds[1:]:
        every = every.unionByName(b)
    order = every.columns
    _text(_tsv(every.repartitionByRange("contig", "start_pos").sortWithinPartitions(*order)), path)


def write_bedgraph(values: DataFrame, path: str, value: str) -> None:
    """(contig, start_pos, end_pos, value) of one numeric column."""
    write_bed_sorted(path, values.select("contig", "start_pos", "end_pos", value))


def write_summary_tsv(rows: DataFrame, path: str, key: str) -> None:
    """A header and rows per value of key, in a folder of its own."""
    rows.withColumn("part", F.col(key)).write.mode("overwrite").partitionBy("part").options(header=True, sep="\t", nullValue="NA").csv(path)


def numbered(records: DataFrame, length: str, *order: str) -> DataFrame:
    """records in ascending order with `number`, from 0, and `before`, the sum of length before each. Ranges of the order are counted apart, a
    table is written to the shared folder, and each range moves by the sums of those before it."""
    spark = records.sparkSession
    kept = records.columns
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in records.schema], "slot int, number long, before long"])

    def count(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        n, total, slot = 0, 0, TaskContext.get().partitionId()
        for batch in batches:
            own = batch.column(batch.schema.get_field_index(length)).fill_null(0).to_numpy().astype(np.int64)
            sums = total + np.cumsum(own)
            yield pa.record_batch([*batch.columns, pa.array(np.full(len(own), slot, np.int32)), pa.array(n + np.arange(len(own))), pa.array(sums - own)], names=[*kept, "slot", "number", "before"])
            n, total = n + len(own), int(sums[-1]) if len(own) else total

    ranged = records.repartitionByRange(*order).sortWithinPartitions(*order)
    path = shared_dir(spark)
    ranged.mapInArrow(count, schema).write.parquet(path)
    placed = spark.read.schema(schema).parquet(path)
    w = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("slot").agg(F.count("*").alias("n"), F.sum(F.coalesce(length, F.lit(0))).alias("all"))  # a row for each range
    moved = sums.select("slot", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("n"), F.coalesce(F.sum("all").over(w), F.lit(0)).alias("all"))
    met = placed.join(F.broadcast(moved), "slot")
    return met.select(*kept, (F.col("number") + F.col("n")).alias("number"), (F.col("before") + F.col("all")).alias("before"))


def write_sharded(records: DataFrame, path: str, shard_bases: int | None = None, shard_records: int | None = None, length: str = "length", order: tuple[str, ...] = ("name",)) -> None:
    """Shards of about shard_bases bases or of shard_records records each, cut between records: column shard of the Parquet table at path, with
    the record's number. Records keep their order over the shards; a shard's files are written by the tasks whose ranges it meets."""
    if (shard_bases is None) == (shard_records is None):
        raise ValueError("give shard_bases or shard_records")
    placed = numbered(records, length, *order)
    shard = F.floor(F.col("before") / shard_bases) if shard_bases else F.floor(F.col("number") / shard_records)
    placed.withColumn("shard", shard).drop("before").write.mode("overwrite").partitionBy("shard").parquet(path)


def write_entity_table(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def write_report_bundle(reports: DataFrame, path: str) -> None:
    """Reports (file, text) as part files of many reports each, not a file for each report: a report is its name, a line feed and its text, and
    ends with a record separator (U+001E), which no text may hold. A null name or text is empty."""
    text = F.coalesce("text", F.lit(""))
    checked = F.when(F.contains(text, F.lit("\x1e")), F.raise_error(F.concat(F.lit("record separator in report "), F.coalesce("file", F.lit(""))))).otherwise(text)
    named = F.concat(F.url_encode(F.coalesce("file", F.lit(""))), F.lit("\n"), checked)
    reports.select(named.alias("value")).write.mode("overwrite").option("lineSep", "\x1e").text(path)
