"""Sequence rows (name, seq)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tiles import extract, mask  # noqa: F401


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def break_at_n(sequences: DataFrame) -> DataFrame:
    """Pieces between runs of N; several pieces get the suffix _j."""
    pieces = sequences.withColumn("p", F.filter(F.split("seq", "[nN]+"), lambda x: x != ""))
    return pieces.select("name", F.size("p").alias("k"), F.posexplode("p").alias("j", "seq")).select(F.when(F.col("k") > 1, F.concat("name", F.lit("_"), F.col("j").cast("string"))).otherwise(F.col("name")).alias("name"), "seq")


def edge_bases(sequences: DataFrame, n: int = 1000) -> DataFrame:
    """The first and last n bases as rows name_start and name_end."""
    ends = F.array(F.struct(F.concat("name", F.lit("_start")).alias("name"), F.left("seq", F.lit(n)).alias("seq")), F.struct(F.concat("name", F.lit("_end")).alias("name"), F.right("seq", F.lit(n)).alias("seq")))
    return sequences.select(F.explode(ends).alias("e")).select("e.name", "e.seq")


def count_ns(sequences: DataFrame) -> DataFrame:
    return sequences.select("name", F.length("seq").cast("long").alias("length"), (F.length("seq") - F.length(F.replace("seq", F.lit("N"), F.lit("")))).cast("long").alias("ns"))


def chunk_records(sequences: DataFrame, size: int = 1_000_000, overlap: int = 10_000, least: int = 11) -> DataFrame:
    """Chunks of size + overlap bases every size bases; the last one runs to the end. Names end in .chunk_i, from 1."""
    n = F.length("seq").cast("long")
    count = F.greatest(F.ceil((n - size - overlap) / size), F.lit(0)) + 1
    each = sequences.where(n >= least).select("name", "seq", n.alias("n"), count.alias("k"), F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("i"))
    width = F.when(F.col("i") == F.col("k") - 1, F.col("n") - F.col("i") * size).otherwise(size + overlap)
    return each.select(F.concat("name", F.lit(".chunk_"), (F.col("i") + 1).cast("string")).alias("name"), (F.col("i") * size).alias("offset"), F.substring("seq", (F.col("i") * size + 1).cast("int"), width.cast("int")).alias("seq"))


def lift_chunks(hits: DataFrame, size: int = 1_000_000, name: str = "name") -> DataFrame:
    """Chunk coordinates (start_pos, end_pos) back to contig coordinates."""
    shift = (F.regexp_extract(name, r"\.chunk_(\d+)$", 1).cast("long") - 1) * size
    return hits.withColumns({"start_pos": F.col("start_pos") + shift, "end_pos": F.col("end_pos") + shift, name: F.regexp_extract(name, r"^(.*)\.chunk_\d+$", 1)})


def rotate_circular(sequences: DataFrame, by: int) -> DataFrame:
    at = F.pmod(F.lit(by), F.greatest(F.length("seq"), F.lit(1)))
    return sequences.select(F.concat("name", F.lit(f"_rot{by}")).alias("name"), F.concat(F.substring("seq", at + 1, F.length("seq")), F.left("seq", at)).alias("seq"))


def dedup_by_sequence(sequences: DataFrame) -> DataFrame:
    """The first name of each distinct sequence and the number of copies; sequences are compared by digest."""
    return sequences.groupBy(F.sha2("seq", 256).alias("digest")).agg(F.min("name").alias("name"), F.count("*").alias("copies"))


def duplicate_list(sequences: DataFrame) -> DataFrame:
    """(digest, name, first) of the records that repeat a sequence: all but the first name of each. Only names and digests
    are shuffled."""
    each = sequences.select("name", F.sha2("seq", 256).alias("digest"))
    first = each.groupBy("digest").agg(F.min("name").alias("first"), F.count("*").alias("copies")).where("copies > 1")
    return each.join(first, "digest").where("name != first").select("digest", "name", "first")


def n_gaps(sequences: DataFrame, least: int = 2) -> DataFrame:
    """Runs of at least so many N, half-open."""
    runs = F.regexp_extract_all("seq", F.lit("[nN]+|[^nN]+"), F.lit(0))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<s:bigint,e:bigint>>").alias("gaps"))

    def step(acc: Column, run: Column) -> Column:
        end = acc["at"] + F.length(run)
        gap = F.struct(acc["at"].alias("s"), end.alias("e"))
        return F.struct(end.alias("at"), F.when(F.upper(F.left(run, F.lit(1))).eqNullSafe("N") & (F.length(run) >= least), F.array_append(acc["gaps"], gap)).otherwise(acc["gaps"]).alias("gaps"))

    return sequences.select("name", F.explode(F.aggregate(runs, start, step)["gaps"]).alias("g")).select("name", F.col("g.s").alias("start_pos"), F.col("g.e").alias("end_pos"))


def telomere_ends(sequences: DataFrame, edge: int = 1000, least: int = 400, motif: str = "TTAGGG|CCCTAA") -> DataFrame:
    """Whether the first and the last `edge` bases hold a run of motifs of at least so many bases."""
    longest = lambda end: F.coalesce(F.array_max(F.transform(F.regexp_extract_all(end, F.lit(f"(?:{motif})+"), F.lit(0)), F.length)), F.lit(0)) >= least
    return sequences.select("name", longest(F.left("seq", F.lit(edge))).alias("at_start"), longest(F.right("seq", F.lit(edge))).alias("at_end"))


def subset_by_names(sequences: DataFrame, names: DataFrame, drop: bool = False) -> DataFrame:
    """Sequences that a list names, or with drop those that it does not."""
    return sequences.join(names.select("name"), "name", "left_anti" if drop else "left_semi")


def filter_length(sequences: DataFrame, least: int = 100_000) -> DataFrame:
    """Sequences of at least so many bases."""
    return sequences.where(F.length("seq") >= least)


def unmask(sequences: DataFrame) -> DataFrame:
    """Sequences in capitals."""
    return sequences.withColumn("seq", F.upper("seq"))


def self_concat(sequences: DataFrame) -> DataFrame:
    """(name, seq): each sequence twice over, the target for reads of a circular one."""
    return sequences.select("name", F.repeat("seq", F.lit(2)).alias("seq"))
