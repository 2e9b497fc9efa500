"""Sample, metric and id tables: joins, unions, names and small conversions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_incomplete_rows(df: DataFrame) -> DataFrame:
    return df.dropna()


def project_columns(df: DataFrame, keep: dict[str, str], constants: dict[str, object] | None = None) -> DataFrame:
    """Some columns under new names, and columns of one value."""
    return df.select(*[F.col(a).alias(b) for a, b in keep.items()], *[F.lit(v).alias(k) for k, v in (constants or {}).items()])


def overlay_overrides(df: DataFrame, overrides: DataFrame, key: str) -> DataFrame:
    """Values of overrides, where they are not null, in place of those of df with the same key."""
    names = [c for c in overrides.columns if c != key]
    met = df.join(overrides.select(key, *[F.col(c).alias(f"override of {c}") for c in names]), key, "left")
    return met.select(*[F.coalesce(f"override of {c}", c).alias(c) if c in names else c for c in df.columns])


def annotate_subject(hits: DataFrame, descriptions: DataFrame, prefix: str = "") -> DataFrame:
    """Hits with the description of their subject: N/A where there is none, else with an optional (prefix) before it."""
    met = hits.join(descriptions.groupBy("sseqid").agg(F.min("description").alias("description")), "sseqid", "left")
    said = F.concat(F.lit(f"({prefix}) " if prefix else ""), F.col("description"))
    return met.withColumn("description", F.coalesce(said, F.lit("N/A")))


def annotation_counts(annotated: DataFrame) -> DataFrame:
    """One row: hits with a description and without."""
    return annotated.agg(F.count_if(F.col("description") != "N/A").alias("found"), F.count_if(F.col("description") == "N/A").alias("missing"))


def sex_info_join(assemblies: DataFrame, samples: DataFrame, pedigree: DataFrame) -> DataFrame:
    """All assemblies with the samples they belong to, which have the pedigree's sex where it knows them."""
    known = samples.join(pedigree, "sample", "left")
    return known.join(assemblies, "sample", "right")


def haplotype_self_merge(rows: DataFrame, keys: list[str], hap: str = "haplotype", first: str = "mat", second: str = "pat") -> DataFrame:
    """One row per key that has both haplotypes: columns with the suffix of their haplotype, rows of one meeting all of the other."""
    rest = [c for c in rows.columns if c not in (*keys, hap)]
    side = lambda name: rows.where(F.col(hap) == name).select(*keys, *[F.col(c).alias(f"{c}_{name}") for c in rest])
    return side(first).join(side(second), keys)


def add_chrom_labels(names: DataFrame, chromosomes: DataFrame) -> DataFrame:
    """Headers of sequences (name): those with a chromosome (name, chrom) say so."""
    n = F.regexp_replace("chrom", "chr", "")
    label = F.concat(F.lit(" [location=chromosome][chromosome="), n, F.lit("]"))
    return names.join(chromosomes, "name", "left").select("name", F.concat("name", F.coalesce(label, F.lit(""))).alias("header"))


def split_by_haplotype(track: DataFrame, haplotypes: DataFrame) -> DataFrame:
    """Rows of a track with the haplotype (contig, hap) of their contig; write them with partitionBy("hap")."""
    return track.join(haplotypes, "contig")


def paste_columns(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Columns of both tables for each key that both have; a key's rows of one meet all of the other's, a null key meets none."""
    return a.join(b, key)


def lookup_chain(issues: DataFrame, assignments: DataFrame, placements: DataFrame, sequences: DataFrame) -> DataFrame:
    """Sequences of the contigs that hold an issue's unitig, with the haplotype whose assembly gets them: that of the new
    assignment (unitig, side) taken over, MAT to 1 and PAT to 2."""
    sides = assignments.join(issues.select("unitig").distinct(), "unitig", "left_semi").where(F.col("side").isin("MAT", "PAT"))
    found = sides.join(placements, "unitig").select("name", F.when(F.col("side") == "MAT", 1).otherwise(2).alias("to_hap")).distinct()
    return sequences.join(found, "name").select("name", "to_hap", "seq")


def rename_map(scaffold_rows: DataFrame, pattern: str = "utig4") -> DataFrame:
    """(name, new_name): second and last field of the scaffold map's lines that name a unitig."""
    f = F.split("value", "[ \t]+")
    return scaffold_rows.where(F.contains("value", F.lit(pattern))).select(f[1].alias("name"), F.element_at(f, -1).alias("new_name"))


def sum_max(df: DataFrame, column: str) -> DataFrame:
    """One row: sum and largest value without the nulls; both null where there is none."""
    return df.agg(F.sum(column).alias("total"), F.max(column).alias("largest"))


def gfa_coverage(segments: DataFrame, placements: DataFrame) -> DataFrame:
    """(name, coverage): bases placed on a segment over its length; 0 without placements."""
    placed = placements.groupBy("name").agg(F.sum(F.col("end_pos") - F.col("start_pos")).alias("bases"))
    return segments.join(placed, "name", "left").select("name", (F.coalesce("bases", F.lit(0)) / F.nullif(F.col("length"), F.lit(0))).alias("coverage"))


def coverage_from_bases(bases: DataFrame, genomes: DataFrame) -> DataFrame:
    """Coverage, to two decimals, of each file (kind, bases) at its kind's genome size (kind, genome)."""
    return bases.join(genomes, "kind").withColumn("coverage", F.round(F.col("bases") / F.col("genome"), 2)).drop("genome")


def union_all(*frames: DataFrame) -> DataFrame:
    """Rows of all frames; columns that some lack are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_union(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys of either list, once."""
    return a.select(key).union(b.select(key)).distinct()


def common_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys that both lists hold, once."""
    return a.select(key).intersect(b.select(key))


def other_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys of the first list that the second lacks, once."""
    return a.select(key).subtract(b.select(key))


def diploid_concat(first: DataFrame, second: DataFrame) -> DataFrame:
    """All rows of both haplotypes, of the same columns, with hap 1 or 2; a column hap of theirs is replaced."""
    return first.withColumn("hap", F.lit(1)).unionByName(second.withColumn("hap", F.lit(2)))


def range_sorted(df: DataFrame, *order: str) -> DataFrame:
    """The rows in order over all partitions."""
    return df.orderBy(*order)


def genbank_id(name: Column) -> Column:
    """Third field between #, else the last."""
    f = F.split(name, "#")
    return F.coalesce(F.try_element_at(f, F.lit(3)), F.element_at(f, -1))


def rewrite_header(header: Column, sample: str, hap: int) -> Column:
    """sample#hap#id of a header: what follows the first blank goes, and so does a leading lcl|; on haplotype 2, a
    mitochondrial contig's version is followed by #MT."""
    marked = F.when(F.contains(header, F.lit("#2#MT")), F.regexp_replace(header, r"\.1 ", ".1#MT ")).otherwise(header) if hap == 2 else header
    return F.concat(F.lit(f"{sample}#{hap}#"), F.regexp_replace(F.regexp_replace(marked, " .*$", ""), r"^lcl\|", ""))


def path_parts(location: Column) -> dict[str, Column]:
    """Sample, haplotype and haplotype number from a file name GCA_number_sample.version.haplotype.suffix."""
    piece = F.split(F.split(F.element_at(F.split(location, "/"), -1), "_")[2], r"\.")
    return {"sample_part": piece[0], "hap_part": piece[2], "mat_pat_int": F.when(piece[2] == "pat", 1).otherwise(2)}


def move_prefix(location: Column, old: str, new: str) -> Column:
    return F.replace(location, F.lit(old), F.lit(new))


def clean_metric(text: Column) -> Column:
    """The last token, between blanks, of a report's row."""
    return F.element_at(F.split(F.rtrim(text), " "), -1)


def count_percent(text: Column) -> tuple[Column, Column]:
    """(count, percent) of ": 123 (45.6%)" as text; NA for what is missing."""
    both, one = r":\s+(\d+)\s+\(([0-9.]+)%\)", r":\s+(\d+)"
    there = text.rlike(both)
    return F.when(text.rlike(one), F.regexp_extract(text, one, 1)).otherwise("NA"), F.when(there, F.regexp_extract(text, both, 2)).otherwise("NA")


def phase_colors(nodes: DataFrame) -> DataFrame:
    """Marker rows of nodes with phase -1 or 1; others go."""
    phase = F.col("phase")
    many, none = F.lit(100000), F.lit(0)
    mat, pat = F.when(phase == 1, many).otherwise(none), F.when(phase == 1, none).otherwise(many)
    return nodes.where(phase.isin(-1, 1)).select("node", mat.alias("mat"), pat.alias("pat"), F.concat(mat.cast("string"), F.lit(":"), pat.cast("string")).alias("counts"), F.when(phase == 1, "#FF8888").otherwise("#8888FF").alias("color"))
