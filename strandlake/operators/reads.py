"""Reads and alignment records: qualities, adapters, tags, CIGAR, kinetics, sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .intervals import intersect_semi
from .lengths import first_records
from .sequences import reverse_complement, subset_by_names


#: Bases of a read that are searched at once.
CHUNK = 256


def mean_read_q(qual: Column) -> Column:
    """Phred value of the mean error probability of a quality string (offset 33); null for an empty one."""
    errors = F.transform(F.filter(F.split(qual, ""), lambda c: c != ""), lambda c: F.pow(F.lit(10.0), (33 - F.ascii(c)) / 10.0))
    total = F.aggregate(errors, F.lit(0.0), lambda a, x: a + x)
    return -10 * F.log10(total / F.nullif(F.length(qual), F.lit(0)))


def filter_read_quality(reads: DataFrame, least_q: float = 20, least_length: int = 10_000) -> DataFrame:
    """Reads at least so long whose mean quality reaches least_q; lengths are looked at first."""
    return reads.where(F.length("seq") >= least_length).where(mean_read_q(F.col("qual")) >= least_q)


def _near(name: str, adapter: str, errors: int) -> Column:
    """Whether the column holds a stretch within so many edits of adapter. One of errors + 1 pieces of the adapter is unchanged, so
    only places around such a piece are compared."""
    seq, n = F.col(name), len(adapter)
    if errors == 0:
        return F.contains(seq, F.lit(adapter))
    cuts = [n * i // (errors + 1) for i in range(errors + 2)]

    # Places are looked for in chunks: finding the i-th base of a long string walks from its start.
    chunks = F.transform(F.sequence(F.lit(0), F.expr(f"cast((length({name}) - 1) div {CHUNK} as int)")), lambda c: F.substring(seq, c * CHUNK - F.when(c > 0, n + errors).otherwise(0) + 1, F.lit(CHUNK + 2 * (n + errors))))

    def around(seed: str, low: int) -> Column:
        def inside(chunk: Column) -> Column:
            places = F.filter(F.sequence(F.lit(1), F.greatest(F.length(chunk) - len(seed) + 1, F.lit(1))), lambda i: F.substring(chunk, i, F.lit(len(seed))) == seed)
            like = lambda s: F.exists(F.sequence(F.lit(n - errors), F.lit(n + errors)), lambda m: F.levenshtein(F.substring(chunk, s, m), F.lit(adapter)) <= errors)
            return F.contains(chunk, F.lit(seed)) & F.exists(places, lambda i: F.exists(F.sequence(i - low - errors, i - low + errors), lambda s: (s >= 1) & like(s)))

        return F.contains(seq, F.lit(seed)) & F.exists(chunks, inside)

    found = F.lit(False)
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        found = found | around(adapter[low:high], low)
    return found


def discard_adapter_reads(reads: DataFrame, adapters: tuple[str, ...], error_rate: float = 0.05, overlap: int = 35) -> DataFrame:
    """Reads without any of the adapters on either strand, in full within error_rate edits a base, or as a part of at least
    overlap bases at an end of the read."""
    complement = str.maketrans("ACGT", "TGCA")
    bad = F.lit(False)
    for a in {x for y in adapters for x in (y, y.translate(complement)[::-1])}:
        bad = bad | _near("seq", a, int(error_rate * len(a)))
        for n in range(overlap, len(a)):
            most = int(error_rate * n)
            bad = bad | (F.levenshtein(F.left("seq", F.lit(n)), F.lit(a[-n:])) <= most) | (F.levenshtein(F.right("seq", F.lit(n)), F.lit(a[:n])) <= most)
    return reads.where(~F.coalesce(bad, F.lit(False)))


def exclude_lines(records: DataFrame, text: str, columns: tuple[str, ...]) -> DataFrame:
    """Records none of whose columns holds the text."""
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.contains(F.col(c), F.lit(text)), F.lit(False))
    return records.where(~hit)


def parse_tag(tags: Column, name: str) -> Column:
    """The value of a tag name:type:value among tab-separated tags; null where there is none."""
    value = F.regexp_extract(tags, f"(?:^|\t){name}:[^:\t]*:([^\t]*)", 1)
    return F.when(F.concat(F.lit("\t"), tags).rlike(f"\t{name}:"), value)


def paf_adapter_filter(hits: DataFrame, most_mismatches: int = 2, least_span: int = 42) -> DataFrame:
    """Hits with few mismatches over a long enough stretch of the query; one where either is null goes."""
    return hits.where((F.col("nm") <= most_mismatches) & (F.col("query_end") - F.col("query_start") >= least_span))


def _cigar(cigar: Column, letters: str) -> Column:
    numbers = F.regexp_extract_all(cigar, F.lit(rf"(\d+)[{letters}]"), F.lit(1))
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))


def query_span(cigar: Column) -> Column:
    """Bases of the read that a CIGAR uses, soft clips included."""
    return _cigar(cigar, "MIS=X")


def reference_span(cigar: Column) -> Column:
    return _cigar(cigar, "MDN=X")


def sam_quality_filter(records: DataFrame, least_mapq: int = 10, least_length: int = 10_000) -> DataFrame:
    """Records of a mapping quality whose cigar takes up enough bases of the read; a null quality or cigar goes."""
    return records.where(F.col("mapq") >= least_mapq).where(query_span(F.col("cigar")) >= least_length)


def tag_filter_and_drop(records: DataFrame, least_rq: float = 0.88, drop: tuple[str, ...] = ("fi", "ri", "fp", "rp")) -> DataFrame:
    """Records whose rq tag reaches a value; some tags are taken out."""
    kept = F.filter(F.split("tags", "\t"), lambda t: ~F.substring_index(t, ":", 1).isin(*drop))
    return records.where(parse_tag(F.col("tags"), "rq").cast("double") >= least_rq).withColumn("tags", F.array_join(kept, "\t"))


#: Text that tells, in a record's tags, that a file holds such values.
TAG_MARKS = {"MM": "MM:Z:C", "ML": "ML:B:C", "fi": "fi:B:C", "ri": "ri:B:C", "fp": "fp:B:C", "rp": "rp:B:C"}
HEADER_MARKS = {"all_kinetics": "--all-kinetics", "keep_kinetics": "--keep-kinetics", "hifi_kinetics": "--hifi-kinetics", "primrose": "PP:primrose"}


def presence_flags(records: DataFrame, headers: DataFrame | None = None, first: int = 100) -> DataFrame:
    """Per file: whether any of its first records has each tag, and whether its header lines (file, value) name each switch."""
    some = first_records(records, first, "file", "read_id", ("flag", "contig", "pos", "tags"))
    out = some.groupBy("file").agg(*[F.bool_or(F.contains(F.coalesce("tags", F.lit("")), F.lit(m))).alias(f"has_{n}") for n, m in TAG_MARKS.items()])
    if headers is None:
        return out
    said = headers.groupBy("file").agg(*[F.bool_or(F.contains("value", F.lit(m))).alias(n) for n, m in HEADER_MARKS.items()])
    return out.join(said, "file", "left").na.fill(False, list(HEADER_MARKS))


def trim_kinetics(reads: DataFrame, strict: bool = False) -> DataFrame:
    """Reads (read_id, read_len, left_trim, right_trim, fi, fp, ri, rp[, tags]) with trimmed arrays and a status.

    fi and fp lose left values at the front and right ones at the end, ri and rp the other way round. No trim: skipped,
    as it was. failed, as it was: a negative or missing trim, a missing array, a trim not below an array's length, or a
    length that is neither 0 nor the read's. fixed: trimmed, and the tags MM and ML taken out. strict: a failure raises.
    """
    arrays = {"fi": ("left_trim", "right_trim"), "fp": ("left_trim", "right_trim"), "ri": ("right_trim", "left_trim"), "rp": ("right_trim", "left_trim")}
    total = F.col("left_trim") + F.col("right_trim")
    bad = F.col("left_trim").isNull() | F.col("right_trim").isNull() | (F.col("left_trim") < 0) | (F.col("right_trim") < 0)
    for a in arrays:
        n = F.size(a)
        bad = bad | F.col(a).isNull() | ((n > 0) & ((total >= n) | (n - total != F.col("read_len"))))
    status = F.when((F.col("left_trim") == 0) & (F.col("right_trim") == 0), "skipped").when(F.coalesce(bad, F.lit(True)), "failed").otherwise("fixed")
    out = reads.withColumn("status", status)
    if strict:
        out = out.withColumn("status", F.when(F.col("status") == "failed", F.raise_error(F.concat(F.lit("kinetics do not fit read "), F.col("read_id").cast("string")))).otherwise(F.col("status")))
    cut = {a: F.when((F.col("status") == "fixed") & (F.size(a) > 0), F.slice(a, (F.col(front) + 1).cast("int"), (F.size(a) - total).cast("int"))).otherwise(F.col(a)) for a, (front, _) in arrays.items()}
    if "tags" in reads.columns:
        cut["tags"] = F.when(F.col("status") == "fixed", F.map_filter("tags", lambda k, v: ~k.isin("MM", "ML"))).otherwise(F.col("tags"))
    return out.withColumns(cut)


def trim_counters(trimmed: DataFrame) -> DataFrame:
    """One row: reads, fixed, skipped and failed ones."""
    return trimmed.agg(F.count("*").alias("reads"), *[F.count_if(F.col("status") == s).alias(s) for s in ("fixed", "skipped", "failed")])


def downsample_coverage(reads: DataFrame, target: float, genome: float, draw: Column | None = None) -> DataFrame:
    """Reads drawn at the rate that gives the target coverage. draw: a number in [0, 1) per read, by default a hash of
    read_id, so that reruns agree."""
    draw = F.pmod(F.xxhash64("read_id"), F.lit(1_000_000)) / 1e6 if draw is None else draw
    rate = reads.agg((target * genome / F.nullif(F.sum("length"), F.lit(0))).alias("rate"))  # one row
    return reads.join(F.broadcast(rate), draw < F.col("rate")).drop("rate")


def mapq_table(records: DataFrame, regions: DataFrame) -> DataFrame:
    """(read_id, contig, pos, mapq) of alignments that overlap a region (contig, start_pos, end_pos)."""
    spans = records.select("read_id", "contig", "pos", "mapq", (F.col("pos") - 1).alias("start_pos"), (F.col("pos") - 1 + reference_span(F.col("cigar"))).alias("end_pos"))
    return intersect_semi(spans, regions).select("read_id", "contig", "pos", "mapq")


def correct_alignments(records: DataFrame, excluded: DataFrame | None = None, mapq: DataFrame | None = None, flipped: DataFrame | None = None, least_read: int = 0, least_alignment: int = 0, most_divergence: float = 1.0, primary_only: bool = True) -> DataFrame:
    """Alignments that a caller may use: without excluded read ids, short reads, short or diverged alignments (NM over
    aligned bases) and, if asked for, those that are not primary; mapq from a table (read_id, contig, pos, mapq) where it
    has one; primary and secondary exchanged for flipped read ids."""
    aligned = _cigar(F.col("cigar"), "M=X")
    out = records.where((query_span(F.col("cigar")) >= least_read) & (aligned >= least_alignment))
    out = out.where(F.coalesce(parse_tag(F.col("tags"), "NM").cast("double"), F.lit(0.0)) <= most_divergence * aligned)
    if flipped is not None:
        marked = flipped.select("read_id", F.lit(True).alias("flip")).distinct()
        out = out.join(marked, "read_id", "left").withColumn("flag", F.when(F.col("flip") & (F.col("flag").bitwiseAND(0x800) == 0), F.col("flag").bitwiseXOR(0x100)).otherwise(F.col("flag"))).drop("flip")
    if primary_only:
        out = out.where(F.col("flag").bitwiseAND(0x900) == 0)
    if excluded is not None:
        out = out.join(excluded.select("read_id").distinct(), "read_id", "left_anti")
    if mapq is not None:
        table = mapq.groupBy("read_id", "contig", "pos").agg(F.max("mapq").alias("new"))
        out = out.join(table, ["read_id", "contig", "pos"], "left").withColumn("mapq", F.coalesce("new", "mapq")).drop("new")
    return out.select(*records.columns)


def mito_read_selection(reads: DataFrame, paf: DataFrame, least_block: int = 12_000) -> DataFrame:
    """Reads (name, ...) with an alignment of at least so many bases."""
    return subset_by_names(reads, paf.where(F.col("block_len") >= least_block).select(F.col("query").alias("name")).distinct())


def orientation_split(alignments: DataFrame) -> DataFrame:
    """(query, strand): each strand that a sequence maps on; one mapped on both has two rows."""
    return alignments.select("query", "strand").distinct()


def oriented(sequences: DataFrame, strands: DataFrame) -> DataFrame:
    """Sequences as their strand has them: reverse-complemented for -, once per strand; those without one stay out."""
    met = sequences.join(strands.withColumnRenamed("query", "name"), "name")
    return met.withColumn("seq", F.when(F.col("strand") == "-", reverse_complement(F.col("seq"))).otherwise(F.col("seq"))).select("name", "strand", "seq")
