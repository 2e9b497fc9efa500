"""Report tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Line numbers that one window orders at first.
LINES = 65_536


def sections(lines: DataFrame, header: str = r"^=+ (.*?) =+$") -> DataFrame:
    """(file, line_no, line) -> rows with the section they lie in: the last header above with no blank line between. Lines are ordered within stretches of
    a file; each begins with the section that the stretches before it leave, so a long file is not one task's."""
    title = F.when(F.col("line").rlike(header), F.regexp_extract("line", header, 1)).when(F.trim("line") == "", F.lit(""))
    dealt = lines.withColumns({"stretch": F.floor(F.col("line_no") / LINES), "title": title})
    order = Window.partitionBy("file", "stretch").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    local = dealt.withColumn("section", F.last("title", ignorenulls=True).over(order))
    # Stretches without a title of their own take the one before; a row for each stretch.
    every = dealt.groupBy("file", "stretch").agg(F.max_by("title", F.when(F.col("title").isNotNull(), F.col("line_no"))).alias("left"))
    before = Window.partitionBy("file").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    begun = every.select(F.col("file").alias("its file"), F.col("stretch").alias("its stretch"), F.last("left", ignorenulls=True).over(before).alias("begun"))
    # A stretch that begins within a section has a row here; null files too are files.
    met = local.join(begun.where("begun != ''"), F.col("file").eqNullSafe(F.col("its file")) & F.col("stretch").eqNullSafe(F.col("its stretch")), "left")
    found = met.withColumn("section", F.coalesce("section", "begun")).where("title is null and coalesce(section, '') != ''")
    return found.select(*lines.columns, "section")


def adapter_sections_to_bed(lines: DataFrame) -> DataFrame:
    """Strong and moderate vector hits as half-open intervals; the rows are 1-based and closed."""
    part = F.split("line", "\t")
    return lines.where(F.col("line").rlike("^VecScreen_(Strong|Moderate)\t")).select(part[1].alias("contig"), (part[2].cast("long") - 1).alias("start_pos"), part[3].cast("long").alias("end_pos"))


def sample_id(path: Column) -> Column:
    """HG, NA or PG and five digits, PG written as HG, before the file's base name unless it begins so; else the base name."""
    base = F.substring_index(path, "/", -1)
    found = F.regexp_replace(F.regexp_extract(path, r"((?:HG|NA|PG)\d{5})", 1), "^PG", "HG")
    return F.when(found == "", base).when(base.startswith(found), base).otherwise(F.concat(found, F.lit("_"), base))


def file_type(name: Column) -> Column:
    out = F.lit("other")
    for kind in ("kinnex", "hic", "ont", "hifi"):
        out = F.when(F.lower(name).contains(kind), kind).otherwise(out)
    return out


def sample_swap_summary(pairs: DataFrame, within_most: float = 0.5, cross_least: float = 0.5) -> DataFrame:
    """(sample1, sample2, score) -> per sample: files by type, pairs within and across, expected numbers, score ranges and
    verdict. Samples without both kinds of pair are left out."""
    sample = lambda c: F.regexp_replace(F.regexp_extract(c, r"((?:HG|NA|PG)\d{5})", 1), "^PG", "HG")
    both = pairs.withColumns({"s1": sample("sample1"), "s2": sample("sample2")})
    side = lambda f, s: both.where(F.col(s) != "").select(F.col(s).alias("sample"), F.col(f).alias("file"))
    files = side("sample1", "s1").unionByName(side("sample2", "s2")).distinct().withColumn("type", file_type(F.col("file")))
    kinds = ("hifi", "ont", "hic", "kinnex", "other")
    counts = files.groupBy("sample").agg(F.count("*").alias("n_files"), *[F.count_if(F.col("type") == k).alias("n_" + k) for k in kinds])
    total = counts.agg(F.sum("n_files").alias("all_files"))  # one row
    named = both.where("s1 != '' and s2 != ''")
    scores = named.where("s1 = s2").select(F.col("s1").alias("sample"), F.lit("within").alias("kind"), "score")
    cross = named.where("s1 != s2").select(F.explode(F.array("s1", "s2")).alias("sample"), F.lit("cross").alias("kind"), "score")
    agg = [f(F.when(F.col("kind") == k, F.col("score"))).alias(f"{n}_{k}") for k in ("within", "cross") for n, f in (("n", F.count), ("min", F.min), ("mean", F.avg), ("max", F.max))]
    out = scores.unionByName(cross).groupBy("sample").agg(*agg).where("n_within > 0 and n_cross > 0").join(counts, "sample").join(F.broadcast(total))
    out = out.withColumns({"expected_within": F.expr("n_files * (n_files - 1) div 2"), "expected_cross": F.col("n_files") * (F.col("all_files") - F.col("n_files")), "verdict": F.when((F.col("min_within") > 0) & (F.col("max_within") < within_most) & (F.col("min_cross") > cross_least), "PASS").otherwise("FAIL")})
    return out.drop("all_files")


def natural_key(name: Column) -> list[Column]:
    """Sort columns that put chr2 before chr10: what precedes the first number, the number, the rest."""
    return [F.regexp_extract(name, r"^(\D*)", 1).alias("prefix"), F.regexp_extract(name, r"(\d+)", 1).try_cast("long").alias("number"), F.regexp_extract(name, r"^\D*\d*(.*)$", 1).alias("rest")]


def melt(table: DataFrame, keys: list[str], values: list[str], name: str = "metric") -> DataFrame:
    """Wide to long."""
    return table.unpivot(keys, values, name, "value")


def metric_mean_stdev(table: DataFrame, key: str, metric: str) -> DataFrame:
    """Mean and sample standard deviation of a text column; what is not a number, such as Not_Calc, is ignored."""
    x = F.col(metric).try_cast("double")
    return table.groupBy(key).agg(F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("stdev"))


def pigeon_summary(lines: DataFrame) -> DataFrame:
    """One row per transcript-classification report (file, line_no, line): counts and percents by name, NA where missing.
    Sections begin at their titles; of a metric's lines in its section the last counts, of by-read matches the first."""
    from .tables import count_percent

    text = F.trim("line")
    title = F.when(F.contains("line", F.lit("Classifications, by isoform")), "isoform").when(F.contains("line", F.lit("Classifications, by read")), "read").when(F.contains("line", F.lit("Junctions")), "junctions").when(F.contains("line", F.lit("Filter reasons")), "filter")
    order = Window.partitionBy("file").orderBy("line_no")  # a report
    section = F.coalesce(F.last(title, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)), F.lit(""))
    count, percent = count_percent(text)
    after = F.trim(F.get(F.split(text, ":"), 1))
    rows = lines.select("file", "line_no", text.alias("text"), section.alias("section"), count.alias("count"), percent.alias("percent"), after.alias("after"))
    last = lambda ok, x: F.coalesce(F.max(F.when(ok, F.struct("line_no", F.col(x).alias("v"))))["v"], F.lit("NA"))
    first = lambda ok, x: F.coalesce(F.min(F.when(ok, F.struct("line_no", F.col(x).alias("v"))))["v"], F.lit("NA"))
    starts = lambda prefix: F.startswith("text", F.lit(prefix))
    made = [last(starts("Input"), "after").alias("flnc_input_reads"), last(starts("Passed") & (F.col("percent") != "NA"), "count").alias("passed_reads"), last(starts("Passed") & (F.col("percent") != "NA"), "percent").alias("passed_pct"), last(starts("Unique genes"), "after").alias("unique_genes"), last(starts("Unique transcripts"), "after").alias("unique_transcripts")]
    for short, name in (("fsm", "Full splice match"), ("ism", "Incomplete splice match"), ("nic", "Novel in catalog"), ("nnc", "Novel not in catalog")):
        own = starts(name) & (F.col("section") == "isoform")
        made += [last(own, "count").alias(f"{short}_isoforms"), last(own, "percent").alias(f"{short}_isoform_pct")]
    made.append(first(starts("Full splice match") & (F.col("section") == "read"), "percent").alias("fsm_read_pct"))
    for short, name in (("intrapriming", "Intrapriming"), ("rt_switching", "RT switching")):
        made.append(last(starts(name) & (F.col("section") == "filter"), "percent").alias(f"{short}_pct"))
    return rows.groupBy("file").agg(*made)


def contamination_rows(lines: DataFrame) -> DataFrame:
    """(file, kind, contig, size, first, last, source) of submission reports: a row for each span of a Trim line, and one, without
    span, for each Exclude line. A blank line ends a section; column headings are left out."""
    title = F.when(F.trim("line").isin("Trim:", "Exclude:"), F.replace(F.trim("line"), F.lit(":"), F.lit(""))).when(F.trim("line") == "", "")
    order = Window.partitionBy("file").orderBy("line_no")  # a report
    kind = F.last(title, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    f = F.split(F.trim("line"), r"\s+")
    rows = lines.withColumns({"kind": kind, "title": title, "f": f}).where("title is null and kind != '' and not line like '%Sequence name, length%'")
    spans = F.when(F.col("kind") == "Trim", F.split(F.col("f")[2], ",")).otherwise(F.array(F.lit(None).cast("string")))
    words = F.array_join(F.slice("f", F.when(F.col("kind") == "Trim", 4).otherwise(3), F.size("f")), " ")
    out = rows.select("file", "kind", F.col("f")[0].alias("contig"), F.col("f")[1].cast("long").alias("size"), F.explode(spans).alias("span"), words.alias("source"))
    ends = F.split("span", r"\.\.")
    return out.select("file", "kind", "contig", "size", ends[0].cast("long").alias("first"), ends[1].cast("long").alias("last"), "source")
