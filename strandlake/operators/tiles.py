"""Sequences in tiles: (name, key, tile, bases).

A chromosome is cut once, from front to back, into tiles of WIDTH bases. What needs bases at a place joins the tile of that place, so
no row is a whole chromosome and no lookup walks a sequence from its start. key tells sequences of one name apart; equal
rows of a table have equal tiles and are counted when the tiles are put together again.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTH = 16_384
#: Bases of a contig whose edits one window orders.
STRETCH = 1_000_000


def heads(sequences: DataFrame) -> DataFrame:
    """(name, key, length), one row per sequence."""
    return sequences.select("name", F.xxhash64("seq").alias("key"), F.length("seq").cast("long").alias("length"))


def tiled(sequences: DataFrame, width: int = WIDTH) -> DataFrame:
    """(name, key, tile, bases), tiles counted from 0. An empty or null sequence has one tile, empty or null."""
    pieces = F.when(F.length("seq") > 0, F.regexp_extract_all("seq", F.lit(f"(?s).{{1,{width}}}"), F.lit(0))).otherwise(F.array("seq"))
    # The key is made before the tiles: once for a sequence.
    cut = sequences.select("name", F.xxhash64("seq").alias("key"), pieces.alias("pieces"))
    return cut.select("name", "key", F.posexplode("pieces").alias("tile", "bases")).withColumn("tile", F.col("tile").cast("long"))


def untiled(tiles: DataFrame, *more: str) -> DataFrame:
    """(name, seq, more) from (name, key, tile, bases, more): one row for each sequence that was cut. more: columns that all tiles of a
    sequence share."""
    rows = tiles.groupBy("name", "key", *more).agg(F.array_sort(F.collect_set(F.struct("tile", F.struct("bases").alias("b")))).alias("t"), F.count("*").alias("n"))
    seq = F.when(F.col("t")[0]["b"]["bases"].isNotNull(), F.array_join(F.transform("t", lambda x: x["b"]["bases"]), ""))
    return rows.select("name", seq.alias("seq"), *more, F.explode(F.array_repeat(F.lit(1), (F.col("n") / F.size("t")).cast("int"))).alias("copy")).drop("copy")


def _over_tiles(rows: DataFrame, start: Column, end: Column, width: int) -> DataFrame:
    """A row for each tile that [start, end) meets, with its part of the tile as s and e; an empty stretch meets the tile of its start."""
    last = F.greatest(F.floor((end - 1) / width), F.floor(start / width))
    each = rows.withColumn("tile", F.explode(F.sequence(F.floor(start / width), last)))
    return each.withColumns({"s": F.greatest(start - F.col("tile") * width, F.lit(0)).cast("int"), "e": F.least(end - F.col("tile") * width, F.lit(width)).cast("int")})


def extract(sequences: DataFrame, intervals: DataFrame, width: int = WIDTH) -> DataFrame:
    """The bases of each interval (contig, start_pos, end_pos, ...), contig as name: what lies inside the sequence, '' if nothing does. Intervals
    of unknown contigs go; equal rows stay as often as they are there. Only the pieces that the intervals cover travel on."""
    names = [c if c != "contig" else "name" for c in intervals.columns]
    asked = intervals.withColumnRenamed("contig", "name").groupBy(*names).agg(F.count("*").alias("copies")).join(heads(sequences).groupBy("name", "key", "length").agg(F.count("*").alias("times")), "name")
    inside = lambda c: F.least(F.greatest(F.col(c), F.lit(0)), F.coalesce("length", F.lit(0)))
    # The end of a sequence that fills its last tile lies in that tile.
    start = F.least(inside("start_pos"), F.greatest(F.coalesce("length", F.lit(0)) - 1, F.lit(0)))
    end = F.greatest(inside("end_pos"), start)
    end = F.when(F.col("start_pos") >= F.coalesce("length", F.lit(0)), start).otherwise(end)
    parts = _over_tiles(asked, start, end, width).join(tiled(sequences, width).dropDuplicates(["name", "key", "tile"]), ["name", "key", "tile"])
    piece = F.struct("tile", F.substring("bases", F.col("s") + 1, F.col("e") - F.col("s")).alias("x"))
    found = parts.groupBy(*names, "key", "copies", "times").agg(F.array_sort(F.collect_list(piece)).alias("p"))
    seq = F.when(F.col("p")[0]["x"].isNotNull(), F.array_join(F.transform("p", lambda p: p["x"]), ""))
    return found.select(*names, seq.alias("seq"), F.explode(F.array_repeat(F.lit(1), (F.col("copies") * F.col("times")).cast("int"))).alias("copy")).drop("copy")


def mask(sequences: DataFrame, merged: DataFrame, width: int = WIDTH) -> DataFrame:
    """(name, seq) with N for the bases of merged intervals (contig, start_pos, end_pos); sequences without one stay as they are."""
    spans = merged.select(F.col("contig").alias("name"), F.greatest("start_pos", F.lit(0)).alias("start_pos"), "end_pos").join(heads(sequences).groupBy("name").agg(F.max("length").alias("length")), "name")
    spans = spans.withColumn("end_pos", F.least("end_pos", "length")).where("start_pos < end_pos")
    # Merged intervals are disjoint: a tile has fewer of them than bases.
    gaps = _over_tiles(spans, F.col("start_pos"), F.col("end_pos"), width).groupBy("name", "tile").agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("gaps"))
    met = tiled(sequences, width).join(gaps, ["name", "tile"], "left")
    met = met.withColumn("gaps", F.expr("filter(transform(gaps, g -> struct(least(g.s, length(bases)) as s, least(g.e, length(bases)) as e)), g -> g.s < g.e)"))
    before = "if(i = 0, 0, gaps[greatest(i - 1, 0)].e)"
    pieces = f"transform(gaps, (g, i) -> concat(substr(bases, {before} + 1, g.s - {before}), repeat('N', g.e - g.s)))"
    return untiled(met.withColumn("bases", F.expr(f"if(coalesce(size(gaps), 0) < 1, bases, concat(array_join({pieces}, ''), substr(bases, gaps[size(gaps) - 1].e + 1)))")))


def bases_at(sites: DataFrame, reference: DataFrame, width: int = 1024) -> DataFrame:
    """sites (contig, pos from 1, ...) with `ref`, the capital base of the reference (name, seq) there; places outside go."""
    tiles = tiled(reference, width).select(F.col("name").alias("contig"), "tile", "bases")
    met = sites.withColumn("tile", F.floor((F.col("pos") - 1) / width)).join(tiles, ["contig", "tile"])
    return met.withColumn("ref", F.upper(F.substring("bases", F.pmod(F.col("pos") - 1, F.lit(width)).cast("int") + 1, F.lit(1)))).where("ref != ''").drop("tile", "bases")


def _fitting(sequences: DataFrame, variants: DataFrame, width: int) -> DataFrame:
    """(name, key, pos, ref, alt) of variants whose ref is what the sequence has at pos. Equal places: the smallest (ref, alt)."""
    best = variants.where("pos >= 1 and ref is not null and alt is not null").groupBy(F.col("contig").alias("name"), F.col("pos").cast("long").alias("pos")).agg(F.min(F.struct("ref", "alt")).alias("v")).select("name", "pos", "v.ref", "v.alt")
    start = F.col("pos") - 1
    parts = _over_tiles(best, start, start + F.length("ref"), width)
    said = F.substring("ref", (F.col("tile") * width + F.col("s") - start + 1).cast("int"), F.col("e") - F.col("s"))
    met = parts.join(tiled(sequences, width).dropDuplicates(["name", "key", "tile"]), ["name", "tile"])
    same = met.where(F.substring("bases", F.col("s") + 1, F.col("e") - F.col("s")) == said)
    whole = same.groupBy("name", "key", "pos", "ref", "alt").agg(F.sum(F.col("e") - F.col("s")).alias("n"))
    return whole.where(F.col("n") == F.length("ref")).drop("n")


def _apart(edits: DataFrame) -> DataFrame:
    """Edits of which none begins inside the kept one before it. Groups that overlap are found in stretches of a sequence, each with the
    reach of those before it; a group is then read in order, holding one number."""
    by = ["name", "key"]
    rows = edits.withColumns({"stop": F.col("pos") + F.length("ref"), "stretch": F.floor(F.col("pos") / STRETCH)})
    over = Window.partitionBy(*by).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    inner = Window.partitionBy(*by, "stretch").orderBy("pos")
    carried = rows.groupBy(*by, "stretch").agg(F.max("stop").alias("stop")).select(*by, "stretch", F.max("stop").over(over).alias("carried"))
    rows = rows.join(carried, [*by, "stretch"])
    reach = F.greatest(F.coalesce(F.max("stop").over(inner.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), F.coalesce("carried", F.lit(0)))
    rows = rows.withColumn("head", F.when(F.col("pos") >= reach, F.col("pos")))
    first = rows.groupBy(*by, "stretch").agg(F.max("head").alias("head")).select(*by, "stretch", F.max("head").over(over).alias("open"))
    rows = rows.withColumn("own", F.max("head").over(inner)).join(first, [*by, "stretch"])
    slim = rows.select("name", "key", F.coalesce("own", "open").alias("group"), "pos", "ref", "alt")

    def keep(batches):
        last, free = None, 0
        for batch in batches:
            chosen = []
            for i, (*group, pos, ref) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("name", "key", "group", "pos", "ref")), strict=True)):
                if group != last:
                    last, free = group, 0
                if pos >= free:
                    free = pos + len(ref)
                    chosen.append(i)
            if chosen:
                yield batch.take(pa.array(chosen))

    return slim.repartition("name", "key", "group").sortWithinPartitions("name", "key", "group", "pos").mapInArrow(keep, slim.schema).drop("group")


def apply_edits(sequences: DataFrame, variants: DataFrame, width: int = WIDTH) -> DataFrame:
    """(name, seq, applied): sequences with the alternative alleles of variants (contig, pos from 1, ref, alt) put in, and how many.

    Of variants that share a position the smallest (ref, alt) counts; one that begins inside the kept one before it is left out, as is one
    whose ref is not what the sequence has there. A ref may reach over tiles: each tile loses its part, the first one gets alt.
    """
    kept = _apart(_fitting(sequences, variants, width))
    start = F.col("pos") - 1
    parts = _over_tiles(kept, start, start + F.length("ref"), width)
    put = F.when(F.col("tile") == F.floor(start / width), F.col("alt")).otherwise("")
    edits = parts.groupBy("name", "key", "tile").agg(F.array_sort(F.collect_list(F.struct("s", "e", put.alias("put")))).alias("edits"))
    met = tiled(sequences, width).join(edits, ["name", "key", "tile"], "left")
    before = "if(i = 0, 0, edits[greatest(i - 1, 0)].e)"
    pieces = f"transform(edits, (g, i) -> concat(substr(bases, {before} + 1, g.s - {before}), g.put))"
    made = met.withColumn("bases", F.expr(f"if(coalesce(size(edits), 0) < 1, bases, concat(array_join({pieces}, ''), substr(bases, edits[size(edits) - 1].e + 1)))"))
    applied = kept.groupBy("name", "key").agg(F.count("*").cast("int").alias("applied"))
    return untiled(made.select("name", "key", "tile", "bases").join(applied, ["name", "key"], "left").withColumn("applied", F.coalesce("applied", F.lit(0))), "applied")
