"""Mixing sources to target weights, with DataFrame functions alone.

Each source is one stream of words, document after document, cut into fixed-length blocks. Every output shard has a
number of slots; each slot draws its source, so a shard's counts are multinomial. What the draws of all shards give a
source above its target goes to the sources that fell short, slot by slot. Slot j of a source takes block p(j mod n) of
its n blocks, where p is a pseudorandom permutation keyed by the source and the round j div n; slots and blocks are
joined by (source, index). Draws are hashes of (seed, slot): the same table gives the same mix.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import materialise, partitions

BLOCK = 64
SHARD_SLOTS = 1024
WEIGHTS = (5.0, 2.0, 1.0)
#: Documents in a group of a source within which sizes are summed in order; shards in a group likewise.
GROUP = 2000
#: Equal parts of [0, 1) by which a slot's draw finds its source.
BINS = 4096
#: Rounds of the swap-or-not permutation.
SWAPS = 24


def _uniform(*what) -> Column:
    return F.pmod(F.xxhash64(*what), F.lit(1 << 40)) / float(1 << 40)


def permuted(x: Column, n: Column, *key) -> Column:
    """A pseudorandom permutation of 0 .. n - 1 for each key, by swap-or-not: each round pairs x with K - x (mod n) and a
    hash of the larger one decides whether they change places. Right for every n; nothing is gathered."""

    def step(at: Column, turn: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(*key, turn), n) - at + n, n)
        return F.when(F.xxhash64(*key, turn, F.greatest(at, other)) >= 0, at).otherwise(other)

    return F.aggregate(F.sequence(F.lit(1), F.lit(SWAPS)), x, step)


def _prefix(rows: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """rows with `before`, the sum of value over the smaller values of the long column order, per keys: sums within groups of
    GROUP, and over the groups."""
    dealt = rows.withColumn("group", F.floor(F.col(order) / GROUP))
    total = dealt.groupBy(*keys, "group").agg(F.sum(value).alias("sum"))
    base = total.select(*keys, "group", (F.sum("sum").over(Window.partitionBy(*keys).orderBy("group")) - F.col("sum")).alias("base"))
    inside = F.sum(value).over(Window.partitionBy(*keys, "group").orderBy(order)) - F.col(value)
    return dealt.withColumn("inside", inside).join(base, [*keys, "group"]).withColumn("before", F.col("base") + F.col("inside")).drop("group", "base", "inside")


def plan_targets(sources: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size) -> target added: share of all words by weight, at most `most` times a source's size, the
    excess given to the others by weight until none is above.

    A row per source; a null source is one, and the last. A source without words gets 0; without sources there are no rows. With the sources in order of (cap / weight), one level fits: those whose cap lies below it get
    their cap and the rest level x weight.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    cycle = F.array(*[F.lit(float(x)) for x in weights])
    w = sources.withColumn("w", F.element_at(cycle, (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))).withColumn("cap", most * F.col("source_size"))
    ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), "source")
    whole = Window.partitionBy()
    w = w.withColumn("level", (share * F.sum("source_size").over(whole) - (F.sum("cap").over(ratio) - F.col("cap"))) / (F.sum("w").over(whole) - F.sum("w").over(ratio) + F.col("w")))
    w = w.withColumn("level", F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct((F.col("cap") / F.col("w")).alias("r"), "level"))).over(whole)["level"])
    return w.withColumn("target", F.least("cap", F.coalesce(F.col("level") * F.col("w"), F.col("cap"))).cast("double")).drop("w", "cap", "level")


@dataclass
class Mix:
    """per_doc: (doc_id, tie, size, source_size, target, taken), a row per input row. pieces: (doc_id, tie, times, round,
    first, n), the words that each round takes of a document. slots: (shard, k, round, index), the blocks of each shard."""

    per_doc: DataFrame
    pieces: DataFrame
    slots: DataFrame


def _tie(text_col: str) -> Column:
    return F.xxhash64("doc_id", text_col, "source")


def mix_sources(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, most: int = 2, block: int = BLOCK, slots: int = SHARD_SLOTS, seed: int = 11, text_col: str = "text") -> Mix:
    """Draws the mix of a documents table.

    A null text has size 0 and is never taken; null sources are one source, last in order; identical rows lie side by
    side in the stream and share what is taken of them; other columns are ignored; an empty table gives no rows. No
    block is taken more than `most` times, so no document exceeds that. Sizes are counted once and written to the
    shared folder when called.
    """
    key = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("null"))
    size = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")
    slim = docs.select("doc_id", _tie(text_col).alias("tie"), key.alias("k"), F.col("source").cast("string").alias("source"), size.alias("size"))
    rows = materialise(slim.groupBy("doc_id", "tie", "k", "source", "size").agg(F.count("*").alias("times")), "sizes")
    rows = rows.withColumn("all", F.col("size") * F.col("times"))
    sources = rows.groupBy("k", "source").agg(F.sum("all").alias("source_size"), F.count("*").alias("rows"))
    planned = plan_targets(sources, weights, share, float(most)).withColumn("blocks", F.ceil(F.col("source_size") / block))
    planned = planned.withColumn("want", F.coalesce(F.col("target") * F.col("blocks") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0)))
    stats = materialise(planned.drop("source"), "sources")

    # Where each document begins in its source's stream: sums within groups of documents, then over the groups.
    grouped = rows.join(stats.select("k", "rows"), "k").withColumn("g", F.pmod(F.xxhash64("doc_id", "tie", F.lit(seed)), F.ceil(F.col("rows") / GROUP)))
    total = grouped.groupBy("k", "g").agg(F.sum("all").alias("n"))
    base = total.select("k", "g", (F.sum("n").over(Window.partitionBy("k").orderBy("g")) - F.col("n")).alias("base"))
    within = grouped.withColumn("before", F.sum("all").over(Window.partitionBy("k", "g").orderBy("doc_id", "tie").rowsBetween(Window.unboundedPreceding, 0)) - F.col("all"))
    placed = within.join(base, ["k", "g"]).withColumn("begin", F.col("base") + F.col("before")).drop("rows", "g", "base", "before", "source")

    slot = _slots(stats, most, slots, seed)
    used = slot.groupBy("k", "index").agg(F.max("round").alias("round"), F.count("*").alias("uses"), F.collect_set("round").alias("rounds"))

    # A document's share of each block that it lies in, joined to the uses of the block.
    spread = placed.where("all > 0").withColumn("index", F.explode(F.sequence(F.floor(F.col("begin") / block), F.floor((F.col("begin") + F.col("all") - 1) / block))))
    # Slots come from a row per source, so Spark underrates their number; they must not be broadcast.
    met = spread.join(used.hint("merge"), ["k", "index"])
    low, high = F.greatest("begin", F.col("index") * block), F.least(F.col("begin") + F.col("all"), (F.col("index") + 1) * block)
    met = met.select("doc_id", "tie", "times", (low - F.col("begin")).alias("first"), (high - low).alias("n"), "uses", "rounds")
    taken = met.groupBy(F.col("doc_id").alias("id2"), F.col("tie").alias("tie2")).agg(F.sum(F.col("n") * F.col("uses")).alias("sum"))
    per_doc = rows.join(taken.hint("merge"), F.col("doc_id").eqNullSafe(F.col("id2")) & (F.col("tie") == F.col("tie2")), "left").withColumn("sum", F.coalesce("sum", F.lit(0)))
    per_doc = per_doc.join(stats.select("k", "source_size", "target"), "k").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)))
    share_of = F.expr("sum div times + if(copy < sum % times, 1, 0)").cast("long")
    per_doc = per_doc.select("doc_id", "tie", "size", "source_size", "target", share_of.alias("taken"))
    pieces = met.withColumn("round", F.explode("rounds")).select("doc_id", "tie", "times", "round", "first", "n")
    return Mix(per_doc, pieces, slot)


def slot_counts(stats: DataFrame, slots: int, seed: int) -> DataFrame:
    """(shard, k, n): how many slots of each shard draw each source. stats: (k, want), a row per source. Each slot draws one
    number, so the counts of a shard are multinomial; sources that want nothing, or null, draw none; no slots, no rows."""
    order = Window.orderBy("k")
    sources = stats.where("want > 0").withColumn("high", F.sum("want").over(order.rowsBetween(Window.unboundedPreceding, 0)) / F.sum("want").over(Window.partitionBy()))
    sources = sources.select("k", F.coalesce(F.lag("high").over(order), F.lit(0.0)).alias("low"), F.when(F.lead("k").over(order).isNull(), 2.0).otherwise(F.col("high")).alias("high"))
    bins = sources.select("k", "low", "high", F.explode(F.sequence(F.floor(F.col("low") * BINS).cast("int"), F.least(F.floor(F.col("high") * BINS).cast("int"), F.lit(BINS - 1)))).alias("bin"))
    n = stats.agg(F.round(F.sum("want")).cast("long")).first()[0] or 0
    shards = stats.sparkSession.range(-(-n // slots)).select(F.col("id").alias("shard"), F.lit(n).cast("long").alias("n"))
    drawn = shards.select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.lit(slots), F.col("n") - F.col("shard") * slots) - 1)).alias("slot"))
    drawn = drawn.withColumn("u", _uniform(F.lit(seed), "shard", "slot")).withColumn("bin", F.floor(F.col("u") * BINS).cast("int"))
    # A row for each source and bin that it reaches into: BINS rows and one a source.
    return drawn.join(bins, "bin").where("u >= low and u < high").groupBy("shard", "k").agg(F.count("*").alias("n"))


def _slots(stats: DataFrame, most: int, slots: int, seed: int) -> DataFrame:
    """(shard, k, round, index) of all slots. A source's slots are numbered over the shards; those beyond its target
    are dealt, in order, to the sources that have fewer."""
    spark = stats.sparkSession
    drawn = materialise(_prefix(slot_counts(stats, slots, seed), ["k"], "shard", "n"), "slots")
    got = drawn.groupBy("k").agg(F.sum("n").alias("got"))
    goal = F.least(F.round("want").cast("long"), F.col("blocks") * most)
    level = stats.join(got, "k", "left").select("k", "blocks", goal.alias("goal"), F.least(F.coalesce("got", F.lit(0)), goal).alias("stay"), F.coalesce("got", F.lit(0)).alias("got"))
    order = Window.orderBy("k")  # a row per source
    level = level.withColumns({"over": F.col("got") - F.col("stay"), "short": F.col("goal") - F.col("stay")})
    wide = F.greatest(F.lit(1).cast("long"), F.ceil(F.sum("short").over(Window.partitionBy()) / BINS))
    level = level.withColumn("wide", wide)
    level = materialise(level.withColumns({"over_from": F.sum("over").over(order) - F.col("over"), "short_from": F.sum("short").over(order) - F.col("short")}), "levels")
    # A row stands for up to SHARD_SLOTS slots, so the small table is dealt to all tasks first.
    each = drawn.repartition(partitions(spark), "k", "shard").select("shard", "k", F.explode(F.sequence(F.col("before"), F.col("before") + F.col("n") - 1)).alias("j"))
    each = each.join(level.select("k", "stay", "over_from", "wide"), "k")
    own = each.where("j < stay").select("shard", "k", "j")
    # The s-th slot too many goes to the source whose shortage it falls into.
    spare = each.where("j >= stay").select("shard", (F.col("over_from") + F.col("j") - F.col("stay")).alias("s"), "wide").withColumn("bin", F.expr("s div wide")).drop("wide")
    short = level.where("short > 0").select("k", "stay", "short_from", "short", F.explode(F.sequence(F.expr("short_from div wide"), F.expr("(short_from + short - 1) div wide"))).alias("bin"))
    dealt = spare.join(short, "bin").where("s >= short_from and s < short_from + short")
    dealt = dealt.select("shard", "k", (F.col("stay") + F.col("s") - F.col("short_from")).alias("j"))
    slot = own.unionByName(dealt).join(level.select("k", "blocks"), "k").withColumn("round", F.expr("j div blocks"))
    return slot.select("shard", "k", "round", permuted(F.expr("j % blocks"), F.col("blocks"), "k", "round", F.lit(seed)).alias("index"))


def mixed_documents(docs: DataFrame, mix: Mix) -> DataFrame:
    """The mix as documents, with the columns of docs: a row for each document and round that takes words of it, whose
    text holds those words in order, with the white space before them; n_chars, where there is one, is counted anew.
    Rows with equal doc_id, text and source are one stream, so they give one row a round: of rows that differ in other columns, that with the
    smallest hash of all columns; a null or empty text gives none."""
    words = F.regexp_extract_all(F.concat(F.lit("\n"), "text"), F.lit("[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+"), F.lit(0))
    parts = mix.pieces.groupBy("doc_id", "tie", "round").agg(F.struct(F.max("times").alias("times"), F.array_sort(F.collect_list(F.struct("first", "n"))).alias("spans")).alias("take"))
    parts = parts.select(F.struct("doc_id", "tie").alias("key of a piece"), "take")
    # One struct holds the row, so that no column of docs can clash.
    own = docs.select(F.struct(F.col("doc_id"), _tie("text").alias("tie")).alias("key"), F.struct(*docs.columns).alias("row"), F.xxhash64(*docs.columns).alias("hash"))
    own = own.groupBy("key").agg(F.min_by("row", "hash").alias("row"))
    same = (F.col("key")["doc_id"].eqNullSafe(F.col("key of a piece")["doc_id"])) & (F.col("key")["tie"] == F.col("key of a piece")["tie"])
    met = own.join(parts.hint("merge"), same).select("row.*", F.col("take").alias("what the mix takes"))
    take = F.col("what the mix takes")
    # The words are a lambda's argument, so that a text is split once, not once a span.
    cut = lambda w: F.array_join(F.flatten(F.transform(take["spans"], lambda p: F.slice(w, (p["first"] + 1).cast("int"), p["n"].cast("int")))), "")
    text = F.transform(F.array(F.flatten(F.array_repeat(words, take["times"].cast("int")))), cut)[0]
    met = met.withColumn("text", F.regexp_replace(text, "^[\\x20\\x09-\\x0D]+", ""))
    if "n_chars" in docs.columns:
        met = met.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return met.select(*docs.columns)
