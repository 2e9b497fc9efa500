"""Merkle manifest of a table: a tree for each source, and one tree over the sources.

The nodes of a group are numbered; an aligned block of SIDE of them is one row that holds its level as one string, the hex
digests side by side. Fixed-width pieces of that string are hashed to the block's parents, and the pieces around a node are its
siblings; as digests have 64 letters, nothing is searched. What a block comes to is a node of the next round, which has SIDE
times fewer, until each group is one node. The way back hands every block the siblings above it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import materialise, partitions

#: Children of a node.
FAN = 16
#: Nodes of a block: two levels of runs.
SIDE = FAN * FAN
#: Letters of a digest.
HEX = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts, put together."""
    return F.sha2(F.concat(*[c.cast("binary") for c in parts]), 256)


def field_text(value: Column) -> Column:
    """A field of a leaf: '-' if null, else its length in bytes, a colon and its text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*fields: Column) -> Column:
    return digest(*[field_text(c) for c in fields])


def numbered(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """rows with `index`, the place from 0 of each row in its group by the order, and `m`, the rows of the group. Ranges of the order
    are numbered apart and moved by what lies before them, so a large group is no single task."""
    keys = [group, *order]
    placed = rows.repartitionByRange(partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys).withColumn("place", F.monotonically_increasing_id())
    placed = materialise(placed.select("*", F.shiftright("place", 33).alias("slot")), "placed")
    w = Window.partitionBy(group)
    held = placed.groupBy(group, "slot").agg(F.count("*").alias("n"), F.min("place").alias("low"))
    held = held.select(group, "slot", "low", (F.sum("n").over(w.orderBy("slot")) - F.col("n")).alias("before"), F.sum("n").over(w).alias("m"))
    return placed.join(held, [group, "slot"]).withColumn("index", F.col("place") - F.col("low") + F.col("before")).drop("place", "slot", "low", "before")


def _piece(level: str, first: Column, count: Column) -> Column:
    """So many digests of a level."""
    return F.substring(F.col(level), first * HEX + 1, count * HEX)


def _parents(level: str) -> Column:
    """The level above."""
    runs = F.ceil(F.octet_length(level) / (FAN * HEX)).cast("int")
    return F.array_join(F.transform(F.sequence(F.lit(0), runs - 1), lambda i: digest(_piece(level, i * FAN, F.lit(FAN)))), "").cast("binary")


def _siblings(level: str, at: Column) -> Column:
    """What stands left and right of a node in its run."""
    run = (at - at % FAN).cast("int")
    return F.struct(_piece(level, run, (at - run).cast("int")).alias("left"), _piece(level, at + 1, (run + FAN - 1 - at).cast("int")).alias("right"))


def _blocks(nodes: DataFrame, group: str, carried: list[str]) -> DataFrame:
    """(group, block, m, level0, level1, top, members) of nodes (group, index, m, hash, *carried): aligned blocks. Levels are the bytes of their
    letters, which Spark cuts without counting characters; level1 is null in a group of one node."""
    at = (F.col("index") % SIDE).cast("int").alias("at")
    rows = nodes.select(group, "m", F.expr(f"index div {SIDE}").alias("block"), F.struct(at, "hash", *carried).alias("x"))
    rows = rows.groupBy(group, "block").agg(F.max("m").alias("m"), F.array_sort(F.collect_list("x")).alias("x"))  # SIDE nodes at most
    rows = rows.withColumn("level0", F.array_join(F.transform("x", lambda x: x["hash"]), "").cast("binary"))
    rows = rows.withColumn("level1", F.when(F.col("m") > 1, _parents("level0")))
    top = F.when(F.col("m") > FAN, _parents("level1")).otherwise(F.coalesce("level1", "level0"))
    return rows.select(group, "block", "m", "level0", "level1", top.alias("top"), F.transform("x", lambda x: F.struct(x["at"].alias("at"), *[x[c].alias(c) for c in carried])).alias("members"))


def climb(nodes: DataFrame, group: str, carried: list[str]) -> tuple[DataFrame, list]:
    """nodes (group, index, m, hash, *carried) -> the groups' roots (group, hash), and the rounds for descend().

    While a group has several nodes, every FAN consecutive ones become one, a last run of one too; a group of one node is its
    own root. Each round writes its blocks to the shared folder.
    """
    rounds = []
    while True:
        blocks = materialise(_blocks(nodes, group, carried), "blocks")
        rounds.append((blocks, carried))
        if not blocks.where(f"m > {SIDE}").limit(1).count():
            return blocks.select(group, F.col("top").cast("string").alias("hash")), rounds
        nodes, carried = blocks.select(group, F.col("block").alias("index"), F.ceil(F.col("m") / SIDE).alias("m"), F.col("top").cast("string").alias("hash")), []


def descend(rounds: list, over: DataFrame, group: str) -> DataFrame:
    """The nodes (hash, *carried) with `above`, the (left, right) siblings from the node's level to the top, and what else over has.

    over: (group, above, ...), a row for each group: what stands above its root. Joins are by block, so no group is a hot key.
    """
    known = [c for c in over.columns if c not in (group, "above")]
    paths = over.withColumn("index", F.lit(0).cast("long"))
    for blocks, carried in reversed(rounds):
        upper = blocks.join(paths.select(group, F.col("index").alias("block"), F.col("above").alias("up"), *known), [group, "block"])
        rows = upper.select(group, "block", "m", "level0", "level1", "up", *known, F.explode("members").alias("x")).select(group, "block", "m", "level0", "level1", "up", *known, "x.*")
        first, second = _siblings("level0", F.col("at")), _siblings("level1", F.expr(f"at div {FAN}").cast("int"))
        above = F.when(F.col("m") > FAN, F.concat(F.array(first, second), "up")).when(F.col("m") > 1, F.concat(F.array(first), "up")).otherwise(F.col("up"))
        paths = rows.select(group, (F.col("block") * SIDE + F.col("at")).alias("index"), _piece("level0", F.col("at"), F.lit(1)).cast("string").alias("hash"), *carried, above.alias("above"), *known)
    return paths.drop(group, "index")


def fold(hash: Column, above: Column) -> Column:
    """The root that a node comes to with the siblings above it."""
    return F.aggregate(above, hash, lambda h, s: digest(s["left"], h, s["right"]))


def proof_text(above: Column) -> Column:
    """All siblings, level by level, left to right."""
    return F.array_join(F.transform(above, lambda s: F.concat(s["left"], s["right"]).cast("string")), "")


def manifest(docs: DataFrame, suspect: Column | None = None, tampered: Column | None = None) -> DataFrame:
    """documents -> (doc_id, leaf, subroot, root, above, changed), one row per input row; above: the siblings from the leaf to the root.

    leaf: digest of doc_id, source, lang, n_chars and text. Leaves of a source ascend by doc_id (null first, equal ids by digest) to its
    subroot, subroots by source (null first, by bytes) to the root. changed: where `suspect` holds, the leaf with `tampered` for
    its text; else null. Null and empty fields differ; repeated rows are leaves each; other columns are ignored; an empty table
    gives no rows. Writes tables to the shared folder when called.
    """
    source = F.col("source").cast("string")
    key = F.when(source.isNull(), F.lit(b"\x00")).otherwise(F.concat(F.lit(b"\x01"), source.cast("binary")))
    changed = F.when(suspect, leaf_digest(*[F.col(c) for c in FIELDS[:-1]], tampered)) if suspect is not None else F.lit(None).cast("string")
    leaves = docs.select(key.alias("g"), F.col("doc_id").alias("id"), F.unhex(leaf_digest(*map(F.col, FIELDS))).alias("hash"), F.unhex(changed).alias("changed"))
    leaves = numbered(materialise(leaves, "leaves"), "g", "id", "hash").withColumn("hash", F.lower(F.hex("hash")))
    subroots, rounds = climb(leaves, "g", ["id", "changed"])
    root, upper = climb(numbered(subroots.select(F.lit(0).alias("all"), "g", "hash"), "all", "g"), "all", ["g"])
    none = F.lit(None).cast("array<struct<left: binary, right: binary>>")
    over = descend(upper, root.select("all", F.coalesce(none, F.array()).alias("above"), F.col("hash").alias("root")), "all")
    rows = descend(rounds, over.withColumnRenamed("hash", "subroot"), "g")
    return rows.select(F.col("id").alias("doc_id"), F.col("hash").alias("leaf"), "subroot", "root", "above", F.lower(F.hex("changed")).alias("changed"))


def in_a_fifth(doc_id: Column) -> Column:
    """Whether 5 divides the CRC-32 of the id's decimal digits."""
    return F.crc32(doc_id.cast("string")) % 5 == 0


def lowered(text: Column) -> Column:
    """A-Z in lower case."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, letters, letters.lower())
