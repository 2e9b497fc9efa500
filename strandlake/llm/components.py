"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .store import materialise


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges, written, and a digest of them that is taken while they are written: (number, sum, hash)."""
    seen = Observation()
    out = materialise(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.pmod("a", F.lit(1_000_003))).alias("s"), F.expr("bit_xor(xxhash64(a, b))").alias("x")), "links")
    return out, tuple(seen.get.get(k) for k in ("n", "s", "x"))


def _named(stars: DataFrame) -> DataFrame:
    """Every id with its component, the smallest id with itself."""
    least = stars.select(F.col("b").alias("id")).distinct()
    return stars.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(least.withColumn("component", F.col("id")))


def connected_components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(a, b) links of longs -> (id, component) for every id that has a link to another; component is the smallest id reachable.

    Each round hangs neighbours on their smallest neighbour (large star, then small star) and writes the
    contracted links to the shared folder. A node of a huge group is only ever a join key, which Spark's skew join
    can split. Nulls, loops and repeated links are ignored. Ends when a round changes nothing. Joins are merge joins whatever
    the size: tables of some rounds would else be broadcast a hundred times, by a driver's thread and through its memory each.
    """
    e = links.where("a is not null and b is not null and a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e, before = _written(e)
    if not before[0]:
        return _named(e)
    for _ in range(most_rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        large = both.join(low.hint("merge"), "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low.hint("merge"), "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e, now = _written(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        if now == before:
            return _named(e)
        before = now
    raise RuntimeError("components did not settle")
