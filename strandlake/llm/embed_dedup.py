"""Near-duplicate vectors by sorted projection passes.

Each pass gives every vector the signs of random projections, puts the vectors of a label in lexicographic order of
these bits and compares each with the next `window` in that order. Pairs whose cosine, in double precision, reaches
the threshold are united across passes. Equal vectors are one from the start. The links of a vector are then counted
exactly within its component, tile by tile, so the window bounds no vector's number of links. The order of a label is cut
into blocks that each begin with the last `window` vectors of the one before, so no window ends at a cut. A label gets
more passes the larger it is, as passes_for works out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import connected_components
from .runs import runs
from .store import materialise, partitions

PASSES = 12
BITS = 32
WINDOW = 100
#: Share of the pairs at the threshold that some pass should compare, whatever the label's size.
RECALL = 0.995
#: Vectors of a block of a label's order, the window before it not counted.
BLOCK = 4096
#: Vectors of a component in a tile's side, on average.
TILE = 512


def passes_for(vectors: Column, crowding: Column, threshold: float, window: int, recall: float, least: int) -> Column:
    """Passes for a label of so many vectors; crowding: 1 less the squared distance of unit vectors from their mean, on average about their mean
    cosine; one deviation above that takes in the vectors that lie nearer to it.

    A pair at the threshold has, without the mean, the cosine r = 1 - (1 - threshold) / (1 - crowding), and equal signs in a projection with
    probability 1 - acos(r) / pi. Where it shares the log2(vectors / window) leading bits, about `window` vectors share them.
    """
    r = F.greatest(1 - (1 - threshold) / F.greatest(1 - crowding, F.lit(1e-9)), F.lit(-1.0))
    met = F.pow(1 - F.acos(r) / np.pi, F.log2(vectors / window))
    need = F.ceil(np.log1p(-recall) / F.log1p(-F.greatest(met, F.lit(1e-9))))
    return F.when((vectors <= window) | (met >= 1) | F.lit(recall <= 0), least).otherwise(F.least(F.greatest(need, F.lit(least)), F.lit(1 << 30))).cast("int")


def _usable(column: str) -> str:
    return f"label is not null and {column} is not null and size({column}) > 0 and not exists({column}, x -> x is null or isnan(x) or abs(x) = double('infinity')) and exists({column}, x -> x != 0)"


def _planes(dim: int, passes: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, passes * BITS))


def _units(binary: list[bytes], dim: int) -> np.ndarray:
    x = np.frombuffer(b"".join(binary), "<f8").reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


#: Means are summed as whole numbers of this fraction, so that they do not depend on the order of the sum.
UNIT = 1 << 24


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(numbers of all vectors, where each begins, how many it has)."""
    size = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy().astype("<f8"), np.cumsum(size) - size, size


def label_means(vectors: DataFrame, window: int) -> DataFrame:
    """(label, dim, n, mean) of labels with more than `window` vectors (label, dim, embedding): the mean of the unit vectors."""

    def add(batches):
        for batch in batches:
            flat, begin, sizes = _vectors(batch.column(1))
            labels = batch.column(0).to_numpy()
            for dim in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == dim)
                x = np.rint(_units([flat[a : a + dim].tobytes() for a in begin[rows].tolist()], dim) * UNIT).astype(np.int64)
                own, at = np.unique(labels[rows], return_inverse=True)
                sums = np.zeros((len(own), dim), np.int64)
                np.add.at(sums, at, x)
                yield pa.record_batch([pa.array(own), pa.array(np.full(len(own), dim, np.int32)), pa.array(np.bincount(at)), pa.array(list(sums), pa.list_(pa.int64()))], names=["label", "dim", "n", "sums"])

    large = vectors.groupBy("label", "dim").count().where(F.col("count") > window).drop("count")
    rows = vectors.join(large, ["label", "dim"], "left_semi").select("label", "embedding")
    parts = rows.mapInArrow(add, "label long, dim int, n long, sums array<long>")
    each = parts.select("label", "dim", "n", F.posexplode("sums").alias("at", "x")).groupBy("label", "dim", "at").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    mean = F.transform(F.array_sort(F.collect_list(F.struct("at", "x", "n"))), lambda v: v["x"] / (v["n"] * UNIT))
    return each.groupBy("label", "dim").agg(F.max("n").alias("n"), mean.alias("mean"))


def crowding(vectors: DataFrame, means: DataFrame) -> DataFrame:
    """means with crowding: the squared length of the mean and one deviation of the vectors' squared distances from it."""
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
    near = vectors.join(means, ["label", "dim"]).select("label", "dim", F.round(dot("embedding", "mean") / F.sqrt(dot("embedding", "embedding")) * (1 << 20)).cast("long").alias("q"))
    sums = near.groupBy("label", "dim").agg(F.sum("q").alias("one"), F.sum(F.col("q").cast("decimal(20,0)") * F.col("q")).cast("double").alias("two"))
    variance = F.greatest(F.col("two") / F.col("n") - F.pow(F.col("one") / F.col("n"), F.lit(2)), F.lit(0.0))
    return means.join(sums, ["label", "dim"]).withColumn("crowding", dot("mean", "mean") + 2 * F.sqrt(variance) / (1 << 20)).drop("one", "two")


def project(x: np.ndarray, means: np.ndarray, passes: int, seed: int) -> np.ndarray:
    """Keys of unit vectors in each pass: the signs of their projections without the mean, first bit highest."""
    bits = (x - means) @ _planes(x.shape[1], passes, seed) > 0
    return bits.reshape(len(x), passes, BITS) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def _keys(vectors: DataFrame, seed: int) -> DataFrame:
    """(pass, label, dim, key, id, vec): a row for each vector and each of its label's passes; a null mean is 0."""

    def each(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 2000):
                part = batch.slice(k, 2000)
                flat, begin, sizes = _vectors(part.column(2))
                means, mean_at, mean_size = _vectors(part.column(4).fill_null([]))
                wanted = part.column(3).to_numpy()
                for dim, passes in np.unique(np.column_stack([sizes, wanted]), axis=0).tolist():
                    rows = np.flatnonzero((sizes == dim) & (wanted == passes))
                    vec = [flat[a : a + dim].tobytes() for a in begin[rows].tolist()]
                    mean = np.zeros((len(rows), dim))
                    told = mean_size[rows] == dim
                    mean[told] = means[mean_at[rows[told]][:, None] + np.arange(dim)]
                    keys = project(_units(vec, dim), mean, passes, seed)
                    for p in range(passes):
                        yield pa.record_batch([pa.array(np.full(len(rows), p, np.int32)), part.column(0).take(pa.array(rows)), pa.array(np.full(len(rows), dim, np.int32)), pa.array(keys[:, p]), part.column(1).take(pa.array(rows)), pa.array(vec, pa.binary())], names=["pass", "label", "dim", "key", "id", "vec"])

    return vectors.select(F.col("label").cast("long").alias("label"), "id", F.col("embedding").cast("array<double>").alias("embedding"), F.col("passes").cast("int").alias("passes"), "mean").mapInArrow(each, "pass int, label long, dim int, key long, id long, vec binary")


def _blocks(keys: DataFrame, window: int) -> DataFrame:
    """(pass, label, dim, block, rank, id): the order of each pass and label in blocks; ranks below block * size are the window before."""
    size = max(BLOCK, window)
    group, order = ["pass", "label", "dim"], ["pass", "label", "dim", "key", "id"]

    def number(batches):
        import pyarrow.compute as pc
        from pyspark import TaskContext

        part, last, at = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in group]
            new = np.zeros(n, bool)
            for c in columns:
                new[1:] |= c[1:] != c[:-1]
            heads = np.concatenate([[0], np.flatnonzero(new)])
            first = np.arange(n) - np.repeat(heads, np.diff(np.append(heads, n)))
            if tuple(c[0] for c in columns) == last:
                first[: heads[1] if len(heads) > 1 else n] += at
            last, at = tuple(c[-1] for c in columns), int(first[-1]) + 1
            yield pa.record_batch([*[batch.column(k) for k in group], batch.column("id"), pa.array(np.full(n, part, np.int32)), pc.cast(pa.array(first), pa.int64())], names=[*group, "id", "part", "at"])

    slim = keys.select(*order).repartitionByRange(partitions(keys.sparkSession), *order).sortWithinPartitions(*order)
    placed = materialise(slim.mapInArrow(number, "pass int, label long, dim int, id long, part int, at long"), "order")
    counts = placed.groupBy(*group, "part").agg(F.count("*").alias("n"))
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    # A row for each range that goes on with the group of the range before: fewer than there are ranges.
    before = before.where("before > 0").select(*group, "part", "before")
    ranked = placed.join(F.broadcast(before), [*group, "part"], "left").withColumn("rank", F.col("at") + F.coalesce("before", F.lit(0)))
    own = F.expr(f"rank div {size}")
    both = F.when(F.col("rank") % size >= size - window, F.array(own, own + 1)).otherwise(F.array(own))
    return ranked.select(*group, F.explode(both).alias("block"), "rank", "id")


def _window_links(vectors: DataFrame, keys: DataFrame, threshold: float, window: int) -> DataFrame:
    """Links within the windows, as a forest per block: (a, b). vectors: (id, vec)."""

    def scan(batches):
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        def compare(old_ids, old, ids, new) -> tuple[list, list]:
            """new rows among themselves and with the `window` old rows before them."""
            a, b = [], []
            every_ids, every = np.concatenate([old_ids, ids]), np.concatenate([old, new])
            for k in range(len(old), len(every), 256):
                low, high = max(0, k - window), min(k + 256, len(every))
                good = every[k:high] @ every[low:high].T >= threshold
                i, j = np.nonzero(good)
                gap = (i + k) - (j + low)
                for x, y in zip(every_ids[i + k][near := (gap > 0) & (gap <= window)].tolist(), every_ids[j + low][near].tolist(), strict=True):
                    if (r := root(x)) != (s := root(y)):
                        parent[max(r, s)] = min(r, s)
                        a.append(x)
                        b.append(y)
            return a, b

        group, old_ids, old = None, None, None
        for batch in batches:
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in ("pass", "label", "dim", "block")]
            new = np.zeros(batch.num_rows, bool)
            for c in columns:
                new[1:] |= c[1:] != c[:-1]
            cuts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
            out_a, out_b = [], []
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                if s == e:
                    continue
                key = tuple(c[s] for c in columns)
                ids = batch.column("id").slice(s, e - s).to_numpy()
                x = _units(batch.column("vec").slice(s, e - s).to_pylist(), int(key[2]))
                if key != group:
                    group, old_ids, old = key, ids[:0], x[:0]
                    parent.clear()
                a, b = compare(old_ids, old, ids, x)
                out_a += a
                out_b += b
                old_ids, old = np.concatenate([old_ids, ids])[-window:], np.concatenate([old, x])[-window:]
            yield pa.record_batch([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])

    block = ["pass", "label", "dim", "block"]
    dealt = _blocks(keys, window).join(vectors, "id").select(*block, "rank", "id", "vec")
    return dealt.repartition(partitions(keys.sparkSession), *block).sortWithinPartitions(*block, "rank").mapInArrow(scan, "a long, b long")


def _tiles(members: DataFrame) -> DataFrame:
    """(c, i, j, ...): the members of each group c in blocks of about TILE, two blocks to a tile, so no pair is ever a row."""
    sizes = members.groupBy("c").agg(F.ceil(F.count("*") / TILE).alias("blocks"))
    dealt = members.join(sizes, "c").withColumn("block", F.pmod(F.xxhash64("id"), "blocks")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.select("c", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "dim", "id", "times", "block", "vec")
    return dealt.repartition("c", "i", "j").sortWithinPartitions("c", "i", "j")


def _compared(run: pa.RecordBatch, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, columns, whether they link) of a tile; a block with itself has no diagonal."""
    x = _units(run.column("vec").to_pylist(), run.column("dim")[0].as_py())
    block, i, j = run.column("block").to_numpy(), run.column("i")[0].as_py(), run.column("j")[0].as_py()
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    good = x[left] @ x[right].T >= threshold
    if i == j:
        np.fill_diagonal(good, False)
    return left, right, good


def _tile_links(members: DataFrame, threshold: float) -> DataFrame:
    """(a, b): a forest of the links of each tile."""

    def tile(batches):
        for run in runs(batches, ["c", "i", "j"]):
            left, right, good = _compared(run, threshold)
            ids, parent = run.column("id").to_numpy(), {}

            def root(x: int) -> int:
                while parent.setdefault(x, x) != x:  # noqa: B023
                    parent[x] = x = parent[parent[x]]  # noqa: B023
                return x

            a, b = [], []
            for x, y in zip(*(ids[k[n]].tolist() for k, n in zip((left, right), np.nonzero(good), strict=True)), strict=True):
                if (r := root(x)) != (s := root(y)):
                    parent[max(r, s)] = min(r, s)
                    a.append(x)
                    b.append(y)
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return _tiles(members).mapInArrow(tile, "a long, b long")


def _link_counts(members: DataFrame, threshold: float) -> DataFrame:
    """(c, dim, id, times, vec) -> (id, n): the copies of other members of c within the threshold."""

    def tile(batches):
        for run in runs(batches, ["c", "i", "j"]):
            left, right, good = _compared(run, threshold)
            times, n = run.column("times").to_numpy(), np.zeros(run.num_rows, np.int64)
            n[left] = good @ times[right]
            if run.column("i")[0].as_py() != run.column("j")[0].as_py():
                n[right] = times[left] @ good
            yield pa.record_batch([run.column("id"), pa.array(n)], names=["id", "n"])

    return _tiles(members).mapInArrow(tile, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def dedup_embeddings(embeddings: DataFrame, threshold: float = 0.93, passes: int = PASSES, window: int = WINDOW, seed: int = 3, recall: float = RECALL) -> DataFrame:
    """embeddings -> (vec_id, n_links, component_id, kept), one row per input row.

    Vectors link when their labels are equal and not null and their cosine is at least the threshold. A vector that is
    null, empty, zero or holds a null or non-finite number, or whose label is null, links with nothing. Vectors of
    different lengths are not compared. Equal vectors link with one another; repeated rows are vectors each. Other
    columns are ignored; an empty table gives no rows. component_id: smallest vec_id reachable; kept: it is one's own.
    passes: at least so many for every label, more where a label's size and crowding ask for them to reach `recall`; recall=0 leaves it
    at passes. Writes tables to the shared folder when called.
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.withColumn("embedding", F.expr(f"if({_usable('embedding')}, embedding, null)"))
    rows = rows.withColumn("key", F.when(F.col("embedding").isNotNull(), F.sha2(F.concat_ws(",", F.col("label").cast("string"), F.transform("embedding", lambda x: F.hex(x.cast("string")))), 256)))
    rows = materialise(rows, "vectors")
    distinct = materialise(rows.where("key is not null").groupBy("key").agg(F.min("vec_id").alias("id"), F.count("*").alias("times"), F.first("label").alias("label"), F.first("embedding").alias("embedding")), "distinct")
    distinct = distinct.withColumn("dim", F.size("embedding"))
    means = crowding(distinct, materialise(label_means(distinct, window), "means"))
    means = means.withColumn("need", passes_for(F.col("n"), F.col("crowding"), threshold, window, recall, passes))
    # So many passes compare as many pairs as there are.
    means = means.withColumn("paired", (F.col("need") > passes) & (F.col("need") * 2 * window > F.col("n")))
    means = materialise(means.select("label", "dim", "mean", "need", "paired"), "means")
    dealt = distinct.join(means, ["label", "dim"], "left").withColumn("passes", F.coalesce("need", F.lit(passes)))
    pack = _keys(distinct.withColumns({"passes": F.lit(1), "mean": F.lit(None).cast("array<double>")}), seed).select("id", "label", "dim", "vec")
    links = _window_links(pack.select("id", "vec"), _keys(dealt.where("not coalesce(paired, false)"), seed), threshold, window)
    every = pack.join(means.where("paired"), ["label", "dim"], "left_semi").select(F.concat_ws(" ", "label", "dim").alias("c"), "dim", "id", F.lit(1).cast("long").alias("times"), "vec")
    links = links.unionByName(_tile_links(every, threshold))
    found = connected_components(links)
    members = found.join(pack, "id").join(distinct.select("id", "times"), "id").select(F.col("component").alias("c"), "dim", "id", "times", "vec")
    counts = _link_counts(members, threshold)
    known = distinct.select("key", "id", "times").join(found, "id", "left").join(counts, "id", "left").select("key", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n"), F.coalesce("component", "id").alias("c"))
    out = rows.join(known, "key", "left").select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("c", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
