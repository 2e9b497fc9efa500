"""Jaccard join of documents on word shingles, by rare-first prefix filtering.

Shingles are ordered by how often they occur, rarest first (counts come from a table of hashed counters, which only
affects speed: any common order is right). Two sets of Jaccard t or more share a shingle within their first
n - ceil(t n) + 1, so sets meet in the list of a prefix shingle. Documents with equal sets are one class from the start.

A pair passes the length and positional filters where it meets, then the suffix filter, then it is compared in full;
a pair that was compared is never compared again. The suffix filter splits both sets by the same fixed pivots, CELLS
ranges of the hash order: the sizes of the ranges differ by no more than the sets do, and only these sizes travel.

Short lists give their pairs at once. Only the components of the links are asked for, so pairs of long lists whose
classes other links already join are not compared: first neighbours within blocks of a list are, then, in lists that
still hold several components, blocks with blocks, leaving out two blocks of one component. No task holds a long list.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import connected_components
from .runs import runs, tidy
from .store import materialise, partitions
from .words import mix, shingle_sets, slices

SKETCH_BITS = 22
SKETCH_PARTS = 64
#: Entries by the counters of a list that one task sorts; a longer list is dealt to several.
HOT = 50_000
FLUSH = 200_000
#: Entries of a list all of whose pairs are tried at once.
SHORT = 32
#: Entries of a block of a long list.
BLOCK = 256
#: Entries among which a neighbour round orders a long list.
REACH = 1000
NEIGHBOUR_ROUNDS = 2
CELLS = 256
SALTS = 16
#: Keys of the sets that a task remembers having sent, so that copies are sent once.
SEEN = 100_000


def _set_key(s: np.ndarray) -> int:
    """63-bit key of a sorted set."""
    with np.errstate(over="ignore"):
        h = mix(np.array([np.bitwise_xor.reduce(mix(s)) + s.sum(dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(len(s))], np.uint64))
    return int(h[0] >> np.uint64(1))


def _profiles(docs: DataFrame, n: int) -> DataFrame:
    """One pass: (part = -1, doc_id, n, k) per document and (part >= 0, blob) per slice of a task's counters."""

    @tidy
    def measure(batches):
        size = 1 << SKETCH_BITS
        counts, waiting, held = np.zeros(size, np.uint32), [], 0

        def drain():
            nonlocal counts, waiting, held
            if waiting:
                counts += np.bincount(np.concatenate(waiting), minlength=size).astype(np.uint32)
                waiting, held = [], 0

        for batch in batches:
            for a, b in slices(batch.column(1)):
                sets = shingle_sets(batch.column(1)[a:b], n)
                yield pa.record_batch([pa.array([-1] * (b - a), pa.int32()), batch.column(0)[a:b], pa.array([len(s) for s in sets], pa.int64()), pa.array([_set_key(s) if len(s) else 0 for s in sets], pa.int64()), pa.nulls(b - a, pa.binary())], names=["part", "doc_id", "n", "k", "blob"])
                for s in sets:
                    waiting.append((s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64))
                    held += len(s)
                if held > 1_000_000:
                    drain()
        drain()
        if counts.any():
            blobs = [zlib.compress(x.tobytes(), 1) for x in counts.reshape(SKETCH_PARTS, -1)]
            yield pa.record_batch([pa.array(range(SKETCH_PARTS), pa.int32()), pa.nulls(SKETCH_PARTS, pa.int64()), pa.nulls(SKETCH_PARTS, pa.int64()), pa.nulls(SKETCH_PARTS, pa.int64()), pa.array(blobs, pa.binary())], names=["part", "doc_id", "n", "k", "blob"])

    return materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(measure, "part int, doc_id long, n long, k long, blob binary"), "profiles")


def _sketch(profiles: DataFrame) -> np.ndarray:
    """Sums the tasks' counters; what reaches the driver has a fixed size."""

    def add(batches):
        for run in runs(batches, ["part"]):
            total = np.zeros((1 << SKETCH_BITS) // SKETCH_PARTS, np.int64)
            for blob in run.column(1).to_pylist():
                total += np.frombuffer(zlib.decompress(blob), np.uint32)
            yield pa.record_batch([run.column(0)[:1], pa.array([zlib.compress(np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes(), 1)])], names=["part", "blob"])

    parts = profiles.where("part >= 0").select("part", "blob").repartition("part").sortWithinPartitions("part").mapInArrow(add, "part int, blob binary")
    out = np.zeros((SKETCH_PARTS, (1 << SKETCH_BITS) // SKETCH_PARTS), np.uint32)
    for row in parts.collect():
        out[row["part"]] = np.frombuffer(zlib.decompress(row["blob"]), np.uint32)
    return out.reshape(-1)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _may(an, ap, bn, bp, percent: int):
    """Length and positional filters on numpy arrays of entries that meet in their first common shingle, if they link."""
    least = -(-percent * (an + bn) // (100 + percent))
    return (100 * np.minimum(an, bn) >= percent * np.maximum(an, bn)) & (1 + np.minimum(an - ap - 1, bn - bp - 1) >= least)


def _distinct_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a, b = np.maximum(a, b), np.minimum(a, b)
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[: len(a)]
    return a[new], b[new]


MEETINGS = "a long, b long, h long, n int, pos int"


def _meetings(docs: DataFrame, sketch: np.ndarray, n: int, percent: int) -> DataFrame:
    """(a, b): pairs of classes that meet in a short list and pass the filters there; (a, h, n, pos), with no b: entries of
    long lists."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(sketch)  # of fixed size
    # Counters of many shingles are high without any hot list: what is hot stands above them.
    hot = max(HOT, 4 * int(sketch.mean(dtype=np.float64)))

    def parts_of(h: np.ndarray) -> np.ndarray:
        return shared.value[(h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.int64) // hot + 1

    @tidy
    def emit(batches):
        counts = shared.value
        h, k, pos, size, held, seen = [], [], [], [], 0, set()

        def flush() -> pa.RecordBatch:
            hashes, keys = np.concatenate(h), np.concatenate(k)
            deal = mix(keys.astype(np.uint64)) % parts_of(hashes).astype(np.uint64)
            place = np.concatenate(size) << 32 | np.concatenate(pos)
            return pa.record_batch([pa.array(hashes.view(np.int64)), pa.array(deal.astype(np.int32)), pa.array(keys), pa.array(place)], names=["h", "deal", "k", "place"])

        for batch in batches:
            for a, b in slices(batch.column(0)):
                for s in shingle_sets(batch.column(0)[a:b], n):
                    if not len(s) or (key := _set_key(s)) in seen:
                        continue
                    if len(seen) < SEEN:
                        seen.add(key)
                    m = prefix_length(len(s), percent)
                    h.append(s[np.argsort(counts[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], kind="stable")[:m]])
                    k.append(np.full(m, key, np.int64))
                    pos.append(np.arange(m))
                    size.append(np.full(m, len(s)))
                    held += m
                if held > FLUSH:
                    yield flush()
                    h, k, pos, size, held = [], [], [], [], 0
        if held:
            yield flush()

    def rows(a, b, h, size, pos) -> pa.RecordBatch:
        none = pa.nulls(len(a), pa.int64())
        return pa.record_batch([pa.array(a), none if b is None else pa.array(b), none if h is None else pa.array(h), *[pa.nulls(len(a), pa.int32()) if x is None else pa.array(x.astype(np.int32)) for x in (size, pos)]], names=["a", "b", "h", "n", "pos"])

    @tidy
    def meet(batches):
        kept = [np.zeros(0, np.int64) for _ in range(4)]  # the list at the end of a batch, which may go on
        long = None  # (h, deal, last k) of a long list that was sent so far as it is known

        def done(h, deal, k, place, last: bool):
            """Batches of the lists that are complete, and what is left."""
            nonlocal long
            fresh = np.append(True, (h[1:] != h[:-1]) | (deal[1:] != deal[:-1]) | (k[1:] != k[:-1]))[: len(h)]
            h, deal, k, place = h[fresh], deal[fresh], k[fresh], place[fresh]
            size, pos = place >> 32, place & 0xFFFFFFFF
            if not len(h):
                return [], [h, deal, k, place]
            heads = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (deal[1:] != deal[:-1])))
            count = np.diff(np.append(heads, len(h)))
            goes_on = np.zeros(len(heads), bool)
            goes_on[0] = long is not None and long[:2] == (h[0], deal[0])
            extended = (count > SHORT) | goes_on | (parts_of(h[heads].view(np.uint64)) > 1)
            keep_from = len(h)
            if not last:
                if extended[-1]:
                    long = (h[-1], deal[-1], k[-1])
                else:
                    keep_from, long = heads[-1], None
            each, group = np.repeat(extended, count), np.repeat(np.arange(len(heads)), count)
            some = each.copy()
            if goes_on[0] and before is not None and k[0] == before:
                some[0] = False  # a repeat over the border of batches
            out = [rows(k[some], None, h[some], size[some], pos[some])] if some.any() else []
            pairs = []
            for gap in range(1, SHORT):
                i = np.flatnonzero((group[gap:] == group[:-gap]) & ~each[gap:] & (np.arange(gap, len(h)) < keep_from))
                if not len(i):
                    break
                i = i[_may(size[i], pos[i], size[i + gap], pos[i + gap], percent)]
                pairs.append((k[i], k[i + gap]))
            if pairs:
                out.append(rows(*_distinct_pairs(*(np.concatenate(x) for x in zip(*pairs, strict=True))), None, None, None))
            return out, [x[keep_from:] for x in (h, deal, k, place)]

        for batch in batches:
            before = long[2] if long else None
            out, kept = done(*(np.concatenate([old, new.to_numpy().astype(np.int64)]) for old, new in zip(kept, batch.columns, strict=True)), False)
            yield from out
        if len(kept[0]):
            before = long[2] if long else None
            yield from done(*kept, True)[0]

    sent = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(emit, "h long, deal int, k long, place long")
    lists = sent.repartition(partitions(spark), "h", "deal").sortWithinPartitions("h", "deal", "k").mapInArrow(meet, MEETINGS)
    return materialise(lists, "meetings")


def _signed_texts(docs: DataFrame, classes: DataFrame, n: int) -> DataFrame:
    """(k, n, sign, text): a whole text of some classes and the sizes of its set's ranges. Texts are smaller than their sets."""

    @tidy
    def build(batches):
        for batch in batches:
            for a, b in slices(batch.column(1)):
                sets = shingle_sets(batch.column(1)[a:b], n)
                signs = [np.bincount((s >> np.uint64(56)).astype(np.int64), minlength=CELLS).astype(np.uint8).tobytes() for s in sets]  # modulo 256
                own = np.array([_set_key(s) for s in sets], np.int64)
                rows = pa.record_batch([pa.array(own), pa.array([len(s) for s in sets], pa.int32()), pa.array(signs, pa.binary()), batch.column(1)[a:b]], names=["k", "n", "sign", "text"])
                yield rows.filter(pa.array(own == batch.column(0)[a:b].to_numpy()))

    texts = docs.select(F.col("doc_id").cast("long").alias("first_id"), F.col("text").cast("string").alias("text"))
    # Rows may share a doc_id: equal ones count once, and build leaves out texts of another class.
    met = classes.join(texts, "first_id").groupBy("first_id", "k", F.xxhash64("text")).agg(F.first("text").alias("text"))
    return materialise(met.select("k", "text").mapInArrow(build, "k long, n int, sign binary, text string"), "texts")


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least symmetric difference of sets by the sizes (modulo 256) of their ranges."""
    gap = np.abs(a.astype(np.int16) - b)
    return np.minimum(gap, 256 - gap).sum(-1)


def _signs(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, CELLS)


class _Verifier:
    """Links among pairs of classes; remembers the pairs that it compared."""

    def __init__(self, texts: DataFrame, n: int, percent: int):
        self.texts, self.n, self.percent, self.tried = texts, n, percent, None

    def links(self, pairs: DataFrame, filtered: bool = False) -> DataFrame:
        """The pairs (a, b), not compared before, with 100 * intersection >= percent * union over whole sets."""
        n, percent, texts = self.n, self.percent, self.texts

        @tidy
        def suffix(batches):
            for batch in batches:
                for k in range(0, batch.num_rows, 20_000):
                    part = batch.slice(k, 20_000)
                    apart = _apart(_signs(part.column("asign")), _signs(part.column("bsign")))
                    both = part.column("an").to_numpy().astype(np.int64) + part.column("bn").to_numpy()
                    yield part.select(["a", "b"]).filter(pa.array((100 + percent) * apart <= (100 - percent) * both))

        @tidy
        def compare(batches):
            for batch in batches:
                for i, j in slices(batch.column(2)):
                    good = []
                    for u, v in zip(shingle_sets(batch.column(2)[i:j], n), shingle_sets(batch.column(3)[i:j], n), strict=True):
                        both = len(u) + len(v) - len(np.union1d(u, v))
                        good.append(100 * both >= percent * (len(u) + len(v) - both))
                    yield pa.record_batch([batch.column(0)[i:j], batch.column(1)[i:j]], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

        if self.tried is not None:
            pairs = pairs.join(self.tried, ["a", "b"], "left_anti")
        if not filtered:
            left, right = (texts.select(F.col("k").alias(x), F.col("n").alias(f"{x}n"), F.col("sign").alias(f"{x}sign")) for x in "ab")
            pairs = pairs.join(left, "a").join(right, "b").mapInArrow(suffix, "a long, b long")
        likely = materialise(pairs.select("a", "b"), "pairs")
        self.tried = likely if self.tried is None else self.tried.unionByName(likely)
        used = texts.select("k", "text").join(likely.select(F.explode(F.array("a", "b")).alias("k")).distinct(), "k", "left_semi")
        left, right = (used.select(F.col("k").alias(x), F.col("text").alias("t" + x)) for x in "ab")
        return likely.join(left, "a").join(right, "b").select("a", "b", "ta", "tb").mapInArrow(compare, "a long, b long")


def _mixed(lists: DataFrame, found: DataFrame) -> DataFrame:
    """The entries of lists that hold several components, with the component c of each. Components only grow, so a list
    that holds one stays out."""
    placed = lists.drop("c").join(found.withColumnRenamed("id", "k"), "k", "left").withColumn("c", F.coalesce("component", "k")).drop("component")
    several = placed.groupBy("h").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.count("*").alias("size")).where("low < high").select("h", "size")
    return materialise(placed.drop("size").join(several, "h"), "lists")


def _neighbours(lists: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs (a, b) of neighbours in blocks of the lists. Turn 0 has one order for all lists, so lists of the same sets give
    the same pairs; others an order and blocks that differ from list to list."""
    # Entries far down their sets seldom pass the positional filter: they come last, so the others are neighbours.
    late = F.col("pos") * (100 + percent) > F.col("n") * (100 - percent)
    size = F.lit(0) if turn % 2 else F.col("n")
    draw = F.xxhash64("k", "h", F.lit(turn)) if turn else F.xxhash64("k")
    dealt = lists.withColumn("part", F.pmod(draw, F.ceil(F.col("size") / REACH)))
    order = Window.partitionBy("h", "part").orderBy(late, size, draw)
    near = dealt.select(*[F.col(x).alias("a" + x) for x in ("k", "pos", "n", "c")], *[F.lag(x).over(order).alias("b" + x) for x in ("k", "pos", "n", "c")])
    least = f"ceil({percent} * (an + bn) / {100.0 + percent})"
    may = f"100 * least(an, bn) >= {percent} * greatest(an, bn) and 1 + least(an - apos - 1, bn - bpos - 1) >= {least}"
    return near.where("bk is not null and ac != bc").where(may).select(F.greatest("ak", "bk").alias("a"), F.least("ak", "bk").alias("b")).distinct()


def _across(lists: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) of the lists' entries in different components that pass the filters. A component with a block's
    entries or more in a list has blocks of its own there; a task compares two blocks."""

    @tidy
    def compare(batches):
        for run in runs(batches, ["h", "xg", "xi", "yg", "yi"]):
            k, c, size, pos, side = (run.column(x).to_numpy() for x in ("k", "c", "n", "pos", "side"))
            size, pos, sign = size.astype(np.int64), pos.astype(np.int64), _signs(run.column("sign"))
            one = [run.column(x)[0].as_py() for x in ("xg", "xi")] == [run.column(y)[0].as_py() for y in ("yg", "yi")]
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side == (0 if one else 1))
            out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for i in left.tolist():
                j = right[(c[right] != c[i]) & _may(size[i], pos[i], size[right], pos[right], percent)]
                j = j[(100 + percent) * _apart(sign[i], sign[j]) <= (100 - percent) * (size[i] + size[j])]
                out_a.append(np.full(len(j), k[i]))
                out_b.append(k[j])
            a, b = _distinct_pairs(np.concatenate(out_a), np.concatenate(out_b))
            yield pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

    each = lists.groupBy("h", "c").agg(F.count("*").alias("s"))
    rest = each.groupBy("h").agg(F.sum(F.when(F.col("s") < BLOCK, F.col("s"))).alias("rest"))
    own = F.col("s") >= BLOCK
    # A large component in a list would be a hot key, so its row is there SALTS times.
    salted = each.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    dealt = lists.withColumn("salt", F.pmod(F.xxhash64("k"), F.lit(SALTS).cast("long"))).join(salted, ["h", "c", "salt"]).drop("salt").join(rest, "h")
    dealt = dealt.withColumns({"g": F.when(own, F.col("c")).otherwise(-1), "i": F.when(own, F.pmod(F.xxhash64("k"), F.ceil(F.col("s") / BLOCK))).otherwise(F.pmod(F.xxhash64("c"), F.ceil(F.col("rest") / BLOCK)))})
    dealt = materialise(dealt.select("h", "g", "i", "k", "c", "n", "pos"), "dealt")
    blocks = dealt.groupBy("h", "g", "i").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    x, y = (blocks.select("h", *[F.col(v).alias(u + v) for v in ("g", "i", "low", "high")]) for u in "xy")
    met = x.join(y, "h").where("(xg < yg or (xg = yg and xi <= yi)) and not (xg = yg and xg >= 0)")
    met = met.where(f"100 * xhigh >= {percent} * ylow and 100 * yhigh >= {percent} * xlow").select(F.col("h").alias("list"), "xg", "xi", "yg", "yi")
    met, dealt = materialise(met, "blocks"), dealt.join(texts.select("k", "sign"), "k")
    within = lambda side: (F.col("h") == F.col("list")) & (F.col("g") == F.col(side + "g")) & (F.col("i") == F.col(side + "i"))
    left = dealt.join(met, within("x")).withColumn("side", F.lit(0))
    right = dealt.join(met.where("not (xg = yg and xi = yi)"), within("y")).withColumn("side", F.lit(1))
    key = ["h", "xg", "xi", "yg", "yi"]
    both = left.unionByName(right).repartition(partitions(lists.sparkSession), *key).sortWithinPartitions(*key)
    return both.mapInArrow(compare, "a long, b long").distinct()


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """documents -> (doc_id, n_shingles, component_id), one row per input row.

    A document's set holds its distinct n-word shingles (A-Z lower-cased words); with fewer words, the whole sequence
    as one. Without words, or with a null text, the set is empty and the document is a component of its own. Two
    documents link when 100 * intersection >= percent * union. Repeated rows fall into one class. A null doc_id names no
    component, and a class of rows that all have none links with no other; other columns are ignored; an empty table
    gives no rows. Writes tables to the shared folder when called.
    """
    profiles = _profiles(docs, n)
    own = profiles.where("part = -1").select("doc_id", "n", "k")
    classes = materialise(own.where("n > 0").groupBy("k").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies")), "classes")
    met = _meetings(docs, _sketch(profiles), n, percent)
    pairs, lists = met.where("b is not null").select("a", "b").distinct(), met.where("b is null").select("h", F.col("a").alias("k"), "n", "pos")
    needed = met.select(F.explode(F.array_compact(F.array("a", "b"))).alias("k")).distinct()
    texts = _signed_texts(docs, classes.join(needed, "k").where("first_id is not null").select("k", "first_id"), n)

    verifier = _Verifier(texts, n, percent)
    found = connected_components(verifier.links(pairs))
    for turn in range(NEIGHBOUR_ROUNDS + 1):
        if lists.isEmpty() or (lists := _mixed(lists, found)).isEmpty():
            break  # every list is of one component
        fresh = verifier.links(_neighbours(lists, turn, percent)) if turn < NEIGHBOUR_ROUNDS else verifier.links(_across(lists, texts, percent), filtered=True)
        found = connected_components(fresh.unionByName(found.select(F.col("id").alias("a"), F.col("component").alias("b"))))

    named = classes.join(found.withColumnRenamed("id", "k"), "k").groupBy("component").agg(F.min("first_id").alias("least"))
    label = found.join(named, "component").select(F.col("id").alias("k"), "least")
    each = materialise(classes.join(label, "k", "left").select("k", "copies", F.coalesce("least", "first_id").alias("least")), "named")
    # Classes with a thousandth of all rows or more, a thousand at most, would be hot keys.
    large = F.broadcast(each.where(F.col("copies") * 1000 >= own.count()).select("k", "least"))
    joined = own.join(large, "k").unionByName(own.join(large, "k", "left_anti").join(each.select("k", "least"), "k", "left"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The documents, all columns, that are the smallest of their component. doc_id is a key: of rows that share one, the one
    with the smallest text stays (null first, then by a hash of the other columns). Rows with a null doc_id cannot be
    named and stay as they are. Nulls, empty texts and empty tables as in jaccard_components."""
    named = docs.where("doc_id is not null")
    kept = jaccard_components(named, n, percent).where("doc_id = component_id").select("doc_id").distinct()
    order = Window.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_first(), F.xxhash64(*docs.columns))
    stay = named.join(kept, "doc_id", "left_semi").select("*", F.row_number().over(order).alias("row number of a doc_id")).where(F.col("row number of a doc_id") == 1)
    return stay.select(*docs.columns).unionByName(docs.where("doc_id is null"))
