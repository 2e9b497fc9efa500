"""Which filter removes what, in every order of the filters, from sorted posting lists.

Rows of a part are numbered within ranges of ids; each filter keeps the sorted numbers of the rows that fail it. In a range,
the union of the lists of each set of filters comes from that of the set without its last filter by a galloping merge: the
entries of the shorter list are searched in the longer, those not there go in. Only sizes leave a range, and sums over
ranges are sizes over the part: what a step removes is the union with its filter less the union without.
"""

from __future__ import annotations

import json
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runs import runs
from .store import materialise

#: Ids of a range: small, so that many ranges level out over the tasks. Equal rows are one entry with a count, so a range has few
#: entries, whatever repeats.
SPAN = 256
WORDS = r"[\x20\x09-\x0D]+"
#: Parts whose sums a task holds before it gives them out.
HELD = 1000


def text_filters(text: Column) -> dict[str, Column]:
    """The failure conditions that a text alone decides: A short, B repetitive, C capitals, D symbols."""
    words = F.array_remove(F.split(text, WORDS), "")
    n = F.size(words)
    capitals = F.char_length(text) - F.char_length(F.regexp_replace(text, "[A-Z]+", ""))
    return {"A": n < 100, "B": 100 * F.size(F.array_distinct(words)) < 80 * n, "C": 100 * capitals > 10 * F.char_length(text), "D": text.rlike(r"[#$%&*|]")}


def failing_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, id, A, B, C, D, E, good, toxic), booleans, one row per document. E: another row with a smaller id has the same text.

    A null text is empty, a null lang the part ''. A null id is smaller than none and has no smaller one. Labels of one id, if there are
    several, count if any of them says 1; labels of no document count nowhere. Other columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    slim = materialise(slim.select("id", "part", F.unhex(F.sha2("text", 256)).alias("key"), *[c.alias(name) for name, c in text_filters(F.col("text")).items()]), "flags")
    # One first row for each text, joined by text and id: a text with many copies is no hot key.
    first = slim.groupBy("key").agg(F.min("id").alias("id")).where("id is not null").withColumn("E", F.lit(False))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    rows = slim.join(first, ["key", "id"], "left").join(marks, "id", "left")
    said = [F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]
    return rows.select("part", "id", "A", "B", "C", "D", F.coalesce("E", F.col("id").isNotNull()).alias("E"), *said)


def _dealt(rows: DataFrame, filters: list[str], tags: list[str], span: int) -> DataFrame:
    """(part, range, id, code, times), each range in one task and sorted; code has a bit for each filter and tag."""
    code = sum((F.coalesce(F.col(c), F.lit(False)).cast("long") * (1 << k) for k, c in enumerate([*filters, *tags])), F.lit(0).cast("long"))
    entries = rows.select(F.coalesce("part", F.lit("")).alias("part"), F.col("id").cast("long").alias("id"), code.alias("code"))
    entries = entries.withColumn("range", F.coalesce(F.floor(F.col("id") / span), F.lit(-(2**62)))).groupBy("part", "range", "id", "code").agg(F.count("*").alias("times"))
    return entries.repartition("part", "range").sortWithinPartitions("part", "range", "id", "code")


def _lists(batches, names: int):
    """(part, range, ids, times, sorted list of entries for each name) for each range."""
    for run in runs(batches, ["part", "range"]):
        code = run.column("code").to_numpy()
        yield run.column("part")[0].as_py(), run.column("range")[0].as_py(), run.column("id"), run.column("times").to_numpy(), [np.flatnonzero(code >> k & 1) for k in range(names)]


def posting_lists(rows: DataFrame, filters: list[str], tags: list[str] = (), span: int = SPAN) -> DataFrame:
    """rows (part, id, a boolean for each filter and tag) -> (part, range, ids, times, lists): the distinct entries of a range in ascending order of id, how
    many rows each stands for, and by name the sorted places in ids of those that fail the filter or carry the tag."""
    names = [*filters, *tags]

    def build(batches):
        for part, at, ids, times, lists in _lists(batches, len(names)):
            named = pa.array([[(name, x.astype(np.int32)) for name, x in zip(names, lists, strict=True)]], pa.map_(pa.string(), pa.list_(pa.int32())))
            yield pa.record_batch([pa.array([part]), pa.array([at], pa.int64()), pa.array([ids.to_pylist()], pa.list_(pa.int64())), pa.array([times], pa.list_(pa.int64())), named], names=["part", "range", "ids", "times", "lists"])

    return _dealt(rows, list(filters), list(tags), span).mapInArrow(build, "part string, range long, ids array<long>, times array<long>, lists map<string, array<int>>")


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union of two sorted lists without repeats."""
    if len(a) < len(b):
        a, b = b, a
    if not len(b):
        return a
    at = np.searchsorted(a, b)
    new = a[np.minimum(at, len(a) - 1)] != b
    return np.insert(a, at[new], b[new]) if new.any() else a


def union_sizes(rows: DataFrame, filters: list[str], tags: list[str] = (), span: int = SPAN) -> DataFrame:
    """(part, failing, total, n, a column for each tag): for each set of filters, as bits, how many rows fail any of them, and how many of
    those carry each tag. total: rows of the part, with the empty set only. A row for each task, part and set."""
    k, m = len(filters), len(tags)
    names = ["part", "failing", "total", "n", *tags]

    def measure(batches):
        held: dict[str, np.ndarray] = {}

        def given():
            for part, sums in held.items():
                yield pa.record_batch([pa.array([part] * (1 << k)), pa.array(np.arange(1 << k), pa.int32()), *[pa.array(c) for c in sums.T]], names=names)
            held.clear()

        for part, _, _, times, lists in _lists(batches, k + m):
            weight = np.zeros((1 + m, len(times)), np.int64)
            weight[0] = times
            for j, own in enumerate(lists[k:], 1):
                weight[j, own] = times[own]
            union = [np.zeros(0, np.int64)]
            sums = np.zeros((1 << k, 2 + m), np.int64)
            sums[0, 0] = times.sum()
            for s in range(1, 1 << k):
                last = s.bit_length() - 1
                union.append(merge(union[s ^ (1 << last)], lists[last]))
                sums[s, 1:] = weight[:, union[s]].sum(axis=1)
            if part not in held and len(held) >= HELD:
                yield from given()
            held[part] = held.get(part, 0) + sums
        yield from given()

    return _dealt(rows, list(filters), list(tags), span).mapInArrow(measure, ", ".join(["part string, failing int", *[f"`{c}` long" for c in names[2:]]]))


def audit_filters(rows: DataFrame, filters: list[str], tags: list[str] = (), orders: list[str] | None = None, span: int = SPAN) -> DataFrame:
    """rows (part, id, a boolean for each one-letter filter and tag) -> (part, filter_order, step, kept, removed, redundant, unique_fails, lost_<tag>,
    shapley), one row for each part, order and step; counts of rows.

    orders: all permutations if not given; shapley sums what the step's filter removes over the orders given. A null part is '';
    null flags are false; ids may repeat or be null, each row counts; an empty table gives no rows. Nothing but sums for each
    part and set of filters leaves the ranges.
    """
    filters, tags = list(filters), list(tags)
    bit = {c: 1 << k for k, c in enumerate(filters)}
    every = (1 << len(filters)) - 1
    steps = []
    for order in orders or ["".join(p) for p in permutations(filters)]:
        before = 0
        for step, c in enumerate(order, 1):
            steps.append({"filter_order": order, "step": step, "own": bit[c], "before": before, "after": before | bit[c], "others": every ^ bit[c]})
            before |= bit[c]
    kind = "array<struct<filter_order: string, step: int, own: int, before: int, after: int, others: int>>"
    sizes = union_sizes(rows, filters, tags, span).groupBy("part", "failing").agg(*[F.sum(c).alias(c) for c in ("total", "n", *tags)])
    parts = sizes.groupBy("part").agg(F.sum("total").alias("total"), F.map_from_entries(F.collect_list(F.struct("failing", F.struct("n", *tags)))).alias("u"))
    told = parts.withColumn("s", F.explode(F.from_json(F.lit(json.dumps(steps)), kind))).select("*", "s.*")
    u = lambda which, c="n": F.col("u")[F.col(which)][c]
    removed = u("after") - u("before")
    told = told.select(
        "part", "filter_order", "step", "own", (F.col("total") - u("after")).alias("kept"), removed.alias("removed"), (u("own") - removed).alias("redundant"),
        (F.element_at("u", F.lit(every))["n"] - u("others")).alias("unique_fails"), *[(u("after", c) - u("before", c)).alias(f"lost_{c}") for c in tags],
    )
    return told.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "own"))).drop("own")
