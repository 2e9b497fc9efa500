"""Stupid-backoff scores over n-gram count tables that are partitioned by hash.

The words and n-grams of the documents are exploded into blocks: one row holds a batch's distinct n-gram hashes of one
range of the hash space, with their counts. All blocks of a range meet in one task, which sums the count table of that
range and joins it back to the blocks; the counts return to their batches, where each document's n-grams are scored
and summed. Counts cover all documents. A block row stands for thousands of n-gram rows; a frequent n-gram is one
entry per batch, so no range is hot.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runs import runs
from .store import materialise_by, partitions
from .words import grams, slices, split

BATCH_BYTES = 12_000_000
#: A hash range holds about as many n-grams as so many batches.
BATCHES_A_RANGE = 2
BACKOFF = 0.4
#: n-grams of two words and more that the corpus holds fewer times count as unseen.
MIN_COUNT = 1
#: Words of the longest n-gram.
ORDER = 3


def _pack(x: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, deflated: sorted hashes and small counts shrink."""
    return zlib.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes(), 1)


def _unpack(b: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(b), np.uint8).reshape(width, -1).T).reshape(-1).view(kind)


def _pack_sorted(x: np.ndarray) -> bytes:
    return _pack(np.diff(x, prepend=np.uint64(0)))


def _unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(_unpack(b, "<u8"), dtype=np.uint64)


def _batches(docs: DataFrame) -> DataFrame:
    """(batch, ids, sizes, vocabulary, places): the documents of a batch as places in its sorted word hashes."""

    def read(parts):
        from pyspark import TaskContext

        task, k = TaskContext.get().partitionId(), 0
        for part in parts:
            for a, b in slices(part.column(1), BATCH_BYTES):
                hashes, sizes = [], []
                for c, d in slices(part.column(1)[a:b]):
                    w = split(part.column(1)[a + c : a + d])
                    hashes.append(w.hash)
                    sizes.append(np.diff(w.first))
                vocabulary, places = np.unique(np.concatenate(hashes), return_inverse=True)
                yield pa.record_batch([pa.array([(task << 32) + k], pa.int64()), pa.array([part.column(0)[a:b].to_pylist()], pa.list_(pa.int64())), pa.array([_pack(np.concatenate(sizes).astype("<u4"))], pa.binary()), pa.array([_pack_sorted(vocabulary)], pa.binary()), pa.array([_pack(places.astype("<u4"))], pa.binary())], names=["batch", "ids", "sizes", "vocabulary", "places"])
                k += 1

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialise_by(rows.mapInArrow(read, "batch long, ids array<long>, sizes binary, vocabulary binary, places binary"), "batch", "batches")


def _ngrams(words: np.ndarray, sizes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the n-gram that ends at each word, and whether there is one (not at a document's first n - 1)."""
    first = np.cumsum(sizes) - sizes
    inside = np.arange(len(words)) - np.repeat(first, sizes) >= n - 1
    out = np.zeros(len(words), np.uint64)
    out[n - 1 :] = grams(words, n)
    return out[inside], inside


def _explode(batches: DataFrame, buckets: int, order: int) -> DataFrame:
    """(p, batch, kind, h, n): the batch's distinct n-grams of a hash range, sorted, and their counts."""

    def cut(parts):
        for part in parts:
            for row in range(part.num_rows):
                sizes, vocabulary, places = _unpack(part.column(1)[row].as_py(), "<u4"), _unpack_sorted(part.column(2)[row].as_py()), _unpack(part.column(3)[row].as_py(), "<u4")
                for kind in range(1, order + 1):  # one table at a time
                    if kind == 1:
                        h, n = vocabulary, np.bincount(places, minlength=len(vocabulary))
                    else:
                        h, n = np.unique(_ngrams(vocabulary[places], sizes, kind)[0], return_counts=True)
                    p = ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
                    found, first = np.unique(p, return_index=True)
                    ends = [*first[1:], len(h)]
                    yield pa.record_batch([pa.array(found.astype(np.int32)), pa.array([part.column(0)[row].as_py()] * len(found), pa.int64()), pa.array([kind] * len(found), pa.int32()), pa.array([_pack_sorted(h[a:b]) for a, b in zip(first, ends, strict=True)], pa.binary()), pa.array([_pack(n[a:b].astype("<u4")) for a, b in zip(first, ends, strict=True)], pa.binary())], names=["p", "batch", "kind", "h", "n"])

    return batches.select("batch", "sizes", "vocabulary", "places").mapInArrow(cut, "p int, batch long, kind int, h binary, n binary")


def _count(blocks: DataFrame, buckets: int) -> DataFrame:
    """(batch, kind, p, c): the corpus counts of a block's n-grams, in its order."""

    def total(parts):
        for run in runs(parts, ["p", "kind"]):
            h = [_unpack_sorted(x.as_py()) for x in run.column("h")]
            n = [_unpack(x.as_py(), "<u4") for x in run.column("n")]
            table, at = np.unique(np.concatenate(h), return_inverse=True)
            count = np.bincount(at, np.concatenate(n), len(table)).astype("<u8")
            ends = np.cumsum([len(x) for x in h])
            yield pa.record_batch([run.column("batch"), run.column("kind"), run.column("p"), pa.array([_pack(count[at[e - len(x) : e]]) for x, e in zip(h, ends, strict=True)], pa.binary())], names=["batch", "kind", "p", "c"])

    return blocks.repartition(buckets, "p").sortWithinPartitions("p", "kind").mapInArrow(total, "batch long, kind int, p int, c binary")


def backoff_scores(docs: DataFrame, backoff: float = BACKOFF, min_count: int = MIN_COUNT, order: int = ORDER) -> DataFrame:
    """documents -> (doc_id, n_words, log_score, mean_log_score), one row per input row.

    log_score sums log S over a text's words. With up to order - 1 words before it in the text, S of a word is the count of
    the longest n-gram that ends there over that of the n-gram without its last word, if the n-gram occurs min_count times in
    all documents; else backoff times S by the next shorter n-gram; c(w) / N at last. N: words of all documents. An
    empty or null text scores 0 and has a null mean; repeated rows count and are scored each; other columns are ignored;
    an empty table gives no rows. Writes a table to the shared folder when called.
    """
    batches = _batches(docs)
    # A task holds a range whole: few batches' n-grams, however many batches there are.
    buckets = max(partitions(docs.sparkSession), batches.count() // BATCHES_A_RANGE)
    counts = _count(_explode(batches, buckets, order), buckets)
    answered = counts.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("kind", "p", "c"))).alias("counts"))  # blocks of one batch

    def measure(parts):
        n = 0
        for part in parts:
            n += sum(int(_unpack(x.as_py(), "<u4").sum()) for x in part.column(0))
        yield pa.record_batch({"n": pa.array([n], pa.int64())})

    total = float(batches.select("sizes").mapInArrow(measure, "n long").agg(F.sum("n")).first()[0] or 0)

    def score(parts):
        for part in parts:
            for row in range(part.num_rows):
                ids, sizes = part.column("ids")[row].values, _unpack(part.column("sizes")[row].as_py(), "<u4").astype(np.int64)
                vocabulary, places = _unpack_sorted(part.column("vocabulary")[row].as_py()), _unpack(part.column("places")[row].as_py(), "<u4")
                told = part.column("counts")[row].as_py() or ()

                def counts(kind: int) -> np.ndarray:
                    own = [_unpack(x["c"], "<u8") for x in told if x["kind"] == kind]  # noqa: B023
                    return np.concatenate(own).astype(float) if own else np.zeros(0)

                words = vocabulary[places]
                seen = counts(1)[places] if len(places) else np.zeros(0)  # of the n-gram that ends at each word
                logs = np.log(seen / total)
                for n in range(2, order + 1):
                    h, inside = _ngrams(words, sizes, n)
                    if not len(h):
                        break
                    own = np.zeros(len(words))
                    own[inside] = counts(n)[np.unique(h, return_inverse=True)[1]]
                    del h
                    before = np.append(0.0, seen[:-1])
                    known = own >= min_count
                    logs = np.where(known, np.log(np.where(known, own, 1.0) / np.where(known, before, 1.0)), np.where(inside, np.log(backoff), 0.0) + logs)
                    seen = own
                doc = np.repeat(np.arange(len(sizes)), sizes)
                sums = np.bincount(doc, logs, len(sizes))
                yield pa.record_batch([ids, pa.array(sizes), pa.array(sums), pa.array(sums / np.maximum(sizes, 1), mask=sizes == 0)], names=["doc_id", "n_words", "log_score", "mean_log_score"])

    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("log_score", T.DoubleType()), T.StructField("mean_log_score", T.DoubleType())])
    return batches.join(answered, "batch", "left").select("ids", "sizes", "vocabulary", "places", "counts").mapInArrow(score, schema)
