"""Token ids as Arrow stream files with fixed-size-list batches.

A file is an Arrow IPC stream of (ids: fixed_size_list<uint16>[seq_len], mask: fixed_size_list<bool>[seq_len]).
The ids of its documents follow one another; mask is true on ids and false on the padding of the file's last sequence;
Arrow keeps it as one bit an id. Every batch but the last has rows_per_batch sequences, so sequence i is row
i % rows_per_batch of batch i // rows_per_batch, and over a memory map both arrays are views of the file. A batch's
metadata names the documents that begin in it. A manifest table beside the files holds each file's number of ids.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .store import partitions
from .words import slices

SEQ_LEN = 1024
ROWS_PER_BATCH = 256
#: Ids after which a new file begins, at the next document.
FILE_IDS = 2_000_000
BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"


def _schema(seq_len: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.uint16(), seq_len)), ("mask", pa.list_(pa.bool_(), seq_len))])


def _write(sink, flat: np.ndarray, docs: np.ndarray, seq_len: int, rows: int) -> None:
    """docs: (id, is null, ids) for each document."""
    begins = np.cumsum(docs[:, 2]) - docs[:, 2]
    n = -(-len(flat) // seq_len)
    ids, mask = np.zeros(n * seq_len, np.uint16), np.zeros(n * seq_len, bool)
    ids[: len(flat)], mask[: len(flat)] = flat, True
    with pa.ipc.new_stream(sink, _schema(seq_len)) as out:
        for k in range(0, n, rows):
            a, b = k * seq_len, min(k + rows, n) * seq_len
            own = docs[(begins >= a) & (begins < b)]
            columns = [pa.FixedSizeListArray.from_arrays(pa.array(x[a:b]), seq_len) for x in (ids, mask)]
            out.write_batch(pa.record_batch(columns, schema=_schema(seq_len)), custom_metadata={"docs": own.astype("<i8").tobytes()})


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", seq_len: int = SEQ_LEN, rows_per_batch: int = ROWS_PER_BATCH, file_ids: int = FILE_IDS, special_as_text: bool = False) -> None:
    """Writes all documents in ascending id order (nulls first, equal ids by text).

    folder: a URI that executors can write to. A null or empty text is the end id alone; repeated rows are written
    each; other columns are ignored; an empty table writes no file and an empty manifest. Files get their final names
    when complete, so a repeated task replaces what a lost one left.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.repartitionByRange(partitions(docs.sparkSession), F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")

    def write(batches):
        from pyarrow import fs
        from pyspark import TaskContext

        from .tokenise import encoder, text_slices, with_end

        enc, task = encoder(tokenizer, special_as_text), TaskContext.get()
        files, top = fs.FileSystem.from_uri(folder)
        parts, index, held, count = [], [], 0, 0

        def flush() -> pa.RecordBatch:
            files.create_dir(top, recursive=True)
            name = f"part-{task.partitionId():07d}-{count:06d}.arrow"
            hidden = f"{top}/_{name}.{task.taskAttemptId()}"
            with files.open_output_stream(hidden) as sink:
                _write(sink, np.concatenate(parts), np.concatenate(index), seq_len, rows_per_batch)
            files.move(hidden, f"{top}/{name}")
            return pa.record_batch({"part": pa.array([task.partitionId()], pa.int32()), "file": [name], "ids": pa.array([held], pa.int64())})

        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for a, b in text_slices(texts):
                flat, offsets = with_end(*enc.ids(texts[a:b]), end_id)
                own = np.column_stack([keys[a:b].fill_null(0).to_numpy(), keys[a:b].is_null().to_numpy(zero_copy_only=False), np.diff(offsets)]).astype(np.int64)
                k = 0
                while k < b - a:  # documents are never split between files
                    room = int(np.searchsorted(offsets, offsets[k] + max(file_ids - held, 0), "right")) - 1
                    end = min(max(room, k if held else k + 1), b - a)
                    if end > k:
                        parts.append(flat[offsets[k] : offsets[end]])
                        index.append(own[k:end])
                        held += int(offsets[end] - offsets[k])
                    if end < b - a:
                        yield flush()
                        parts, index, held, count = [], [], 0, count + 1
                    k = end
        if held:
            yield flush()

    rows.mapInArrow(write, "part int, file string, ids long").write.mode("overwrite").parquet(f"{folder}/manifest")


class TokenFile:
    """Random access to the sequences of one local file, without copies: sequence(i) -> views (ids as numpy, mask as an
    Arrow boolean array). i counts from 0; one beyond len() raises IndexError. A file has a sequence at least."""

    def __init__(self, path: str):
        with pa.ipc.open_stream(pa.memory_map(path)) as reader:
            self.batches = list(reader)
        self.rows = self.batches[0].num_rows if self.batches else 0

    def __len__(self) -> int:
        return sum(b.num_rows for b in self.batches)

    def sequence(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        batch, row = self.batches[i // self.rows], i % self.rows
        n = batch.schema.field("ids").type.list_size
        ids, mask = (batch.column(k).flatten().slice(row * n, n) for k in (0, 1))
        return ids.to_numpy(zero_copy_only=True), mask


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files, start counted over all files by name. Null ids come back null, repeated ids
    as often as they were written; a folder of an empty table gives no rows."""
    schema = "file string, doc_id long, begins long, n_tokens long, ids_crc32 long"

    def read(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids, docs = [], []
                with pa.ipc.open_stream(content.as_buffer()) as reader:
                    while True:
                        try:
                            part, said = reader.read_next_batch_with_custom_metadata()
                        except StopIteration:
                            break
                        flat, mask = (part.column(k).flatten() for k in (0, 1))
                        ids.append(flat.to_numpy()[: mask.true_count])  # padding is at the end
                        docs.append(np.frombuffer(said[b"docs"], "<i8").reshape(-1, 3))
                flat, docs = np.concatenate(ids).astype("<u4"), np.concatenate(docs)
                ends = np.cumsum(docs[:, 2])
                begins = ends - docs[:, 2]
                crc = [zlib.crc32(flat[a:b]) for a, b in zip(begins, ends, strict=True)]
                yield pa.record_batch([pa.array([os.path.basename(path)] * len(docs), pa.string()), pa.array(docs[:, 0], pa.int64(), mask=docs[:, 1] == 1), pa.array(begins, pa.int64()), pa.array(docs[:, 2], pa.int64()), pa.array(crc, pa.int64())], names=["file", "doc_id", "begins", "n_tokens", "ids_crc32"])

    manifest = spark.read.schema("part int, file string, ids long").parquet(f"{folder}/manifest")
    # Where each file begins: sums within a part, and over the parts, a row each.
    parts = manifest.groupBy("part").agg(F.sum("ids").alias("all"))
    parts = parts.select("part", (F.sum("all").over(Window.orderBy("part")) - F.col("all")).alias("before"))
    inside = F.sum("ids").over(Window.partitionBy("part").orderBy("file")) - F.col("ids")
    before = manifest.withColumn("inside", inside).join(parts, "part").select("file", (F.col("before") + F.col("inside")).alias("base"))
    files = spark.read.schema(BINARY_FILE).format("binaryFile").option("pathGlobFilter", "part-*.arrow").option("recursiveFileLookup", "true").load(folder)
    found = files.select("path", "content").mapInArrow(read, schema)
    return found.join(before, "file").select("doc_id", (F.col("base") + F.col("begins")).alias("start"), "n_tokens", "ids_crc32")
