"""Packing by power-of-two decomposition.

Each document, with its end id, is cut into full blocks of max_len ids and then into one piece for each binary digit
of the rest, longest first. Every piece is a sequence of its own: its length is a power of two, so nothing is padded,
and no sequence holds two documents. Sequences of equal length form a bucket; a batch is drawn from one bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runs import tidy

#: Ids of a batch of pieces at most, unless one document has more: their bytes stay below what 32-bit offsets reach.
BATCH_IDS = 100_000_000


def cut_pieces(tokens: np.ndarray, max_len: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length) of all pieces, in order, of documents with so many tokens each."""
    full, rest = tokens // max_len, tokens % max_len
    doc = [np.repeat(np.arange(len(tokens)), full)]
    start = [(np.arange(len(doc[0])) - np.repeat(np.cumsum(full) - full, full)) * max_len]
    length = [np.full(len(doc[0]), max_len, np.int64)]
    for k in range(max_len.bit_length() - 1):
        own = np.flatnonzero(rest >> k & 1)
        doc.append(own)
        start.append(tokens[own] - (rest[own] & ((2 << k) - 1)))
        length.append(np.full(len(own), 1 << k, np.int64))
    doc, start, length = (np.concatenate(x) for x in (doc, start, length))
    order = np.lexsort((start, doc))
    return doc[order], start[order], length[order]


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, max_len: int = 1024, id_col: str = "doc_id", text_col: str = "text", special_as_text: bool = False) -> DataFrame:
    """documents -> (doc_id, start, length, ids, doc_tokens, bucket, sequence_id, offset), one row per piece.

    ids: little-endian unsigned 32-bit ids as binary. bucket: log2 of the length. A null or empty text is the end id
    alone; a null id is kept; repeated rows are packed each; other columns are ignored; an empty table gives no rows.
    max_len must be a power of two. One map over the input: no shuffle, nothing is gathered.
    """
    if max_len & (max_len - 1) or max_len < 1:
        raise ValueError("max_len must be a power of two")
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("doc_tokens", T.LongType())])

    @tidy
    def pack(batches):
        from .tokenise import encoder, text_slices, with_end

        enc = encoder(tokenizer, special_as_text)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for a, b in text_slices(texts):
                flat, offsets = with_end(*enc.ids(texts[a:b]), end_id, np.dtype("<u4"))
                tokens = np.diff(offsets)
                doc, start, length = cut_pieces(tokens, max_len)
                ends = np.cumsum(length)
                # The pieces, in order, are the ids of all documents, in order.
                begin = 0
                while begin < len(ends):
                    low = int(ends[begin] - length[begin])
                    stop = max(int(np.searchsorted(ends, low + BATCH_IDS, "right")), begin + 1)
                    some = slice(begin, stop)
                    where = np.append(low, ends[some]) - low
                    ids = pa.BinaryArray.from_buffers(pa.binary(), stop - begin, [None, pa.py_buffer((4 * where).astype(np.int32)), pa.py_buffer(flat[low : int(ends[stop - 1])])])
                    yield pa.record_batch([keys[a:b].take(pa.array(doc[some])), pa.array(start[some]), pa.array(length[some]), ids, pa.array(tokens[doc[some]])], names=schema.names)
                    begin = stop

    pieces = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(pack, schema)
    return pieces.withColumns({"bucket": F.log2("length").cast("int"), "sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})
