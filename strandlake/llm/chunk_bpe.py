"""Byte-pair encoding by content-defined chunks that documents share, and decoding.

A rolling hash of the last bytes cuts texts into chunks, so equal passages give equal chunks wherever they stand. The chunks
that many documents share are found by a count over all documents and encoded once for the whole job; any other chunk is
encoded once in a Python worker, as long as its cache holds it. The ids of a text are those of its chunks, but around each join a
window is encoded anew: from the last but one anchor of the left chunk to the second anchor of the right one. An anchor is an
ASCII letter or digit followed by a blank, where both known patterns always cut. The outer words of the window must come out as
they did in the chunks; if they do not, the text is encoded whole. Under a tokenizer of an unknown pattern each text is one
chunk.
"""

from __future__ import annotations

import hashlib
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import materialise, partitions
from .tokenise import encoder, text_slices
from .words import byte_hashes, raw

#: Bytes that the rolling hash looks at; a power of two.
WINDOW = 32
#: A cut where so many leading bits of the hash are 0: 1,024 bytes apart on average.
CUT_BITS = 10
#: Anchors between two cuts at least: two words on each side for the windows at the joins.
ANCHORS = 4
#: Chunks that are encoded for the whole job and broadcast, those that save most, and their longest in bytes: 100 MB with ids at most.
SHARED, LONGEST = 8192, 4096
#: Bytes of text in which a chunk must occur twice for its text to be passed on.
COUNT_SLICE = 8_000_000
#: Bytes of chunks in a worker's cache.
CACHE_BYTES = 48_000_000
_GEAR = np.random.default_rng(20250713).integers(0, 2**32, 256, dtype=np.uint32)
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def rolling(data: np.ndarray) -> np.ndarray:
    """A hash of the WINDOW bytes that end at each byte."""
    h, k = _GEAR[data], 1
    while k < WINDOW:
        h[k:] = h[k:] + (h[:-k] << np.uint32(k))
        k *= 2
    return h


def chunk_edges(data: np.ndarray, offsets: np.ndarray, cut: bool = True) -> np.ndarray:
    """A row for each chunk of the texts: start, first and second anchor, last but one and last anchor, end. Texts of no bytes have no chunk;
    a text that is one chunk and has few anchors gives its start and end for them."""
    n = len(data)
    starts = np.unique(offsets[:-1][offsets[:-1] < n])
    if not n:
        return np.zeros((0, 6), np.int64)
    anchor = np.zeros(n, bool)
    anchor[1:] = _ALNUM[data[:-1]] & (data[1:] == 0x20)
    anchor[starts] = False
    anchors = np.flatnonzero(anchor)
    found = np.zeros(0, np.int64)
    if cut:
        found = np.flatnonzero(rolling(data) >> np.uint32(32 - CUT_BITS) == 0) + 1
        found = found[found < n]
        found = found[(data[found] & 0xC0) != 0x80]  # a character begins
        found = found[found - starts[np.searchsorted(starts, found, "right") - 1] >= WINDOW]
    edge = np.union1d(starts, found)
    head = np.isin(edge, starts)
    inside = lambda a, b: np.searchsorted(anchors, b, "left") - np.searchsorted(anchors, a, "right")
    enough = head.copy()
    enough[1:] |= inside(edge[:-1], edge[1:]) >= ANCHORS
    edge, head = edge[enough], head[enough]
    edge = edge[head | (inside(edge, np.append(edge[1:], n)) >= ANCHORS)]
    ends = np.append(edge[1:], n)
    low, high = np.searchsorted(anchors, edge, "right"), np.searchsorted(anchors, ends, "left")
    out = np.column_stack([edge, edge, edge, ends, ends, ends])
    full = high - low >= ANCHORS
    for k, at in ((1, low), (2, low + 1), (3, high - 2), (4, high - 1)):
        out[full, k] = anchors[at[full]]
    return out


def _text(data: bytes, offsets: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(data))


class ChunkEncoder:
    """ids(arrow string column) -> (ids, offsets). known: entries that learn() has made elsewhere, by chunk."""

    def __init__(self, path: str, known: dict[bytes, tuple], special_as_text: bool = False):
        self.enc = encoder(path, special_as_text)
        self.known, self.cache, self.held, self.encoded, self.whole = known, {}, 0, 0, 0

    def learn(self, chunks: list[bytes], edges: np.ndarray) -> list[tuple]:
        """(ids, ids before the second anchor, ids of the word between the first two, ids of that between the last two, ids from the last but
        one anchor) of each chunk; edges as chunk_edges gives them, counted from the chunk's start."""
        sizes = edges[:, 5]
        base = np.cumsum(sizes) - sizes
        flat, off = self.enc.ids(_text(b"".join(chunks), np.append((edges[:, :5] + base[:, None]).ravel(), sizes.sum())))
        n = np.diff(off).reshape(-1, 5)
        self.encoded += len(chunks)
        return [(flat[a:b].copy(), int(h + v), int(v), int(w), int(w + t)) for a, b, (h, v, _, w, t) in zip(off[:-1:5], off[5::5], n.tolist(), strict=True)]

    def _entries(self, whole: bytes, edges: np.ndarray) -> list[tuple]:
        chunks = [whole[a:b] for a, b in zip(edges[:, 0].tolist(), edges[:, 5].tolist(), strict=True)]
        new: dict[bytes, int] = {}
        for i, c in enumerate(chunks):
            if c not in self.known and c not in self.cache and c not in new:
                new[c] = i
        if new:
            at = list(new.values())
            self.cache.update(zip(new, self.learn(list(new), edges[at] - edges[at, :1]), strict=True))
            self.held += sum(map(len, new))
        found = [self.known.get(c) or self.cache[c] for c in chunks]
        while self.held > CACHE_BYTES:
            for c in list(islice(self.cache, len(self.cache) // 2 + 1)):
                del self.cache[c]
                self.held -= len(c)
        return found

    def ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = raw(column)
        edges = chunk_edges(data, offsets, self.enc.kind != "unknown")
        if not len(edges):
            return np.zeros(0, np.uint16), np.zeros(len(offsets), np.int64)
        whole = data.tobytes()
        entries = self._entries(whole, edges)
        doc = np.searchsorted(offsets, edges[:, 0], "right") - 1
        left = np.flatnonzero(doc[1:] == doc[:-1])
        begin, end = edges[left, 3], edges[left + 1, 2]
        windows = b"".join([whole[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)])
        joins, where = self.enc.ids(_text(windows, np.append(0, np.cumsum(end - begin))))
        parts, counts, wrong = [], np.zeros(len(offsets) - 1, np.int64), set()
        joined, k, pieces = set(left.tolist()), 0, {}
        for i, (d, (own, lead, first, last, trail)) in enumerate(zip(doc.tolist(), entries, strict=True)):
            a, b = (lead if i - 1 in joined else 0), (len(own) - trail if i in joined else len(own))
            pieces.setdefault(d, []).append(own[a:b])
            if i in joined:
                again = joins[where[k] : where[k + 1]]
                _, lead2, first2, _, _ = entries[i + 1]
                left_word, right_word = own[b : b + last], entries[i + 1][0][lead2 - first2 : lead2]
                if len(again) < last + first2 or not np.array_equal(again[:last], left_word) or not np.array_equal(again[len(again) - first2 :], right_word):
                    wrong.add(d)
                pieces[d].append(again)
                k += 1
        for d, found in pieces.items():
            if d in wrong:
                found = [self.enc.ids(column[d : d + 1])[0]]
                self.whole += 1
            parts += found
            counts[d] = sum(map(len, found))
        return np.concatenate(parts), np.append(0, np.cumsum(counts))


def chunk_counts(docs: DataFrame, text_col: str = "text", slice_bytes: int = COUNT_SLICE) -> DataFrame:
    """(key, docs, chunk): for chunks of at most LONGEST bytes, in how many documents they occur, by a 64-bit hash; chunk: the text, where some slice of
    the documents holds it twice, else null."""

    def count(batches):
        for batch in batches:
            for a, b in text_slices(batch.column(0), slice_bytes):
                data, offsets = raw(batch.column(0)[a:b])
                edges = chunk_edges(data, offsets)
                if not len(edges):
                    continue
                size = edges[:, 5] - edges[:, 0]
                short = size <= LONGEST
                doc = np.searchsorted(offsets, edges[:, 0], "right") - 1
                seen, at = np.unique(np.column_stack([byte_hashes(data, size).view(np.int64), doc])[short], axis=0, return_index=True)
                keys, first, n = np.unique(seen[:, 0], return_index=True, return_counts=True)
                rows = np.flatnonzero(short)[at[first]]
                text = [data[edges[r, 0] : edges[r, 5]].tobytes().decode() if m > 1 else None for r, m in zip(rows.tolist(), n.tolist(), strict=True)]
                yield pa.record_batch([pa.array(keys), pa.array(n), pa.array(text, pa.string())], names=["key", "docs", "chunk"])

    rows = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "key long, docs long, chunk string")
    return rows.groupBy("key").agg(F.sum("docs").alias("docs"), F.max("chunk").alias("chunk"))


def shared_chunks(docs: DataFrame, tokenizer: str, text_col: str = "text", most: int = SHARED, special_as_text: bool = False) -> dict[bytes, tuple]:
    """Encodings of the chunks whose sharing saves most, `most` of them at most, each encoded once. Counts cover all documents; writes
    a table to the shared folder."""
    found = materialise(chunk_counts(docs, text_col).where("docs > 1 and chunk is not null"), "chunks")
    best = found.select("key", (F.octet_length("chunk") * (F.col("docs") - 1)).alias("saved")).orderBy(F.desc("saved"), "key").limit(most)
    some = found.join(F.broadcast(best.select("key")), "key").select("chunk").repartition(partitions(docs.sparkSession))

    def learn(batches):
        for batch in batches:
            made = ChunkEncoder(tokenizer, {}, special_as_text)
            data, offsets = raw(batch.column(0))
            if len(data):
                # A chunk alone is one text: its own anchors, no cut.
                entries = made.learn([c.encode() for c in batch.column(0).to_pylist()], (e := chunk_edges(data, offsets, False)) - e[:, :1])
                yield pa.record_batch([batch.column(0), pa.array([e[0].tobytes() for e in entries], pa.binary()), pa.array([list(e[1:]) for e in entries], pa.list_(pa.int32()))], names=["chunk", "ids", "counts"])

    rows = some.mapInArrow(learn, "chunk string, ids binary, counts array<int>").collect()  # `most` rows of LONGEST bytes
    return {r.chunk.encode(): (np.frombuffer(r.ids, np.uint16), *r.counts) for r in rows}


def encode_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", most: int = SHARED, special_as_text: bool = False) -> DataFrame:
    """documents -> (doc_id, n_tokens, ids), one row per input row; ids: little-endian unsigned 32-bit, exactly those of the tokenizers library
    with add_special_tokens=False.

    A null or empty text has no ids; null ids and repeated rows are kept; other columns are ignored; an empty table gives no rows. Two
    scans: one counts chunks, one is a map. most=0 leaves the count out.
    """
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(shared_chunks(docs, tokenizer, text_col, most, special_as_text) if most else {})
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])

    def encode(batches):
        made = ChunkEncoder(tokenizer, known.value, special_as_text)
        for batch in batches:
            for a, b in text_slices(batch.column(1)):
                flat, offsets = made.ids(batch.column(1)[a:b])
                if 4 * len(flat) < 2**31:
                    ids = pa.BinaryArray.from_buffers(pa.binary(), b - a, [None, pa.py_buffer((4 * offsets).astype(np.int32)), pa.py_buffer(flat.astype("<u4"))])
                else:
                    ids = pa.array([flat[x:y].astype("<u4").tobytes() for x, y in zip(offsets[:-1], offsets[1:], strict=True)], pa.binary())
                yield pa.record_batch([batch.column(0)[a:b], pa.array(np.diff(offsets)), ids], names=schema.names)

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(encode, schema)


def token_bytes(tok) -> list[bytes]:
    """What each id stands for under a byte-level decoder: letters of the vocabulary that stand for one byte each, or else the token's own text."""
    # Fixed rule of byte-level vocabularies: printable Latin-1 characters are themselves, the other bytes follow from U+0100 on.
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
    out = [b""] * (max(tok.get_vocab(True).values()) + 1)
    for token, i in tok.get_vocab(True).items():
        out[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
    return out


class Decoder:
    """text(ids), as the library's decode(ids, skip_special_tokens=False), and joined(ids), their decimals with commas between."""

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            level = (json.load(file).get("decoder") or {}).get("type") == "ByteLevel"
        self.table = token_bytes(self.tok) if level else None
        decimal = [f"{i}," for i in range(max(self.tok.get_vocab(True).values()) + 1)]
        self.decimal = np.array(decimal, "S").view(np.uint8).reshape(len(decimal), -1)

    def text(self, ids: np.ndarray) -> bytes:
        if self.table is None:
            return self.tok.decode(ids.tolist(), skip_special_tokens=False).encode()
        out = b"".join(map(self.table.__getitem__, ids.tolist()))
        try:
            out.decode()
        except UnicodeDecodeError:
            return out.decode(errors="replace").encode()
        return out

    def joined(self, ids: np.ndarray) -> bytes:
        wide = self.decimal[ids].ravel()
        return wide[wide != 0][:-1].tobytes()


def decode_documents(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_tokens, ids) -> (doc_id, n_tokens, ids_sha256, text). text: what the library decodes, special tokens kept; ids_sha256: hex digest
    of the decimal ids joined by commas. Null ids are none. One map."""
    kind = encoded.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("text", T.StringType())])

    def decode(batches):
        made = Decoder(tokenizer)
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                ids = [np.frombuffer(x.as_buffer(), "<u4") if x.is_valid else np.zeros(0, "<u4") for x in part.column(2)]
                sums = [hashlib.sha256(made.joined(x)).hexdigest() for x in ids]
                yield pa.record_batch([part.column(0), part.column(1), pa.array(sums), pa.array([made.text(x) for x in ids], pa.binary()).cast(pa.string())], names=schema.names)

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(decode, schema)
