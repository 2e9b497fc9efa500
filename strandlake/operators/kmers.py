"""k-mer tables of sequences (name, seq). A k-mer of up to 31 bases is a number of two bits a base; the counts of a piece of
sequence are added up where it is read, and only blocks of distinct k-mers with their counts are shuffled."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bases that are turned into k-mers at once; a longer sequence is cut into pieces that overlap.
PIECE = 100_000
#: k-mers that are sorted at once; stretches that a task holds before it gives them away are a fourth of that.
SORTED = 4_000_000
#: Buckets of a count are 2 to this power, or more; the factor of hashes; bases of the shorter words by whose hash k-mers are dealt.
BUCKET_BITS, ODD, SHORT = 12, 0x9E3779B97F4A7C15, 10
#: Bases that are spelled at once.
SPELT = 7
#: Bits of the filter of repeated k-mers (16 MB), and bytes of a block in which tasks' filters are merged.
FILTER_BITS, FILTER_BLOCK = 1 << 27, 1 << 14
_CODE = np.full(256, 4, np.uint8)
for _i, _c in enumerate("ACGT"):
    _CODE[ord(_c)] = _CODE[ord(_c.lower())] = _i


def _strands(bases: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of each window of k bases and of its reverse complement; a base that is none counts as A."""
    b = (bases & 3).astype(np.int64)
    ahead, back, size = None, None, 0  # of windows of the first `size` bases
    a, r, width = b, 3 - b, 1  # of windows of `width` bases, doubled from step to step
    while True:
        if k & width:
            if size:
                ahead, back = ahead[: len(a) - size] << (2 * width) | a[size:], r[size:] << (2 * size) | back[: len(r) - size]
            else:
                ahead, back = a, r
            size += width
        if 2 * width > k:
            break
        a, r = a[:-width] << (2 * width) | a[width:], r[width:] << (2 * width) | r[:-width]
        width *= 2
    n = len(bases) - k + 1
    return ahead[:n], back[:n]


def _whole(bases: np.ndarray, k: int) -> np.ndarray:
    """Starts of the windows of k that hold bases alone."""
    total = np.concatenate([[0], np.cumsum(bases > 3)])
    return np.flatnonzero(total[k:] == total[:-k])


def canonical_codes(bases: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, code) of each window of k of the codes 0-3 (4: no base) that holds bases alone; the smaller of the code and
    that of the reverse complement."""
    if len(bases) < k:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    good = _whole(bases, k)
    return good, np.minimum(*_strands(bases, k))[good]


def stretches(bases: np.ndarray, k: int, repeated: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, count, least, word) of stretches of neighbouring k-mers, 33 - k at most, that have the same least of their shorter words' hashes
    on both strands; word: the bases of the stretch, two bits each from the highest, so 32 at most. A k-mer and its reverse
    complement have the same least. repeated: bits of a filter; k-mers that it does not hold are left out."""
    good = _whole(bases, k) if len(bases) >= k else np.zeros(0, np.int64)
    if repeated is not None and len(good):
        slot = slots(np.minimum(*_strands(bases, k))[good], 8 * len(repeated))
        good = good[(repeated[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)]
    if not len(good):
        return good, good, np.zeros(0, np.uint32), np.zeros(0, np.uint64)
    most = 33 - k
    short = min(k, max(SHORT, k - most + 1))
    x = (np.minimum(*_strands(bases, short)).astype(np.uint64) + np.uint64(ODD)) * np.uint64(0xD6E8FEB86659FD93)
    least, width, windows = ((x ^ x >> np.uint64(32)) * np.uint64(ODD) >> np.uint64(32)).astype(np.uint32), 1, k - short + 1
    while 2 * width <= windows:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    if width < windows:
        least = np.minimum(least[: width - windows], least[windows - width :])
    least = least[good]
    heads = np.flatnonzero(np.append(True, (good[1:] != good[:-1] + 1) | (least[1:] != least[:-1])))
    count = np.diff(np.append(heads, len(good)))
    if count.max() > most:
        heads = np.flatnonzero((np.arange(len(good)) - np.repeat(heads, count)) % most == 0)
        count = np.diff(np.append(heads, len(good)))
    start, half = good[heads], np.concatenate([bases & 3, np.zeros(32, np.uint8)]).astype(np.uint32)
    for width in (1, 2, 4, 8):
        half = half[:-width] << np.uint32(2 * width) | half[width:]
    drop = (2 * (most - count)).astype(np.uint64)
    word = (half[start].astype(np.uint64) << np.uint64(32) | half[start + 16]) >> drop << drop
    return start, count, least[heads], word


def _expanded(word: np.ndarray, count: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(code, place of its word) of the k-mers of words."""
    back = ~word
    for by, mask in ((2, 0x3333333333333333), (4, 0x0F0F0F0F0F0F0F0F)):
        back = back >> np.uint64(by) & np.uint64(mask) | (back & np.uint64(mask)) << np.uint64(by)
    back, of, mask = back.byteswap(), np.repeat(np.arange(len(word)), count), np.uint64((1 << 2 * k) - 1)
    place = (2 * (np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count))).astype(np.uint64)
    ahead = word[of] >> (np.uint64(64 - 2 * k) - place)
    ahead &= mask
    return np.minimum(ahead, back[of] >> place & mask).astype(np.int64), of


def _pieces(texts: pa.Array, k: int, compress: bool):
    """(row of each base, code of each base) of pieces of the sequences, with a break between rows."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, where, what = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(what, np.uint8) if what is not None else np.zeros(0, np.uint8)
    begin = 0
    while begin < len(texts):
        end = max(int(np.searchsorted(offsets, offsets[begin] + PIECE, "right")) - 1, begin + 1)
        low, high = int(offsets[begin]), int(offsets[end])
        seam: np.ndarray = np.zeros(0, np.uint8)
        for at in range(low, max(high, low + 1), PIECE):
            stop = min(at + PIECE, high)
            cut = offsets[begin : end + 1]
            cut = cut[(cut > at) & (cut < stop)] - at
            code = np.insert(_CODE[data[at:stop]], cut, 4)
            row = np.repeat(np.arange(begin, end), np.clip(offsets[begin + 1 : end + 1], at, stop) - np.clip(offsets[begin:end], at, stop))
            row = np.insert(row, cut, row[np.minimum(cut, len(row) - 1)] if len(row) else 0)
            if len(seam):
                code, row = np.concatenate([seam, code]), np.concatenate([np.full(len(seam), begin), row])
            if compress:
                keep = np.append(True, code[1:] != code[:-1])[: len(code)]
                code, row = code[keep], row[keep]
            yield row, code
            seam = code[len(code) - k + 1 :] if k > 1 else code[:0]
        begin = end


def _summed(code: np.ndarray, owner: np.ndarray, n: np.ndarray | None, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code, owner, n) of each distinct pair, in order, with its counts added up (one each without n); sorted as one number where both fit."""
    if not len(code):
        return code, owner, np.zeros(0, np.int64)
    bits = int(owner.max()).bit_length()
    if width + bits <= 63:
        both = code << bits | owner
        if n is None:
            both = np.sort(both)
        else:
            order = np.argsort(both, kind="stable")  # runs that are in order already
            both, n = both[order], n[order]
        heads = np.flatnonzero(np.append(True, both[1:] != both[:-1]))
        code, owner, size = both[heads] >> bits, both[heads] & ((1 << bits) - 1), len(both)
    else:
        order = np.lexsort((owner, code))
        code, owner, n = code[order], owner[order], None if n is None else n[order]
        heads = np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (owner[1:] != owner[:-1])))
        code, owner, size = code[heads], owner[heads], len(code)
    return code, owner, np.diff(np.append(heads, size)) if n is None else np.add.reduceat(n, heads)


def blocks(sequences: DataFrame, k: int = 21, keep: tuple[str, ...] = (), compress: bool = False, repeated=None) -> DataFrame:
    """Blocks of the canonical k-mers of sequences, in order of their bucket, each bucket in one partition; merged() makes k-mers of them.

    No row of the shuffle is a k-mer, and neighbours travel together: a task cuts what it reads into stretches of up to 33 - k k-mers that have the
    same least hash of a shorter word, and sends them as 64-bit words, equal ones once with their number. Buckets, 16 or more a shuffle
    partition, are ranges of a hash of that least hash, so all of a k-mer's occurrences, on either strand, meet in one.
    """
    if not 1 <= k <= 31:
        raise ValueError("k must lie between 1 and 31")
    rows = sequences.select(*[F.col(c).cast("string").alias(c) for c in keep], F.col("seq").cast("string").alias("seq"))
    parts = int(sequences.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    top = np.uint64(64 - max(BUCKET_BITS, (16 * parts - 1).bit_length()))

    def given(held, known):
        bucket, owner, count, word = (np.concatenate(x) for x in zip(*held, strict=True))
        if not len(word):
            return
        own = len(known).bit_length()
        kind = bucket << (own + 5) | owner << 5 | count - 1
        order = np.lexsort((word, kind))
        kind, word = kind[order], word[order]
        heads = np.flatnonzero(np.append(True, (kind[1:] != kind[:-1]) | (word[1:] != word[:-1])))
        times, kind, word = np.diff(np.append(heads, len(word))), kind[heads], word[heads]
        run = np.flatnonzero(np.append(True, kind[1:] >> 5 != kind[:-1] >> 5)) if keep else np.zeros(0, np.int64)  # of one bucket and owner
        bucket = kind >> (own + 5)
        begin = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        ends = np.append(begin, len(word))
        within = np.searchsorted(run, ends).astype(np.int32)  # runs before each bucket
        blob = lambda x, at: pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer((at * x.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(x))])
        times = times.astype(np.min_scalar_type(int(times.max())))
        named = pa.array(list(known), pa.string()).take(pa.array(kind[run] >> 5 & ((1 << own) - 1)))
        columns = [pa.array(bucket[begin], pa.int32()), pa.ListArray.from_arrays(pa.array(within), named), blob(np.diff(np.append(run, len(word))).astype(np.uint32), within) if keep else pa.nulls(len(begin), pa.binary()), blob(word, ends), blob((kind & 31).astype(np.uint8) + np.uint8(1), ends), blob(times, ends)]
        whole = pa.record_batch(columns, names=["bucket", "groups", "runs", "word", "count", "times"])
        for at in range(0, len(begin), 1024):
            yield whole.slice(at, 1024)

    def cut(batches):
        known: dict = {}
        held, size = [], 0
        for batch in batches:
            if keep:
                which = np.array([known.setdefault("\x01".join("\x00" if x is None else x for x in r), len(known)) for r in zip(*[batch.column(j).to_pylist() for j in range(len(keep))], strict=True)], np.int64)
            for row, bases in _pieces(batch.column(len(keep)), k, compress):
                start, count, least, word = stretches(bases, k, None if repeated is None else repeated.value)
                bucket = (least.astype(np.uint64) * np.uint64(ODD) >> top).astype(np.int64)
                held.append((bucket, which[row[start]] if keep else np.zeros(len(word), np.int64), count, word))
                size += len(word)
                if 4 * size >= SORTED:
                    yield from given(held, known)
                    held, size = [], 0
            if len(known) > 65_536:
                if held:
                    yield from given(held, known)
                known, held, size = {}, [], 0
        if held:
            yield from given(held, known)

    sent = rows.mapInArrow(cut, "bucket int, groups array<string>, runs binary, word binary, count binary, times binary")
    return sent.repartition(parts, "bucket").sortWithinPartitions("bucket")


def merged(sent: DataFrame, k: int, then, schema, keep: bool = True, told: DataFrame | None = None) -> DataFrame:
    """What then(code, owner, n, groups, told) yields as record batches of the schema for the k-mers of whole buckets of blocks(): each distinct (code,
    owner) once, in order, with its count; groups: the values of keep by owner, joined by \\x01, null as \\x00. told: one row of one
    column, which each partition's first row brings along. What several calls make of the same blocks shares their shuffle.
    """
    if extra := told is not None:
        first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
        name = told.columns[0]
        sent = sent.withColumn("first", first).join(F.broadcast(told)).select("bucket", "groups", "runs", "word", "count", "times", F.when(F.col("first"), F.col(name)).alias("told"))

    def merge(batches):
        raw, size, held, known, last, said = [], 0, [], {}, None, None

        def fold():
            word, count = np.frombuffer(b"".join(x[0] for x in raw), np.uint64), np.frombuffer(b"".join(x[1] for x in raw), np.uint8)
            times = np.concatenate([np.frombuffer(x[2], f"u{len(x[2]) // len(x[1])}") for x in raw]).astype(np.int64)
            owner = np.repeat(np.concatenate([x[3] for x in raw]), np.concatenate([x[4] for x in raw])) if keep else None
            if few := times.sum() <= 2 * len(times):
                word, count, owner = np.repeat(word, times), np.repeat(count, times), np.repeat(owner, times) if keep else None
            code, of = _expanded(word, count, k)
            new = _summed(code, owner[of] if keep else np.zeros(len(code), np.int64), None if few else times[of], 2 * k)
            raw.clear()
            held[:] = [_summed(*(np.concatenate(x) for x in zip(held[0], new, strict=True)), 2 * k) if held else new]

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for bucket, groups, runs, word, count, times in zip(*columns[:6], strict=True):
                if said is None and extra:
                    said = columns[6][0]  # of the partition's first row
                if bucket != last and 4 * (size + sum(len(x[0]) for x in held)) >= SORTED:  # of whole buckets, which have no k-mer in common
                    if raw:
                        fold()
                    yield from then(*held[0], list(known), said)
                    size, held, known = 0, [], {}
                elif size >= max(SORTED, 2 * sum(len(x[0]) for x in held)):
                    fold()
                    size = 0
                last = bucket
                own = np.array([known.setdefault(g, len(known)) for g in groups], np.int64) if keep else None
                raw.append((word, count, times, own, np.frombuffer(runs, np.uint32) if keep else None))
                size += len(count) * 6
        if raw:
            fold()
        if held:
            yield from then(*held[0], list(known), said)

    return sent.mapInArrow(merge, schema)


def packed_counts(sequences: DataFrame, k: int = 21, least: int = 1, keep: tuple[str, ...] = (), compress: bool = False, repeated=None) -> DataFrame:
    """(keep ..., code, n) of canonical k-mers, k at most 31, seen at least so many times per value of keep. Windows with a
    letter other than ACGT, in either case, do not count. compress: runs of one base count as one. Null sequences have none.
    repeated: a broadcast filter of repeated_filter(); k-mers that it does not hold are left out.
    """
    schema = T.StructType([*[T.StructField(c, T.StringType()) for c in keep], T.StructField("code", T.LongType()), T.StructField("n", T.LongType())])

    def then(code, owner, n, groups, _):
        if least > 1:
            code, owner, n = (x[n >= least] for x in (code, owner, n))
        said = [[None if x == "\x00" else x for x in g.split("\x01")] for g in groups]
        yield from pa.table([*[pa.array([x[j] for x in said], pa.string()).take(pa.array(owner)) for j in range(len(keep))], pa.array(code), pa.array(n)], names=schema.names).to_batches(PIECE)

    return merged(blocks(sequences, k, keep, compress, repeated), k, then, schema, bool(keep))


def slots(codes: np.ndarray, bits: int) -> np.ndarray:
    """A place for each code in a filter of so many bits, a power of two."""
    x = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return ((x ^ (x >> np.uint64(29))) & np.uint64(bits - 1)).astype(np.int64)


def _set_bits(held: np.ndarray, at: np.ndarray) -> None:
    """Sets the bits at ascending places."""
    if len(at):
        byte = at >> 3
        heads = np.flatnonzero(np.append(True, byte[1:] != byte[:-1]))
        held[byte[heads]] |= np.bitwise_or.reduceat(np.left_shift(1, at & 7).astype(np.uint8), heads)


def repeated_filter(sequences: DataFrame, k: int = 21, compress: bool = False, bits: int = FILTER_BITS) -> np.ndarray:
    """A filter that holds every k-mer seen twice or more, and few others: bits / 8 bytes, whatever the input.

    A task marks a k-mer's place once, and in a second filter when it meets the place again. Blocks of both filters are merged over the tasks:
    what two tasks have each seen once is seen twice. Only blocks with a mark are shuffled. The more distinct k-mers there are for
    the bits, the more of those seen once get through; none seen twice is lost.
    """
    if bits & (bits - 1) or bits < 8 * FILTER_BLOCK:
        raise ValueError(f"bits must be a power of two of at least {8 * FILTER_BLOCK}")

    def mark(batches):
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            for _, bases in _pieces(batch.column(0), k, compress):
                at, n = np.unique(slots(canonical_codes(bases, k)[1], bits), return_counts=True)
                seen = (once[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
                _set_bits(twice, at[(n > 1) | seen])
                _set_bits(once, at)
        a, b = once.reshape(-1, FILTER_BLOCK), twice.reshape(-1, FILTER_BLOCK)
        for i in np.flatnonzero(a.any(axis=1)).tolist():
            yield pa.record_batch([pa.array([i], pa.int32()), pa.array([a[i].tobytes()], pa.binary()), pa.array([b[i].tobytes()], pa.binary())], names=["block", "once", "twice"])

    def merge(batches):
        last, once, twice = None, None, None
        given = lambda: pa.record_batch([pa.array([last], pa.int32()), pa.array([twice.tobytes()], pa.binary())], names=["block", "twice"])
        for batch in batches:
            for i, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if i != last:
                    if last is not None:
                        yield given()
                    last, once, twice = i, np.zeros(FILTER_BLOCK, np.uint8), np.zeros(FILTER_BLOCK, np.uint8)
                a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
                twice |= b | (once & a)
                once |= a
        if last is not None:
            yield given()

    marked = sequences.select(F.col("seq").cast("string").alias("seq")).mapInArrow(mark, "block int, once binary, twice binary")
    merged = marked.repartition("block").sortWithinPartitions("block").mapInArrow(merge, "block int, twice binary")
    out = np.zeros((bits // 8 // FILTER_BLOCK, FILTER_BLOCK), np.uint8)
    for r in merged.collect():  # bits / 8 bytes
        out[r.block] = np.frombuffer(r.twice, np.uint8)
    return out.reshape(-1)


def suppressed_counts(sequences: DataFrame, k: int = 21, least: int = 2, keep: tuple[str, ...] = (), compress: bool = False, bits: int = FILTER_BITS) -> DataFrame:
    """packed_counts of k-mers seen at least twice, in two passes: nearly all that occur once never leave the task that reads them. The filter
    is made when this is called. With keep, a k-mer counts as seen in all values of keep together for the filter."""
    if least < 2:
        raise ValueError("suppression needs least >= 2")
    held = sequences.sparkSession.sparkContext.broadcast(repeated_filter(sequences, k, compress, bits))
    return packed_counts(sequences, k, least, keep, compress, held)


def spelled(code: Column, k: int) -> Column:
    """The bases of a code."""
    return F.translate(F.lpad(F.conv(code.cast("string"), 10, 4), k, "0"), "0123", "ACGT")


def kmer_count(sequences: DataFrame, k: int = 21, least: int = 1, compress: bool = False) -> DataFrame:
    """(kmer, n) of canonical k-mers seen at least so many times."""
    return packed_counts(sequences, k, least, compress=compress).select(spelled(F.col("code"), k).alias("kmer"), "n")


def union_sum(*tables: DataFrame) -> DataFrame:
    """Counts added up over tables of (code or kmer, n)."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out.groupBy(tables[0].columns[0]).agg(F.sum("n").alias("n"))


def spelled_codes(code: np.ndarray, k: int) -> pa.Array:
    """spelled() of an array of codes."""
    out, letters = np.empty((len(code), k), np.uint8), np.frombuffer(b"ACGT", np.uint8)
    for end in range(k, 0, -SPELT):
        n = min(SPELT, end)
        words = np.stack([letters[np.arange(1 << 2 * n) >> 2 * (n - 1 - i) & 3] for i in range(n)], axis=1)
        out[:, end - n : end] = words[code >> 2 * (k - end) & ((1 << 2 * n) - 1)]
    return pa.Array.from_buffers(pa.string(), len(code), [None, pa.py_buffer(np.arange(len(code) + 1, dtype=np.int32) * np.int32(k)), pa.py_buffer(out)])


def union_counts(sequences: DataFrame, k: int = 21, key: str = "role") -> DataFrame:
    """(kmer, n): k-mers of the sequences of each value of key counted apart and added up over its values, as union_sum does with
    tables; the counts of a k-mer meet in its bucket, so only stretches of sequence are shuffled, once."""

    def then(code, owner, n, groups, _):
        heads = np.flatnonzero(np.append(True, code[1:] != code[:-1])[: len(code)])
        if len(heads):
            yield from pa.table([spelled_codes(code[heads], k), pa.array(np.add.reduceat(n, heads))], names=["kmer", "n"]).to_batches(PIECE)

    return merged(blocks(sequences, k, (key,)), k, then, "kmer string, n long")


def count_histogram(counts: DataFrame) -> DataFrame:
    """(n, distinct): how many k-mers have each count."""
    return counts.groupBy("n").agg(F.count("*").alias("distinct"))


def valley(counts: DataFrame) -> DataFrame:
    """One row: the smallest count after which the histogram of counts rises or stays level, or 1."""
    order = Window.orderBy("n")  # a row per count
    step = count_histogram(counts).withColumn("next", F.lead("distinct").over(order))
    return step.where("distinct <= next").agg(F.coalesce(F.min("n"), F.lit(1)).cast("long").alias("least"))


def reliable(counts: DataFrame) -> DataFrame:
    """k-mers whose count reaches the histogram's valley: the others are taken for errors of reading."""
    return counts.join(F.broadcast(valley(counts)), F.col("n") >= F.col("least")).drop("least")  # one row


def hapmers(mother: DataFrame, father: DataFrame, child: DataFrame) -> DataFrame:
    """(code, parent): reliable k-mers of one parent alone that the child has."""
    seen = child.select("code")
    one = lambda a, b, name: reliable(a).join(b.select("code"), "code", "left_anti").join(seen, "code", "left_semi").select("code", F.lit(name).alias("parent"))
    return one(mother, father, "mat").unionByName(one(father, mother, "pat"))


def hapmer_counts(sequences: DataFrame, k: int = 21, key: str = "role", roles: tuple[str, str, str] = ("0", "1", "2")) -> DataFrame:
    """(kmer, parent): hapmers of the k-mers of the sequences whose key is the mother, the father or the child; other sequences do not count.

    What mother, father and child have of a k-mer meets in its bucket, twice over one shuffle of blocks: first the histograms
    of counts, then, with the valleys known, the k-mers that stay. No row before them is a k-mer.
    """
    sent = blocks(sequences.where(F.col(key).cast("string").isin(*roles)), k, (key,))

    def table(code, owner, n, groups):
        """(distinct codes, their counts in a column each of mother, father, child)"""
        heads = np.append(True, code[1:] != code[:-1])
        out = np.zeros((int(heads.sum()), 3), np.int64)
        out[np.cumsum(heads) - 1, np.array([roles.index(g) for g in groups])[owner]] = n
        return code[heads], out

    def histogram(code, owner, n, groups, _):
        if len(code):
            _, held = table(code, owner, n, groups)
            for j, role in enumerate(roles[:2]):
                size, distinct = np.unique(held[held[:, j] > 0, j], return_counts=True)
                yield pa.record_batch([pa.array([role] * len(size), pa.string()), pa.array(size), pa.array(distinct)], names=["role", "n", "distinct"])

    def select(code, owner, n, groups, told):
        if len(code):
            code, held = table(code, owner, n, groups)
            least = {x["role"]: x["least"] for x in told}
            for j, parent in enumerate(("mat", "pat")):
                at = np.flatnonzero((held[:, j] >= max(least.get(roles[j], 1), 1)) & (held[:, 1 - j] == 0) & (held[:, 2] > 0))
                yield from pa.table([spelled_codes(code[at], k), pa.array([parent]).take(pa.array(np.zeros(len(at), np.int64)))], names=["kmer", "parent"]).to_batches(PIECE)

    counts = merged(sent, k, histogram, "role string, n long, distinct long").groupBy("role", "n").agg(F.sum("distinct").alias("distinct"))
    step = counts.withColumn("next", F.lead("distinct").over(Window.partitionBy("role").orderBy("n")))  # a row per count
    least = step.groupBy("role").agg(F.coalesce(F.min(F.when(F.col("distinct") <= F.col("next"), F.col("n"))), F.lit(1)).cast("long").alias("least"))
    return merged(sent, k, select, "kmer string, parent string", told=least.agg(F.collect_list(F.struct("role", "least")).alias("valleys")))


def kmer_qv(assembly: DataFrame, reads: DataFrame, k: int = 21) -> DataFrame:
    """One row: distinct k-mers of the assembly, those absent from the reads, error rate, quality value, and completeness: the
    share of the reads' k-mers, seen twice or more, that the assembly has."""
    both = assembly.select("code", F.lit(1).alias("a")).join(reads.select("code", F.col("n").alias("r")), "code", "full_outer")
    solid = F.col("r") >= 2
    out = both.agg(F.count("a").alias("total"), F.count_if(F.col("a").isNotNull() & F.col("r").isNull()).alias("only_assembly"), F.count_if(solid).alias("solid"), F.count_if(solid & F.col("a").isNotNull()).alias("found"))
    out = out.withColumn("error", 1 - F.pow(1 - F.col("only_assembly") / F.nullif(F.col("total"), F.lit(0)), F.lit(1.0 / k)))
    return out.withColumns({"qv": F.when(F.col("error") > 0, -10 * F.log10("error")), "completeness": F.col("found") / F.nullif(F.col("solid"), F.lit(0))}).drop("solid", "found")


def high_frequency(counts: DataFrame, fraction: float = 0.9998) -> DataFrame:
    """k-mers more frequent than the smallest count up to which this share of distinct k-mers lies."""
    run = count_histogram(counts).select("n", F.sum("distinct").over(Window.orderBy("n")).alias("c"), F.sum("distinct").over(Window.partitionBy()).alias("all"))
    edge = run.where(F.col("c") >= fraction * F.col("all")).agg(F.min("n").alias("edge"))  # one row
    return counts.join(F.broadcast(edge), F.col("n") > F.col("edge")).drop("edge")
