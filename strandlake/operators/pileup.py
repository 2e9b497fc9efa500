"""Bases and methylation calls of reads at each place of a reference, counted in tiles."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Places of a tile, and bases of reads that are laid out at once.
WIDTH, CHUNK = 256, 4_000_000
_CODE = np.full(256, 4, np.uint8)
for _i, _c in enumerate("ACGT"):
    _CODE[ord(_c)] = _CODE[ord(_c.lower())] = _i
_OP = re.compile(r"(\d+)([MIDNSHP=X])")
_SKIPS = re.compile(r"C\+m[?.]?,([0-9,]*);?")
#: Tiles of calls that a task holds; when there are more, they are sent.
HELD = 16_384
#: Stands for the place of a read that has none.
NOWHERE = -(1 << 60)


def stretches(cigar: str) -> list[tuple[int, int, int]]:
    """(offset in the read, offset from the alignment's start, bases) where read and reference run side by side."""
    out, q, t = [], 0, 0
    for n, op in _OP.findall(cigar):
        n = int(n)
        if op in "M=X":
            out.append((q, t, n))
            q, t = q + n, t + n
        elif op in "IS":
            q += n
        elif op in "DN":
            t += n
    return out


def _counts(contigs: np.ndarray, pos: list, cigars: list, data: np.ndarray, offsets: np.ndarray, rows: range) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(contig code, tile, counts) of the records in rows: counts has 4 * WIDTH numbers a tile, those of a place side by side."""
    own, start, ref, size = [], [], [], []
    for r in rows:
        if pos[r] is None or cigars[r] is None:
            continue
        low, have = int(offsets[r]), int(offsets[r + 1] - offsets[r])
        for q, t, n in stretches(cigars[r]):
            n = min(n, have - q)
            if n > 0:
                own.append(contigs[r])
                start.append(low + q)
                ref.append(pos[r] + t)
                size.append(n)
    if not size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 4 * WIDTH), np.int64)
    size = np.array(size, np.int64)
    inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    base = _CODE[data[np.repeat(start, size) + inner]]
    place, contig = np.repeat(ref, size) + inner, np.repeat(own, size)
    good = base < 4
    base, place, contig = base[good], place[good], contig[good]
    keys = np.stack([contig, place // WIDTH], axis=1)
    heads = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))[: len(keys)]  # reads run along tiles
    tiles, at = np.unique(keys[heads], axis=0, return_inverse=True)
    which = np.repeat(at.reshape(-1), np.diff(np.append(heads, len(keys))))
    counts = np.bincount(which * (4 * WIDTH) + (place % WIDTH) * 4 + base, minlength=len(tiles) * 4 * WIDTH)
    return tiles[:, 0], tiles[:, 1], counts.reshape(len(tiles), 4 * WIDTH)


def _added(tiles: DataFrame, names: list[str]) -> DataFrame:
    """(contig, pos, names) of (contig, tile, counts): the counts of each tile added up; places where all are 0 go."""
    width = len(names)

    def add(batches):
        def given(key, total):
            at = np.flatnonzero(total.any(axis=1))
            pos = pa.nulls(len(at), pa.int64()) if key[1] == NOWHERE else pa.array(key[1] * WIDTH + at)
            return pa.record_batch([pa.array([key[0]] * len(at), pa.string()), pos, *[pa.array(total[at, k]) for k in range(width)]], names=["contig", "pos", *names])

        last, total = None, None
        for batch in batches:
            for name, tile, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if (name, tile) != last:
                    if last is not None:
                        yield given(last, total)
                    last, total = (name, tile), np.zeros((WIDTH, width), np.int64)
                total += np.frombuffer(counts.as_buffer(), "<i4").reshape(WIDTH, width)
        if last is not None:
            yield given(last, total)

    dealt = tiles.repartition("contig", "tile").sortWithinPartitions("contig", "tile")
    return dealt.mapInArrow(add, f"contig string, pos long, {', '.join(f'{x} long' for x in names)}")


def base_pileup(records: DataFrame) -> DataFrame:
    """(contig, pos, a, c, g, t) from aligned records (contig, pos from 1, cigar, seq): how often reads show each base at a place where any does.

    Other letters than ACGT, in either case, do not count, nor do bases that a cigar names beyond the sequence's end; records without
    a place, cigar or sequence show nothing. What is shuffled is a row for each tile of WIDTH places that a batch of reads meets, with its
    counts, so a place of any depth is a few rows; they are added number by number.
    """

    def count(batches):
        for batch in batches:
            contig = batch.column(0).dictionary_encode()
            codes, names = contig.indices.fill_null(-1).to_numpy(), contig.dictionary
            seq = batch.column(3).cast(pa.large_string()).fill_null("")
            _, where, what = seq.buffers()
            offsets = np.frombuffer(where, np.int64)[seq.offset : seq.offset + len(seq) + 1]
            data = np.frombuffer(what, np.uint8) if what is not None else np.zeros(0, np.uint8)
            pos, cigars = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            begin = 0
            while begin < len(pos):
                end = max(int(np.searchsorted(offsets, offsets[begin] + CHUNK, "right")) - 1, begin + 1)
                own, tile, counts = _counts(codes, pos, cigars, data, offsets, range(begin, end))
                if len(own):
                    blobs = pa.array([c.tobytes() for c in counts.astype("<i4")], pa.binary())
                    yield pa.record_batch([names.take(pa.array(np.where(own < 0, 0, own), mask=own < 0)), pa.array(tile), blobs], names=["contig", "tile", "counts"])
                begin = end

    rows = records.selectExpr("contig", "cast(pos as bigint) as pos", "cigar", "seq")
    tiles = rows.mapInArrow(count, "contig string, tile long, counts binary")
    return _added(tiles, ["a", "c", "g", "t"])


def _spread(codes: np.ndarray, each: list[list]) -> tuple[np.ndarray, np.ndarray]:
    """(row, what each[codes[row]] holds) of all rows, row after row; a code below 0 holds nothing."""
    count = np.array([len(x) for x in each] + [0], np.int64)
    begin = np.cumsum(count) - count
    flat = np.array([y for x in each for y in x], np.int64)
    n = count[codes]
    row = np.repeat(np.arange(len(codes)), n)
    return row, flat[np.arange(len(row)) + np.repeat(begin[codes] - np.cumsum(n) + n, n)] if len(row) else flat[:0]


def _ranks(mm: str) -> list[int]:
    """Which Cs of a read, counted from 0, mm names."""
    found = _SKIPS.search(mm)
    out, last = [], -1
    for skip in found[1].split(",") if found else ():
        if skip:
            last += int(skip) + 1
            out.append(last)
    return out


def _coded(column: pa.Array) -> tuple[np.ndarray, list]:
    """(code of each row, -1 for null; what the codes stand for): what is equal is read once for a batch."""
    column = column.dictionary_encode()
    return column.indices.fill_null(-1).to_numpy(zero_copy_only=False), column.dictionary.to_pylist()


def _calls(pos: np.ndarray, back: np.ndarray, blocks: tuple, named: tuple, ml: tuple, data: np.ndarray, offsets: np.ndarray, most_plain: float, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, whether modified) of the calls at CpGs of some reads. blocks: (row, q, t, n), named: (row, rank), rows in order;
    ml: (values, where each row's begin)."""
    none = np.zeros(0, np.int64)
    own = np.flatnonzero(data == np.where(back, ord("G"), ord("C")).astype(np.uint8).repeat(np.diff(offsets)))
    if not len(own):
        return none, none, none.astype(bool)
    row = np.searchsorted(offsets, own, "right") - 1
    count = np.bincount(row, minlength=len(back))
    rank = np.arange(len(own)) - (np.cumsum(count) - count)[row]
    rank = np.where(back[row], count[row] - 1 - rank, rank)
    beside = own + np.where(back[row], -1, 1)
    inside = (beside >= offsets[row]) & (beside < offsets[row + 1])
    cpg = inside & (data[np.where(inside, beside, 0)] == np.where(back[row], ord("C"), ord("G")))
    row, rank, q = row[cpg], rank[cpg], (own - offsets[row])[cpg]
    # The block that holds the base: rows' blocks begin ever further along the read.
    b_row, b_q, b_t, b_n = blocks
    if not len(b_row):
        return none, none, none.astype(bool)
    at = np.searchsorted(b_row << 32 | b_q, row << 32 | q, "right") - 1
    met = (at >= 0) & (b_row[at] == row) & (q < b_q[at] + b_n[at])
    row, rank, q, at = row[met], rank[met], q[met], at[met]
    chance = np.zeros(len(row))
    n_row, n_rank = named
    if len(n_row):
        key, values, begin = n_row << 32 | n_rank, *ml
        k = np.minimum(np.searchsorted(key, row << 32 | rank), len(key) - 1)
        hit = np.flatnonzero(key[k] == (row << 32 | rank))
        of = row[hit]
        place = begin[of] + k[hit] - np.searchsorted(n_row, of)
        chance[hit] = np.where(place < begin[of + 1], np.append(values, np.nan)[np.minimum(place, len(values))], np.nan)
        chance[hit] = (chance[hit] + 0.5) / 256
    said = (chance >= least) | (chance <= most_plain)  # not where ml has no number
    row, q, at = row[said], q[said], at[said]
    place = np.where(pos[row] == NOWHERE, NOWHERE, pos[row] - 1 + b_t[at] + q - b_q[at] - back[row])
    return row, place, chance[said] >= least


def methyl_counts(records: DataFrame, least_modified: float, least_plain: float) -> DataFrame:
    """(contig, pos, coverage, modified) of methyl_pileup's records. What is shuffled is a row for each tile of WIDTH places that a task's reads
    meet, so neither a base nor a call is a row; a task that holds HELD tiles sends them."""

    def count(batches):
        held: dict[tuple[str | None, int], np.ndarray] = {}

        def sent():
            out = pa.record_batch([pa.array([k[0] for k in held], pa.string()), pa.array([k[1] for k in held], pa.int64()), pa.array([x.astype("<i4").tobytes() for x in held.values()], pa.binary())], names=["contig", "tile", "counts"])
            held.clear()
            return out

        for batch in batches:
            contig, names = _coded(batch.column(0))
            pos = batch.column(1).fill_null(NOWHERE).to_numpy(zero_copy_only=False)
            back = batch.column(2).fill_null("").to_numpy(zero_copy_only=False) == "-"
            cigar, cigars = _coded(batch.column(3))
            walked = [[x for x in stretches(c) if x[2]] for c in cigars]
            mm, mms = _coded(batch.column(5))
            named = [_ranks(x) for x in mms]
            ml = batch.column(6)
            first = np.append(0, np.cumsum(ml.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)))
            values = ml.flatten().cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
            seq = batch.column(4)
            if not pc.all(pc.string_is_ascii(seq), min_count=0).as_py():
                seq = pa.array([None if x is None else x.encode("ascii", "replace").decode() for x in seq.to_pylist()])  # a letter is a byte
            seq = seq.cast(pa.large_string()).fill_null("")
            _, where, what = seq.buffers()
            offsets = np.frombuffer(where, np.int64)[seq.offset : seq.offset + len(seq) + 1]
            data = np.frombuffer(what, np.uint8) if what is not None else np.zeros(0, np.uint8)
            a = 0
            while a < batch.num_rows:
                b = max(int(np.searchsorted(offsets, offsets[a] + CHUNK, "right")) - 1, a + 1)
                parts = [_spread(cigar[a:b], [[x[i] for x in w] for w in walked]) for i in range(3)]
                row, place, modified = _calls(pos[a:b], back[a:b], (parts[0][0], *[p[1] for p in parts]), _spread(mm[a:b], named), (values, first[a : b + 1]), data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], 1 - least_plain, least_modified)
                if len(row):
                    tile, codes = np.where(place == NOWHERE, NOWHERE, place // WIDTH), contig[a:b][row]
                    keys = np.stack([codes, tile], axis=1)
                    heads = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))  # reads run along tiles
                    tiles, at = np.unique(keys[heads], axis=0, return_inverse=True)
                    at = np.repeat(at.reshape(-1), np.diff(np.append(heads, len(keys))))
                    inner = np.where(tile == NOWHERE, 0, place % WIDTH) * 2
                    slot = at * (2 * WIDTH) + inner
                    size = len(tiles) * 2 * WIDTH
                    counts = (np.bincount(slot, minlength=size) + np.bincount(slot[modified] + 1, minlength=size)).reshape(-1, 2 * WIDTH)
                    for (c, k), own in zip(tiles.tolist(), counts, strict=True):
                        key = (None if c < 0 else names[c], k)
                        if key in held:
                            held[key] += own
                        else:
                            held[key] = own.copy()
                    if len(held) > HELD:
                        yield sent()
                a = b
        if held:
            yield sent()

    rows = records.selectExpr("contig", "cast(pos as bigint) as pos", "strand", "cigar", "upper(seq) as seq", "mm", "ml")
    return _added(rows.mapInArrow(count, "contig string, tile long, counts binary"), ["coverage", "modified"])
