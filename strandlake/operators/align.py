"""Edit distances by bit vectors: adapters in reads, merged structural variants, telomere repeats at ends."""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import intervals as iv

#: Bases of reads that are aligned side by side.
CHUNK = 16_000_000
_CODE = np.full(256, 4, np.uint8)
for _i, _c in enumerate("ACGT"):
    _CODE[ord(_c)] = _CODE[ord(_c.lower())] = _i
_ONE = np.uint64(1)


def _columns(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """(fewest edits of the whole pattern anywhere in each text, edits of each prefix of the pattern that ends where the text ends).

    A column of the table of edits is two bit vectors of its vertical steps; all texts go on by one base at a time. sizes descend.
    """
    m, n = len(pattern), len(sizes)
    if m > 64:
        raise ValueError("a pattern has 64 bases at most")
    equal = np.zeros(5, np.uint64)
    for i, c in enumerate(pattern):
        equal[_CODE[ord(c)]] |= _ONE << np.uint64(i)
    equal[4] = 0
    up, down = np.full(n, ~np.uint64(0)), np.zeros(n, np.uint64)
    score, best = np.full(n, m, np.int16), np.full(n, m, np.int16)
    top = np.uint64(m - 1)
    live = n
    for t in range(int(sizes[0]) if n else 0):
        while sizes[live - 1] <= t:
            live -= 1
        p, d = up[:live], down[:live]
        eq = equal[codes[starts[:live] + t]]
        xv = eq | d
        xh = (((eq & p) + p) ^ p) | eq
        ph, mh = d | ~(xh | p), p & xh
        score[:live] += ((ph >> top) & _ONE).astype(np.int16) - ((mh >> top) & _ONE).astype(np.int16)
        np.minimum(best[:live], score[:live], out=best[:live])
        ph, mh = ph << _ONE, mh << _ONE
        up[:live] = mh | ~(xv | ph)
        down[:live] = ph & xv
    bits = np.arange(m, dtype=np.uint64)
    steps = ((up[:, None] >> bits) & _ONE).astype(np.int16) - ((down[:, None] >> bits) & _ONE).astype(np.int16)
    return best, np.cumsum(steps, axis=1)


def holds_adapter(seqs: pa.Array, adapters: tuple[str, ...], error_rate: float, overlap: int) -> np.ndarray:
    """Whether each sequence holds an adapter on either strand: whole, within error_rate edits a base of it, or a part of at least `overlap` bases
    of it, its end at the sequence's start or its start at the sequence's end, within error_rate edits a base of the part."""
    complement = str.maketrans("ACGT", "TGCA")
    patterns = sorted({x for a in adapters for x in (a.upper(), a.upper().translate(complement)[::-1])})
    seqs = seqs.cast(pa.large_string()).fill_null("")
    _, where, what = seqs.buffers()
    offsets = np.frombuffer(where, np.int64)[seqs.offset : seqs.offset + len(seqs) + 1]
    data = _CODE[np.frombuffer(what, np.uint8)[: offsets[-1]]] if what is not None else np.zeros(0, np.uint8)
    sizes = np.diff(offsets)
    order = np.argsort(-sizes, kind="stable")
    found = np.zeros(len(sizes), bool)
    k = 0
    while k < len(order):
        end = max(k + 1, k + int(CHUNK // max(int(sizes[order[k]]), 1)))
        rows = order[k:end]
        for a in patterns:
            most = np.floor(error_rate * np.arange(1, len(a) + 1) + 1e-9)
            part = np.arange(1, len(a) + 1) >= overlap
            best, ending = _columns(data, offsets[rows], sizes[rows], a)
            found[rows] |= (best <= most[-1]) | ((ending <= most) & part).any(axis=1)
            # The start of a sequence is the end of its reverse.
            near = np.minimum(sizes[rows], len(a) + int(most[-1]) + 1)
            by = np.argsort(-near, kind="stable")
            flat = np.concatenate([data[offsets[r] : offsets[r] + n][::-1] for r, n in zip(rows[by].tolist(), near[by].tolist(), strict=True)])
            _, ending = _columns(flat, np.cumsum(near[by]) - near[by], near[by], a[::-1])
            found[rows[by]] |= ((ending <= most) & part).any(axis=1)
        k = end
    return found


def discard_adapters(reads: DataFrame, adapters: tuple[str, ...], error_rate: float = 0.05, overlap: int = 35) -> DataFrame:
    """Reads (seq, ...) that hold none of the adapters, of 64 bases at most, as holds_adapter says. A read without bases stays, as does one
    whose seq is null; lower case counts as upper case. One map."""

    def keep(batches):
        for batch in batches:
            seq = batch.column(batch.schema.get_field_index("seq"))
            yield batch.filter(pa.array(~holds_adapter(seq, adapters, error_rate, overlap)))

    return reads.mapInArrow(keep, reads.schema)


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance; a column of the table is one number of len(a) bits."""
    if not a or not b:
        return len(a) + len(b)
    equal: dict[str, int] = {}
    for i, c in enumerate(a):
        equal[c] = equal.get(c, 0) | 1 << i
    every, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, score = every, 0, len(a)
    for c in b:
        eq = equal.get(c, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph, mh = (down | ~(xh | up)) & every, up & xh
        score += bool(ph & top) - bool(mh & top)
        ph, mh = (ph << 1 | 1) & every, mh << 1 & every
        up, down = (mh | ~(xv | ph)) & every, ph & xv
    return score


def grown_forest(calls: list[tuple[int, int, str, str]], reach: float, likeness: float | None) -> list[int]:
    """A group number for each of the calls (pos, length, caller, alt), in order of pos. Links, shortest first, join groups that have no caller in
    common. A link: another caller, a distance in (pos, length) of at most reach, and with likeness 1 - edits / length at least that."""
    links = []
    for i, (pos, length, caller, alt) in enumerate(calls):
        for j in range(i + 1, len(calls)):
            if calls[j][0] - pos > reach:
                break
            far = (calls[j][0] - pos) ** 2 + (calls[j][1] - length) ** 2
            if far <= reach**2 and calls[j][2] != caller and (likeness is None or 1 - edit_distance(alt, calls[j][3]) / max(len(alt), len(calls[j][3]), 1) >= likeness):
                links.append((far, i, j))
    parent, callers = list(range(len(calls))), [{c[2]} for c in calls]

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for _, i, j in sorted(links):
        a, b = root(i), root(j)
        if a != b and not callers[a] & callers[b]:
            parent[max(a, b)] = min(a, b)
            callers[min(a, b)] |= callers[max(a, b)]
    return [root(i) for i in range(len(calls))]


def merge_calls(calls: DataFrame, reach: int = 500, least_identity: float = 0.3, least_support: int = 3) -> DataFrame:
    """(contig, kind, strand, first, last, callers, support, alt) of structural variant calls (caller, contig, pos, kind, strand, support, alt) that
    are one variant.

    Supported calls of equal contig, kind and strand are joined by grown_forest; insertions must be alike. Of calls of one caller, place and
    alt the best supported counts. The call with most support (ties: the first by place, length, caller, alt) gives the alt. A null caller or
    alt is ''; calls without a contig or place go. Calls farther apart than reach never meet, so stretches of calls are dealt each to one task.
    """
    group = F.concat_ws("\x01", "contig", F.coalesce("kind", F.lit("\x02")), F.coalesce("strand", F.lit("\x02")))
    good = calls.where((F.col("support") >= least_support) & F.col("contig").isNotNull() & F.col("pos").isNotNull())
    good = good.select(group.alias("group"), "contig", "kind", "strand", F.col("pos").cast("long").alias("pos"), F.coalesce("caller", F.lit("")).alias("caller"), F.coalesce("alt", F.lit("")).alias("alt"), F.col("support").cast("long").alias("support"))
    good = good.groupBy("group", "contig", "kind", "strand", "pos", "caller", "alt").agg(F.max("support").alias("support"))
    rows = good.withColumnRenamed("contig", "where").withColumnsRenamed({"group": "contig"}).withColumns({"start_pos": F.col("pos"), "end_pos": F.col("pos") + 1, "length": F.length("alt")})
    islands = iv.islands(rows.select("contig", "start_pos", "end_pos"), ["contig"], "start_pos", "end_pos", reach)
    met = iv.overlaps(rows, islands).select("contig", F.col("b_start_pos").alias("island"), "pos", "length", "caller", "alt", "support", "where", "kind", "strand")
    dealt = met.repartition("contig", "island").sortWithinPartitions("contig", "island", "pos", "length", "caller", "alt")

    def join(batches):
        stream = (r for batch in batches for r in batch.to_pylist())
        for _, own in groupby(stream, lambda r: (r["contig"], r["island"])):
            own = list(own)
            roots = grown_forest([(r["pos"], r["length"], r["caller"], r["alt"]) for r in own], reach, least_identity if own[0]["kind"] == "INS" else None)
            made: dict[int, list] = {}
            for r, x in zip(own, roots, strict=True):
                made.setdefault(x, []).append(r)
            out = [(g[0]["where"], g[0]["kind"], g[0]["strand"], g[0]["pos"], g[-1]["pos"], len({r["caller"] for r in g}), sum(r["support"] for r in g), max(g, key=lambda r: r["support"])["alt"]) for g in made.values()]
            columns = list(zip(*out, strict=True))
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["contig", "kind", "strand", "first", "last", "callers", "support", "alt"])

    return dealt.mapInArrow(join, "contig string, kind string, strand string, first long, last long, callers long, support long, alt string")


def repeat_run(hits: np.ndarray, penalty: int, drop: int) -> tuple[int, int]:
    """(windows of the best run from the front on, its score): hits are worth 1, other windows cost penalty; a run ends where it has lost more
    than drop since its best."""
    if not len(hits):
        return 0, 0
    score = np.cumsum(np.where(hits, 1, -penalty))
    most = np.maximum(np.maximum.accumulate(score), 0)
    broken = np.flatnonzero(most - score > drop)
    score = score[: broken[0]] if len(broken) else score
    if not len(score) or score.max() <= 0:
        return 0, 0
    at = int(np.argmax(score))
    return at + 1, int(score[at])


def telomere_repeats(sequences: DataFrame, motif: str = "TTAGGG", edge: int = 100_000, penalty: int = 1, drop: int = 2000, least: int = 300) -> DataFrame:
    """(name, end, start_pos, end_pos, score): repeats of the motif, or its reverse complement, at the start and the end of sequences (name, seq).

    A window of the motif's length counts as a hit in any rotation of the motif on either strand, so changed, lost and added bases cost a few
    windows each. Within the outer `edge` bases the best run from the end inwards, as repeat_run says, is a row if it scores `least`.
    """
    k = len(motif)
    strands = (motif.upper(), motif.upper().translate(str.maketrans("ACGT", "TGCA"))[::-1])
    wanted = {int("".join(str(_CODE[ord(c)]) for c in (s + s)[i : i + k]), 4) for s in strands for i in range(k)}
    table = np.zeros(4**k, bool)
    table[list(wanted)] = True

    def hits(bases: str) -> np.ndarray:
        codes = _CODE[np.frombuffer(bases.encode("ascii", "replace"), np.uint8)].astype(np.int64)
        n = len(codes) - k + 1
        if n <= 0:
            return np.zeros(0, bool)
        value, bad = np.zeros(n, np.int64), np.zeros(n, bool)
        for i in range(k):
            value = value * 4 + (codes[i : i + n] & 3)
            bad |= codes[i : i + n] > 3
        return table[value] & ~bad

    def find(batches):
        for batch in batches:
            out = []
            for name, n, left, right in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for end, run in (("start", repeat_run(hits(left or ""), penalty, drop)), ("end", repeat_run(hits(right or "")[::-1], penalty, drop))):
                    windows, score = run
                    if windows and score >= least:
                        reach = windows + k - 1
                        out.append((name, end, 0 if end == "start" else n - reach, reach if end == "start" else n, score))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(list(c), x) for c, x in zip(columns, kinds, strict=True)], names=["name", "end", "start_pos", "end_pos", "score"])

    ends = sequences.select("name", F.length("seq").cast("long").alias("n"), F.left("seq", F.lit(edge)).alias("left"), F.right("seq", F.lit(edge)).alias("right"))
    return ends.mapInArrow(find, "name string, `end` string, start_pos long, end_pos long, score long")
