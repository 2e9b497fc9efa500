"""Call sets compared by the sequences they spell.

Two callers may write one change in different ways: an indel anywhere in a repeat, two neighbouring bases as one or two variants. Each
variant is trimmed and gets the range over which it can be moved; variants whose ranges meet are a cluster. In a cluster the
largest sets of truth and query variants are sought that turn the reference into the same sequence; those variants match.
"""

from __future__ import annotations

import heapq
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialise
from . import intervals as iv
from .tiles import extract

#: Bases on either side of a variant in which its range is sought: at first, and for those whose range reaches that far.
NEAR, FAR = 64, 65_536
#: Bases on either side of a cluster that both sequences must share, and the gap at which clusters meet.
GAP = 1


def trimmed(ref: str, alt: str) -> tuple[int, str, str]:
    """(bases cut in front, ref, alt) without what both alleles begin or end with."""
    k = 0
    while k < min(len(ref), len(alt)) and ref[len(ref) - 1 - k] == alt[len(alt) - 1 - k]:
        k += 1
    ref, alt = ref[: len(ref) - k], alt[: len(alt) - k]
    k = 0
    while k < min(len(ref), len(alt)) and ref[k] == alt[k]:
        k += 1
    return k, ref[k:], alt[k:]


def movable(bases: str, at: int, ref: str, alt: str) -> tuple[int, int]:
    """[first, last) of the bases that a trimmed variant at `at` can touch when it is moved. Only a pure insertion or deletion moves: to the
    left while the base before it is its last one, to the right while the base behind it is its first one."""
    if ref and alt:
        return at, at + len(ref)
    low, unit = at, ref or alt
    while unit and low > 0 and bases[low - 1] == unit[-1]:
        low, unit = low - 1, unit[-1] + unit[:-1]
    high, unit = at + len(ref), ref or alt
    while unit and high < len(bases) and bases[high] == unit[0]:
        high, unit = high + 1, unit[1:] + unit[0]
    return low, high


def matched(bases: str, truth: list[tuple[int, int, str]], query: list[tuple[int, int, str]]) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """Places in truth and query of the largest sets of variants (start, bases replaced, alt; in order) that spell the same sequence over `bases`.

    Both sides are read from left to right, always the one whose sequence is shorter; a state is how far each has come and what one
    is ahead. Of equal sets the first by place counts; each side gives one variant at least.
    """
    sides = (truth, query)
    first = [{}, {}]
    for s, own in enumerate(sides):
        for k, v in enumerate(own):
            first[s].setdefault(v[0], []).append(k)
    end = len(bases)
    start = (0, 0, 0, 0, 0, "")  # truth: place, next variant; query: the same; the side ahead, by what
    best = {start: (0, (), ())}
    heap = [(0, 0, start)]
    done = set()
    while heap:
        _, _, state = heapq.heappop(heap)
        if state in done:
            continue
        done.add(state)
        score, used_t, used_q = best[state]
        i, ki, j, kj, ahead, extra = state
        if i == end and j == end and not extra and ki >= len(truth) and kj >= len(query):
            continue
        # The side behind moves; if neither is ahead, the one that has read less.
        s = 1 - ahead if extra else (0 if (i, ki) <= (j, kj) else 1)
        at, k = ((i, ki), (j, kj))[s]
        if at == end and not any(v >= k for v in first[s].get(at, ())):
            if extra:
                continue
            s = 1 - s
            at, k = ((i, ki), (j, kj))[s]
        moves = [(v, sides[s][v][1], sides[s][v][2]) for v in first[s].get(at, ()) if v >= k and at + sides[s][v][1] <= end]
        if at < end:
            moves.append((None, 1, bases[at]))
        elif any(v >= k for v in first[s].get(at, ())):
            moves.append((None, 0, ""))
        for v, n, said in moves:
            new_at, new_k = at + n, (len(sides[s]) if at == end and v is None else k) if v is None else v + 1
            if extra and s != ahead:
                m = min(len(extra), len(said))
                if extra[:m] != said[:m]:
                    continue
                rest, front = (extra[m:], ahead) if len(extra) > m else (said[m:], s)
            else:
                rest, front = extra + said, s
            front = front if rest else 0
            place = (new_at, new_k, j, kj) if s == 0 else (i, ki, new_at, new_k)
            t, q = (used_t + (v,), used_q) if v is not None and s == 0 else (used_t, used_q + (v,)) if v is not None else (used_t, used_q)
            new = (*place, front, rest)
            value = (score + (v is not None), t, q)
            old = best.get(new)
            if old is None or value[0] > old[0] or (value[0] == old[0] and (value[1], value[2]) < (old[1], old[2])):
                best[new] = value
                done.discard(new)
                heapq.heappush(heap, (place[0] + place[2], place[1] + place[3], new))
    ends = [v for (i, _, j, _, _, extra), v in best.items() if i == end and j == end and not extra]
    good = [v for v in ends if v[1] and v[2]]
    if not good:
        return (), ()
    top = max(v[0] for v in good)
    return min((v[1], v[2]) for v in good if v[0] == top)


def _ranged(variants: DataFrame, reference: DataFrame, reach: int) -> DataFrame:
    """variants with fits, start, n, put (the trimmed variant), low, high (its range) and far, whether the range may go on."""
    names = variants.columns
    asked = variants.withColumns({"start_pos": F.greatest(F.col("pos") - 1 - reach, F.lit(0)), "end_pos": F.col("pos") - 1 + F.length("ref") + reach})
    met = extract(reference, asked).withColumnRenamed("name", "contig")
    kind = {f.name: f.dataType.simpleString() for f in met.schema}
    schema = ", ".join([*[f"`{c}` {kind[c]}" for c in names], "fits boolean, start long, n int, put string, low long, high long, far boolean"])

    def place(batches):
        for batch in batches:
            out = []
            for pos, ref, alt, begin, bases in zip(*(batch.column(c).to_pylist() for c in ("pos", "ref", "alt", "start_pos", "seq")), strict=True):
                bases, at = (bases or "").upper(), pos - 1 - begin
                ref, alt = ref.upper(), alt.upper()
                fits = bases[at : at + len(ref)] == ref and at >= 0
                cut, short, put = trimmed(ref, alt)
                at += cut
                low, high = movable(bases, at, short, put) if fits else (at, at + len(short))
                out.append((fits, begin + at, len(short), put, begin + low, begin + high, fits and ((low == 0 and begin > 0) or high == len(bases))))
            columns = zip(*out, strict=True) if out else [[]] * 7
            kinds = (pa.bool_(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.bool_())
            yield pa.record_batch([*[batch.column(c) for c in names], *[pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]], names=[*names, "fits", "start", "n", "put", "low", "high", "far"])

    return met.mapInArrow(place, schema)


def match_calls(truth: DataFrame, query: DataFrame, reference: DataFrame) -> DataFrame:
    """(contig, pos, ref, alt, side, matched) of the distinct variants (contig, pos from 1, ref, alt) of truth and query over the reference
    (name, seq). A variant whose ref is not the reference's, or whose contig is unknown, matches nothing, as does a null one. A
    variant in a repeat of more than FAR bases is placed within that many. Clusters are dealt each to one task. Writes tables to the shared folder when called.
    """
    key = ["contig", "pos", "ref", "alt"]
    side = lambda calls, name: calls.select("contig", F.col("pos").cast("long").alias("pos"), "ref", "alt").distinct().withColumn("side", F.lit(name))
    # What is read more than once is written once, the reference too: it may be made by a query.
    reference = materialise(reference.select("name", "seq"), "reference")
    every = materialise(side(truth, "truth").unionByName(side(query, "query")), "calls")
    named = every.where("contig is not null and pos >= 1 and ref is not null and alt is not null and ref != alt")
    near = materialise(_ranged(named, reference, NEAR), "near")
    ranged = near.where("not far").unionByName(_ranged(near.where("far").select(*named.columns), reference, FAR))
    good = ranged.where("fits").select(*named.columns, "start", "n", "put", (F.col("low") - GAP).alias("start_pos"), (F.col("high") + GAP).alias("end_pos"))
    good = materialise(good, "good")
    islands = iv.islands(good.select("contig", "start_pos", "end_pos").distinct(), ["contig"], "start_pos", "end_pos", 0)
    segments = extract(reference, islands.withColumn("from", F.greatest("start_pos", F.lit(0)))).withColumnRenamed("name", "contig").withColumnRenamed("seq", "bases")
    segments = materialise(segments, "segments")
    met = iv.overlaps(good, segments).select(*named.columns, "start", "n", "put", F.col("b_from").alias("from"), F.col("b_bases").alias("bases"))

    def replay(batches):
        rows = (r for batch in batches for r in batch.to_pylist())
        for _, own in groupby(rows, lambda r: (r["contig"], r["from"])):
            own = list(own)
            sides = {s: sorted((r["start"] - r["from"], r["n"], r["put"], r["pos"], r["ref"], r["alt"]) for r in own if r["side"] == s) for s in ("truth", "query")}
            found = matched(own[0]["bases"].upper(), [v[:3] for v in sides["truth"]], [v[:3] for v in sides["query"]])
            out = [(own[0]["contig"], *sides[s][k][3:], s) for s, places in zip(("truth", "query"), found, strict=True) for k in places]
            if out:
                contig, pos, ref, alt, side = zip(*out, strict=True)
                yield pa.record_batch([pa.array(contig), pa.array(pos, pa.int64()), pa.array(ref), pa.array(alt), pa.array(side)], names=[*key, "side"])

    dealt = met.repartition("contig", "from").sortWithinPartitions("contig", "from")
    same = dealt.mapInArrow(replay, "contig string, pos long, ref string, alt string, side string").withColumn("matched", F.lit(True))
    return every.join(same, [*key, "side"], "left").withColumn("matched", F.coalesce("matched", F.lit(False)))


def compare_haplotypes(truth: DataFrame, query: DataFrame, reference: DataFrame) -> DataFrame:
    """Per contig: truth and query variants that match, those that do not, precision and recall, as match_calls finds them."""
    t, q = F.col("side") == "truth", F.col("side") == "query"
    out = match_calls(truth, query, reference).groupBy("contig").agg(F.count_if(t & F.col("matched")).alias("truth_shared"), F.count_if(q & F.col("matched")).alias("query_shared"), F.count_if(t & ~F.col("matched")).alias("only_truth"), F.count_if(q & ~F.col("matched")).alias("only_query"))
    share = lambda a, b: F.col(a) / F.nullif(F.col(a) + F.col(b), F.lit(0))
    return out.withColumns({"precision": share("query_shared", "only_query"), "recall": share("truth_shared", "only_truth")})
