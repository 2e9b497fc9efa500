"""Matching of call sets against brute force over all subsets, and different spellings of one sequence."""

from itertools import combinations

import numpy as np


def spelled(bases, variants):
    """The sequence of non-overlapping variants (start, n, alt), or None."""
    out, at = [], 0
    for s, n, alt in variants:
        if s < at or s + n > len(bases):
            return None
        out += [bases[at:s], alt]
        at = s + n
    return "".join([*out, bases[at:]])


def brute(bases, truth, query):
    def every(own):
        found = {}
        for k in range(1, len(own) + 1):
            for places in combinations(range(len(own)), k):
                s = spelled(bases, [own[i] for i in places])
                if s is not None:
                    found[s] = max(found.get(s, 0), k)
        return found

    a, b = every(truth), every(query)
    return max((a[s] + b[s] for s in a if s in b), default=0)


def test_matched_against_all_subsets():
    from strandlake.operators.haplotypes import matched

    rng = np.random.default_rng(0)
    seen = 0
    for _ in range(1500):
        bases = "".join(rng.choice(list("AC"), int(rng.integers(3, 12))))
        sides = []
        for _ in range(2):
            own = set()
            for _ in range(int(rng.integers(0, 5))):
                s, n = int(rng.integers(0, len(bases) + 1)), int(rng.integers(0, 3))
                alt = "".join(rng.choice(list("AC"), int(rng.integers(0, 3))))
                if s + n <= len(bases) and bases[s : s + n] != alt:
                    own.add((s, n, alt))
            sides.append(sorted(own))
        want = brute(bases, *sides)
        t, q = matched(bases, *sides)
        assert len(t) + len(q) == want, (bases, sides, t, q, want)
        if want:
            seen += 1
            assert spelled(bases, [sides[0][i] for i in t]) == spelled(bases, [sides[1][i] for i in q]) is not None
    assert seen > 100


def test_trimmed_and_movable():
    from strandlake.operators.haplotypes import movable, trimmed

    assert trimmed("ACA", "A") == (0, "AC", "") and trimmed("AC", "ATC") == (1, "", "T") and trimmed("ACG", "ATG") == (1, "C", "T")
    assert movable("GACACACT", 1, "AC", "") == (1, 7) and movable("GACACACT", 5, "AC", "") == (1, 7)
    assert movable("GACACACT", 3, "", "AC") == (1, 7) and movable("GACT", 1, "A", "T") == (1, 2) and movable("AAAA", 2, "", "A") == (0, 4)


def test_calls_with_other_spellings(spark):
    from strandlake.operators.haplotypes import compare_haplotypes, match_calls

    repeat = "CA" * 200  # longer than the first look
    chr1 = "GGTTACGTAC" + repeat + "TTGACGGATCC"
    end = len("GGTTACGTAC" + repeat)
    truth = [("1", 3, "T", "A"), ("1", 5, "AC", "GT"), ("1", 10, "CCA", "C"), ("1", end + 6, "G", "T"), ("1", end + 2, "T", "C"), ("1", 1, "T", "A"), ("2", 1, "A", "C"), (None, 1, "A", "C"), ("3", 1, "A", "C"), ("1", 4, None, "C")]
    query = [("1", 5, "A", "G"), ("1", 6, "C", "T"), ("1", end - 2, "ACA", "A"), ("1", end + 6, "G", "C"), ("1", end + 2, "T", "C"), ("1", end + 2, "T", "C"), ("1", 3, "TT", "AT")]
    fields = "contig string, pos int, ref string, alt string"
    reference = spark.createDataFrame([("1", chr1), ("2", "a"), ("4", None)], "name string, seq string")
    t, q = spark.createDataFrame(truth, fields), spark.createDataFrame(query, fields)
    got = {(r.contig, r.pos, r.ref, r.alt, r.side) for r in match_calls(t, q, reference).where("matched").collect()}
    want_t, want_q = [truth[i] for i in (0, 1, 2, 4)], [query[i] for i in (0, 1, 2, 4, 6)]
    assert got == {(*v, "truth") for v in want_t} | {(*v, "query") for v in want_q}
    rows = {r.contig: r for r in compare_haplotypes(t, q, reference).collect()}
    assert (rows["1"].truth_shared, rows["1"].query_shared, rows["1"].only_truth, rows["1"].only_query) == (4, 5, 3, 1)
    assert rows["2"].precision is None and rows["2"].recall == 0
    assert compare_haplotypes(t.limit(0), q.limit(0), reference).count() == 0
