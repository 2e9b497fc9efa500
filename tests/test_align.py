"""Bit-vector alignment, the forest of calls and telomere repeats against plain tables and brute force."""

import numpy as np
import pyarrow as pa


def table(pattern, text):
    """Edits of each prefix of the pattern that ends at each place of the text, wherever it begins."""
    d = np.zeros((len(pattern) + 1, len(text) + 1), int)
    d[:, 0] = np.arange(len(pattern) + 1)
    for i in range(1, len(pattern) + 1):
        for j in range(1, len(text) + 1):
            d[i, j] = min(d[i - 1, j - 1] + (pattern[i - 1] != text[j - 1]), d[i - 1, j] + 1, d[i, j - 1] + 1)
    return d


def brute(read, adapters, rate, overlap):
    read = (read or "").upper()
    for a in {x for y in adapters for x in (y, y.translate(str.maketrans("ACGT", "TGCA"))[::-1])}:
        most = lambda n: int(np.floor(rate * n + 1e-9))
        d, back = table(a, read), table(a[::-1], read[::-1])
        if d[len(a)].min() <= most(len(a)) or any(d[n, -1] <= most(n) or back[n, -1] <= most(n) for n in range(overlap, len(a) + 1)):
            return True
    return False


def worn(rng, s, rate):
    out = []
    for c in s:
        x = rng.random()
        out.append("" if x < rate / 3 else rng.choice(list("ACGT")) + c if x < 2 * rate / 3 else rng.choice(list("ACGT")) if x < rate else c)
    return "".join(out)


def test_adapters_against_the_whole_table(spark):
    from strandlake.operators.align import discard_adapters, holds_adapter

    rng = np.random.default_rng(2)
    adapters = tuple("".join(rng.choice(list("ACGT"), n)) for n in (20, 31))
    reads = []
    for k in range(240):
        a = adapters[k % 2]
        a = a.translate(str.maketrans("ACGT", "TGCA"))[::-1] if k % 3 == 0 else a
        a = worn(rng, a, 0.12)
        body = "".join(rng.choice(list("ACGT"), int(rng.integers(0, 120))))
        cut = int(rng.integers(10, 31))
        reads.append([body + a + body[::-1], a[-cut:] + body, body + a[:cut], body][k % 4])
    reads += ["", None, "N" * 50, adapters[0].lower(), "é" + adapters[1], adapters[0][:15], adapters[0] * 3]
    for rate, overlap in ((0.0, 12), (0.1, 12), (0.15, 18)):
        want = [brute(r, adapters, rate, overlap) for r in reads]
        assert holds_adapter(pa.array(reads), adapters, rate, overlap).tolist() == want
        assert 20 < sum(want) < len(reads)
        df = spark.createDataFrame([(i, r) for i, r in enumerate(reads)], "id long, seq string").repartition(3)
        assert {r.id for r in discard_adapters(df, adapters, rate, overlap).collect()} == {i for i, w in enumerate(want) if not w}
    assert discard_adapters(df.limit(0), adapters).count() == 0


def test_edit_distance():
    from strandlake.operators.align import edit_distance

    rng = np.random.default_rng(3)
    for _ in range(200):
        a, b = ("".join(rng.choice(list("AC"), int(rng.integers(0, 90)))) for _ in range(2))
        d = np.arange(len(b) + 1)
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(d[j - 1] + (x != y), d[j] + 1, new[-1] + 1))
            d = new
        assert edit_distance(a, b) == d[-1]


def test_merged_calls_are_those_of_the_whole_forest(spark):
    from strandlake.operators.align import edit_distance, merge_calls

    rng = np.random.default_rng(4)
    rows = []
    for _ in range(1000):
        pos = int(rng.integers(0, 400)) * 150 + int(rng.integers(0, 200))
        kind = str(rng.choice(["INS", "DEL"]))
        rows.append((f"c{rng.integers(0, 4)}", f"chr{rng.integers(0, 2)}", pos, kind, "+", int(rng.integers(1, 20)), "".join(rng.choice(list("ACGT"), int(rng.integers(1, 60)))) if kind == "INS" else "N" * int(rng.integers(1, 700))))
    rows += [rows[0], (None, "chr0", 5, None, None, 9, None), ("c1", None, 5, "INS", "+", 9, "A"), ("c1", "chr0", None, "INS", "+", 9, "A")]
    df = spark.createDataFrame(rows, "caller string, contig string, pos long, kind string, strand string, support int, alt string")
    got = sorted(map(tuple, merge_calls(df.repartition(5)).collect()), key=str)
    best = {}
    for caller, contig, pos, kind, strand, support, alt in rows:
        if support >= 3 and contig is not None and pos is not None:
            key = (contig, kind, strand, pos, len(alt or ""), caller or "", alt or "")
            best[key] = max(best.get(key, 0), support)
    calls = sorted(best, key=str)
    links = []
    for i, a in enumerate(calls):
        for j, b in enumerate(calls):
            far = (a[3] - b[3]) ** 2 + (a[4] - b[4]) ** 2
            if a[:3] == b[:3] and a[3:] < b[3:] and a[5] != b[5] and far <= 500**2 and (a[1] != "INS" or 1 - edit_distance(a[6], b[6]) / max(len(a[6]), len(b[6]), 1) >= 0.3):
                links.append((far, a[3:], b[3:], i, j))
    groups = {i: {i} for i in range(len(calls))}
    for *_, i, j in sorted(links):
        a, b = groups[i], groups[j]
        if a is not b and not {calls[k][5] for k in a} & {calls[k][5] for k in b}:
            a |= b
            for k in b:
                groups[k] = a
    want = []
    for g in {id(g): g for g in groups.values()}.values():
        own = sorted((calls[k] for k in g), key=lambda c: c[3:])
        want.append((*own[0][:3], own[0][3], own[-1][3], len({c[5] for c in own}), sum(best[c] for c in own), max(own, key=lambda c: best[c])[6]))
    assert got == sorted(want, key=str) and len(want) < len(calls) - 50
    assert merge_calls(df.limit(0)).count() == 0


def test_worn_telomeres(spark):
    from strandlake.operators.align import telomere_repeats

    def brute_run(seq, penalty, drop):
        rotations = {(s + s)[i : i + 6] for s in ("TTAGGG", "CCCTAA") for i in range(6)}
        score = best = at = 0
        for i in range(len(seq) - 5):
            score += 1 if seq[i : i + 6].upper() in rotations else -penalty
            if score > best:
                best, at = score, i + 1
            if best - score > drop:
                break
        return at, best

    rng = np.random.default_rng(6)
    rows = [(f"s{i}", worn(rng, "CCCTAA" * int(rng.integers(0, 80)), 0.05) + "".join(rng.choice(list("ACGTN"), 300)) + worn(rng, "ttaggg" * int(rng.integers(0, 80)), 0.08)) for i in range(60)] + [("e", ""), ("n", None), (None, "TTAGGG" * 20), ("short", "TTAG")]
    df = spark.createDataFrame(rows, "name string, seq string").repartition(3)
    for drop, least, edge in ((50, 30, 10_000), (20, 100, 200)):
        want = []
        for name, seq in rows:
            for end, part in (("start", (seq or "")[:edge]), ("end", (seq or "")[-edge:])):
                at, best = brute_run(part if end == "start" else part[::-1].translate(str.maketrans("ACGTacgt", "TGCAtgca")), 1, drop)
                if at and best >= least:
                    want.append((name, end, 0 if end == "start" else len(seq) - at - 5, at + 5 if end == "start" else len(seq), best))
        got = telomere_repeats(df, edge=edge, drop=drop, least=least).collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str) and len(want) > 20
