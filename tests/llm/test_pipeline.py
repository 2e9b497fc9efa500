"""Stages of the corpus pipeline against brute force."""

import zlib

import numpy as np
import pyarrow as pa


def test_classifier_stage_rejects_what_passes_the_rules(spark, tmp_path):
    from corpus_pipeline import SCORE, quality_classifier, quality_rules
    from strandlake.llm.mil import fit_bags, passages

    rng = np.random.default_rng(2)
    good, bad = ([f"{c}{x}{y}o" for x in "bdfgl" for y in "aeiu"] for c in "tk")
    text = lambda vocabulary, n: " ".join(rng.choice(vocabulary, n))
    # Labelled low-quality texts are too short for the rules; texts like them, but long enough, carry no label.
    rows = [(i, text(good, 40 if i % 2 else 120), 1) for i in range(100)] + [(i, text(bad, 40), 0) for i in range(100, 200)]
    planted = range(200, 240)
    rows += [(i, text(bad, 120), None) for i in planted] + [(i, text(good, 120), None) for i in range(240, 280)] + [(280, None, None)]
    folder = f"file://{tmp_path}"
    spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, y) for i, _, y in rows if y is not None], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")

    ruled = quality_rules(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder).cache()
    got = {r.doc_id for r in quality_classifier(spark, ruled, folder).collect()}
    left = {r.doc_id: r.text for r in ruled.collect()}
    assert set(planted) <= set(left) and not set(range(100, 200)) & set(left)

    fit = sorted((r for r in rows if r[2] is not None and zlib.crc32(str(r[0]).encode()) % 5), key=lambda r: str(r[0]))
    model = fit_bags([passages(pa.array([t]))[0] for _, t, _ in fit], np.array([y for _, _, y in fit]))
    assert got == {i for i, t in left.items() if model.score(pa.array([t]))[0] >= SCORE}
    assert not got & set(planted) and set(range(240, 280)) <= got


def test_join_mix_and_packing_of_what_is_left(spark, tmp_path):
    """The last three stages, one after the other as run() does, against sets, targets and plain calls of the tokenizer."""
    import re
    from collections import Counter, defaultdict

    import public_tokenizers
    from tokenizers import Tokenizer

    from corpus_pipeline import STAGES

    rng = np.random.default_rng(8)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(60):
        text = " ".join(rng.choice(vocabulary, int(rng.integers(60, 200))))
        rows.append((i, text, "en", ["s1", "s2", "s3", None][i % 4], len(text), "x"))
        if i % 3 == 0:  # a near copy, and an exact one
            words = text.split(" ")
            words[5] = "changed"
            rows += [(100 + i, " ".join(words), "en", "s1", 0, "y"), (200 + i, text.upper(), "en", "s2", 0, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size string").repartition(3)
    stages, folder = dict(STAGES), f"file://{tmp_path}"

    def through(name, df):
        stages[name](spark, df, folder).write.parquet(f"{folder}/{name.replace(' ', '-')}")
        return spark.read.parquet(f"{folder}/{name.replace(' ', '-')}")

    left = through("n-gram Jaccard join", docs)
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in ((r[0], r[1].lower().split(" ")) for r in rows)}
    near = {i: {j for j in sets if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])} for i in sets}
    parts, seen = {}, set()
    for i in sorted(sets):
        if i not in seen:
            own, todo = set(), [i]
            while todo:
                x = todo.pop()
                if x not in own:
                    own.add(x)
                    todo += near[x]
            seen |= own
            parts[i] = own
    assert {r.doc_id for r in left.collect()} == set(parts) and len(parts) == 60

    mixed = through("mixing", left)
    text_of = {r[0]: r[1].split(" ") for r in rows}
    taken, source = Counter(), {r[0]: r[3] for r in rows}
    for r in mixed.collect():
        own, whole = re.findall(r"\S+", r.text), text_of[r.doc_id] * 2
        taken[r.doc_id] += len(own)
        at = 0
        for w in own:  # words of the document, in its order
            at = whole.index(w, at) + 1
        assert r.n_chars == len(r.text) and r.source == source[r.doc_id] and r.size == "x"
    assert all(taken[i] <= 2 * len(text_of[i]) for i in parts)
    size, got = Counter(), Counter()
    for i in parts:
        size[source[i]] += len(text_of[i])
        got[source[i]] += taken[i]
    order, weight = sorted(size, key=lambda s: (s is None, s or "")), {}
    for k, s in enumerate(order):
        weight[s] = (5, 2, 1)[k % 3]
    target, open_ = {}, set(order)
    total = 1.5 * sum(size.values())
    while open_:
        share = {s: total * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 2 * size[s]}
        if not full:
            target |= share
            break
        target |= {s: 2 * size[s] for s in full}
        total -= sum(2 * size[s] for s in full)
        open_ -= full
    assert all(abs(got[s] - target[s]) <= 0.1 * target[s] for s in order)

    packed = stages["packing"](spark, mixed, folder).collect()
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter((r.doc_id, tuple(tok.encode(r.text, add_special_tokens=False).ids + [0])) for r in mixed.collect())
    pieces = defaultdict(list)
    for r in packed:
        assert r.length & (r.length - 1) == 0 and len(r.ids) == 4 * r.length
        pieces[r.doc_id].append(r)
    count = Counter()
    for doc_id, own in pieces.items():  # pieces of a row follow one another
        ids = []
        for r in sorted(own, key=lambda r: r.sequence_id):
            if r.start == 0 and ids:
                count[doc_id, tuple(ids)] += 1
                ids = []
            assert r.start == len(ids)
            ids += np.frombuffer(r.ids, "<u4").tolist()
        count[doc_id, tuple(ids)] += 1
    assert count == want
