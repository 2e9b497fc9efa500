"""Null, empty, long, repeated and clashing input of the operators and the pipeline's stages, and what fits may see."""

import zlib

import numpy as np
import pyarrow as pa
import pytest


def test_urls_of_every_kind(spark):
    from strandlake.llm.url_filter import RULES, SOFT, STRICT, filter_urls

    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.NET/en/x?free=win", "http://net", "http://x.net/", "http://example.net/de/", "http://example.com/de/casino", "http://a.org/fr/casino", "http://a.org/casino", "http://a.b/free-win", "http://a.b/free-free", "http://a.b/winfree", "http://a.b/" + "x" * 300_000 + "/casino", "http://é.b/ü?q#f", "http://a.b/xxx#", "://net/x"]
    rows = [(i, u, "clash", "clash") for i, u in enumerate(urls)] + [(4, urls[4], "a", "b")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string").repartition(2)

    def brute(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, path = "".join(c.lower() if c.isascii() else c for c in rest[:cut]), rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
        fit = [r for r in RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
        text = "".join(c.lower() if c.isascii() else c for c in url or "")
        inner = set("abcdefghijklmnopqrstuvwxyz0123456789")
        seen = lambda terms: sum(any(text[i : i + len(t)] == t and (i == 0 or text[i - 1] not in inner) and (i + len(t) == len(text) or text[i + len(t)] not in inner) for i in range(len(text) - len(t) + 1) if text[i] == t[0]) for t in terms)
        strict, soft = seen(STRICT), seen(SOFT)
        best = max(fit, key=lambda r: len(r[0] + r[1]), default=None)
        return host, path, best and best[0] + best[1], best[2] if best else "block" if strict or soft >= 2 else "allow", strict, soft

    got = filter_urls(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict, r.n_strict, r.n_soft) == brute(urls[r.page_id])
    assert filter_urls(pages.limit(0)).count() == 0


def corpus(spark):
    rng = np.random.default_rng(3)
    good, bad = ([f"{c}{x}{y}" for x in "bdfgl" for y in "aeiu"] for c in "tk")
    text = lambda words, n: " ".join(rng.choice(words, n))
    rows = [(i, text(good, 80), 1) for i in range(60)] + [(i, text(bad, 30) + " $$$ !!!" * 20, 0) for i in range(60, 120)]
    rows += [(200, None, None), (201, "", None), (202, "x" * 3_000_000, None), (203, text(good, 60_000), None), (204, text(good, 70), 2), (None, text(good, 70), None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), 7) for i, t, _ in rows] + [(3, rows[3][1], "en", "s", 1, 7)], "doc_id long, text string, lang string, source string, n_chars long, score int")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if y is not None] + [(None, 1), (3, 1)], "doc_id long, quality int")
    return rows, docs.repartition(3), labels


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_fits_never_see_the_held_out(spark):
    from strandlake.llm.labelled import training_rows
    from strandlake.llm.mil import fit_classifier
    from strandlake.llm.quality_rules import fit_rules

    rows, docs, labels = corpus(spark)
    seen = training_rows(docs, labels).collect()
    assert {r.doc_id for r in seen} == {i for i, _, y in rows if y in (0, 1) and not held(i)}
    assert len(training_rows(docs, labels, 5).collect()) == 10
    # Labels of the held-out rows and rows of no label change nothing.
    from pyspark.sql import functions as F

    from strandlake.llm.labelled import held_out

    turned = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (fit_classifier(docs, x).score(pa.array([rows[0][1], rows[70][1]])) for x in (labels, turned))
    assert np.allclose(a, b) and a[0] > 0.5 > a[1]
    a, b = (fit_rules(docs, x) for x in (labels, turned))
    assert all(np.array_equal(getattr(a, n), getattr(b, n)) for n in ("feature", "threshold", "left", "right", "value", "roots"))
    none = labels.limit(0)
    assert fit_classifier(docs, none).score(pa.array(["a"])).tolist() == [0.5] and fit_rules(docs, none).probability(np.zeros((1, 11)))[0] > 0.9


def test_rules_on_a_table(spark):
    from strandlake.llm.quality_rules import FEATURES, Forest, apply_rules, fit_rules, statistics

    rows, docs, labels = corpus(spark)
    forest = fit_rules(docs, labels)

    def walk(forest: Forest, x):
        total = forest.bias
        for at in forest.roots:
            while forest.left[at] != at:
                at = forest.left[at] if x[forest.feature[at]] <= forest.threshold[at] else forest.right[at]
            total += forest.value[at]
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))

    texts = {i: t for i, t, _ in rows}
    got = apply_rules(docs, forest).collect()
    assert len(got) == len(rows) + 1 and len(FEATURES) == 11
    for r in got:
        base, x = statistics(pa.array([texts[r.doc_id]], pa.string()))
        assert np.isclose(r.score, walk(forest, x[0])) and [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words] == base[0].tolist()
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and r.kept == (not r.base_failed and r.score >= 0.3)
    kept = {r.doc_id for r in got if r.kept}
    assert set(range(60)) <= kept and not kept & set(range(60, 120)) and not {200, 201, 202} & kept
    assert apply_rules(docs.limit(0), forest).count() == 0


def test_classifier_on_a_table(spark):
    from strandlake.llm.mil import classify, fit_classifier

    rows, docs, labels = corpus(spark)
    got = classify(docs, fit_classifier(docs, labels)).collect()
    assert len(got) == len(rows) + 1 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    score = {r.doc_id: r.score for r in got}
    assert all(score[i] > 0.5 for i in range(60) if held(i)) and all(score[i] < 0.5 for i in range(60, 120) if held(i))


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_stages_one_after_the_other(spark, tmp_path, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    import corpus_pipeline

    rows, docs, labels = corpus(spark)
    folder = f"file://{tmp_path}"
    (docs.limit(0) if empty else docs).write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    at = spark.read.parquet(f"{folder}/documents.parquet")
    columns = at.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, made = at.collect(), stage(spark, at, folder)
        assert made.columns == columns
        path = f"{folder}/{name.replace(' ', '-')}"
        made.write.parquet(path)
        at = spark.read.parquet(path)
        if name != "mixing":
            assert {(r.doc_id, r.text) for r in at.collect()} <= {(r.doc_id, r.text) for r in before}
        if name == "n-gram Jaccard join":  # one row of each doc_id that is named, of texts that are alike
            ids = [r.doc_id for r in at.collect() if r.doc_id is not None]
            assert len(ids) == len(set(ids))
    mixed = at.collect()
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted(len(tok.encode(r.text, add_special_tokens=False).ids) + 1 for r in mixed)
    pieces = corpus_pipeline.STAGES[-1][1](spark, at, folder).collect()
    assert sum(p.length for p in pieces) == sum(want) and all(p.length & (p.length - 1) == 0 for p in pieces)
    assert corpus_pipeline.run(spark, folder).count() == len(pieces)
    assert bool(pieces) != empty


def test_long_words_and_hashes():
    from strandlake.llm.words import _BYTE, _STEP, mix, split

    texts = ["ab " + "x" * 20_000 + " ab", "y" * 4096, "z" * 4097, None]
    w = split(pa.array(texts))
    for at, n, h in zip(w.start, w.length, w.hash, strict=True):
        total, power = 0, 1
        for b in w.data[at : at + n].tolist():
            total = (total + int(_BYTE[b]) * power) % 2**64
            power = power * int(_STEP) % 2**64
        assert mix(np.array([(total + int(n)) % 2**64], np.uint64))[0] == h
    assert len(w.hash) == 5


def test_components(spark):
    from strandlake.llm.components import connected_components

    links = [(1, 2), (2, 3), (3, 1), (10, 11), (7, 7), (None, 4), (5, None), (20, 19), (19, 18), (18, 17), (17, 16), (2, 1)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 10: 10, 11: 10, **{i: 16 for i in range(16, 21)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("order,least", [(1, 1), (2, 2), (3, 1), (3, 2), (4, 2)])
def test_backoff_orders(spark, order, least):
    import math
    from collections import Counter

    from strandlake.llm.backoff_lm import backoff_scores

    rng = np.random.default_rng(order)
    texts = [None, "", "a", "a b", "a b", "b " * 40] + [" ".join(rng.choice(list("abcd"), rng.integers(1, 30))) for _ in range(40)] + [" ".join(rng.choice(list("efghijklmnop"), 9)) for _ in range(9)]
    cut = [(t or "").split() for t in texts]
    c = Counter(tuple(w[i : i + n]) for w in cut for n in range(1, order + 1) for i in range(len(w) - n + 1))
    total = sum(len(w) for w in cut)

    def s(gram):
        if len(gram) == 1:
            return c[gram] / total
        return c[gram] / c[gram[:-1]] if c[gram] >= least else 0.4 * s(gram[1:])

    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_words string").repartition(3)
    for r in backoff_scores(docs, order=order, min_count=least).collect():
        w = cut[r.doc_id]
        want = sum(math.log(s(tuple(w[max(0, i - order + 1) : i + 1]))) for i in range(len(w)))
        assert r.n_words == len(w) and math.isclose(r.log_score, want, rel_tol=1e-9, abs_tol=1e-9)
