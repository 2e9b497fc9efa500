"""The operators against brute force, with nulls, empty and long texts, ties, repeated rows and empty tables."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [None, "", " \n\t", "one two", "A b c d e f g", "a B c d e f g", "tie " * 30, "tie " * 30, "x " * 5000, "déjà vu\nline\nline\n\nü", " ".join(f"w{i}" for i in range(100)), " ".join(f"w{i}" for i in range(98)) + " z z", "!!! $$$ | #"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", None if i % 4 == 0 else f"s{i % 3}", len(t or ""), "clash") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[4]], "doc_id long, text string, lang string, source string, n_chars long, size string").repartition(2)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def words(t):
    return WORD.findall(t or "")


def test_rule_statistics():
    from strandlake.llm.quality_rules import statistics

    base, _ = statistics(pa.array(TEXTS))
    for t, got in zip(TEXTS, base.tolist(), strict=True):
        w = words(t)
        windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        assert got == [len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(covered)]


def test_monotone_forest():
    from strandlake.llm.quality_rules import fit_forest

    rng = np.random.default_rng(0)
    x = rng.random((500, 2))
    forest = fit_forest(x, (x[:, 0] + 0.3 * rng.random(500) < 0.6).astype(int), (-1, 0), trees=20)
    line = np.column_stack([np.linspace(0, 1, 50), np.full(50, 0.5)])
    assert (np.diff(forest.probability(line)) <= 1e-12).all()
    assert fit_forest(x[:0], np.zeros(0, int), (-1, 0)).probability(x).min() > 0.9


def test_classifier_scores_every_text(docs, none):
    from strandlake.llm.mil import classify, fit_bags

    rng = np.random.default_rng(1)
    from strandlake.llm.mil import WIDTH

    model = fit_bags([rng.normal(y, 1, (3, WIDTH)).astype(np.float32) for y in (0, 1) for _ in range(20)], np.repeat([0, 1], 20), steps=20)
    rows = classify(docs, model).collect()
    assert len(rows) == len(TEXTS) + 1 and all(0 <= r.score <= 1 for r in rows)
    assert classify(none, model).count() == 0


def test_packing_round_trip(docs, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    from strandlake.llm.packing import pack_documents

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    pieces = pack_documents(docs, path).toPandas()
    assert pieces.sequence_id.is_unique and (pieces.offset == 0).all()
    for i, t in enumerate(TEXTS):
        own = pieces[pieces.doc_id == i].drop_duplicates("start").sort_values("start")
        ids = np.frombuffer(b"".join(own.ids), "<u4").tolist()
        assert ids == [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        assert all(n & (n - 1) == 0 and n <= 1024 for n in own.length)
    assert pack_documents(none, path).count() == 0


def test_token_files_round_trip(spark, docs, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    from strandlake.llm.store import shared_dir
    from strandlake.llm.token_files import TokenFile, read_token_files, write_token_files

    path = public_tokenizers.path("word_bpe_49k.json")
    tok, folder = Tokenizer.from_file(path), f"{shared_dir(spark)}/t"
    write_token_files(docs, folder, path, seq_len=16, rows_per_batch=4, file_ids=2000)
    assert spark.read.parquet(f"{folder}/manifest").count() > 1
    got = sorted(map(tuple, read_token_files(spark, folder).collect()))
    order = sorted([*range(len(TEXTS)), 4])
    at, want = 0, []
    for i in order:
        ids = np.array([*tok.encode(TEXTS[i] or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == want
    import glob

    file = TokenFile(sorted(glob.glob(folder.removeprefix("file://") + "/*.arrow"))[0])
    ids, mask = file.sequence(len(file) - 1)
    assert len(ids) == 16 and len(mask) == 16 and mask.true_count <= 16
    write_token_files(none, folder + "2", path)
    assert read_token_files(spark, folder + "2").count() == 0


def test_mix(docs, none):
    from strandlake.llm.mixing import mix_sources, mixed_documents

    mix = mix_sources(docs, block=8, slots=64)
    rows = mix.per_doc.collect()
    assert len(rows) == len(TEXTS) + 1 and all(0 <= r.taken <= 2 * r.size for r in rows)
    sizes = Counter()
    for i, t in [*enumerate(TEXTS), (4, TEXTS[4])]:
        sizes[None if i % 4 == 0 else f"s{i % 3}"] += len(words(t))
    assert {r.source_size for r in rows} == set(sizes.values())
    assert math.isclose(sum({r.source_size: r.target for r in rows}.values()), 1.5 * sum(sizes.values()))
    assert sorted(map(tuple, mix_sources(docs, block=8, slots=64).per_doc.collect())) == sorted(map(tuple, rows))
    made = mixed_documents(docs, mix)
    assert made.columns == docs.columns
    assert sum(len(words(r.text)) for r in made.collect()) == sum(r.taken for r in rows)
    assert mix_sources(none).per_doc.count() == 0


def test_chat_round_trip(spark):
    from strandlake.llm.chat import format_conversations, loss_text, read_turns
    from pyspark.sql import functions as F

    turns = [(1, 0, "user", "</s>[INST] a\\z \\b [/INST]"), (1, 1, "assistant", "<s></s>\\"), (2, 0, "tool", "x<</ROLE>>"), (2, 1, None, None), (2, None, "user", "first"), (3, 0, "assistant", "")]
    rows = spark.createDataFrame([(*t, 1) for t in turns], "conv_id long, turn long, role string, text string, segments int")
    got = {r.conv_id: r for r in read_turns(format_conversations(rows)).withColumn("loss", loss_text(F.col("formatted"), F.col("loss_spans"))).collect()}
    assert [tuple(t) for t in got[1].turns] == [("user", "</s>[INST] a\\z \\b [/INST]"), ("assistant", "<s></s>\\")]
    assert [tuple(t) for t in got[2].turns] == [("user", "first"), ("tool", "x<</ROLE>>"), ("", "")]
    assert got[1].loss == "<s></s>\\" and got[1].valid and not got[2].valid and got[3].loss == ""
    assert format_conversations(rows.limit(0)).count() == 0


def test_urls():
    from strandlake.llm.url_filter import build, cut_url, hits

    machine = build()
    assert cut_url("HTTP://A.Com/x?y") == ("a.com", "/x") and cut_url(None) == cut_url("a.com/x") == ("", "") and cut_url("h://a.b?x/") == ("a.b", "")
    assert hits(machine, "http://x-casino.com") == ({"casino"}, set()) and hits(machine, "http://casinos.com/winfree") == (set(), set())
    assert hits(machine, "http://cheap-CHEAP.com/win") == (set(), {"cheap", "win"}) and hits(machine, None) == (set(), set())


def _components(n, links):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def test_jaccard(docs, none):
    from strandlake.llm.ngram_join import jaccard_components

    lower = str.maketrans({c: chr(c + 32) for c in range(65, 91)})
    sets = []
    for t in TEXTS:
        w = words((t or "").translate(lower))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    want = _components(len(sets), links)
    got = jaccard_components(docs).collect()
    assert len(got) == len(TEXTS) + 1
    for r in got:
        assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), want[r.doc_id])
    assert jaccard_components(none).count() == 0


def test_embeddings(spark):
    from strandlake.llm.embed_dedup import dedup_embeddings

    rng = np.random.default_rng(5)
    base = rng.normal(size=(6, 16))
    vectors = [(base[i % 6] + 0.12 * rng.normal(size=16)).tolist() for i in range(60)] + [base[0].tolist()] * 3
    rows = [(i, v, 1 if i % 6 < 3 else 2, "x") for i, v in enumerate(vectors)]
    n = len(rows)
    rows += [(n, None, 1, "x"), (n + 1, [0.0] * 16, 1, "x"), (n + 2, [float("nan")] * 16, 1, "x"), (n + 3, vectors[0], None, "x"), (n + 4, [None] * 16, 1, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, key string")
    x = np.array(vectors)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    labels = np.array([r[2] for r in rows[:n]])
    good = (x @ x.T >= 0.93) & (labels[:, None] == labels)
    np.fill_diagonal(good, False)
    want = _components(n, [(i, j) for i, j in zip(*np.nonzero(good), strict=True)])
    for r in dedup_embeddings(df).collect():
        assert (r.n_links, r.component_id) == ((int(good[r.vec_id].sum()), want[r.vec_id]) if r.vec_id < n else (0, r.vec_id))
        assert r.kept == (r.vec_id == r.component_id)
    assert dedup_embeddings(df.limit(0)).count() == 0


def test_backoff(docs, none):
    from strandlake.llm.backoff_lm import backoff_scores

    texts = [words(t) for t in [*TEXTS, TEXTS[4]]]
    one = Counter(w for t in texts for w in t)
    two = Counter(p for t in texts for p in zip(t, t[1:], strict=False))
    total = sum(one.values())
    for r in backoff_scores(docs, order=2, min_count=2).collect():
        t = texts[r.doc_id]
        want = sum(math.log(two[v, w] / one[v]) if v is not None and two[v, w] >= 2 else math.log(one[w] / total) + (math.log(0.4) if v is not None else 0) for v, w in zip([None, *t], t, strict=False))
        assert r.n_words == len(t) and math.isclose(r.log_score, want, rel_tol=1e-9, abs_tol=1e-9) and (r.mean_log_score is None) == (not t)
    assert backoff_scores(none).count() == 0
