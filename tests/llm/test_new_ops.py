"""Filter audit, Merkle manifest and chunked encoding against brute force, with nulls, ties, repeats, long texts and empty tables."""

import hashlib
import math
import re
import zlib
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, leaf string, part string, ids int"


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", 1) for r in rows], DOCS).repartition(3)


def odd_rows(rng):
    words = ["alpha", "Beta", "GAMMA", "d#lta", "e", "é", "字", "zz"]
    rows = []
    for i in range(260):
        text = " ".join(rng.choice(words, int(rng.integers(0, 140)))) if i % 3 else "the same text " * 40
        rows.append((i // 2 if i > 200 else i, text, [None, "", "en", "fr"][i % 4], [None, "", "a", "é", "b"][int(rng.integers(0, 5))] if i % 2 else "hot", i))
    rows += [(None, "the same text " * 40, "en", None, None), (None, None, None, "a", None), (3, None, None, None, 3), (3, None, None, None, 3), (7, "", "en", "", 0), (2**40, "x" * 300_000 + " #", "en", "one", 1)]
    return rows


def failing(rows):
    first = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            first[text or ""] = min(first.get(text or "", doc_id), doc_id)
    for doc_id, text, lang, *_ in rows:
        t = text or ""
        ws = re.findall(r"[^\x20\x09-\x0D]+", t)
        upper = sum("A" <= c <= "Z" for c in t)
        yield lang or "", doc_id, {"A": len(ws) < 100, "B": 100 * len(set(ws)) < 80 * len(ws), "C": 100 * upper > 10 * len(t), "D": any(c in "#$%&*|" for c in t), "E": doc_id is not None and doc_id > first[t]}


@pytest.mark.parametrize("span", [1, 7, 1024])
def test_audit_against_brute_force(spark, span):
    from strandlake.llm.filter_audit import audit_filters, failing_rows

    rows = odd_rows(np.random.default_rng(1))
    marks = {i: (int(i % 3 == 0), int(i % 5 == 0)) for i in range(0, 200, 2)}
    labels = spark.createDataFrame([(i, q, t) for i, (q, t) in marks.items()] + [(4, 1, None), (None, 1, 1), (6, None, None)], "doc_id long, quality int, toxic int")
    marks[4] = (1, marks[4][1])
    flagged = failing_rows(rows_of(spark, rows), labels)
    got = {(r.part, r.filter_order, r.step): r for r in audit_filters(flagged, list("ABCDE"), ["good", "toxic"], span=span).collect()}
    known = list(failing(rows))
    parts = {p for p, *_ in known}
    assert len(got) == len(parts) * 120 * 5
    removed = {}
    for part in parts:
        own = [(i, f) for p, i, f in known if p == part]
        for order in permutations("ABCDE"):
            left = own
            for step, c in enumerate(order, 1):
                gone = [x for x in left if x[1][c]]
                left = [x for x in left if not x[1][c]]
                r = got[part, "".join(order), step]
                fails = [x for x in own if x[1][c]]
                want = (len(left), len(gone), len(fails) - len(gone), sum(sum(x[1].values()) == 1 for x in fails), sum(marks.get(i, (0, 0))[0] for i, _ in gone), sum(marks.get(i, (0, 0))[1] for i, _ in gone))
                assert (r.kept, r.removed, r.redundant, r.unique_fails, r.lost_good, r.lost_toxic) == want
                removed[part, c] = removed.get((part, c), 0) + len(gone)
    assert all(r.shapley == removed[p, o[s - 1]] for (p, o, s), r in got.items())


def test_posting_lists_and_empty_tables(spark):
    from strandlake.llm.filter_audit import audit_filters, failing_rows, merge, posting_lists

    rng = np.random.default_rng(2)
    for _ in range(200):
        a, b = (np.unique(rng.integers(0, 50, int(rng.integers(0, 40)))) for _ in range(2))
        assert merge(a, b).tolist() == np.union1d(a, b).tolist()
    rows = spark.createDataFrame([("p", 5, True, False), ("p", 5, True, False), ("p", 9, False, None), ("p", None, True, True), (None, 2000, True, False)], "part string, id long, X boolean, Y boolean")
    got = {(r.part, r.range): r for r in posting_lists(rows, ["X", "Y"], span=1024).collect()}
    assert set(got) == {("p", 0), ("p", -(2**62)), ("", 1)}
    assert got["p", 0].ids == [5, 9] and got["p", 0].times == [2, 1] and got["p", 0].lists == {"X": [0], "Y": []}
    assert got["p", -(2**62)].ids == [None]
    assert {(r.filter_order, r.step): r.removed for r in audit_filters(rows, ["X", "Y"], orders=["YX"]).where("part = 'p'").collect()} == {("YX", 1): 1, ("YX", 2): 2}
    none = failing_rows(rows_of(spark, []), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert audit_filters(none, list("ABCDE"), ["good", "toxic"]).count() == 0


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def tree(hashes, fan=16):
    """(root, siblings of each leaf, level by level, as (left, right))."""
    above = [[] for _ in hashes]
    at, level = list(range(len(hashes))), hashes
    while len(level) > 1:
        for k, i in enumerate(at):
            run = level[i - i % fan : i - i % fan + fan]
            above[k].append(("".join(run[: i % fan]), "".join(run[i % fan + 1 :])))
        level = [sha("".join(level[i : i + fan])) for i in range(0, len(level), fan)]
        at = [i // fan for i in at]
    return level[0] if level else None, above


def leaf(r):
    return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (r[0], r[3], r[2], r[4], r[1])))


@pytest.mark.parametrize("hot", [1, 16, 17, 256, 257, 5000])
def test_manifest_against_brute_force(spark, hot):
    from strandlake.llm.merkle import fold, in_a_fifth, lowered, manifest, proof_text
    from pyspark.sql import functions as F

    rng = np.random.default_rng(hot)
    rows = odd_rows(rng)[:40:3] + odd_rows(rng)[-6:] + [(i, f"Text {i}", "en", "big", None) for i in range(hot)]
    rows += [(i, "x", None, f"s{i:03d}", 0) for i in range(300 if hot == 257 else 3)]  # more sources than a block has
    made = manifest(rows_of(spark, rows), in_a_fifth(F.col("doc_id")), lowered(F.col("text")))
    got = made.select("doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("above")), 256).alias("proof"), fold(F.coalesce("changed", "leaf"), F.col("above")).alias("folded")).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    order = sorted(groups, key=lambda s: b"" if s is None else b"\1" + s.encode())
    subroots, paths = {}, {}
    for s in order:
        own = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        subroots[s], paths[s] = tree([leaf(r) for r in own])
        groups[s] = own
    root, over = tree([subroots[s] for s in order])
    want = []
    low = lambda t: t and "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    for k, s in enumerate(order):
        for r, path in zip(groups[s], paths[s], strict=True):
            full = path + over[k]
            h = leaf((r[0], low(r[1]), *r[2:])) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 else leaf(r)
            for a, b in full:
                h = sha(a + h + b)
            want.append((r[0], leaf(r), subroots[s], root, sha("".join(a + b for a, b in full)), h))
    key = lambda x: tuple(str(y) for y in x)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert any(x[5] == root for x in want) and (hot < 100 or any(x[5] != root for x in want))


def test_manifest_of_nothing(spark):
    from strandlake.llm.merkle import manifest

    assert manifest(rows_of(spark, [])).count() == 0
    one = manifest(rows_of(spark, [(1, "t", None, None, None)])).first()
    assert one.leaf == one.subroot == one.root and one.above == [] and one.changed is None


def vocabulary(name="byte_bpe_50k.json"):
    import public_tokenizers

    return public_tokenizers.path(name)


def odd_texts():
    rng = np.random.default_rng(5)
    bits = [*"ab1 \n\t.'!é漢 　字🙂", "<|endoftext|>", "<|", " the", " of it's "]
    made = ["".join(rng.choice(bits, int(n))) for n in rng.integers(0, 3000, 60)]
    shared = " ".join(f"word{x}" for x in rng.integers(0, 900, 3000))
    return [*made, *[x[:50] + shared + x[-50:] for x in made[:20]], shared, shared, shared[:100_000] * 5, "a" * 50_000, " " * 20_000, "ab " * 20_000, "", None]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_chunks_give_the_ids_of_the_library(name):
    from tokenizers import Tokenizer

    from strandlake.llm.chunk_bpe import ChunkEncoder, Decoder

    texts, tok, made = odd_texts(), Tokenizer.from_file(vocabulary(name)), ChunkEncoder(vocabulary(name), {})
    decoder = Decoder(vocabulary(name))
    for _ in range(2):
        flat, offsets = made.ids(pa.array(texts, pa.string()))
        for t, a, b in zip(texts, offsets[:-1], offsets[1:], strict=True):
            want = tok.encode(t or "", add_special_tokens=False).ids
            assert flat[a:b].tolist() == want
            assert decoder.text(flat[a:b]).decode() == tok.decode(want, skip_special_tokens=False)
            assert decoder.joined(flat[a:b]).decode() == ",".join(map(str, want))
    assert made.whole == 0 and made.encoded < 2 * math.ceil(sum(len((t or "").encode()) for t in texts) / 1024)
    rng = np.random.default_rng(1)
    for _ in range(300):  # ids in any order, characters cut in two among them
        ids = rng.integers(0, tok.get_vocab_size(), int(rng.integers(0, 12)))
        assert decoder.text(ids).decode() == tok.decode(ids.tolist(), skip_special_tokens=False)


def test_a_join_that_does_not_agree_is_mended():
    from tokenizers import Tokenizer

    from strandlake.llm.chunk_bpe import ChunkEncoder

    text = " ".join(f"w{i}" for i in range(2000))
    made = ChunkEncoder(vocabulary(), {})
    made.ids(pa.array([text]))
    made.cache = {c: (ids[:lead - 1], lead, first, last, trail) if k == 1 else (ids, lead, first, last, trail) for k, (c, (ids, lead, first, last, trail)) in enumerate(made.cache.items())}
    flat, _ = made.ids(pa.array([text]))
    assert made.whole == 1 and flat.tolist() == Tokenizer.from_file(vocabulary()).encode(text, add_special_tokens=False).ids


def test_cuts_follow_the_content():
    from strandlake.llm.chunk_bpe import chunk_edges
    from strandlake.llm.words import raw

    rng = np.random.default_rng(9)
    passage = " ".join(f"word{x}" for x in rng.integers(0, 900, 4000))
    texts = [passage, "before " * 30 + passage, passage[777:] + " after"]
    data, offsets = raw(pa.array(texts))
    whole, edges = data.tobytes(), chunk_edges(data, offsets)
    doc = np.searchsorted(offsets, edges[:, 0], "right") - 1
    sets = [{whole[a:b] for a, b in edges[doc == d][:, [0, 5]].tolist()} for d in range(3)]
    assert len(sets[0]) > 15 and len(sets[0] & sets[1]) >= len(sets[0]) - 2 and len(sets[0] & sets[2]) >= len(sets[0]) - 4
    assert (np.diff(edges, axis=1) >= 0).all()


def test_shared_chunks_are_encoded_once(spark, monkeypatch):
    from tokenizers import Tokenizer

    from strandlake.llm.chunk_bpe import ChunkEncoder, chunk_counts, decode_documents, encode_documents, shared_chunks

    texts = odd_texts()
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)] + [(None, "null id", None, None, None), (0, texts[0], None, None, None)]
    docs = rows_of(spark, rows)
    known = shared_chunks(docs, vocabulary(), most=40)
    assert 10 < len(known) <= 40 and all(len(c) <= 4096 for c in known)
    assert all(sum(c in (t or "").encode() for t in texts) > 1 for c in known)
    assert chunk_counts(docs).where("docs > 1").count() >= len(known)
    made = ChunkEncoder(vocabulary(), known)
    made.ids(pa.array(texts, pa.string()))
    assert not set(made.cache) & set(known)
    tok = Tokenizer.from_file(vocabulary())
    for most in (0, 40):
        got = decode_documents(encode_documents(docs, vocabulary(), most=most), vocabulary()).collect()
        want = []
        for i, t, *_ in rows:
            ids = tok.encode(t or "", add_special_tokens=False).ids
            want.append((i, len(ids), sha(",".join(map(str, ids))), tok.decode(ids, skip_special_tokens=False)))
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    empty = rows_of(spark, [])
    assert decode_documents(encode_documents(empty, vocabulary()), vocabulary()).count() == 0
