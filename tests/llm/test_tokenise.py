"""Cut and cached encoding against plain calls of the library."""

import random

import numpy as np
import pyarrow as pa
import pytest

PIECES = ["a", "Word", "don't", "'s", "1234", "x9", "é", "Ü", "ñandú", "\u0130", "\u0149", "\u00d7", "\u0394", "\u4e2d", "\U0001f600", "e\u0301", "\u00a0", "\u2028", "\x00", "\x1c", "<|endoftext|>", "<|", "|>", "<", "!!!", "...", "``", "foo_bar", "ALLCAPS", "\u0141"]
GAPS = [" ", " ", " ", "\n", "\n\n", "  ", "\t", " \n", "\n ", "\r\n", "\x0b", "   x   ", ""]


def texts(n, seed):
    rng = random.Random(seed)
    out = [None, "", " ", "\n", " a", "a ", "\n\na", " \n \n", "<|endoftext|>"]
    for _ in range(n):
        plain = rng.random() < 0.6
        words = [w for w in PIECES if w.isascii() and w.isprintable() and "<" not in w] + ["é", "Ü", "\u0141"] if plain else PIECES
        out.append("".join(rng.choice(words) + rng.choice(GAPS) for _ in range(rng.randrange(1, 30))))
    return out


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("special", [False, True])
def test_ids_are_the_librarys(name, special, monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    from strandlake.llm import tokenise

    path = public_tokenizers.path(name)
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = special
    monkeypatch.setattr(tokenise, "CACHE", 60)  # so that pieces leave the cache
    monkeypatch.setattr(tokenise, "SLICE", 300)  # and long texts are cut
    enc = tokenise.PieceEncoder(path, special)
    assert enc.kind != "unknown"
    for seed in range(12):
        some = texts(300, seed) + ["long text of words " * 200, "one" * 500]
        column = pa.array(some)
        ids, offsets = enc.ids(column)
        want = [x.ids for x in tok.encode_batch([t or "" for t in some], add_special_tokens=False)]
        for i, w in enumerate(want):
            assert ids[offsets[i] : offsets[i + 1]].tolist() == w, some[i]
        a, b = enc.ids(column[5:9])
        assert a.tolist() == [x for w in want[5:9] for x in w] and len(b) == 5


def test_unknown_tokenizers_are_not_cut(tmp_path):
    import json

    import public_tokenizers
    from tokenizers import Tokenizer

    from strandlake.llm.tokenise import PieceEncoder

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        spec = json.load(file)
    spec["pre_tokenizer"]["add_prefix_space"] = True
    path = str(tmp_path / "other.json")
    with open(path, "w", encoding="utf-8") as file:
        json.dump(spec, file)
    enc, tok = PieceEncoder(path), Tokenizer.from_file(path)
    some = texts(50, 1)
    ids, _ = enc.ids(pa.array(some))
    assert enc.kind == "unknown" and ids.tolist() == [x for t in some for x in tok.encode(t or "", add_special_tokens=False).ids]


def test_pieces_cover_each_document():
    from strandlake.llm.packing import cut_pieces

    tokens = np.array([1, 5, 1024, 2048, 3000, 2047, 7])
    doc, start, length = cut_pieces(tokens, 1024)
    for i, n in enumerate(tokens):
        own = doc == i
        want = [1024] * (n // 1024) + [1 << k for k in range(9, -1, -1) if n % 1024 >> k & 1]
        assert length[own].tolist() == want and start[own].tolist() == (np.cumsum(want) - want).tolist()
