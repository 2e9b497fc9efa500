"""Token ids of whole texts by the tokenizers library, each distinct piece of text encoded once per cache.

A text of plain characters is cut where the tokenizer's own pattern always cuts, so the ids of the pieces, put
together, are those of the text. The pieces of a slice of texts are found, made distinct and put back with numpy; only
pieces that the cache lacks reach the library. Any other text is encoded whole, and so is every text under a tokenizer
whose pattern is not one of the two that the cuts are right for.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .words import IS_WORD, byte_hashes, raw

#: Bytes of text that are cut into pieces at once.
SLICE = 2_000_000
#: Distinct pieces in the cache; when there are more, those not used for longest go.
CACHE = 800_000

_SPACE = ~IS_WORD
#: Bytes of plain texts: printable ASCII, the white space of words, and letters from U+00C0 to U+017F in two bytes.
_PLAIN = np.zeros(256, bool)
_PLAIN[[*range(0x09, 0x0E), *range(0x20, 0x7F), *range(0x80, 0xC0), 0xC3, 0xC4, 0xC5]] = True

# The pre-tokenizer patterns of the two public vocabularies.
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _kind(path: str) -> str:
    """spaced: byte-level, pieces keep the space before them; bare: white space is dropped; unknown: nothing is cut."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    cut, normal = spec.get("pre_tokenizer") or {}, spec.get("normalizer") or {}
    if cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space") and not normal:
        return "spaced"
    parts = cut.get("pretokenizers") or [{}]
    steps = [x.get("type") for x in normal.get("normalizers", [])]
    if parts[0].get("type") == "Split" and (parts[0].get("pattern") or {}).get("Regex") == _WORD_PATTERN and parts[0].get("invert") and steps == ["NFC", "Replace", "Lowercase"]:
        return "bare"
    return "unknown"


class PieceEncoder:
    """ids(arrow string column) -> (ids, offsets): the ids of all texts one after the other, and where each text's begin.

    special_as_text: strings of special tokens in a text are ordinary text; by default they give the special id, as a
    plain call of the library does. Ids must be under 65,536. A null text has no ids.
    """

    def __init__(self, path: str, special_as_text: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = special_as_text
        if self.tok.get_vocab_size() > 65_536:
            raise ValueError("ids do not fit 16 bits")
        self.kind = _kind(path)
        added = [x.content.encode() for x in self.tok.get_added_tokens_decoder().values()]
        # A text that holds the first two bytes of an added token is encoded whole.
        self.starts = {x[:2] for x in added if len(x) > 1}
        if any(len(x) < 2 or any(_SPACE[b] for b in x) for x in added):
            self.kind = "unknown"
        self.between = {"spaced": "\n", "bare": " \x00 "}.get(self.kind, "")
        mark = self._whole([self.between])[0] if self.between else []
        self.mark = int(mark[0]) if len(mark) == 1 else None
        self.keys, self.begin, self.count, self.used = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.turn = np.zeros(0, np.uint16), 0

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, np.uint16) for x in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _odd(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which texts are encoded whole."""
        if self.kind == "unknown":
            return np.ones(len(offsets) - 1, bool)
        bad = ~_PLAIN[data]
        for a, b in self.starts:
            bad[:-1] |= (data[:-1] == a) & (data[1:] == b)
        total = np.concatenate([[0], np.cumsum(bad)])
        return total[offsets[1:]] > total[offsets[:-1]]

    def _cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Starts of the pieces, which together are all bytes: a word with the space before it, a word, or white space."""
        space = _SPACE[data]
        heads = np.zeros(len(data), bool)
        heads[offsets[:-1][offsets[:-1] < len(data)]] = True
        before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)  # a word byte of the same text
        before[1:] = ~space[:-1]
        before &= ~heads
        after[:-1] = ~space[1:] & ~heads[1:]
        gap = np.zeros(len(data), bool)  # white space other than one blank before it, in the same text
        gap[1:] = space[:-1] & (data[:-1] != 0x20)
        return np.flatnonzero(heads | (space & (before | after)) | (~space & gap))

    def _learn(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, where each piece's begin, how many they are) from the library."""
        count, order, flats = np.zeros(len(pieces), np.int64), [], []
        words = np.array([i for i, p in enumerate(pieces) if self.mark is not None and (self.kind == "bare" or not p.isspace())], np.int64)
        for k in range(0, len(words), 2000):
            some = words[k : k + 2000]
            flat = self._whole([self.between.join([pieces[i] for i in some.tolist()])])[0]
            marks = np.flatnonzero(flat == self.mark)
            if len(marks) != len(some) - 1:
                raise RuntimeError("pieces were not encoded apart")
            count[some] = np.diff(np.concatenate([[-1], marks, [len(flat)]])) - 1
            flats.append(np.delete(flat, marks))
            order.append(some)
        rest = np.setdiff1d(np.arange(len(pieces)), words)
        for i, x in zip(rest.tolist(), self._whole([pieces[i] for i in rest.tolist()]) if len(rest) else [], strict=True):
            count[i] = len(x)
            flats.append(x)
        order = np.concatenate([*order, rest]).astype(np.int64)
        begin = np.zeros(len(pieces), np.int64)
        begin[order] = np.cumsum(count[order]) - count[order]
        return np.concatenate(flats) if flats else np.zeros(0, np.uint16), begin, count

    def _known(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the cache, whether it is there) of each key."""
        at = np.searchsorted(self.keys, keys)
        here = at < len(self.keys)
        here[here] = self.keys[at[here]] == keys[here]
        return at, here

    def _add(self, keys: np.ndarray, ids: np.ndarray, begin: np.ndarray, counts: np.ndarray) -> None:
        if len(self.keys) + len(keys) > CACHE:
            stay = (self.used == self.turn) | (self.used > np.median(self.used))
            where = _spans(self.begin[stay], self.count[stay])
            self.pool, self.keys, self.count, self.used = self.pool[where], self.keys[stay], self.count[stay], self.used[stay]
            self.begin = np.cumsum(self.count) - self.count
        at = np.searchsorted(self.keys, keys)
        begin = len(self.pool) + begin
        self.keys, self.begin, self.count = np.insert(self.keys, at, keys), np.insert(self.begin, at, begin), np.insert(self.count, at, counts)
        self.used, self.pool = np.insert(self.used, at, self.turn), np.concatenate([self.pool, ids])

    def _plain(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of each text) of plain texts."""
        if not len(data):
            return np.zeros(0, np.uint16), np.zeros(len(offsets) - 1, np.int64)
        start = self._cuts(data, offsets)
        size = np.diff(np.append(start, len(data)))
        keys, first, back = np.unique(byte_hashes(data, size), return_index=True, return_inverse=True)
        if self.kind == "bare":  # white space has no ids
            blank = _SPACE[data[start[first]]] & _SPACE[data[start[first] + size[first] - 1]]
        else:
            blank = np.zeros(len(keys), bool)
        self.turn += 1
        at, here = self._known(keys)
        self.used[at[here]] = self.turn
        new = np.flatnonzero(~here & ~blank)
        if len(new):
            whole = data.tobytes()
            texts = [whole[a : a + n].decode() for a, n in zip(start[first[new]].tolist(), size[first[new]].tolist(), strict=True)]
            self._add(keys[new], *self._learn([t.strip() for t in texts] if self.kind == "bare" else texts))
        at, here = self._known(keys)
        at[~here] = 0
        if len(self.keys):
            begin, count = self.begin[at], np.where(here, self.count[at], 0)
        else:
            begin = count = np.zeros(len(keys), np.int64)
        n = count[back]
        ids = self.pool[_spans(begin[back], n)]
        total = np.concatenate([[0], np.cumsum(n)])
        edge = np.searchsorted(start, offsets)
        return ids, np.diff(total[edge])

    def ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = raw(column)
        parts, owner = (offsets, np.arange(len(offsets) - 1)) if self.kind == "unknown" else _split_long(data, offsets)
        odd = self._odd(data, parts)
        counts = np.zeros(len(parts) - 1, np.int64)
        found: list[np.ndarray] = [np.zeros(0, np.uint16)] * (len(parts) - 1)
        k = 0
        while k < len(odd):
            if odd[k]:
                found[k] = self._whole([data[parts[k] : parts[k + 1]].tobytes().decode()])[0]
                counts[k] = len(found[k])
                k += 1
                continue
            end = k
            while end < len(odd) and not odd[end] and (end == k or parts[end + 1] - parts[k] <= SLICE):
                end += 1
            found[k], counts[k:end] = self._plain(data[parts[k] : parts[end]], parts[k : end + 1] - parts[k])
            k = end
        each = np.bincount(owner, counts, len(offsets) - 1).astype(np.int64)
        return np.concatenate(found) if found else np.zeros(0, np.uint16), np.concatenate([[0], np.cumsum(each)])


def _spans(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All places of the spans [begin, begin + count), span after span."""
    ends = np.cumsum(count)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begin - ends + count, count)


def _split_long(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets with cuts inside long texts, and each part's text. A cut lies before a blank between two ASCII letters, where
    both patterns always cut and no character combines with another."""
    size = np.diff(offsets)
    if not len(size) or size.max() <= SLICE:
        return offsets, np.arange(len(size))
    parts, owner = [], []
    for k, (a, n) in enumerate(zip(offsets[:-1].tolist(), size.tolist(), strict=True)):
        cuts = np.zeros(1, np.int64)
        if n > SLICE:
            part = data[a : a + n]
            letter = ((part | 0x20) >= 0x61) & ((part | 0x20) <= 0x7A)
            good = np.flatnonzero((part[1:-1] == 0x20) & letter[:-2] & letter[2:]) + 1
            if len(good):
                cuts = np.append(cuts, np.unique(good[np.minimum(np.searchsorted(good, np.arange(SLICE, n, SLICE)), len(good) - 1)]))
        parts.append(a + cuts)
        owner.append(np.full(len(cuts), k))
    return np.append(np.concatenate(parts), offsets[-1]), np.concatenate(owner)


_made: dict[tuple[str, bool], PieceEncoder] = {}


def encoder(path: str, special_as_text: bool = False) -> PieceEncoder:
    """One per Python worker."""
    if (path, special_as_text) not in _made:
        _made[path, special_as_text] = PieceEncoder(path, special_as_text)
    return _made[path, special_as_text]


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int, kind=np.uint16) -> tuple[np.ndarray, np.ndarray]:
    """The ids of each text followed by end_id, and the new offsets."""
    n = len(offsets) - 1
    out = np.full(len(ids) + n, end_id, kind)
    out[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(offsets))] = ids
    return out, offsets + np.arange(n + 1)


def text_slices(column: pa.Array, most: int = SLICE):
    """Row ranges of at most so many bytes, or of one row."""
    size = pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    begin, held = 0, 0
    for i, n in enumerate(size.tolist()):
        if held and held + n > most:
            yield begin, i
            begin, held = i, 0
        held += n
    if begin < len(size):
        yield begin, len(size)
