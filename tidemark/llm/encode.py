"""Encoding whole texts with a tokenizer file, fast enough for a corpus: pieces between spaces are
encoded once and remembered.

A piece between spaces is encoded alike wherever it stands, because the tokenizers below never build
a token across the borders that their pattern cuts at. For the same reason signs behind a letter are encoded
apart from it, so that a word is encoded once and not with every sign that may follow. Texts with any white
space other than space and newline, where the libraries' ideas of white space differ, and texts that hold one
of the file's own marks (such as an end of text) are encoded as a whole.

Pieces are looked up many at a time by a 64-bit hash and a second one that confirms it, in sorted arrays: some 40 bytes
a piece, against 200 in a dictionary, and no object per piece of a text.
"""

from __future__ import annotations

import hashlib
import os
import re
import sys
from array import array

import numpy as np

from tidemark.llm.common import Words, batches, mix

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core

# How the file treats white space between words: it drops it, or one character of it goes with the word behind
# and the rest of a run stands alone.
DROPS_SPACE, KEEPS_SPACE = "drops", "keeps"

_SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # ASCII signs but the apostrophe, which may belong to letters
_GAP = np.zeros(256, dtype=bool)
_GAP[[0x20, 0x0A]] = True
REMEMBERED = 2_000_000  # pieces that a worker keeps, some 80 MB
AT_ONCE = 1 << 20  # characters whose words are arrays at the same time


class _Known:
    """Ids of pieces by key: ids of entry i are ``ids[start[i]:start[i] + n[i]]``."""

    def __init__(self, dtype: str):
        self.dtype = np.dtype(dtype)
        self.key, self.check = np.empty(0, np.uint64), np.empty(0, np.uint64)
        self.start, self.n, self.ids = np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, self.dtype)

    def find(self, key: np.ndarray, check: np.ndarray) -> np.ndarray:
        """The entry of every key, or -1."""
        if not len(self.key):
            return np.full(len(key), -1)
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where((self.key[at] == key) & (self.check[at] == check), at, -1)

    def add(self, key: np.ndarray, check: np.ndarray, ids: list[bytes]) -> None:
        """Keys that are not there yet, each once."""
        n = np.fromiter(map(len, ids), dtype=np.int32, count=len(ids)) // self.dtype.itemsize
        start = np.cumsum(n, dtype=np.int64) - n + len(self.ids)
        order = np.argsort(key)
        at = np.searchsorted(self.key, key[order])
        self.key, self.check = np.insert(self.key, at, key[order]), np.insert(self.check, at, check[order])
        self.start, self.n = np.insert(self.start, at, start[order]), np.insert(self.n, at, n[order])
        self.ids = np.concatenate((self.ids, np.frombuffer(b"".join(ids), dtype=self.dtype)))

    def bytes_of(self, entries: np.ndarray) -> list[bytes]:
        raw, width = self.ids.tobytes(), self.dtype.itemsize
        starts = width * self.start[entries]
        return [raw[a:b] for a, b in zip(starts.tolist(), (starts + width * self.n[entries]).tolist())]


class Encoder:
    """Texts to little-endian token ids; one per Python worker and file (``Encoder.of``)."""

    _open: dict[tuple[str, str], "Encoder"] = {}

    def __init__(self, path: str, space: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = "<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"
        self.code = "H" if self.dtype == "<u2" else "I"
        assert sys.byteorder == "little"  # as every platform that Spark supports, bar one
        self.drops = space == DROPS_SPACE
        marks = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = re.compile("|".join([r"[^\S \n]", *marks]))
        self.known = _Known(self.dtype)
        named = self.tokenizer.get_vocab(with_added_tokens=True)
        self.edge = np.zeros(max(named.values()) + 1, dtype=bool)  # tokens at which a word ends, or begins
        for token, number in named.items():
            self.edge[number] = token.endswith("</w>") if self.drops else token.startswith("Ġ")

    @classmethod
    def of(cls, path: str, space: str) -> "Encoder":
        if (path, space) not in cls._open:
            cls._open[path, space] = cls(path, space)
        return cls._open[path, space]

    @classmethod
    def forget(cls) -> None:
        """Drop the encoders of this worker: its next tasks have other work."""
        cls._open.clear()

    def encode(self, texts: list[str | None], end: int) -> list[bytes]:
        """The ids of every text (null: none), each followed by ``end``, as bytes of ``dtype``."""
        out: list[bytes] = []
        last = np.array([end], dtype=self.dtype).tobytes()
        for a, b in batches(texts, AT_ONCE):
            out += [x + last for x in self._some(texts[a:b])]
        return out

    def _plain(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.code, x.ids).tobytes() for x in found]

    def _joined(self, words: list[str]) -> list[bytes]:
        """Ids of many words of letters by few calls of the library: such a word is one piece to it, so the tokens tell
        where a word begins (or ends, where the file marks ends). Where they do not, word by word."""
        out = []
        for at in range(0, len(words), 500):
            part = words[at : at + 500]
            text = (" " if self.drops else "").join(part)
            found = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.dtype)
            edges = np.flatnonzero(self.edge[found])
            if len(edges) == len(part):
                cuts = [0, *(edges[:-1] + 1).tolist(), len(found)] if self.drops else [*edges.tolist(), len(found)]
                raw, width = found.tobytes(), found.itemsize
                out += [raw[width * a : width * b] for a, b in zip(cuts, cuts[1:])]
            else:
                out += self._plain(part)
        return out

    def _new(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces met for the first time."""
        words = [p.rstrip(_SIGNS) for p in pieces]
        words = [w if w[-1:].lower().isalpha() else p for p, w in zip(pieces, words)]
        signs = [p[len(w) :] for p, w in zip(pieces, words)]
        parts = list({*words, *signs} - {""})
        entry = self.known.find(*self._keys(parts))
        have = np.flatnonzero(entry >= 0)
        ids = dict(zip([parts[i] for i in have.tolist()], self.known.bytes_of(entry[have])))
        ids[""] = b""
        unknown = [p for p in parts if p not in ids]
        letters = str.isalpha if self.drops else (lambda p: p[0] == " " and p[1:].isalpha())
        simple = [p for p in unknown if letters(p)]
        ids.update(zip(simple, self._joined(simple)))
        others = [p for p in unknown if p not in ids]
        for at in range(0, len(others), 20_000):
            ids.update(zip(others[at : at + 20_000], self._plain(others[at : at + 20_000])))
        return [ids[w] + ids[x] for w, x in zip(words, signs)]

    def _keys(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Both hashes of pieces as they stand: a word with the white space in front, if any, or a run of it."""
        bodies = Words([p.lstrip(" \n") for p in pieces], lower=False, gaps=_GAP)
        front = [len(p) - len(p.lstrip(" \n")) for p in pieces]
        prefix = np.array([_front(p[:k]) for p, k in zip(pieces, front)], dtype=np.uint64)
        body = np.zeros(len(pieces), dtype=np.uint64)
        body[bodies.first[:-1] < bodies.first[1:]] = bodies.hash
        return _both(body, prefix)

    def _some(self, texts: list[str | None]) -> list[bytes]:
        odd = [t is not None and self.odd.search(t) is not None for t in texts]
        words = Words([None if o else t for t, o in zip(texts, odd)], lower=False, gaps=_GAP)
        owner, hashes = words.owner(), words.hash
        begin, first = words.start, words.first
        prefix = np.zeros(len(hashes), dtype=np.uint64)
        runs: list[tuple[int, int, int]] = []  # white space that stands alone: before which word, from, to
        if not self.drops:
            before = np.concatenate(([0], words.end[:-1]))[: len(begin)]
            leads = first[:-1][first[:-1] < first[1:]]
            before[leads] = words.text_start[owner[leads]]
            spaced = begin > before
            prefix[spaced] = words.raw[begin[spaced] - 1]
            runs = [(i, int(before[i]), int(begin[i]) - 1) for i in np.flatnonzero(begin - before > 1).tolist()]
            tails = np.where(first[:-1] < first[1:], words.end[np.maximum(first[1:] - 1, 0)] if len(begin) else 0, words.text_start[:-1])
            stops = words.text_start[1:] - 1
            runs += [(int(first[k + 1]), int(tails[k]), int(stops[k])) for k in np.flatnonzero(stops > tails).tolist()]
            runs.sort(key=lambda r: r[1])
        key, check = _both(hashes, prefix)
        source = np.arange(len(key))  # a word by its number, a run behind all words
        if runs:
            spaces = self._keys([words.raw[a:b].tobytes().decode() for _, a, b in runs])
            at = np.array([r[0] for r in runs])
            # a run that ends a text and one that begins the next stand before the same word: their order is kept
            key, check = np.insert(key, at, spaces[0]), np.insert(check, at, spaces[1])
            source = np.insert(source, at, len(hashes) + np.arange(len(runs)))
            ends = np.array([r[1] for r in runs])
            first = first + np.searchsorted(ends, words.text_start)
        distinct, where, which = np.unique(key, return_index=True, return_inverse=True)
        entry = self.known.find(distinct, check[where])
        if (entry < 0).any():
            if len(self.known.key) > REMEMBERED:
                self.known, entry = _Known(self.dtype), np.full(len(entry), -1)
            lost = np.flatnonzero(entry < 0)
            pieces = self._pieces(words, prefix, runs, source[where[lost]])
            self.known.add(distinct[lost], check[where[lost]], self._new(pieces))
            entry = self.known.find(distinct, check[where])
        entry = entry[which]
        n = self.known.n[entry].astype(np.int64)
        ends = np.concatenate(([0], np.cumsum(n)))
        ids = self.known.ids[np.repeat(self.known.start[entry] - ends[:-1], n) + np.arange(ends[-1])]
        edges = ends[first].tolist()
        raw, width = ids.tobytes(), ids.itemsize
        out = [raw[width * a : width * b] for a, b in zip(edges, edges[1:])]
        for i, t in enumerate(texts):
            if odd[i]:
                out[i] = self._plain([t])[0]
        return out

    @staticmethod
    def _pieces(words: Words, prefix: np.ndarray, runs: list[tuple[int, int, int]], wanted: np.ndarray) -> list[str]:
        """The pieces themselves: a word by its number, a run of white space by its number behind all words."""
        begins = np.concatenate((words.start - (prefix > 0), np.array([a for _, a, _ in runs], dtype=np.int64)))[wanted]
        ends = np.concatenate((words.end, np.array([b for *_, b in runs], dtype=np.int64)))[wanted]
        raw = words.raw.tobytes()
        return [raw[a:b].decode("utf-8", "surrogatepass") for a, b in zip(begins.tolist(), ends.tolist())]


def _front(space: str) -> int:
    """A number for the white space of a piece: the character itself, or a hash of a run."""
    if len(space) < 2:
        return ord(space) if space else 0
    return int.from_bytes(hashlib.blake2b(space.encode(), digest_size=8).digest(), "little")


def _both(body: np.ndarray, prefix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return mix(body + prefix * np.uint64(0x9E3779B97F4A7C15)), mix(body ^ mix(prefix + np.uint64(0x5BD1E995)))
