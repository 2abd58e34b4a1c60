"""Byte-level BPE ids of whole texts, with a bounded cache of pieces.

The pre-tokeniser never joins across a space that is followed by something
visible, so a text may be cut before each such space and its pieces encoded
apart. Pieces are found and looked up by hash over a whole batch of texts; those
not seen yet are encoded in one call and cut apart by the byte lengths of ids.
Texts are cut at the file's added tokens first, each of which is a piece.
"""

from __future__ import annotations

import json
import re

import numpy as np

from rxlake.llm.textkit import BYTE_VALUES, prefix_sums, span_hash

#: May follow the space of a cut: printable ASCII, or the first byte of a code
#: point of which no white space is made (white space begins with C2, E1 to E3).
_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True
_VISIBLE[0xC3:0xF5] = True
_VISIBLE[0xE1:0xE4] = False
_ENCODERS: dict[str, Encoder] = {}


def _byte_letters() -> dict[str, int]:
    """Letters that byte-level vocabularies write for bytes: printable ones stand
    for themselves, the others for code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids as the ``tokenizers`` library gives them for the file at ``path``."""

    #: Pieces in the cache before it is emptied.
    MOST = 400_000

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        vocab = file["model"]["vocab"]
        added = file.get("added_tokens") or []
        if any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens that depend on what is around them")
        self._added = {t["content"].encode(): t["id"] for t in added}
        longest = sorted(self._added, key=len, reverse=True)
        self._literal = re.compile(b"|".join(map(re.escape, longest))) if added else None
        letters = _byte_letters()
        special = [t for t in vocab if any(c not in letters for c in t) or t.startswith("<|")]
        ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in special}
        self._bpe = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        top = max([*vocab.values(), *self._added.values()])
        self.wide = np.uint16 if top < 65536 else np.uint32
        #: Bytes of each id.
        self.bytes_of = np.zeros(top + 1, np.int64)
        for t, i in ranks.items():
            self.bytes_of[i] = len(t)
        for t, i in self._added.items():
            self.bytes_of[i] = len(t)
        self._clear()

    def _clear(self) -> None:
        self._hash = np.zeros(0, np.uint64)
        self._at = np.zeros(0, np.int64)
        self._size = np.zeros(0, np.int64)
        self._ids = np.zeros(0, self.wide)

    def _learn(self, hashes: np.ndarray, pieces: list[bytes]) -> None:
        """Add pieces (hashes ascending): those that begin with a space may be
        encoded as one text, the first pieces of texts one by one."""
        ids, sizes = [], np.zeros(len(pieces), np.int64)
        inner = [i for i, p in enumerate(pieces) if p[:1] == b" "]
        joined = np.array(self._bpe.encode_ordinary(b"".join(pieces[i] for i in inner).decode()), self.wide)
        ends = np.searchsorted(np.cumsum(self.bytes_of[joined]), np.cumsum([len(pieces[i]) for i in inner]), "left") + 1 if inner else np.zeros(0, np.int64)
        sizes[inner] = np.diff(ends, prepend=0)
        at = np.zeros(len(pieces), np.int64)
        at[inner] = ends - sizes[inner]
        ids.append(joined)
        total = len(joined)
        for i, p in enumerate(pieces):
            if p[:1] != b" ":
                x = np.array([self._added[p]] if p in self._added else self._bpe.encode_ordinary(p.decode()), self.wide)
                ids.append(x)
                at[i], sizes[i] = total, len(x)
                total += len(x)
        at += len(self._ids)
        self._ids = np.concatenate([self._ids, *ids])
        where = np.searchsorted(self._hash, hashes)
        self._hash = np.insert(self._hash, where, hashes)
        self._at = np.insert(self._at, where, at)
        self._size = np.insert(self._size, where, sizes)

    def _look_up(self, hashes: np.ndarray) -> np.ndarray:
        i = np.minimum(np.searchsorted(self._hash, hashes), max(len(self._hash) - 1, 0))
        return np.where(self._hash[i] == hashes, i, -1) if len(self._hash) else np.full(len(hashes), -1)

    def _edges(self, raw: bytes, offs: np.ndarray) -> np.ndarray:
        """``offs`` and the ends of all added tokens in the texts."""
        if self._literal is None:
            return offs
        own = []
        # Each text apart: no token spans two.
        if self._literal.search(raw):
            for a, z in zip(offs, offs[1:], strict=False):
                own += [x for m in self._literal.finditer(raw, int(a), int(z)) for x in m.span()]
        return np.unique(np.append(offs, np.array(own, offs.dtype))) if own else offs

    def encode(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts ``buf[offs[i]:offs[i + 1]]``, and their offsets by text."""
        n = len(buf)
        if not n:
            return np.zeros(0, self.wide), np.zeros(len(offs), np.int64)
        cut = np.zeros(n, bool)
        cut[:-1] = (buf[:-1] == 32) & _VISIBLE[buf[1:]]
        raw = buf.tobytes()
        edges = self._edges(raw, offs)
        ends = edges[1:][(edges[1:] > 0)] - 1
        cut[ends] = False  # a space that ends a text
        cut[edges[:-1][edges[:-1] < n]] = True
        start = np.flatnonzero(cut)
        stop = np.append(start[1:], n)
        h = span_hash(prefix_sums(buf, BYTE_VALUES), start, stop)
        known, back = np.unique(h, return_inverse=True)
        found = self._look_up(known)
        new = np.flatnonzero(found < 0)
        if len(new):
            if len(self._hash) + len(new) > self.MOST:
                self._clear()
                new = np.arange(len(known))
            first = np.empty(len(known), np.int64)
            first[back[::-1]] = np.arange(len(start))[::-1]
            self._learn(known[new], [raw[start[i] : stop[i]] for i in first[new]])
            found = self._look_up(known)
        size = self._size[found][back]
        at = self._at[found][back]
        before = np.cumsum(size) - size
        ids = self._ids[np.repeat(at - before, size) + np.arange(int(size.sum()))]
        by_text = np.append(before, len(ids))[np.searchsorted(start, offs)]
        return ids, by_text


def encoder(path: str) -> Encoder:
    """One encoder a process and vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
