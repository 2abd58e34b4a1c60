"""Vectorised work on Arrow text columns: words, hashes of words, lines and windows.

A word is a run of bytes other than space and \\t to \\r. Hashes are 64-bit sums
of random byte values times powers of an odd base (mod 2**64), so the hash of
any span comes from two prefix sums; they are mixed before use.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_RNG = np.random.default_rng(20240607)
BYTE_VALUES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_UPPER = np.arange(256) - 32 * ((np.arange(256) >= 97) & (np.arange(256) <= 122))
#: Gives an upper-case letter the value of its lower-case form.
FOLDED_VALUES = BYTE_VALUES.copy()
FOLDED_VALUES[65:91] = BYTE_VALUES[97:123]
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False
LEADS = (np.arange(256) & 0xC0) != 0x80  # bytes that begin a code point
BASE = int(_RNG.integers(1, 2**63)) * 2 + 1
PLACE = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * U(2) + U(1)
_POW = np.ones(1, np.uint64)
_INV = np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse."""
    global _POW, _INV
    if len(_POW) < n:
        size = max(n, 1 << 16)
        grow = np.full(size, BASE, np.uint64)
        grow[0] = 1
        _POW = np.cumprod(grow, dtype=np.uint64)
        grow[1:] = pow(BASE, -1, 2**64)
        _INV = np.cumprod(grow, dtype=np.uint64)
    return _POW[:n], _INV[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def prefix_sums(buf: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(values[buf] * powers(len(buf) + 1)[0][: len(buf)], dtype=np.uint64, out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of byte spans; the length is mixed in."""
    inv = powers(len(sums))[1]
    return mix((sums[end] - sums[start]) * inv[start] + (end - start).astype(np.uint64) * PLACE[63])


def text_slices(batch: pa.RecordBatch, column: str, max_bytes: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with at most ``max_bytes`` of text (or one row):
    first row, last row + 1, bytes, offsets of the texts in them. Null is empty."""
    col = batch.column(batch.schema.get_field_index(column))
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    if col.null_count:
        col = pc.fill_null(col, "")
    n = len(col)
    if not n:
        return
    _, at, data = col.buffers()
    offs = np.frombuffer(at, np.int64)[col.offset : col.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + max_bytes, "right")) - 1)
        yield lo, hi, raw[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


@dataclass
class Words:
    """Words of some texts: byte spans, hashes, and the first word of each text."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # of text i: first[i] up to first[i + 1]
    sums: np.ndarray

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.count)


def words_of(buf: np.ndarray, offs: np.ndarray, fold_case: bool) -> Words:
    n = len(buf)
    solid = NOT_SPACE[buf]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    begins, ends = solid.copy(), solid.copy()
    if n:
        begins[1:] &= ~solid[:-1] | edge[1:n]
        ends[:-1] &= ~solid[1:] | edge[1:n]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    sums = prefix_sums(buf, FOLDED_VALUES if fold_case else BYTE_VALUES)
    return Words(start, end, span_hash(sums, start, end), np.searchsorted(start, offs), sums)


def windows_of(words: Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of ``k`` words inside a text: index of the first word, text, hash."""
    n, count = len(words.hash), words.count
    if n < k:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = np.zeros(n - k + 1, np.uint64)
    for j in range(k):
        h += words.hash[j : n - k + 1 + j] * PLACE[j]
    doc = words.doc
    inside = doc[: n - k + 1] == doc[k - 1 :]
    at = np.flatnonzero(inside)
    del count
    return at, doc[at], mix(h[at])
