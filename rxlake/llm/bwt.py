"""Burrows-Wheeler transform of a collection of aligned strings, with common
prefixes, built column by column.

Strings are placed so that equal windows stand in equal columns. Each round, from
the last column to the first, puts one more symbol in front of every string that
reaches it: strings are kept in the order of what follows, a stable sort by the
new symbol gives the next order (the transform's column is the symbols in the old
one), and the common prefix of two neighbours grows by one over the least between
them, or is none if their symbols differ. Columns are read from a file and the
transform's columns written to one, both from front to end; in memory there is
one column, the order and the common prefixes.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

NONE = 255  # no byte of UTF-8 has this value


def _range_min(lcp: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Minimum of ``lcp[lo:hi]`` for each pair; ranges are not empty."""
    out = lcp[lo]
    wide = np.flatnonzero(hi - lo > 1)
    if len(wide):
        pairs = np.empty(2 * len(wide), np.int64)
        pairs[0::2], pairs[1::2] = lo[wide], hi[wide]
        out[wide] = np.minimum.reduceat(np.append(lcp, np.int32(0)), pairs)[0::2]
    return out


def _write_columns(strings: list[bytes], left: np.ndarray, last: int, first: int, path: str) -> None:
    table = np.full((last - first, len(strings)), NONE, np.uint8)
    for i, s in enumerate(strings):
        end = last - (left[i] + len(s))
        table[end : end + len(s), i] = np.frombuffer(s, np.uint8)[::-1]
    table.tofile(path)


def repeated_starts(strings: list[bytes], left: np.ndarray, width: int) -> list[np.ndarray]:
    """For each string (its first byte in column ``left``), and each place with
    ``width`` bytes left: has another string the same bytes in the same columns?"""
    m = len(strings)
    size = np.array([len(s) for s in strings], np.int64)
    left = np.asarray(left, np.int64)
    starts = np.maximum(size - width + 1, 0)
    marks = np.zeros((m, int(starts.max(initial=0))), bool)
    if not marks.size:
        return [marks[i, :n] for i, n in enumerate(starts)]
    end = left + size
    last, first = int(end.max()), int(left.min())
    by_end = np.argsort(-end, kind="stable")
    entered = 0
    order, lcp = np.zeros(0, np.int64), np.zeros(0, np.int32)
    with tempfile.TemporaryDirectory(prefix="bwt-") as folder:
        columns = os.path.join(folder, "columns")
        _write_columns(strings, left, last, first, columns)
        with open(columns, "rb") as source, open(os.path.join(folder, "transform"), "wb") as transform:
            for c in range(last - 1, first - 1, -1):
                column = np.fromfile(source, np.uint8, m)
                gone = left[order] > c
                if gone.any():
                    kept = np.flatnonzero(~gone)
                    begin = np.append(0, kept[:-1] + 1)
                    lcp = _range_min(lcp, begin, kept + 1) if len(kept) else lcp[:0]
                    order = order[kept]
                # Strings that end here: nothing follows yet, so they come first.
                now = entered
                while entered < m and end[by_end[entered]] > c:
                    entered += 1
                if entered > now:
                    lcp = np.concatenate([np.zeros(entered - now, np.int32), lcp])
                    if len(order):
                        lcp[entered - now] = 0
                    order = np.concatenate([by_end[now:entered], order])
                symbol = column[order]
                symbol.tofile(transform)
                new = np.argsort(symbol, kind="stable")
                by_symbol = symbol[new]
                grown = np.zeros(len(new), np.int32)
                same = np.flatnonzero(by_symbol[1:] == by_symbol[:-1]) + 1
                if len(same):
                    grown[same] = 1 + _range_min(lcp, new[same - 1] + 1, new[same] + 1)
                order, lcp = order[new], grown
                hit = np.append(lcp >= width, False)
                hit = hit[:-1] | hit[1:]
                at = c - left[order]
                ok = hit & (at < starts[order])
                marks[order[ok], at[ok]] = True
    return [marks[i, :n] for i, n in enumerate(starts)]
