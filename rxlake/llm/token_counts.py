"""Token counts by section: offset-mapped attribution.

Each whole text is encoded once. Byte lengths of the ids give each token's
span; spans are joined to the sections' intervals by binary search. A token
that crosses a boundary belongs to the section that holds most of its
characters, the earlier one in a tie (``rule="most"``), or to the section in
which it begins (``rule="first"``). Each token is counted exactly once.

Defined cases: null or empty text has one empty section with no tokens;
repeated rows are counted each; an empty table gives no rows; a text without
line feeds is one section.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlake.llm.encode import encoder
from rxlake.llm.store import free_name, schema_of, ship_code
from rxlake.llm.textkit import LEADS, text_slices


def attribute(sizes: np.ndarray, ends: np.ndarray, buf: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Section (interval between ``ends``, ascending byte ends) of each token,
    and whether the token crosses a boundary."""
    stop = np.cumsum(sizes)
    start = stop - sizes
    first = np.searchsorted(ends, start, "right")
    crosses = np.searchsorted(ends, stop, "left") > first
    owner = first.copy()
    if rule == "most":
        for t in np.flatnonzero(crosses):
            edges = [start[t], *ends[(k := first[t]) : np.searchsorted(ends, stop[t], "left")], stop[t]]
            # A part of a character counts as the character.
            chars = [max(int(LEADS[buf[a:b]].sum()), 1) for a, b in zip(edges, edges[1:], strict=False)]
            owner[t] = k + int(np.argmax(chars))
    return owner, crosses


def count_by_section(docs: DataFrame, path: str, columns: list[str], *, rule: str = "most") -> DataFrame:
    """One row a line of each text: ``columns``, section (from 0), section_start,
    section_end (code points), n_tokens, n_crossing, doc_tokens."""
    if rule not in ("most", "first"):
        raise ValueError(rule)
    ship_code(docs.sparkSession)
    made = ["section", "section_start", "section_end", "n_tokens", "n_crossing", "doc_tokens"]
    own = [c for c in columns if c not in made]
    (text,) = free_name(docs.select(*own), "_text")
    rows = docs.select(*own, F.col("text").alias(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            for lo, hi, buf, offs in text_slices(batch, text, 2 << 20):
                ids, by_text = enc.encode(buf, offs)
                ends = np.unique(np.concatenate([np.flatnonzero(buf == 10) + 1, offs[1:]]))
                ends = ends[ends > 0]
                owner, crosses = attribute(enc.bytes_of[ids], ends, buf, rule)
                n = np.bincount(owner, minlength=len(ends))
                x = np.bincount(owner[crosses], minlength=len(ends))
                chars = np.zeros(len(buf) + 1, np.int64)
                np.cumsum(LEADS[buf], out=chars[1:])
                begins = np.append(0, ends)[: len(ends)]
                row = np.searchsorted(offs, begins, "right") - 1
                base = chars[offs[row]]
                nth = np.arange(len(ends)) - np.searchsorted(begins, offs[row])
                table = np.stack([row, nth, chars[begins] - base, chars[ends] - base, n, x, np.diff(by_text)[row]]).astype(np.int64)
                none = np.flatnonzero(np.diff(offs) == 0)  # a text without characters: one empty section
                table = np.concatenate([table, np.stack([none, *[np.zeros_like(none)] * 6])], axis=1)
                take = pa.array(table[0] + lo)
                yield pa.RecordBatch.from_arrays([batch.column(i).take(take) for i in range(len(own))] + [pa.array(c) for c in table[1:]], [*own, *made])

    return rows.mapInArrow(run, schema_of(docs.select(*own), ", ".join(f"{c} bigint" for c in made)))
