"""Phrase collocation mining by top-order marginalisation.

Every word begins one window: itself and the words that lead it in its piece, padded
with nulls to the longest order. Only these windows are counted; a ROLLUP over
their columns then sums shorter and shorter prefixes, which are the counts of all
phrases of all orders, for each occurrence of a phrase is a prefix of one window.

A window is cut (padded) before a word, and after a word before a pair, that occurs
too seldom to be in a phrase that counts. Two passes over the texts make the bitmaps
that tell: of frequent words and of frequent pairs, by hash. A false hit leaves a
window longer than needed and changes no count that reaches the threshold, so
bitmaps have a size bound (``MAX_BITS``) and results do not depend on it.

Words are numbered by a 64-bit hash of language and word; if a frequent one shares
its number with any other word, which a second hash tells, all are numbered anew with
another seed. Words are spelt out for the phrases that are returned.

Defined cases: null or empty texts have no words; a null language is ``und``;
repeated rows count as often as they come; equal scores are ordered by count and
phrase; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rxlake.llm.store import discard, keep, ship_code
from rxlake.llm.textkit import BYTE_VALUES, PLACE, U, mix, prefix_sums, span_hash, text_slices

ORDER = 5
LEAST = 100
TOP = 2000
#: Most bits of a bitmap (16 MB), the size that goes to every task.
MAX_BITS = 1 << 27
#: Join keys of one word are spread over so many salts.
SALTS = 16
SLICE = 2 << 20

_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\v\f\r")] = True
_SOLID = ~_BREAK
_SOLID[[32, 9]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Slice:
    """The words of some texts: ``key`` numbers distinct (language, word) pairs of
    the slice, of which ``langs``, ``words``, ``ids`` and ``checks`` tell; ``joined`` marks words
    that are followed by another in their piece."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, lang: pa.Array, seed: int):
        n = len(buf)
        solid = _SOLID[buf]
        edge = np.zeros(n + 1, bool)
        edge[offs] = True
        begins, ends = solid.copy(), solid.copy()
        if n:
            begins[1:] &= ~solid[:-1] | edge[1:n]
            ends[:-1] &= ~solid[1:] | edge[1:n]
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        doc = np.repeat(np.arange(len(offs) - 1), np.diff(np.searchsorted(start, offs)))
        piece = np.cumsum(_BREAK[buf], dtype=np.int32)[start]
        self.joined = np.zeros(len(start), bool)
        self.joined[:-1] = (doc[1:] == doc[:-1]) & (piece[1:] == piece[:-1])

        at = np.zeros(len(start) + 1, np.int64)
        np.cumsum(end - start, out=at[1:])
        spelt = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(at), pa.py_buffer(_LOWER[buf[solid]])).dictionary_encode()
        spoken = lang.dictionary_encode()
        wide = max(len(spoken.dictionary), 1)
        both = spelt.indices.to_numpy().astype(np.int64) * wide + spoken.indices.to_numpy()[doc]
        distinct, self.key, self.count = np.unique(both, return_inverse=True, return_counts=True)
        self.words = spelt.dictionary.take(pa.array(distinct // wide))
        self.langs = spoken.dictionary.take(pa.array(distinct % wide))
        own = _hashes(spelt.dictionary)[distinct // wide]
        tongue = _hashes(spoken.dictionary.cast(pa.large_string()))[distinct % wide]
        self.ids = mix(own ^ mix(tongue + U(seed)))
        #: A second number from other values of the bytes; equal ids of different
        #: words differ in it.
        self.checks = mix(_hashes(spelt.dictionary, BYTE_VALUES[::-1])[distinct // wide] + tongue)


def _hashes(strings: pa.Array, values: np.ndarray = BYTE_VALUES) -> np.ndarray:
    if not len(strings):
        return np.zeros(0, np.uint64)
    _, at, data = strings.buffers()
    offs = np.frombuffer(at, np.int64)[: len(strings) + 1]
    raw = np.frombuffer(data, np.uint8)[: offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return span_hash(prefix_sums(raw, values), offs[:-1], offs[1:])


def _pairs(ids: np.ndarray) -> np.ndarray:
    """Number of each id with the one that follows it: 40 bits, for bitmaps only."""
    return mix(ids[:-1] * PLACE[0] + ids[1:] * PLACE[1]) >> U(24)


def _has(bitmap: np.ndarray, ids: np.ndarray) -> np.ndarray:
    at = ids & U(8 * len(bitmap) - 1)
    return (bitmap[at >> U(3)] >> (at & U(7)).astype(np.uint8)) & 1 > 0


def _slices(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[Slice]:
    for batch in batches:
        lang = batch.column(batch.schema.get_field_index("lang"))
        for lo, hi, buf, offs in text_slices(batch, "text", SLICE):
            found = Slice(buf, offs, lang.slice(lo, hi - lo), seed)
            if len(found.key):
                yield found


def vocabulary(texts: DataFrame, seed: int) -> DataFrame:
    """id, f, clash (words of this number differ): all words of all texts; and rows
    with lang, the number 0 and all words of that language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in _slices(batches, seed):
            spoken = s.langs.dictionary_encode()
            total = np.bincount(spoken.indices.to_numpy(), s.count, len(spoken.dictionary)).astype(np.int64)
            n, k = len(s.ids), len(total)
            ids, checks = (np.append(x, np.zeros(k, np.uint64)).view(np.int64) for x in (s.ids, s.checks))
            lang = pa.concat_arrays([pa.nulls(n, pa.string()), spoken.dictionary.cast(pa.string())])
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(checks), lang, pa.array(np.append(s.count, total))], ["id", "chk", "lang", "c"])

    found = texts.mapInArrow(run, "id bigint, chk bigint, lang string, c bigint").groupBy("id", "lang")
    return found.agg(F.sum("c").alias("f"), F.min("chk").alias("_a"), F.max("chk").alias("_b")).select("id", "lang", "f", (F.col("_a") != F.col("_b")).alias("clash"))


def spelled(texts: DataFrame, words, seed: int) -> DataFrame:
    """id, word of all frequent words, by slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in _slices(batches, seed):
            some = np.flatnonzero(_has(words.value, s.ids))
            yield pa.RecordBatch.from_arrays([pa.array(s.ids[some].view(np.int64)), s.words.take(pa.array(some)).cast(pa.string())], ["id", "word"])

    return texts.mapInArrow(run, "id bigint, word string")


def bitmap(ids: DataFrame) -> np.ndarray:
    """Bits of the numbers in column ``id``: about 16 bits a number, ``MAX_BITS`` at most."""
    bits = min(MAX_BITS, 1 << max(15, (16 * ids.count()).bit_length()))
    place = F.col("id").bitwiseAND(F.lit(bits - 1)) + 1
    chunks = ids.groupBy(F.bitmap_bucket_number(place).alias("chunk")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros(bits // 8, np.uint8)
    for row in chunks.collect():  # at most MAX_BITS / 32,768 rows of 4 KB
        part = np.frombuffer(row["bits"], np.uint8)
        out[(row["chunk"] - 1) * 4096 :][: len(part)] = part[: len(out)]
    return out


def frequent_pairs(texts: DataFrame, words, seed: int, least: int) -> DataFrame:
    """Numbers of the pairs of frequent words that occur ``least`` times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in _slices(batches, seed):
            ok = _has(words.value, s.ids)[s.key]
            both = np.flatnonzero(s.joined[:-1] & ok[:-1] & ok[1:])
            ids = s.ids[s.key]
            pair, times = np.unique(_pairs(ids)[both], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pair.view(np.int64)), pa.array(times)], ["id", "c"])

    found = texts.mapInArrow(run, "id bigint, c bigint").groupBy("id").agg(F.sum("c").alias("c"))
    return found.where(F.col("c") >= least).select("id")


def top_windows(texts: DataFrame, words, pairs, seed: int, order: int) -> DataFrame:
    """lang, w1 to w<order> (null: padding) and their count c, by slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in _slices(batches, seed):
            ids, n = s.ids[s.key], len(s.key)
            ok = _has(words.value, s.ids)[s.key]
            link = s.joined & ok
            link[:-1] &= ok[1:]
            some = np.flatnonzero(link[:-1])
            link[some] = _has(pairs.value, _pairs(ids)[some])
            length, lead = ok.astype(np.int64), link.copy()
            for step in range(1, order):
                length += lead
                lead &= np.append(link[step:], np.zeros(min(step, n), bool))[:n]
            kinds = len(s.ids)
            for m in range(1, order + 1):
                at = np.flatnonzero(length == m)
                code = s.key[at].astype(np.int64)
                for step in range(1, m):
                    code = np.unique(code, return_inverse=True)[1] * kinds + s.key[at + step]
                _, first, times = np.unique(code, return_index=True, return_counts=True)
                at = at[first]
                cols = [pa.array(ids[at + step].view(np.int64)) if step < m else pa.nulls(len(at), pa.int64()) for step in range(order)]
                lang = s.langs.take(pa.array(s.key[at])).cast(pa.string())
                yield pa.RecordBatch.from_arrays([lang, *cols, pa.array(times)], ["lang", *_columns(order), "c"])

    return texts.mapInArrow(run, "lang string, " + ", ".join(f"{w} bigint" for w in _columns(order)) + ", c bigint")


def _columns(order: int) -> list[str]:
    return [f"w{i + 1}" for i in range(order)]


def marginals(windows: DataFrame, order: int, least: int) -> DataFrame:
    """lang, p (ids of the words), f: all phrases of up to ``order`` words that occur
    ``least`` times, words among them, from the counts of the longest windows alone."""
    cols = _columns(order)
    summed = windows.rollup("lang", *cols).agg(F.sum("c").alias("f"), F.grouping_id().alias("g"))
    # A grouping set of k words has order - k low bits; its last word must be there.
    words = F.lit(order) - F.bit_count("g")
    p = F.slice(F.array(*cols), 1, F.greatest(words, F.lit(1)))
    found = summed.where((words >= 1) & (F.col("f") >= least)).select("lang", p.alias("p"), "f")
    return found.where(F.element_at("p", -1).isNotNull())


def scored(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, p, a, l, r, n, score of phrases of two words and more, by their lowest cut."""
    size, k = F.size("p"), F.col("k")
    many = phrases.where(size >= 2).withColumnRenamed("f", "a")
    cuts = many.select("*", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("*", F.slice("p", 1, k).alias("left"), F.slice("p", k + 1, size - k).alias("right"))
    one = size == 1
    looked = phrases.select("p", "f", F.explode(F.when(one, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))).alias("s"))
    for side, value in (("left", "l"), ("right", "r")):
        salt = F.when(F.size(side) == 1, F.pmod(F.hash("p"), F.lit(SALTS))).otherwise(F.lit(0))
        part = looked.select(F.col("p").alias(side), F.col("f").alias(value), F.col("s").alias("salt"))
        cuts = cuts.withColumn("salt", salt).join(part, [side, "salt"]).drop("salt")
    cuts = cuts.join(totals, "lang")
    big = "decimal(38,0)"
    a, n, left, right = (F.col(c).cast("decimal(19,0)") for c in "anlr")
    cuts = cuts.withColumn("_top", ((a * n).cast(big) * F.lit(1000).cast("decimal(4,0)")).cast(big)).withColumn("_down", (left * right).cast(big))
    cuts = cuts.withColumn("score", F.expr("_top div _down"))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("m")
    return cuts.groupBy("lang", "p", "a", "n").agg(lowest).select("lang", "p", "a", "m.l", "m.r", "n", "m.score")


def maximal(found: DataFrame, percent: int) -> DataFrame:
    """Without phrases inside a longer one that has ``percent`` of their count. A
    longer one holds, between itself and the phrase, one of a single word more, which
    occurs as often at least: those of one word more decide."""
    size = F.size("p")
    inside = F.array(F.slice("p", 1, size - 1), F.slice("p", 2, size - 1))
    longer = found.where(size >= 3).select(F.explode(inside).alias("p"), "a").groupBy("p").agg(F.max("a").alias("_longer"))
    kept = found.join(longer, "p", "left")
    return kept.where(F.col("_longer").isNull() | (F.col("_longer") * 100 < F.col("a") * percent)).drop("_longer")


def collocations(docs: DataFrame, *, order: int = ORDER, least: int = LEAST, percent: int = 100, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    ship_code(docs.sparkSession)
    texts = docs.select(F.col("text"), F.coalesce(F.col("lang"), F.lit("und")).alias("lang"))
    for seed in count():
        vocab = keep(vocabulary(texts, seed), "vocabulary")
        if vocab.where((F.col("f") >= least) & F.col("clash")).isEmpty():
            break
    totals = keep(vocab.where("lang IS NOT NULL").select("lang", F.col("f").alias("n")), "totals")
    known = keep(vocab.where((F.col("f") >= least) & F.col("lang").isNull()).select("id"), "words")
    discard(vocab)
    sc = docs.sparkSession.sparkContext
    words = sc.broadcast(bitmap(known))
    often = keep(frequent_pairs(texts, words, seed, least), "pairs")
    pairs = sc.broadcast(bitmap(often))
    discard(often, known)
    longest = keep(top_windows(texts, words, pairs, seed, order).groupBy("lang", *_columns(order)).agg(F.sum("c").alias("c")), "windows")
    phrases = keep(marginals(longest, order, least), "phrases")
    discard(longest)
    found = keep(maximal(scored(phrases, totals), percent), "collocations")
    # The first ones of each part of a language, then of the language: a task
    # holds SALTS times ``top`` rows and ties. Map tasks cut before each exchange.
    near, rest = found.withColumn("_part", F.pmod(F.hash("p"), F.lit(SALTS))), ["lang", "_part"]
    for keys in (rest, ["lang"]):
        first = Window.partitionBy(*keys).orderBy(F.desc("score"), F.desc("a"))
        near = near.withColumn("_at", F.rank().over(first)).where(F.col("_at") <= top).drop("_at")
    near = keep(near.drop("_part"), "first")
    wanted = keep(near.select(F.explode("p").alias("id")).distinct(), "wanted")
    names = keep(spelled(texts, words, seed).join(wanted, "id", "left_semi").distinct(), "names")
    spelt = near.select("p", F.posexplode("p").alias("i", "id")).join(names, "id")
    spelt = spelt.groupBy("p").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    last = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = near.join(spelt, "p").withColumn("rank", F.row_number().over(last).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
