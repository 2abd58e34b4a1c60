"""Scoring with a gated recurrent language model learnt from the corpus.

1. Tokens of the training documents are counted by 64-bit word hash.
2. The VOCAB most frequent make the model's vocabulary, in classes by frequency;
   the weights start as the unigram distribution. The rounds deal out all
   training documents among them, by hash of id and text; in each, every task
   trains a copy on its part and copies are averaged by tokens, as a tree.
3. Every document is scored whole, its state carried from window to window.
   The counts of the ``LISTED`` most frequent words go to all tasks (a bound of
   about 4 MB); the other words of each document meet their counts in a join.

The probability of a word beyond the vocabulary is that of the rare class times
(c + 1/2) / (R + (W + 1) / 2): c its count, R tokens and W words of that class.

Defined cases: null or empty text is the end token alone; repeated rows count
each; a null id is not held out; words with equal counts are ordered by hash;
without training documents all counts are 0; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxlake.llm import gru
from rxlake.llm.store import keep, ship_code
from rxlake.llm.textkit import text_slices, words_of

#: Words whose counts every task holds.
LISTED = 1 << 18
#: Rounds of training, each on its own part of the training documents.
ROUNDS = 2
SLICES = 8
END_HASH = np.uint64(0x5EED_0E4D)


def held_out(doc_id: Column, folds: int = 5, fold: int = 1) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def token_counts(docs: DataFrame) -> DataFrame:
    """word (64-bit hash), c: counts over all tokens of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts, size = [], [], 0

        def flush() -> pa.RecordBatch:
            h, back = np.unique(np.concatenate(hashes), return_inverse=True)
            c = np.bincount(back, np.concatenate(counts))
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.astype(np.int64))], ["word", "c"])

        for b in batches:
            for lo, hi, buf, offs in text_slices(b, "text"):
                h, c = np.unique(words_of(buf, offs, fold_case=True).hash, return_counts=True)
                hashes.append(np.append(h, END_HASH))
                counts.append(np.append(c, hi - lo))
                size += len(h)
                if size > 1_000_000:
                    yield flush()
                    hashes, counts, size = [], [], 0
        if hashes:
            yield flush()

    return docs.select("text").mapInArrow(run, "word bigint, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Counts:
    """The most frequent words, by hash: number by falling frequency, count."""

    word: np.ndarray
    number: np.ndarray
    count: np.ndarray
    tokens: int
    words: int

    @classmethod
    def of(cls, table: DataFrame) -> Counts:
        total = table.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
        top = table.orderBy(F.desc("c"), "word").limit(LISTED).toArrow()
        word = top.column("word").to_numpy().astype(np.int64).view(np.uint64)
        count = top.column("c").to_numpy().astype(np.int64)
        best = np.lexsort((word.view(np.int64), -count))
        word, count = word[best], count[best]
        order = np.argsort(word)
        return cls(word[order], order, count[order], int(total["n"] or 0), int(total["v"]))

    def top(self) -> np.ndarray:
        """Counts of the vocabulary in order."""
        by_number = np.empty(len(self.number), np.int64)
        by_number[self.number] = self.count
        return by_number[: gru.VOCAB]

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and count of each hash; -1 and 0 where not listed."""
        if not len(self.word):
            return np.full(len(h), -1), np.zeros(len(h), np.int64)
        i = np.minimum(np.searchsorted(self.word, h), len(self.word) - 1)
        ok = self.word[i] == h
        return np.where(ok, self.number[i], -1), np.where(ok, self.count[i], 0)


def _numbered(buf: np.ndarray, offs: np.ndarray, counts: Counts) -> tuple[np.ndarray, ...]:
    """All tokens of some texts, each text's end included: text, number, count, hash."""
    w = words_of(buf, offs, fold_case=True)
    h = np.insert(w.hash, w.first[1:], END_HASH)
    text = np.insert(w.doc, w.first[1:], np.arange(len(offs) - 1))
    known, back = np.unique(h, return_inverse=True)
    number, count = counts.find(known)
    return text, number[back], count[back], h


def _input(number: np.ndarray) -> np.ndarray:
    return np.where((number < 0) | (number >= gru.VOCAB), gru.RARE, number).astype(np.int32)


def rounds(docs: DataFrame) -> list[DataFrame]:
    """``docs`` dealt out: each row in one round. The text takes part in the hash,
    so that rows of a null or frequent id spread."""
    turn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(ROUNDS))
    return [docs.where(turn == i) for i in range(ROUNDS)]


def train(docs: DataFrame, counts: Counts) -> tuple[dict[str, np.ndarray], int]:
    """Weights after all rounds and the tokens learnt from, which are all tokens
    of ``docs``, the training documents."""
    top = counts.top()
    weights, learnt = gru.start(top, counts.tokens - int(top.sum())), 0
    for part in rounds(docs):
        part = part.select("text")
        flat = gru.flatten(weights)

        def run(batches: Iterator[pa.RecordBatch], flat: np.ndarray = flat) -> Iterator[pa.RecordBatch]:
            own, texts, seen, size = gru.unflatten(flat), [], 0, 0
            for b in batches:
                for lo, hi, buf, offs in text_slices(b, "text"):
                    text, number, _, _ = _numbered(buf, offs, counts)
                    ends = np.searchsorted(text, np.arange(hi - lo + 1))
                    x = _input(number)
                    texts += [x[ends[i] : ends[i + 1]] for i in range(hi - lo)]
                    size += len(x)
                    if size > 1_000_000:
                        seen += gru.train(own, texts)
                        texts, size = [], 0
            if texts:
                seen += gru.train(own, texts)
            if seen:
                pieces = np.array_split(gru.flatten(own), SLICES)
                pid = TaskContext.get().partitionId()
                yield pa.RecordBatch.from_arrays([pa.array([pid] * SLICES, pa.int64()), pa.array(range(SLICES), pa.int64()), pa.array([float(seen)] * SLICES), pa.array([x.astype("<f4").tobytes() for x in pieces], pa.binary())], ["pid", "slice", "tokens", "weights"])

        copies = part.mapInArrow(run, "pid bigint, slice bigint, tokens double, weights binary")
        # Each task averages at most 64 copies of a slice, then the averages meet.
        for level in (64, 4096, 1 << 62):
            copies = copies.withColumn("pid", F.floor(F.col("pid") / level)).groupBy("pid", "slice").applyInArrow(_average, copies.schema)
        found = {r["slice"]: r for r in copies.collect()}  # one model: bounded
        if found:
            weights = gru.unflatten(np.concatenate([np.frombuffer(found[i]["weights"], "<f4") for i in range(SLICES)]))
            learnt += int(found[0]["tokens"])
    return weights, learnt


def _average(part: pa.Table) -> pa.Table:
    tokens = part.column("tokens").to_numpy()
    total = sum(n * np.frombuffer(w.as_py(), "<f4").astype(np.float64) for n, w in zip(tokens, part.column("weights"), strict=True))
    mean = (total / tokens.sum()).astype("<f4").tobytes()
    return pa.table({"pid": part.column("pid")[:1], "slice": part.column("slice")[:1], "tokens": [float(tokens.sum())], "weights": [mean]}, schema=part.schema)


def score(docs: DataFrame, *, held: str = "held_out") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    ship_code(docs.sparkSession)
    docs = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias(held))
    learn = docs.where(~F.col(held))
    table = keep(token_counts(learn), "counts")
    counts = Counts.of(table)
    weights, _ = train(learn, counts)
    top = counts.top()
    rare_tokens, rare_words = counts.tokens - int(top.sum()), counts.words - len(top)
    all_log = float(np.log10(counts.tokens + 0.5 * (counts.words + 1)))
    rare_log = float(np.log10(rare_tokens + 0.5 * (rare_words + 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid, wait, texts, held_size = TaskContext.get().partitionId() << 33, [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            lp = gru.score(weights, texts) / np.log(10)
            at = 0
            for rows in wait:
                n = rows.num_rows
                both = pa.array(rows.column("score").to_numpy() + lp[at : at + n])
                at += n
                yield rows.set_column(rows.schema.get_field_index("score"), "score", both)

        for b in batches:
            for lo, hi, buf, offs in text_slices(b, "text"):
                n = hi - lo
                text, number, count, h = _numbered(buf, offs, counts)
                ends = np.searchsorted(text, np.arange(n + 1))
                x = _input(number)
                texts += [x[ends[i] : ends[i + 1]] for i in range(n)]
                listed = number >= 0
                logs = np.where(listed, np.log10(count + 0.5), 0.0)
                size = np.diff(ends)
                base = np.bincount(text, logs, n) - size * all_log
                rare = x == gru.RARE
                part = np.bincount(text[rare], logs[rare], n) - np.bincount(text[rare], minlength=n) * rare_log
                # Words that are not listed, each once a text.
                out = np.flatnonzero(~listed)
                out = out[np.lexsort((h[out], text[out]))]
                new = np.ones(len(out), bool)
                new[1:] = (h[out][1:] != h[out][:-1]) | (text[out][1:] != text[out][:-1])
                first = np.flatnonzero(new)
                times = np.diff(np.append(first, len(out)))
                words = pa.StructArray.from_arrays([pa.array(h[out][first].view(np.int64)), pa.array(times)], ["word", "k"])
                at = np.append(0, np.cumsum(np.bincount(text[out][first], minlength=n))).astype(np.int32)
                cols = {
                    "rid": pa.array(rid + np.arange(n)),
                    "doc_id": b.column(0).slice(lo, n),
                    "held": b.column(2).slice(lo, n),
                    "n_tokens": pa.array(size.astype(np.int64)),
                    "n_known": pa.array(np.bincount(text[listed], minlength=n).astype(np.int64)),
                    "base": pa.array(base),
                    "score": pa.array(part),
                    "rest": pa.ListArray.from_arrays(pa.array(at), words),
                }
                rid += n
                wait.append(pa.RecordBatch.from_pydict(cols))
                held_size += len(x)
                if held_size > 1_500_000:
                    yield from flush()
                    wait, texts, held_size = [], [], 0
        if wait:
            yield from flush()

    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", "text", held).mapInArrow(run, f"rid bigint, doc_id {kind}, held boolean, n_tokens bigint, n_known bigint, base double, score double, rest array<struct<word:bigint,k:bigint>>")
    rows = keep(rows, "scored")
    rest = rows.select("rid", F.inline("rest")).join(table, "word", "left")
    logs = F.sum(F.col("k") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("more")
    rest = rest.groupBy("rid").agg(logs, F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("found"))
    out = rows.drop("rest").join(rest, "rid", "left")
    more = F.coalesce("more", F.lit(0.0))
    return out.select("doc_id", F.col("held").alias(held), "n_tokens", (F.col("n_known") + F.coalesce("found", F.lit(0))).alias("n_known"), F.lit(counts.tokens).cast("long").alias("train_tokens"), (F.col("base") + more).alias("base_score"), (F.col("score") + more).alias("score"))
