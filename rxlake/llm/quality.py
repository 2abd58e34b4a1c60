"""Quality rules: boosted trees over document statistics.

Statistics come from one vectorised pass over whole texts. A gradient-boosted
classifier is fitted here on a bounded sample of labelled documents
(``max_labels``, chosen by hash of the id) and flattened into arrays of nodes;
scoring walks all trees of a batch at once. Chosen statistics may only lower
the score as they grow (symbols, repeated lines and words).

Defined cases: null or empty text has statistics 0 and fails the base rules;
repeated rows are scored alike; labels that are null, or whose document is
missing, are ignored; with no usable label, or one class only, the trees keep
everything that passes the base rules; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlake.llm.store import free_name, schema_of, ship_code
from rxlake.llm.textkit import LEADS, mix, prefix_sums, span_hash, text_slices, windows_of, words_of

SYMBOLS = b"#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = [*COUNTS, "symbols_per_word", "dup_line_share", "repeat_share", "mean_word", "upper_share", "digit_share", "mark_share", "words_per_line", "distinct_share"]
#: Features that may only lower the score as they grow.
FALLING = ["n_symbols", "n_dup_lines", "n_repeat_words", "symbols_per_word", "dup_line_share", "repeat_share"]
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_MARK = np.zeros(256, bool)
_MARK[[33, 63, 34, 40, 41, 47, 58, 59, 61, 64, 95, 124]] = True


def _per_text(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return np.diff(sums[offs])


def _repeats(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For keys by text: is a key found twice or more; is it one after the first."""
    key = mix(h + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = key[order][1:] == key[order][:-1]
    twice, later = np.empty(len(key), bool), np.empty(len(key), bool)
    twice[order], later[order] = same[1:] | same[:-1], same[:-1]
    return twice, later


def statistics(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Feature matrix, one row a text, columns as in ``FEATURES``."""
    n = len(offs) - 1
    w = words_of(buf, offs, fold_case=False)
    count = w.count
    in_word = np.zeros(len(buf) + 1, np.int8)
    np.add.at(in_word, w.start, 1)
    np.add.at(in_word, w.end, -1)
    chars = _per_text(LEADS[buf] & (np.cumsum(in_word[:-1]) > 0), offs)
    at, doc, h = windows_of(w, 3)
    twice, later = _repeats(doc, h)
    covered = np.zeros(len(w.hash) + 3, np.int32)
    for j in range(3):
        covered[at[twice] + j] = 1
    repeated = np.add.reduceat(np.append(covered, 0), np.minimum(w.first[:-1], len(covered))) if n else np.zeros(0)
    repeated = np.where(count > 0, repeated, 0)
    # Lines: spans between line feeds and the edges of texts, if they hold a word.
    feed = np.flatnonzero(buf == 10)
    begin = np.sort(np.concatenate([offs[:-1], feed + 1]))
    owner = np.searchsorted(offs, begin, "right") - 1
    # A feed that ends a text begins an empty line of its own, which has no word.
    begin_ok = (begin < offs[np.minimum(owner + 1, n)]) if n else np.zeros(0, bool)
    begin, owner = begin[begin_ok], owner[begin_ok]
    begin, first = np.unique(begin, return_index=True)
    owner = owner[first]
    stop = np.minimum(offs[owner + 1], np.append(feed, len(buf))[np.searchsorted(feed, begin)]) if len(begin) else begin
    has_word = np.searchsorted(w.start, stop) > np.searchsorted(w.start, begin)
    begin, stop, owner = begin[has_word], stop[has_word], owner[has_word]
    _, later = _repeats(owner, span_hash(w.sums, begin, stop))
    lines = np.bincount(owner, minlength=n)
    dup = np.bincount(owner[later], minlength=n)
    _, later = _repeats(w.doc, w.hash)
    again = np.bincount(w.doc[later], minlength=n)
    one = np.maximum(count, 1)
    symbols = _per_text(_SYMBOL[buf], offs)
    size = np.maximum(chars, 1)
    share = [_per_text(t[buf], offs) / size for t in (_UPPER, _DIGIT, _MARK)]
    cols = [count, chars, symbols, dup, repeated, symbols / one, dup / np.maximum(lines, 1), repeated / one, chars / one, *share, count / np.maximum(lines, 1), 1 - again / one]
    return np.column_stack([np.asarray(c, np.float64) for c in cols])


@dataclass
class Trees:
    """All trees in one set of node arrays; a leaf points to itself."""

    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds for the rows of ``x``."""
        at = np.tile(self.roots, (len(x), 1))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            go_left = x[rows, self.feature[at]] <= self.cut[at]
            at = np.where(go_left, self.left[at], self.right[at])
        return self.bias + self.value[at].sum(1)


def fit_trees(x: np.ndarray, y: np.ndarray, falling: list[int], *, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 64, l2: float = 1.0, least: float = 2.0) -> Trees:
    """Boosting on the logistic loss over binned features. A split on a falling
    feature must not give its right side the larger value, and both sides stay
    within bounds inherited from above, so the whole model is monotone."""
    if not 0 < y.sum() < len(y):
        trees, x = 0, np.zeros((1, x.shape[1]))
        y = y[:1] if len(y) else np.zeros(1)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    code = np.column_stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)])
    p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    bias = float(np.log(p / (1 - p)))
    score = np.full(len(y), bias)
    feature, cut, left, right, value, roots = [], [], [], [], [], []

    def node(lo: float, hi: float, g: float, h: float) -> int:
        k = len(feature)
        feature.append(0)
        cut.append(np.inf)
        left.append(k)
        right.append(k)
        value.append(rate * float(np.clip(-g / (h + l2), lo, hi)))
        return k

    for _ in range(trees):
        prob = 1 / (1 + np.exp(-score))
        grad, hess = prob - y, prob * (1 - prob)
        root = node(-np.inf, np.inf, grad.sum(), hess.sum())
        roots.append(root)
        level = [(root, np.arange(len(y)), -np.inf, np.inf)]
        for _ in range(depth):
            below = []
            for k, rows, lo, hi in level:
                g, h = grad[rows], hess[rows]
                best = (1e-6, None)
                for f, c in enumerate(cuts):
                    if not len(c):
                        continue
                    gl = np.cumsum(np.bincount(code[rows, f], g, len(c) + 1))[:-1]
                    hl = np.cumsum(np.bincount(code[rows, f], h, len(c) + 1))[:-1]
                    gr, hr = g.sum() - gl, h.sum() - hl
                    vl, vr = np.clip(-gl / (hl + l2), lo, hi), np.clip(-gr / (hr + l2), lo, hi)
                    gain = -(gl * vl + (hl + l2) * vl * vl / 2 + gr * vr + (hr + l2) * vr * vr / 2)
                    v0 = np.clip(-g.sum() / (h.sum() + l2), lo, hi)
                    gain += g.sum() * v0 + (h.sum() + l2) * v0 * v0 / 2
                    gain[(hl < least) | (hr < least)] = -1
                    if f in falling:
                        gain[vr > vl] = -1
                    j = int(np.argmax(gain))
                    if gain[j] > best[0]:
                        best = (gain[j], (f, j, vl[j], vr[j], gl[j], hl[j], gr[j], hr[j]))
                if best[1] is None:
                    continue
                f, j, vl, vr, gl, hl, gr, hr = best[1]
                mid = (vl + vr) / 2
                lo_l, hi_l, lo_r, hi_r = (mid, hi, lo, mid) if f in falling else (lo, hi, lo, hi)
                feature[k], cut[k] = f, float(cuts[f][j])
                left[k], right[k] = node(lo_l, hi_l, gl, hl), node(lo_r, hi_r, gr, hr)
                go = code[rows, f] <= j
                below += [(left[k], rows[go], lo_l, hi_l), (right[k], rows[~go], lo_r, hi_r)]
            level = below
        arrays = Trees(np.array([root]), np.array(feature), np.array(cut), np.array(left), np.array(right), np.array(value), depth, 0.0)
        score += arrays.score(x)
    return Trees(np.array(roots, np.int64), np.array(feature, np.int64), np.array(cut), np.array(left, np.int64), np.array(right, np.int64), np.array(value), depth, bias)


def label_sample(docs: DataFrame, labels: DataFrame, max_labels: int) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of at most ``max_labels`` labelled documents, the
    first by hash of the id. Bounded, hence broadcast and collected."""
    ship_code(docs.sparkSession)
    chosen = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.max("quality").alias("y"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # Of different texts under one id, that of the least statistics.
    found = _counted(rows, ["doc_id", "y"]).groupBy("doc_id", "y").agg(F.min("stats").alias("stats")).orderBy("doc_id").collect()
    return np.array([r["stats"] for r in found], np.float64).reshape(-1, len(FEATURES)), np.array([r["y"] for r in found], np.float64)


def _counted(rows: DataFrame, keep: list[str]) -> DataFrame:
    names = [f.name for f in rows.schema.fields if f.name in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, buf, offs in text_slices(b, "text"):
                x = statistics(buf, offs)
                out = [b.column(b.schema.get_field_index(c)).slice(lo, hi - lo) for c in names]
                stats = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([*out, stats], [*names, "stats"])

    return rows.select(*names, "text").mapInArrow(run, schema_of(rows.select(*names), "stats array<double>"))


@dataclass
class QualityRules:
    """Fitted rules. A document is kept if it passes the base rules and its
    log-odds reach ``least``."""

    trees: Trees
    least: float

    @classmethod
    def fit(cls, docs: DataFrame, labels: DataFrame, *, max_labels: int = 20_000, lost: float = 0.002) -> QualityRules:
        """``lost``: share of the good labelled documents that the limit may
        reject at most; the limit never exceeds even odds."""
        x, y = label_sample(docs, labels, max_labels)
        falling = [FEATURES.index(f) for f in FALLING]
        trees = fit_trees(x, y, falling)
        good = np.sort(trees.score(x[y == 1])) if len(trees.roots) else np.zeros(0)
        least = min(0.0, float(good[int(len(good) * lost)]) - 1e-9) if len(good) else -np.inf
        return cls(trees, least)

    def judge(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Base rules failed, log-odds, kept."""
        words, repeat = x[:, 0], x[:, FEATURES.index("n_repeat_words")]
        failed = (words < 50) | (100 * repeat > 50 * words)
        score = self.trees.score(x) if len(self.trees.roots) else np.zeros(len(x))
        return failed, score, ~failed & (score >= self.least)


def assess(docs: DataFrame, rules: QualityRules, keep: list[str], out: str = "quality") -> DataFrame:
    """Columns ``keep`` of ``docs`` and the struct ``out``: the counts,
    base_failed, log_odds, kept."""
    ship_code(docs.sparkSession)
    (text,) = free_name(docs.select(*keep), "_text")
    rows = docs.select(*keep, F.col("text").alias(text))
    kind = pa.struct([*[pa.field(c, pa.int64()) for c in COUNTS], pa.field("base_failed", pa.bool_()), pa.field("log_odds", pa.float64()), pa.field("kept", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, buf, offs in text_slices(b, text):
                x = statistics(buf, offs)
                failed, score, kept = rules.judge(x)
                cols = [pa.array(x[:, i].astype(np.int64)) for i in range(len(COUNTS))] + [pa.array(failed), pa.array(score), pa.array(kept)]
                found = pa.StructArray.from_arrays(cols, fields=list(kind))
                own = [b.column(i).slice(lo, hi - lo) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*own, found], [*keep, out])

    counts = ",".join(f"{c}:bigint" for c in COUNTS)
    return rows.mapInArrow(run, schema_of(docs.select(*keep), f"{out} struct<{counts},base_failed:boolean,log_odds:double,kept:boolean>"))


def keep_good(docs: DataFrame, rules: QualityRules) -> DataFrame:
    """``docs`` without the rejected documents, all columns kept."""
    (out,) = free_name(docs, "_quality")
    return assess(docs, rules, docs.columns, out).where(F.col(f"{out}.kept")).select(*docs.columns)
