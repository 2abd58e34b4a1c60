"""Conversation repair, collocations and best-fit packing against plain versions."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from rxlake.llm import bestfit, phrases, repair
from rxlake.llm.queries import ORACLE, QUERIES, byte_bpe

SMALL = "/root/testdata/sf0.001"


def same_as_sql(spark, name, tables, folder=SMALL):
    ours = QUERIES[name](spark, folder)
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    theirs = con.execute(ORACLE[name]).fetchall()
    names = [c[0] for c in con.description]
    assert sorted(names) == sorted(ours.columns)
    assert Counter(map(tuple, theirs)) == Counter(tuple(r) for r in ours.select(*names).collect())


# --- conversation repair ------------------------------------------------------------


def brute_align(codes):
    """All edits of all targets up to twice the length, by plain search."""
    n = len(codes)
    targets = [""] + ["ua" * k for k in range(1, n + 3)] + ["s" + "ua" * k for k in range(1, n + 3)]
    best = None
    for t in targets:
        seen = {}

        def go(i, j, t=t, seen=seen):
            if (i, j) in seen:
                return seen[i, j]
            found = [(0, "")] if i == n and j == len(t) else []
            if i < n:
                x, f = codes[i] >> 2, codes[i] & 3
                c, a = go(i + 1, j)
                found.append((c + 2, "D" + a))
                if j < len(t) and f not in (repair.BLANK, repair.DUPLICATE):
                    kept = "sua_"[x] == t[j]
                    if kept or t[j] != "s":
                        c, a = go(i + 1, j + 1)
                        found.append((c + (not kept) + 5 * (f == repair.TRUNCATED), ("K" if kept else "R") + a))
            if j < len(t) and t[j] != "s":
                c, a = go(i, j + 1)
                found.append((c + 5, "I" + a))
            seen[i, j] = min(found, default=(10**9, ""))
            return seen[i, j]

        best = min(x for x in (best, go(0, 0)) if x is not None)
    return best


def test_alignment_is_least_and_ascii_least():
    r = random.Random(5)
    for _ in range(400):
        codes = bytes(r.choice([0, 1, 1, 2, 2, 3]) * 4 + r.choice([0, 0, 0, 1, 2, 3]) for _ in range(r.randint(0, 9)))
        expected = brute_align(codes)
        assert repair.align(codes) == expected, codes
        assert repair.align_folded(codes) == expected, codes
    for n in (150, 400):
        codes = bytes(r.choice([0, 1, 2, 1, 2, 3]) * 4 + r.choice([0, 0, 1, 3]) for _ in range(n))
        assert repair.align(codes) == repair.align_folded(codes) == repair.align(codes, cells=1)


TURNS = "text string, conv_id bigint, turn bigint, role string, lost int, fault string, _h int"


def odd_conversations():
    rows = []
    for c in (1, 2, 3, None):
        for t in (0, 1, 1, 2, 5, None):
            rows.append((f"Text {t} of it.", c, t, ("system", "user", "assistant", None, "", "Tool")[(t or 0) % 6]))
    rows += [(None, 4, 0, "user"), ("", 4, 1, "assistant"), ("x" * 100_000, 4, 2, "user"), ("a\nb?\n \t", 5, 0, "user"), ("ü…", 5, 1, "assistant"), ("ok!", 6, 3, "user"), ("ok!", 6, 3, "user"), ("ok!", 6, 4, "user")]
    return [(*r, 1, "f", 2) for r in rows]


def plain_repair(rows):
    found = {}
    for text, conv, turn, role, *_ in rows:
        mine = found.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        if h:
            mine += [(turn is not None, turn or 0, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    for conv, mine in found.items():
        mine.sort()
        seen, codes, kinds = set(), [], Counter()
        for _, _, role, text in mine:
            words = re.findall("[^\x20\x09-\x0d]", text)
            f = 1 if not words else 2 if (role, text) in seen else 3 if words[-1] not in ".!?" else 0
            seen.add((role, text))
            kinds[f] += 1
            x = "sua".find(role[0]) if role else 3
            codes.append((3 if x < 0 else x) * 4 + f)
        cost, audit = brute_align(bytes(codes))
        turns = [t for there, t, _, _ in mine if there]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(mine))
        kept, rest, odd = [], iter(mine), (len(audit) - audit.count("D")) % 2
        for e in audit:
            _, _, role, text = next(rest) if e != "I" else (0, 0, "", "")
            if e != "D":
                kept.append(f"{role if e == 'K' else ('user', 'assistant')[(len(kept) - odd) % 2]}:{text}")
        found[conv] = (gaps, kinds[1], kinds[2], kinds[3], illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest(), kept)
    return found


def test_repair_of_odd_conversations(spark):
    rows = odd_conversations()
    turns = repair.damaged(spark.createDataFrame(rows, TURNS).repartition(3))
    expected = plain_repair(rows)
    got = {r["conv_id"]: tuple(r)[1:] for r in repair.audits(turns).collect()}
    assert got == {c: v[:8] for c, v in expected.items()}
    lines = {}
    for r in repair.repaired(turns).orderBy("conv_id", "place").collect():
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    assert lines == {c: v[8] for c, v in expected.items() if v[8]}
    none = repair.audits(repair.damaged(spark.createDataFrame([], TURNS)))
    assert none.count() == 0


def test_long_conversation_goes_to_a_scratch_file(spark, monkeypatch):
    c = repair.Conversation(1)
    c.texts = repair.tempfile.SpooledTemporaryFile(max_size=100)
    for i in range(50):
        c.add(i, ("user", "assistant")[i % 2], f"turn {i}.", 0)
    assert c.texts._rolled
    assert [t for _, _, t in c.repaired("K" * 50)] == [f"turn {i}.".encode() for i in range(50)]


def test_repair_query_equals_sql(spark):
    same_as_sql(spark, "op12_repair", ["conversations"])


# --- collocations -------------------------------------------------------------------


def plain_collocations(rows, least, top, order=5):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, order + 1):
                f.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    many = {p: a for p, a in f.items() if a >= least and len(p) > 2}
    out = {}
    for (lang, *p), a in many.items():
        inside = any(lang == x[0] and len(x) - 1 > len(p) and b >= a and any(list(x[i : i + len(p)]) == p for i in range(1, len(x))) for x, b in many.items())
        if inside:
            continue
        cuts = [(1000 * a * n[lang] // (f[(lang, *p[:k])] * f[(lang, *p[k:])]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), a, f[(lang, *p[:k])], f[(lang, *p[k:])], n[lang], score))
    return {(lang, i + 1): (x[2].decode(), *x[3:]) for lang, them in out.items() for i, x in enumerate(sorted(them)[:top])}


WORDY = "lang string, w1 string, text string, f int, p string"


def wordy():
    r = random.Random(3)
    rows = [(None, None), (None, ""), ("en", " \t,;"), ("de", None)]
    words = "the a of to Straße x été y Z q".split()
    for lang in ("en", "de", None, ""):
        for _ in range(30):
            text = "".join(r.choice(words[: 3 + len(lang or "xxx")]) + r.choice([" ", " ", "\t ", ", ", ".", "\n", " "]) for _ in range(r.randint(1, 120)))
            rows.append((lang, text + " A Bee Cee Dee Eff gee"))
    rows += [("en", "new york city " * 4000)]
    return [(lang, "w", t, 3, "p") for lang, t in rows + rows[:9]]


def test_collocations_equal_plain_counts(spark):
    docs = spark.createDataFrame(wordy(), WORDY).repartition(3)
    texts = [(t, lang) for lang, _, t, _, _ in wordy()]
    for least, top in ((5, 40), (30, 2000)):
        got = {(r["lang"], r["rank"]): tuple(r)[2:] for r in phrases.collocations(docs, least=least, top=top).collect()}
        assert got == plain_collocations(texts, least, top)
    assert phrases.collocations(spark.createDataFrame([], WORDY)).count() == 0


def test_collocations_do_not_depend_on_the_bitmaps(spark, monkeypatch):
    docs = spark.createDataFrame(wordy(), WORDY)
    before = Counter(map(tuple, phrases.collocations(docs, least=5).collect()))
    monkeypatch.setattr(phrases, "bitmap", lambda ids: np.full(4096, 255, np.uint8))
    assert Counter(map(tuple, phrases.collocations(docs, least=5).collect())) == before


def test_collocations_renumber_words_that_clash(spark, monkeypatch):
    docs = spark.createDataFrame(wordy(), WORDY)
    before = Counter(map(tuple, phrases.collocations(docs, least=5).collect()))
    real, seeds = phrases.vocabulary, []

    def clashing(texts, seed):
        seeds.append(seed)
        found = real(texts, seed)
        return found.withColumn("clash", F.lit(True)) if seed == 0 else found

    monkeypatch.setattr(phrases, "vocabulary", clashing)
    assert Counter(map(tuple, phrases.collocations(docs, least=5).collect())) == before
    assert seeds == [0, 1]


def test_words_with_one_number_are_found(spark, monkeypatch):
    monkeypatch.setattr(phrases, "mix", lambda h: h * np.uint64(0) + (h % np.uint64(3)))
    table = spark.createDataFrame([("a b c d e f g h", "en")], "text string, lang string")
    rows = phrases.vocabulary(table, 0).where("lang IS NULL").collect()
    assert len(rows) <= 3 and any(r["clash"] for r in rows) and sum(r["f"] for r in rows) == 8


def test_collocations_query_equals_sql(spark):
    same_as_sql(spark, "op13_collocations", ["documents"], "/root/testdata/sf0.01")


# --- best-fit packing ---------------------------------------------------------------


def least_bins(sizes, full):
    """By trying everything."""
    best = len(sizes)

    def go(rest, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if not rest:
            best = len(rooms)
            return
        s, *more = rest
        for room in sorted(set(rooms)):
            if room >= s:
                left = list(rooms)
                left[left.index(room)] -= s
                go(more, left)
        go(more, [*rooms, full - s])

    go(sorted(sizes, reverse=True), [])
    return best


def test_bounds_hold_and_bins_are_sound():
    r = random.Random(1)
    tight = 0
    for _ in range(300):
        full = r.choice([10, 17, 24])
        sizes = np.array(sorted((r.randint(1, full) for _ in range(r.randint(1, 9))), reverse=True))
        value, under = bestfit.lower_bound(np.bincount(sizes, minlength=full + 1))
        best = least_bins(sizes.tolist(), full)
        bound = -(-value // under)
        assert Fraction(int(sizes.sum()), full) <= Fraction(value, under) and bound <= best
        tight += bound == best
        bins, at = bestfit.best_fit_decreasing(sizes, full)
        used = Counter()
        for b, a, s in zip(bins.tolist(), at.tolist(), sizes.tolist(), strict=True):
            assert a == used[b]
            used[b] += s
        assert max(used.values()) <= full and best <= len(used) <= best + 1
        assert sorted(used) == list(range(len(used)))
    assert tight > 280


def test_partitions_with_gaps_exchange(spark):
    # Each small partition wastes part of its last bin; together they fill it.
    items = spark.range(3000).selectExpr("id % 7 AS pid", "id AS before", "CAST(pmod(xxhash64(id), 300) + 1 AS BIGINT) AS size")
    placed, certificate = bestfit.place_items(items, 1024, dealt=30)
    alone = bestfit.pack_round(items, 0, 100, 1024).where("opens").count()
    assert certificate.exchanges >= 1 and certificate.bound <= certificate.sequences < alone
    assert certificate.sequences <= 1.01 * certificate.bound
    rows = placed.join(items, ["pid", "before"]).collect()
    assert len(rows) == 3000 and len({r["sequence_id"] for r in rows}) == certificate.sequences
    used = Counter()
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == used[r["sequence_id"]]
        used[r["sequence_id"]] += r["size"]
    assert max(used.values()) <= 1024


@pytest.mark.parametrize("with_ids", [True, False])
def test_bestfit_packs_every_id_once(spark, documents, no_documents, with_ids):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(byte_bpe())
    docs = documents.withColumn("row", F.monotonically_increasing_id()).cache()
    known = {r["row"]: r["text"] for r in docs.collect()}
    pieces, certificate = bestfit.pack(docs, byte_bpe(), [c for c in docs.columns if c not in ("text", "start")], with_ids=with_ids, dealt=5)
    rows = pieces.collect()
    by_row, by_sequence = {}, {}
    for r in rows:
        by_row.setdefault(r["row"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_row) == set(known)
    for row, them in by_row.items():
        ids = np.array([*t.encode(known[row] or "", add_special_tokens=False).ids, 2], "<u4")
        them.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in them] == list(range(len(them)))
        at = 0
        for i, r in enumerate(them):
            part = ids[at : at + r["length"]].tobytes()
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(part)
            assert r["length"] == 1024 or (i == 0 and r["length"] < 1024)
            assert not with_ids or r["ids"] == part
            at += r["length"]
        assert at == len(ids)
    short = 0
    for them in by_sequence.values():
        at = 0
        for r in sorted(them, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
        short += them[0]["length"] < 1024
    assert short == certificate.sequences >= certificate.bound
    assert bestfit.pack(no_documents, byte_bpe(), ["doc_id"])[0].count() == 0


# --- other queries against their SQL --------------------------------------------------


@pytest.mark.parametrize(("name", "tables"), [("op1_mixing", ["documents"]), ("op2_topk", ["embeddings"]), ("op6_secret_scan", ["documents"])])
def test_query_equals_sql(spark, name, tables):
    same_as_sql(spark, name, tables)
