"""Mixing, packing, token counts, secret scans, quality rules and scoring
against plain versions, on a table with all the odd cases."""

import hashlib
import math
import re
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from rxlake.llm import gru, mixing, packing, quality, rnn_lm, secret_scan, token_counts
from rxlake.llm.queries import byte_bpe


def test_mix_targets_and_copies(documents, no_documents):
    rows = mixing.plan_mix(documents).collect()
    assert len(rows) == documents.count()
    size, target = Counter(), {}
    for r in rows:
        assert r["mix"]["size"] == len(brute.words(r["text"]))
        assert 0 <= r["mix"]["copies"] <= 2
        size[r["source"]] += r["mix"]["size"]
        target[r["source"]] = r["mix"]["target"]
        rate = r["mix"]["target"] / r["mix"]["source_size"]
        assert math.floor(rate) <= r["mix"]["copies"] <= math.ceil(rate)
    assert all(r["mix"]["source_size"] == size[r["source"]] for r in rows)
    # Water filling by repeated capping.
    order = sorted(size, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    full, pool = set(), 1.5 * sum(size.values())
    while True:
        rest = [s for s in order if s not in full]
        level = (pool - sum(2 * size[s] for s in full)) / max(sum(weight[s] for s in rest), 1)
        over = {s for s in rest if weight[s] * level >= 2 * size[s]}
        if not over:
            break
        full |= over
    for s in order:
        assert target[s] == pytest.approx(2 * size[s] if s in full else weight[s] * level)
    assert Counter(map(str, rows)) == Counter(map(str, mixing.plan_mix(documents).collect()))
    taken = mixing.mix(documents)
    assert taken.columns == documents.columns and taken.count() == sum(r["mix"]["copies"] for r in rows)
    assert mixing.mix(no_documents).count() == 0 and mixing.plan_mix(no_documents).count() == 0


def test_mix_draws_a_row_once(documents):
    plan = mixing.mix(documents)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("conv(substring(md5(") == 1


def test_rows_of_one_id_draw_each(spark):
    rows = [(i, f"ten words {i} a b c d e f g", "a") for i in range(300)]
    rows += [(None, f"ten words {i} a b c d e f g", "b") for i in range(300)]  # a null id
    rows += [(7, "ten words one two three four five six seven eight", "c")] * 300  # one row again and again
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4)
    found = mixing.plan_mix(docs).collect()
    assert len(found) == 900
    for source, copies in (("a", {2}), ("b", {0, 1}), ("c", {1, 2})):
        mine = [r["mix"] for r in found if r["source"] == source]
        assert {m["copies"] for m in mine} == copies
        assert abs(sum(m["size"] * m["copies"] for m in mine) - mine[0]["target"]) < 0.1 * mine[0]["target"]
    again = mixing.plan_mix(docs.repartition(7)).collect()
    assert Counter(map(str, found)) == Counter(map(str, again))


def test_a_copy_of_a_text_is_one_place(spark):
    key = {k: f"a9B8c7D6e5F4g3H2i1J{k}" + "x" * 4 for k in "01234"}
    rows = [(1, f"one text {key['0']}", "a", "en"), (2, f"one text {key['0']}", "b", "en")]  # one text, two owners
    rows += [(3, f"text {key['1']}", "a", "en"), (4, f"another {key['1']}", "b", "en")]  # two texts, two owners
    rows += [(5 + i, f"text {i} {key['2']}", "a", "en") for i in range(3)]  # one owner, one repository
    rows += [(10 + i, f"text {i} {key['3']}", "a", lang) for i, lang in enumerate(("en", "de", "fr", "es"))]  # four repositories
    rows += [(20 + i, f"same text {key['4']}", "a", lang) for i, lang in enumerate(("en", "de", "fr", "es", None))]  # copies of one text
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    live = {r["doc_id"]: r["secrets"]["n_live"] for r in secret_scan.findings(docs, ["doc_id"]).collect()}
    assert live == {1: 1, 2: 1, 3: 0, 4: 0, 5: 1, 6: 1, 7: 1, 10: 0, 11: 0, 12: 0, 13: 0, **{20 + i: 1 for i in range(5)}}


def test_packing_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "some text", 5, 6, 7, 8)], "doc_id bigint, text string, total int, before_total int, _lo int, _total int")
    row = packing.pack(docs, byte_bpe(), docs.columns).first()
    assert (row["total"], row["before_total"], row["_lo"], row["_total"], row["text"]) == (5, 6, 7, 8, "some text")


def _ids(rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(byte_bpe())
    t.encode_special_tokens = True
    return {r: t.encode(r or "", add_special_tokens=False) for r in set(rows)}


def test_packing_cuts_every_id_once(documents, no_documents):
    docs = documents.withColumn("row", F.monotonically_increasing_id()).cache()
    known = {r["row"]: r["text"] for r in docs.collect()}
    ids = _ids(known.values())
    pieces = packing.pack(docs, byte_bpe(), ["row", "doc_id", "size"], length=256)
    rows = sorted(pieces.collect(), key=lambda r: (r["row"], r["start"]))
    got = {}
    for r in rows:
        whole = got.setdefault(r["row"], [])
        assert r["start"] == len(whole) and r["size"] == 7
        own = np.frombuffer(r["ids"], "<u4")
        assert len(own) == r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"]
        whole += own.tolist()
        assert r["doc_tokens"] == len(ids[known[r["row"]]].ids) + 1
    assert got == {k: ids[t].ids + [1] for k, t in known.items()}
    seqs = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == seqs.get(r["sequence_id"], 0)
        seqs[r["sequence_id"]] = r["offset"] + r["length"]
    assert sorted(seqs) == list(range(len(seqs)))
    assert all(n == 256 for s, n in seqs.items() if s + 1 < len(seqs))
    whole = packing.assemble(pieces).collect()
    assert {r["sequence_id"]: r["tokens"] for r in whole} == seqs
    assert all(len(r["ids"]) == 4 * r["tokens"] for r in whole)
    assert packing.pack(no_documents, byte_bpe(), ["doc_id"]).count() == 0


def test_token_counts_by_line(documents, no_documents):
    docs = documents.withColumn("row", F.monotonically_increasing_id()).cache()
    known = {r["row"]: r["text"] or "" for r in docs.collect()}
    ids = _ids(known.values())
    for rule in ("most", "first"):
        rows = sorted(token_counts.count_by_section(docs, byte_bpe(), ["row", "start"], rule=rule).collect(), key=lambda r: (r["row"], r["section"]))
        by_row = {}
        for r in rows:
            by_row.setdefault(r["row"], []).append(r)
        for k, text in known.items():
            lines = re.findall(r"[^\n]*\n|[^\n]+\Z", text) or [""]
            own = by_row[k]
            assert [text[r["section_start"] : r["section_end"]] for r in own] == lines
            n = [0] * len(lines)
            for a, z in ids[text].offsets:
                part = [min(z, r["section_end"]) - max(a, r["section_start"]) for r in own]
                n[int(np.argmax(part)) if rule == "most" else next(i for i, p in enumerate(part) if p > 0)] += 1
            assert [r["n_tokens"] for r in own] == n
            assert {r["doc_tokens"] for r in own} == {len(ids[text].ids)}
    assert token_counts.count_by_section(no_documents, byte_bpe(), ["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        token_counts.count_by_section(documents, byte_bpe(), ["doc_id"], rule="last")


def test_secrets_and_redaction(documents, no_documents):
    found = secret_scan.findings(documents, documents.columns, out="f")
    rows = found.withColumn("base", secret_scan.as_text(F.col("f.base"))).withColumn("spans", secret_scan.as_text(F.col("f.spans"))).collect()
    assert len(rows) == documents.count()
    for r in rows:
        base = brute.secrets(r["text"])
        assert r["base"] == ",".join(base)
        assert (r["f"]["n_assign"], r["f"]["n_access"], r["f"]["n_hex"]) == tuple(sum(b.startswith(k) for b in base) for k in ("assign", "access", "hex"))
        assert set(base) <= set(r["spans"].split(",")) | {""}
    spans = {r["doc_id"]: r["spans"] for r in rows}
    # A long mixed token that one owner holds is added; one that two hold is not.
    assert "mixed" in spans[18] and "AKIA" not in spans[18]
    assert "access" in spans[17] and spans[17].count("mixed") == 1
    clean = {r["doc_id"]: r for r in secret_scan.redact(documents).collect()}
    assert clean[18]["text"] == "own key [SECRET] here; password=token:abcdef12"
    assert clean[1]["text"] is None and clean[2]["text"] == ""
    assert clean[16]["n_chars"] == len(clean[16]["text"])
    assert "24be6443" not in clean[16]["text"] and "hunter2x" not in clean[16]["text"]
    assert secret_scan.redact(documents).columns == documents.columns
    assert secret_scan.redact(no_documents).count() == 0
    assert hashlib.sha256(b"").hexdigest() == no_documents.sparkSession.range(1).select(F.sha2(F.lit(""), 256)).first()[0]


def test_secret_plan_has_no_python(documents):
    plan = secret_scan.findings(documents, ["doc_id"])._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_quality_statistics_and_verdict(spark, documents, no_documents):
    labels = spark.createDataFrame([(6, 1), (12, 1), (13, 0), (14, 0), (99, 1), (None, 1), (10, None)], "doc_id bigint, quality int")
    rules = quality.QualityRules.fit(documents, labels)
    rows = quality.assess(documents, rules, ["doc_id", "text", "q"], "found").collect()
    assert len(rows) == documents.count()
    for r in rows:
        want = brute.statistics(r["text"])
        got = r["found"]
        assert tuple(got[c] for c in quality.COUNTS) == want
        assert got["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (got["base_failed"] and got["kept"])
    kept = quality.keep_good(documents, rules)
    assert kept.columns == documents.columns
    assert kept.count() == sum(r["found"]["kept"] for r in rows)
    none = quality.QualityRules.fit(documents, labels.limit(0))
    assert all(r["found"]["kept"] != r["found"]["base_failed"] for r in quality.assess(documents, none, ["doc_id"], "found").collect())
    assert quality.assess(no_documents, rules, ["doc_id"]).count() == 0


def test_trees_are_monotone_and_fit():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 3))
    y = ((x[:, 0] - x[:, 1] + 0.3 * rng.normal(size=3000)) > 0).astype(float)
    trees = quality.fit_trees(x, y, falling=[1])
    assert ((trees.score(x) > 0) == y).mean() > 0.93
    probe = np.tile(x[:200, None, :], (1, 50, 1))
    probe[:, :, 1] = np.linspace(-3, 3, 50)
    s = trees.score(probe.reshape(-1, 3)).reshape(200, 50)
    assert (np.diff(s, axis=1) <= 1e-12).all()


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    learn = labels.where("doc_id % 3 <> 0")
    rules = quality.QualityRules.fit(docs, learn)
    test = quality.assess(docs, rules, ["doc_id"], "f").join(labels.where("doc_id % 3 = 0"), "doc_id")
    rows = test.where("NOT f.base_failed").select("quality", "f.kept").collect()
    assert np.mean([bool(r["quality"]) == r["kept"] for r in rows]) > 0.97


def test_scores_and_counts(documents, no_documents):
    docs = documents.withColumn("row", F.lit(1))
    rows = rnn_lm.score(docs).collect()
    texts = [(r["doc_id"], r["text"]) for r in documents.collect()]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    count = Counter()
    for i, t in texts:
        if not held(i):
            count.update([*brute.words(t, fold=True), "\0"])
    n, v = sum(count.values()), len(count)
    want = Counter()
    for i, t in texts:
        w = [*brute.words(t, fold=True), "\0"]
        base = sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        want[i, held(i), len(w), sum(count[x] > 0 for x in w), n, round(base, 6)] += 1
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows) == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in rows)
    assert rnn_lm.score(no_documents).count() == 0


def test_model_learns_and_carries_state():
    rng = np.random.default_rng(1)
    # Two kinds of text over the same alphabet: the state must tell them apart.
    texts = [rng.integers(0, 20, 90).astype(np.int32) + 20 * (i % 2) for i in range(400)]
    counts = np.bincount(np.concatenate(texts), minlength=40)
    p = gru.start(counts, 0)
    first = gru.score(p, texts[:40]).sum()
    assert first == pytest.approx(sum(np.log(counts[t] / counts.sum()).sum() for t in texts[:40]), rel=1e-3)
    for _ in range(3):
        gru.train(p, texts[40:])
    assert gru.score(p, texts[:40]).sum() > 0.9 * first
    alone = np.array([gru.score(p, [t])[0] for t in texts[:10]])
    assert np.allclose(alone, gru.score(p, texts[:40])[:10], rtol=1e-4)
    assert np.array_equal(gru.flatten(gru.unflatten(gru.flatten(p))), gru.flatten(p))
    lp, _ = gru.predict(p, np.repeat(rng.normal(size=(1, gru.HIDDEN)).astype(np.float32), gru.VOCAB + 1, 0), np.arange(gru.VOCAB + 1))
    assert np.exp(lp).sum() == pytest.approx(1, abs=1e-3)


def test_held_out_likelihood_beats_counts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    total = rnn_lm.score(docs).where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert total["s"] > total["b"]


def test_every_training_token_is_learnt_from(spark, documents, no_documents):
    def learnt(docs):
        counts = rnn_lm.Counts.of(rnn_lm.token_counts(docs))
        return rnn_lm.train(docs, counts)[1], counts.tokens

    docs = documents.where(~rnn_lm.held_out(F.col("doc_id")))
    seen, tokens = learnt(docs)
    assert seen == tokens > 0
    # One id, or none, on all rows; few documents.
    one = spark.createDataFrame([(i, f"word{k} of this text") for k in range(40) for i in (None, 7)], "doc_id bigint, text string")
    for part in (one, one.where("doc_id IS NULL"), one.limit(1)):
        seen, tokens = learnt(part)
        assert seen == tokens > 0
    assert all(0 < r.where("doc_id IS NULL").count() < 40 for r in rnn_lm.rounds(one))
    assert learnt(no_documents) == (0, 0)


def test_added_tokens_in_texts(spark):
    from tokenizers import Tokenizer

    end = "<|endoftext|>"
    texts = [end, end * 2, f"a {end} b", f"quoted{end}  two\n{end} \n x {end}é\n", f"{end} lead", f"tail \n{end}", "<|endof", f"text|> {end}", "<|endoftext |> <|ENDOFTEXT|>", "", f"one  {end}  two " * 50, None, f"<{end}> <|{end}|>"]
    rows = spark.createDataFrame(list(enumerate(texts)), "row int, text string").coalesce(1)
    library = Tokenizer.from_file(byte_bpe())
    ids = {i: library.encode(t or "", add_special_tokens=False) for i, t in enumerate(texts)}
    assert 50256 in ids[0].ids
    got = {}
    for r in sorted(packing.pack(rows, byte_bpe(), ["row"], length=16).collect(), key=lambda r: (r["row"], r["start"])):
        got.setdefault(r["row"], []).extend(np.frombuffer(r["ids"], "<u4").tolist())
    assert got == {i: e.ids + [1] for i, e in ids.items()}
    counted = Counter()
    for r in token_counts.count_by_section(rows, byte_bpe(), ["row"], rule="first").collect():
        counted[r["row"], r["section_start"]] += r["n_tokens"]
    for i, t in enumerate(texts):
        begins = [0, *[m.end() for m in re.finditer("\n", t or "") if m.end() < len(t)]]
        assert [counted[i, b] for b in begins] == [sum(b <= a < z for a, _ in ids[i].offsets) for b, z in zip(begins, [*begins[1:], len(t or "")], strict=True)]


# --- the recurrent model, plainly ------------------------------------------------------


def small_model(seed=3):
    r = np.random.default_rng(seed)
    p = gru.start(np.arange(gru.VOCAB, 0, -1).astype(float), 50, seed=seed)
    return {k: (v + r.normal(size=v.shape) * 0.2).astype(np.float32) for k, v in p.items()}


def plain_likelihood(p, tokens):
    """Step by step, in double precision, over the whole text."""
    q = {k: v.astype(np.float64) for k, v in p.items()}
    sig = lambda a: 1 / (1 + np.exp(-a))
    soft = lambda a: a - a.max() - np.log(np.exp(a - a.max()).sum())
    n, h, last, total = gru.HIDDEN, np.zeros(gru.HIDDEN), gru.BEGIN, 0.0
    for t in tokens:
        a, g = q["emb"][last] @ q["wx"] + q["b"], h @ q["u"]
        z, r = sig(a[:n] + g[:n]), sig(a[n : 2 * n] + g[n : 2 * n])
        new = np.tanh(a[2 * n :] + r * g[2 * n :])
        h = (1 - z) * new + z * h
        c = min(t // gru.BLOCK, gru.CLASSES)
        total += soft(h @ q["wc"] + q["bc"])[c]
        if c < gru.CLASSES:
            total += soft(h @ q["wo"][c] + q["bo"][c])[t - c * gru.BLOCK]
        last = t
    return total


def test_whole_texts_are_scored_as_step_by_step():
    r = np.random.default_rng(1)
    p = small_model()
    texts = [r.integers(0, gru.VOCAB + 1, n).astype(np.int32) for n in (1, 5, gru.WINDOW, 3 * gru.WINDOW + 7, 200, 0)]
    got = gru.score(p, texts, width=2)
    for t, x in zip(texts, got, strict=True):
        assert x == pytest.approx(plain_likelihood(p, t), rel=2e-4, abs=1e-3)


def test_gradients_are_those_of_the_likelihood(monkeypatch):
    # One window, one step: the change of each weight follows the numeric gradient.
    r = np.random.default_rng(2)
    p = small_model()
    text = r.integers(0, gru.VOCAB + 1, gru.WINDOW).astype(np.int32)
    steps, real = [], np.clip

    def clip(x, lo, hi, **kw):
        steps.append(x.copy())
        return real(x, lo, hi, **kw)

    monkeypatch.setattr(gru.np, "clip", clip)
    before = {k: v.copy() for k, v in p.items()}
    assert gru.train({k: v.copy() for k, v in p.items()}, [text], width=1) == len(text)
    monkeypatch.undo()
    caught = dict(zip(gru.SHAPES, steps, strict=True))
    scale = 1 / np.sqrt(len(text))
    used = {"emb": [(int(text[0]), 3)], "wx": [(2, 5), (7, 40)], "u": [(1, 2), (4, 20), (9, 44)], "wc": [(3, int(min(text[5] // gru.BLOCK, gru.CLASSES)))], "bc": [(0,)]}
    for name, places in used.items():
        for at in places:
            eps, moved = 1e-3, {}
            for sign in (1, -1):
                q = {k: v.astype(np.float64) for k, v in before.items()}
                q[name][at] += sign * eps
                moved[sign] = -plain_likelihood(q, text)
            numeric = (moved[1] - moved[-1]) / (2 * eps) * scale
            assert caught[name][at] == pytest.approx(numeric, rel=0.02, abs=2e-3), (name, at)
