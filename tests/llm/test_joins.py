"""Near duplicates, suffix dedup, top-k search, page text and the pipeline
against plain versions, on tables with all the odd cases."""

import hashlib
import random
import re
import tracemalloc
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rxlake.llm import bwt, graph, html_main, jaccard, store, suffix_dedup, topk


def check_components(docs):
    near = jaccard.near_duplicates(docs, F.col("rid")).collect()
    rows = [(r["rid"], r["doc_id"], r["text"]) for r in docs.collect()]
    want = brute.components(rows)
    got = {r["row_key"]: (r["n_shingles"], r["component_id"]) for r in near}
    ids = {r: i for r, i, _ in rows}
    # Documents without words are linked with nothing.
    assert got == {r: (n, c if n else ids[r]) for r, (n, c) in want.items()}


def test_near_duplicates(documents, no_documents):
    check_components(documents.withColumn("rid", F.concat(F.lit("r"), F.monotonically_increasing_id())).checkpoint())
    assert jaccard.near_duplicates(no_documents).count() == 0


def test_large_groups_of_near_copies(spark, monkeypatch):
    """Long lists go to cells: chains of edits that no single member is near to."""
    monkeypatch.setattr(jaccard, "SHORT", 4)
    monkeypatch.setattr(jaccard, "CELL", 10)
    r = random.Random(4)
    base = [f"w{i}" for i in range(60)]
    rows, n = [], 0
    for group in range(3):
        for _ in range(30):
            w = [f"{x}g{group}" for x in base]
            for at in r.sample(range(60), r.randint(0, 3)):
                w[at] = f"e{r.random()}"
            rows.append((n, " ".join(w + [f"t{group}"] * r.randint(0, 2)), f"r{n}"))
            n += 1
    rows += [(n + i, " ".join(base[: 10 + i]), f"r{n + i}") for i in range(40)]
    check_components(spark.createDataFrame(rows, "doc_id bigint, text string, rid string"))


def test_first_prefixes_are_shuffled_in_parts(documents, monkeypatch):
    kept, keep = [], jaccard.keep
    monkeypatch.setattr(jaccard, "keep", lambda df, name="t": (kept.append(name), keep(df, name))[1])
    found = []
    for parts in (1, 3):
        monkeypatch.setattr(jaccard, "PARTS", parts)
        found.append(sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in jaccard.near_duplicates(documents).collect()))
    assert kept.count("shared") == 4 and found[0] == found[1]


def test_one_of_each(documents, no_documents):
    kept = jaccard.one_of_each(documents)
    assert kept.columns == documents.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids == Counter([1, 2, 3, 4, 6, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, None, 20, 21]) | Counter([8] if 8 in ids else [])
    assert jaccard.one_of_each(no_documents).count() == 0


def test_prefix_choice_never_loses_a_partner():
    r = random.Random(5)
    for _ in range(300):
        n = r.randint(1, 60)
        common = r.randint(int(jaccard.least_common(n)), n)
        universe = list(range(400))
        r.shuffle(universe)
        a = sorted(universe[:n])
        b = sorted(universe[:common] + universe[n : n + r.randint(0, n - common)])
        if 5 * len(set(a) & set(b)) < 4 * len(set(a) | set(b)):
            continue
        df = {t: r.choice([2, 2, 3, 9, 50]) for t in universe}
        probes = {}
        for name, s in (("a", a), ("b", b)):
            m = len(s)
            longest = m - jaccard.least_common(m) + jaccard.length_of(m, jaccard.LEVELS[-1])
            pos = np.array([i for i, t in enumerate(s) if i < longest and t in set(a) & set(b)])
            token = np.array([s[i] for i in pos])
            need, inside, chosen = jaccard.choose(m, pos, np.array([df[t] for t in token]), token)
            probes[name] = set(token[chosen]), set(token[inside]), need
        one, two = probes["a"], probes["b"]
        assert one[0] & two[1] or two[0] & one[1]
        assert len(one[1] & two[1]) >= min(one[2], two[2]) > 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 200), (300, 301), (301, 300)]
    got = {r["node"]: r["label"] for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert {got[i] for i in range(51)} == {0} and {got[100 + i] for i in range(40)} == {100} and got[300] == got[301] == 300
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_transform_finds_repeats():
    r = random.Random(3)
    for width in (3, 6):
        for _ in range(150):
            strings = [bytes(r.choice(b"ab") for _ in range(r.randint(0, 20))) for _ in range(r.randint(1, 9))]
            left = [r.randint(-6, 0) for _ in strings]
            seen = Counter((c + i, s[i : i + width]) for c, s in zip(left, strings, strict=True) for i in range(len(s) - width + 1))
            want = [[seen[c + i, s[i : i + width]] > 1 for i in range(len(s) - width + 1)] for c, s in zip(left, strings, strict=True)]
            assert [m.tolist() for m in bwt.repeated_starts(strings, np.array(left), width)] == want
    assert bwt.repeated_starts([b"", b""], np.zeros(2), 3)[0].tolist() == []


@pytest.mark.parametrize("most", [4096, 2, 0])
def test_suffix_dedup(documents, no_documents, monkeypatch, most):
    monkeypatch.setattr(suffix_dedup, "MOST", most)
    rows = suffix_dedup.removed(documents, ["doc_id", "n", "label"], with_text=True).collect()
    texts = [r["text"] for r in documents.collect()]
    own = [(r["doc_id"], r["text"]) for r in documents.collect()]
    want = Counter((i, len((t or "").encode()), gone, runs, hashlib.sha256(k).hexdigest()) for (i, t), (k, gone, runs) in zip(own, brute.repeats(texts), strict=True))
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows) == want
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in rows)
    assert suffix_dedup.removed(no_documents, ["doc_id"]).count() == 0


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "CHUNK", 16)
    r = np.random.default_rng(2)
    rows = [(i, [float(x) for x in r.normal(size=7)]) for i in range(120)]
    rows += [(200 + i, rows[0][1]) for i in range(40)]  # one hot vector
    rows += [(300, None), (301, [1.0, None] + [0.0] * 5), (302, [float("nan")] * 7), (303, [float("inf")] * 7), (304, []), (305, [0.5] * 3), (None, [1.0] * 7), rows[50], (350, [1e6] * 7)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("score", F.lit(1))
    v = table.select("vec_id", topk.quantised(F.col("embedding")).alias("v"))
    got = topk.top_k(v, F.col("vec_id") % 50 == 0, 5).collect()
    known = {i: [int(np.floor(256 * x)) for x in e] for i, e in rows if i is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)}
    want = set()
    for q in (i for i in known if i % 50 == 0):
        best = sorted((-sum(a * b for a, b in zip(known[q], known[c], strict=False)), c) for c in known if c != q)[:5]
        want |= {(q, k + 1, c, -s) for k, (s, c) in enumerate(best)}
    assert {tuple(x) for x in got} == want and len(got) == len(want)
    few = v.where("vec_id IN (0, 1, 2)")
    assert topk.top_k(few, F.col("vec_id") == 0, 5).count() == 2
    assert topk.top_k(v.limit(0), F.col("vec_id") == 0, 5).count() == 0
    big = np.array([[2**40, 3], [1, -(2**40)]])
    assert (topk.products(big, np.array([[1, 1]])) == [[2**40 + 3], [1 - 2**40]]).all()


def broadcast_parts(df):
    """What each broadcast of a plan reads, as text."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = [len(re.match(r"[ :+|-]*", x)[0]) for x in lines]
    for i in (i for i, x in enumerate(lines) if "BroadcastExchange" in x):
        end = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
        yield "\n".join(lines[i:end])


def test_top_k_broadcasts_no_vectors(spark, monkeypatch):
    # As files they are short: the planner would broadcast all copies of the queries' chunks.
    monkeypatch.setattr(topk, "CHUNK", 16)
    r = np.random.default_rng(4)
    rows = [(i, [float(x) for x in r.normal(size=9)]) for i in range(300)]
    v = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").select("vec_id", topk.quantised(F.col("embedding")).alias("v"))
    seen, keep = [], topk.keep
    monkeypatch.setattr(topk, "keep", lambda df, name: (seen.append(df), keep(df, name))[1])
    top = topk.top_k(v, F.col("vec_id") % 50 == 0, 5)
    sent = [part for df in [*seen, top] for part in broadcast_parts(df)]
    assert len(seen) > 4 and not [x for x in sent if re.search(r"\b(v|qv|cv|vals|q_vals|c_vals)#", x)]
    assert top.count() == 30


def test_top_k_of_wide_and_uneven_numbers(spark, monkeypatch):
    """Cells of narrow, wide and huge integers, ties, and fewer dimensions than blocks."""
    monkeypatch.setattr(topk, "CHUNK", 8)
    r = np.random.default_rng(6)
    for dims, scale in ((1, 3), (3, 4), (5, 2**20), (4, 2**28), (2, 2**31 - 1)):
        vectors = [[int(x) for x in r.integers(-scale, scale, dims, endpoint=True)] for _ in range(90)]
        vectors[7] = [x % 5 for x in vectors[7]]
        v = spark.createDataFrame(list(enumerate(vectors)), "vec_id bigint, v array<bigint>")
        got = {tuple(x) for x in topk.top_k(v, F.col("vec_id") % 30 == 0, 4).collect()}
        want = set()
        for q in (0, 30, 60):
            best = sorted((-sum(a * b for a, b in zip(vectors[q], c, strict=True)), i) for i, c in enumerate(vectors) if i != q)[:4]
            want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
        assert got == want
    big = np.array([[2**33, 1], [-(2**33), 5]])
    assert topk._exact(big, big).tolist() == [[2**66 + 1, 5 - 2**66], [5 - 2**66, 2**66 + 25]]
    with pytest.raises(OverflowError):
        topk.products(big, big)

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><meta name=x></head><body class="no-sidebar header-on">
<header class="site"><h1>Site</h1></header><nav><ul><li><a href=/a>Menu</a></ul></nav><div id="cookie-notice">We use cookies</div>
<div class="wrap"><div class="post-content p-12"><h2>The&nbsp;story</h2><p>First <b>bo</b>ld para,
 with   space.<br>Next line<p>Second &lt;para&gt; &#233;t&eacute; goes on here <script>var x="</p><p>no";</script>and on.
<div class="ad">Buy now</div><ul><li>point one</li><li>point two</li></ul><form><input name=q>Search</form>
<blockquote>quoted 5 < 6 words</blockquote><!-- hidden <p>words</p> --></div>
<aside>Related links and more words</aside><section id="comments"><p>A reader's remark that is long, long, long, long and longer still than all the others here put together, really.</p></section></div>
<footer>&copy; me</footer></body></html>"""
STORY = "The story First bold para, with space. Next line Second <para> été goes on here and on. point one point two quoted 5 < 6 words"


def test_page_text():
    page = html_main.Page(PAGE)
    assert page.text(page.best()) == STORY
    for html, want in [("", ""), ("plain words", "plain words"), ("<p>a<p>b", "a b"), ("<div><p>one</div></b></p>two <em", "one two"), ("<article><p>x &am", "x &am"), ("<script>1", ""), ("<p hidden>no</p><p>yes", "yes")]:
        page = html_main.Page(html)
        assert page.text(page.choose(None)) == want, html
    deep = html_main.Page("<div>" * 3000 + "word" + "</b>" * 3000)
    assert deep.text(deep.best()) == "word"


def test_host_consensus(spark):
    story = "<p>" + "word " * 40 + "</p>"
    # The long related box outweighs the story on one page; the host's other pages decide.
    page = '<html><body><div class="story s{i}">{a}</div><div class="box">{b}</div></body></html>'
    rows = [(i, f"http://u@Host.example:80/{i}", page.format(i=i, a=story, b="<p>box</p>"), "x", "y") for i in range(9)]
    rows.append((9, "https://host.example?q", page.format(i=9, a=story, b="<p>" + "other " * 45 + "</p>"), "x", "y"))
    rows += [(10, None, story, "x", "y"), (11, "no url", None, "x", "y"), (12, "http://alone.example/", "", "x", "y"), (9, "https://host.example?q", rows[9][2], "x", "y")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, path string")
    got = html_main.main_text(pages, ["page_id", "url", "path"], out="text")
    assert got.columns == ["page_id", "url", "path", "text"]
    found = sorted((r["page_id"], r["text"]) for r in got.collect())
    want = "word " * 39 + "word"
    assert found == sorted([(i, want) for i in [*range(10), 9, 10]] + [(11, ""), (12, "")])
    assert html_main.main_text(pages.limit(0), ["page_id"]).count() == 0


def test_prefix_sums(spark):
    rows = spark.range(500).select((F.col("id") * 3).alias("id"), (F.col("id") % 7).alias("v"))
    got = {r["id"]: r["s"] for r in store.global_prefix(rows, [F.col("id").desc()], {"s": F.col("v")}).collect()}
    total = 0
    for i in range(499, -1, -1):
        assert got[3 * i] == total
        total += i % 7
    got = {r["id"]: r["before_v"] for r in store.prefix_of_totals(rows, "id", ["v"], fanout=10).collect()}
    assert got[30] == sum(range(7)) + 0 + 1 + 2 and got[0] == 0


def test_pipeline(spark, documents, no_documents, tmp_path):
    spark.createDataFrame([(6, 1), (12, 1), (13, 0), (14, 0)], "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "secret_scan", "source_mixture", "packing"]
    for docs in (documents, no_documents):
        rows = docs
        for name, stage in corpus_pipeline.STAGES:
            rows = stage(spark, rows, str(tmp_path))
            assert name == "packing" or rows.columns == docs.columns
            rows = store.keep(rows, name)
        docs.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        again = corpus_pipeline.run(spark, str(tmp_path))
        pick = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        whole = lambda df: Counter((r["doc_id"], r["doc_tokens"]) for r in df.select(*pick).where("start = 0").collect())
        assert whole(again) == whole(rows)
    assert rows.count() == 0


def test_page_text_of_split_articles():
    def main(html, path=None):
        page = html_main.Page(html)
        return page.text(page.choose(path))

    a, b = "first " * 40 + "end", "second " * 20 + "end"
    ad = '<div class="ad">Buy now</div>'
    # Siblings on one path, named like content or not, with noise between.
    for name in (' class="content"', ' class="c1"', ""):
        for x, y in ((a, b), (b, a), (a, "short"), (b, b)):
            html = f"<body><nav>Menu</nav><div{name}><p>{x}</p></div>{ad}<div{name}>{y}</div><footer>me</footer></body>"
            assert main(html) == main(html, "body>div" + {"": ""}.get(name, "." + name[8:-1].replace("1", "#"))) == f"{x} {y}"
    # Headings and text outside the article, and several articles.
    assert main(f"<main><h1>T</h1><article>{a}</article></main>") == f"T {a}"
    assert main(f'<body><h1><a href="/long-address">T</a></h1>{ad}<article>{a}</article>after <p><a href=x>more of this site</a></body>') == f"T {a} after"
    assert main(f"<main><article>{a}</article><article>b</article></main>") == f"{a} b"
    # Parents of their own: what stands in each, and in the one they share.
    part = "<section><h2>{}</h2><div class=text>{}</div></section>"
    assert main("<main><h1>T</h1>" + part.format("A", a) + ad + part.format("B", b) + "</main>") == f"T A {a} B {b}"
    # A cell of links on the same path is noise; links in what is named like content stay.
    links = "".join(f"<a href=/{i}>one of the links</a> " for i in range(9))
    assert main(f"<table><tr><td>{links}</td><td>{a}</td></tr></table>") == a
    assert main(f"<div class=content>{a}</div><div class=content>{links}</div>") == a + " one of the links" * 9


PARA = "Some real text of the article that is long enough to be the main thing. " * 4


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ('<body><div class="content has-sidebar"><article><p>{t}</p></article><div class="sidebar">side x</div></div></body>', "{t}"),
        ('<body><div class="site no-sidebar"><main><p>{t}</p></main></div>', "{t}"),
        ('<body><form id="form1"><div><p>{t}</p></div><input></form></body>', "{t}"),
        ('<article><div class="entry-header"><h1>Title</h1></div><p>{t}</p></article>', "Title {t}"),
        ('<article><h1 class="page-header">Title</h1><p>{t}</p></article>', "Title {t}"),
        ("<article><header><h1>Title</h1></header><p>{t}</p></article>", "Title {t}"),
        ('<article><p>{t}</p><p class="side-note">Note</p></article>', "{t} Note"),
        ('<article><p title="my class=nav">Kept</p><p>{t}</p></article>', "Kept {t}"),
        ('<article><p data-x="a>b" class=story>Kept</p><p>{t}</p></article>', "Kept {t}"),
        ('<body><div class="sidebar-left-layout"><div class="content"><p>{t}</p></div><aside>x y</aside></div></body>', "{t}"),
        ('<header>top</header><article><p>{t}</p></article><div class="comments"><article>{t}{t}{t}</article></div><div class="ad">buy</div><p class="ad">buy<p>after', "{t} after"),
        ('<div class="post-content"><p>{t}</p></div><div class="related-posts"><p>{t}{t}</p></div><div id="cookie-notice">{t}</div><form><label>a</label>{t}</form>', "{t}"),
        ('<div class="ad">{t}</div><footer>{t}</footer>', ""),
    ],
)
def test_what_looks_like_noise_is_judged_by_what_it_holds(html, want):
    page = html_main.Page(html.replace("{t}", PARA))
    assert page.text(page.choose(None)) == want.replace("{t}", PARA.strip())


def test_deep_pages_take_little_memory():
    tracemalloc.start()
    page = html_main.Page("<div>" * 20000 + "word" + "</div>" * 20000)
    assert page.text(page.choose(page.votes()[0][0])) == "word"
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30e6


def test_pages_of_plain_articles_equal_a_plain_reading():
    import pyarrow.parquet as pq

    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet", columns=["html"]).column("html").to_pylist()
    for html in pages:
        page = html_main.Page(html or "")
        assert page.text(page.choose(None)) == brute.article(html)
