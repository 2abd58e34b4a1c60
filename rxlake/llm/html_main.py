"""Main text of web pages: consensus host paths.

Each page is read once into text blocks under containers; a container is scored
by its plain text, less what lies in links; a generalised path (tags and classes,
digits masked) by all containers on it. Every page votes for its best paths;
votes are summed by host in Spark, and each page is read again with its host's
winning path. A page on which that path is missing, or holds too little of what
its own best path has, keeps its own.

The text is that of all containers on the path, in page order, with headings and
text that stand directly in the containers around them, up to the one they share.
Left out are elements of ``DROPPED``, hidden ones, containers not named like content
that are mostly links, and text around that is mostly links, headings not. Elements
that only look like noise, by tag (``SOFT``), role or name, are read first and judged
by what they hold: one with an article inside, or named by its page's layout around
most of the text, stays, as does a form around the page and a header in an article;
others take no part in scores, votes or text. Reader comments never stay. A name
counts for a heading or paragraph only if it is noise as a whole.

Defined cases: null or empty html gives an empty text; a url that is null or has
no host belongs to the host ""; repeated rows vote each and give equal rows;
equal votes go to the smaller path; unclosed or misnested tags, and a page cut
off inside a tag, are read as far as they go; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from heapq import nsmallest
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxlake.llm.store import free_name, keep, schema_of, ship_code

# Element and class names of HTML and of common page templates.
CONTAINERS = frozenset("body main article section div td center".split())
BLOCKS = CONTAINERS | frozenset("html head p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr th caption blockquote pre figure figcaption address hr br header footer nav aside form fieldset details summary hgroup menu dialog".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
DROPPED = frozenset("head nav menu dialog button select option noscript template iframe object canvas svg math audio video map".split())
SOFT = frozenset("header footer aside form label fieldset".split())
RAW = "script|style|textarea|title|xmp|noembed|noframes"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NOISE = frozenset(
    "ad ads adv advert adverts advertisement adbox adsense sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs sidebar side aside rail header masthead topbar footer foot copyright legal "
    "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended comment comments commentlist disqus reply replies respond discussion "
    "form search widget widgets pagination pager toolbar skip".split()
)
COMMENTS = frozenset("comment comments commentlist disqus reply replies respond discussion".split())
GOOD = frozenset("article content entry post story main text body".split())
#: Noise words that beside a word of ``GOOD`` tell a part of the article.
PLACES = frozenset("header side masthead banner form".split())
#: Words of names that tell how a page is laid out, not what an element is.
LAYOUT = frozenset("has have no not with without is on off layout".split())
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b[^>]*>.*?(?:</(?P=raw)\s*[^>]*>|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*|[^>]*)(?:>|\Z)",
    re.S | re.I,
)
_ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
_NAMES = re.compile(r"[^a-z0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())


def noise_of(name: str, whole: bool) -> str:
    """What a name (a class or an id) tells: "", "noise" or "comments". ``whole``:
    all its words must be noise."""
    words = [w for w in _NAMES.split(name) if w]
    found = NOISE.intersection(words)
    if not found or LAYOUT.intersection(words) or (whole and not NOISE.issuperset(words)):
        return ""
    if found & COMMENTS:
        return "comments"
    return "" if found <= PLACES and GOOD.intersection(words) else "noise"


class Page:
    """Containers and text blocks of a page.

    Nodes are containers and elements that look like noise: parent, step (tag and
    generalised class), weight, kind of noise. Paths are numbered by (path of the
    parent, step), so depth costs nothing. Blocks, in page order: (node, text, is it
    no mere links)."""

    def __init__(self, html: str):
        self.parent, self.step, self.weight, self.tag, self.noise = [-1], ["body"], [0.7], ["body"], [""]
        self.blocks: list[tuple[int, str, bool]] = []
        self.linked = [0]
        self._read(html)
        n = len(self.parent)
        self._number: dict[tuple[int, str], int] = {}
        self.path = [0] * n
        for i in range(n):
            self.path[i] = self._number.setdefault((self.path[self.parent[i]] if i else -1, self.step[i]), len(self._number))
        self._judge()
        self.plain = [0] * n
        for node, text, _ in self.blocks:
            self.plain[node] += len(text)
        self.plain, self.linked = self._sums(self.plain), self._sums([0 if self.out[i] else x for i, x in enumerate(self.linked)])
        #: Scores of all containers on a path.
        self.total = [0.0] * len(self._number)
        for i, p in enumerate(self.path):
            self.total[p] += self.score(i)

    def _sums(self, own: list[int]) -> list[int]:
        """Of each node and all below it."""
        out = list(own)
        for i in range(len(out) - 1, 0, -1):
            out[self.parent[i]] += out[i]
        return out

    def _judge(self) -> None:
        """Mark nodes that are noise and take their blocks away."""
        n = len(self.parent)
        size, free, articles, good = [0] * n, 0, [0] * n, [0] * n
        noisy, talk, story = [False] * n, [False] * n, [False] * n
        for i in range(1, n):
            p = self.parent[i]
            noisy[i] = noisy[p] or bool(self.noise[i])
            talk[i] = talk[p] or self.noise[i] == "comments"
            story[i] = story[p] or self.tag[i] in ("article", "main")
        for node, text, _ in self.blocks:
            size[node] += len(text)
            free += 0 if noisy[node] else len(text)
        whole = sum(size)
        size = self._sums(size)
        for i in range(1, n):
            if size[i] and not talk[i] and not self.noise[i]:
                articles[i] = self.tag[i] in ("article", "main")
                good[i] = self.weight[i] > 1
        articles, good = self._sums(articles), self._sums(good)
        self.out = [False] * n
        for i in range(1, n):
            kind, around = self.noise[i], self.out[self.parent[i]]
            stays = not kind or (
                kind != "comments"
                and (articles[i] > 0 or (good[i] > 0 and 2 * size[i] >= whole) or (self.tag[i] == "header" and story[self.parent[i]]) or (self.tag[i] == "form" and size[i] > 10 * free))
            )
            self.out[i] = around or not stays
        self.blocks = [b for b in self.blocks if not self.out[b[0]]]

    def _attributes(self, tag: str, attrs: str) -> tuple[bool, str, str, bool]:
        """Is the element to be dropped; its kind of noise; its class, generalised; is
        it named like content."""
        drop, noise, label, good = tag in DROPPED, "noise" if tag in SOFT else "", "", False
        if not attrs or attrs.isspace():
            return drop, noise, label, good
        seen = set()
        for name, a, b, c in _ATTR.findall(attrs):
            name, value = name.lower(), (a or b or c).lower()
            if name in seen:
                continue
            seen.add(name)
            if name == "style":
                drop |= bool(_HIDDEN.search(value))
            elif name == "hidden" or name == "aria-hidden":
                drop |= name == "hidden" or value == "true"
            elif name == "role":
                drop |= value in ("navigation", "menu", "menubar", "dialog", "alertdialog")
                noise = noise or ("noise" if value in ROLES else "")
            elif name in ("class", "id"):
                names = value.split()
                good |= any(GOOD.intersection(_NAMES.split(w)) for w in names)
                if tag not in ("body", "html", "main", "article"):
                    kinds = {noise_of(w, tag in HEADINGS or tag not in CONTAINERS) for w in names}
                    noise = "comments" if "comments" in kinds else noise or ("noise" if "noise" in kinds else "")
                if name == "class":
                    label = ".".join(sorted(re.sub(r"\d+", "#", w).replace(">", "") for w in names))
        return drop, noise, label, good

    def _read(self, html: str) -> None:
        stack: list[tuple[str, int]] = []  # open tags and the container they are in
        opened: Counter[str] = Counter()
        node, skip, skip_at = 0, 0, 0
        parts: list[str] = []
        links, at, in_links = 0, 0, 0

        def close() -> None:
            nonlocal in_links
            text = " ".join(unescape("".join(parts)).split())
            if text:
                heading = bool(stack) and stack[-1][0] in HEADINGS
                self.blocks.append((node, text, heading or 2 * in_links < len(text)))
            parts.clear()
            in_links = 0

        for m in _TOKEN.finditer(html):
            if m.start() > at and not skip:
                parts.append(html[at : m.start()])
                if links:
                    self.linked[node] += m.start() - at
                    in_links += m.start() - at
            at = m.end()
            tag = m["tag"]
            if not tag:
                continue
            tag = tag.lower()
            if tag in BLOCKS and not skip:
                close()
            if m["end"]:
                if tag == "a":
                    links = 0
                if not opened[tag]:
                    continue
                depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
                if depth is None or (skip and depth < skip_at - 1 and tag not in CONTAINERS):
                    continue
                node = stack[depth][1]
                opened.subtract(t for t, _ in stack[depth:])
                del stack[depth:]
                if skip and len(stack) < skip_at:
                    skip = 0
                continue
            if tag == "a":
                links = 1
            if tag in VOID or m["attrs"].rstrip().endswith("/"):
                continue
            if tag in BLOCKS and stack and stack[-1][0] == "p":
                node = stack.pop()[1]  # a paragraph ends where the next block begins
                opened["p"] -= 1
                if skip and len(stack) < skip_at:
                    skip = 0
            if tag == "body" and skip and stack[skip_at - 1][0] == "head":
                stack.clear()
                opened.clear()  # an unclosed head ends here
                skip = 0
            drop, noise, label, good = (False, "", "", False) if skip else self._attributes(tag, m["attrs"])
            if tag in BLOCKS or drop or noise:
                if noise and not drop and tag not in BLOCKS:
                    close()
                stack.append((tag, node))
                opened[tag] += 1
            if drop:
                skip, skip_at = 1, len(stack)
            elif not skip and ((tag in CONTAINERS and tag != "body") or noise):
                self.parent.append(node)
                self.step.append(f"{tag}.{label}" if label else tag)
                self.weight.append(1.5 if tag == "article" else 1.3 if tag == "main" or good else 1.0)
                self.tag.append(tag)
                self.noise.append(noise)
                self.linked.append(0)
                node = len(self.parent) - 1
        if at < len(html) and not skip:
            parts.append(html[at:])
        close()

    def score(self, i: int) -> float:
        return 0.0 if self.out[i] else max(self.plain[i] - 2 * self.linked[i], 0) * self.weight[i]

    def best(self) -> int:
        """The last container on the path of highest score; the inner path in a tie."""
        return max(range(len(self.parent)), key=lambda i: (self.total[self.path[i]], i))

    def spelled(self, i: int) -> str:
        """The path of a container as text."""
        steps = []
        while i >= 0:
            steps.append(self.step[i])
            i = self.parent[i]
        return ">".join(reversed(steps))

    def find(self, path: str | None) -> int:
        """The number of a path given as text; -1 if the page has none such."""
        at = -1
        for i, step in enumerate((path or "").split(">")):
            at = self._number.get((at, step), -2)
            if at == -2:
                return -1
        return at

    def votes(self, most: int = 3) -> list[tuple[str, float]]:
        """The best paths with their part of the top score."""
        last = {p: i for i, p in enumerate(self.path)}
        order = nsmallest(most, last, key=lambda p: (-self.total[p], -last[p]))
        top = self.total[order[0]]
        return [(self.spelled(last[p]), self.total[p] / top) for p in order if top and self.total[p] > 0]

    def choose(self, path: str | None, least: float = 0.5) -> int:
        """A container on the path to take: ``path`` or the page's own best."""
        own, wanted = self.best(), self.find(path)
        if wanted < 0 or self.total[wanted] < least * self.total[self.path[own]]:
            return own
        return max((i for i, p in enumerate(self.path) if p == wanted), key=lambda i: (self.score(i), i))

    def text(self, node: int) -> str:
        """Of all containers on the path of ``node``, and what stands around them."""
        same = {i for i, p in enumerate(self.path) if p == self.path[node] and (i == node or self.weight[i] > 1 or self.score(i) > 0)}
        inside = [False] * len(self.parent)
        for i in range(len(self.parent)):
            inside[i] = i in same or (i > 0 and inside[self.parent[i]])
        # One path, one depth: the levels above meet in the container they share.
        level = {self.parent[i] for i in same} - {-1}
        around = set(level)
        while len(level) > 1:
            level = {self.parent[i] for i in level}
            around |= level
        # Headings and the like in elements of their own (a kept header) count too.
        for i in range(1, len(self.parent)):
            if self.noise[i] and self.parent[i] in around and i not in same and self.tag[i] not in CONTAINERS:
                around.add(i)
        return " ".join(t for n, t, plain in self.blocks if inside[n] or (plain and n in around))


def host(url: Column) -> Column:
    found = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/?#:]*)", 1))
    return F.coalesce(found, F.lit(""))


def host_paths(pages: DataFrame) -> DataFrame:
    """host, path: each host's winning path. Votes are summed where they are
    cast before they meet, so a host with most of the pages is no hot task."""
    ship_code(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sums: dict[tuple[str, str], float] = {}
            for h, html in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                for path, part in Page(html.as_py() or "").votes():
                    sums[h, path] = sums.get((h, path), 0.0) + part
            keys = list(sums)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([sums[k] for k in keys], pa.float64())], ["host", "path", "part"])

    votes = pages.select(host(F.col("url")).alias("host"), "html").mapInArrow(run, "host string, path string, part double")
    # Rounded, so that the order of summation does not decide a tie.
    total = votes.groupBy("host", "path").agg(F.round(F.sum("part"), 6).alias("votes"))
    best = total.groupBy("host").agg(F.max(F.struct("votes", "path")).alias("top"), F.max("votes").alias("most"))
    first = total.join(best.select("host", "most"), "host").where("votes = most").groupBy("host").agg(F.min("path").alias("path"))
    return keep(first, "paths")


def main_text(pages: DataFrame, columns: list[str], out: str = "text") -> DataFrame:
    """``columns`` of the pages and the main text ``out``."""
    paths = host_paths(pages)
    own = [c for c in columns if c != out]
    html, where, path = free_name(pages.select(*own), "_html", "_host", "_path")
    rows = pages.select(*own, F.col("html").alias(html), host(F.col("url")).alias(where))
    rows = rows.join(paths.select(F.col("host").alias(where), F.col("path").alias(path)), where, "left").select(*own, html, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                b = batch.slice(lo, 200)
                texts = []
                for source, p in zip(b.column(len(own)), b.column(len(own) + 1), strict=True):
                    page = Page(source.as_py() or "")
                    texts.append(page.text(page.choose(p.as_py())))
                yield pa.RecordBatch.from_arrays([b.column(i) for i in range(len(own))] + [pa.array(texts, pa.string())], [*own, out])

    return rows.mapInArrow(run, schema_of(pages.select(*own), f"{out} string"))
