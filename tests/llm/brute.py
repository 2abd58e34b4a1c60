"""Plain versions of the operators, for small tables."""

import re
from collections import Counter, defaultdict
from html.parser import HTMLParser

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text, fold=False):
    text = text or ""
    if fold:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return WORD.findall(text)


def shingles(text, k=5):
    w = words(text, fold=True)
    if len(w) >= k:
        return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    return frozenset([tuple(w)]) if w else frozenset()


def components(rows):
    """rows: (row, id, text) -> row: (set size, smallest id of its component)."""
    sets = {r: shingles(t) for r, _, t in rows}
    lists = defaultdict(list)
    for r, s in sets.items():
        for x in s:
            lists[x].append(r)
    parent = {r: r for r, _, _ in rows}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    pairs = Counter((a, b) for rows_ in lists.values() for i, b in enumerate(rows_) for a in rows_[:i])
    for (a, b), c in pairs.items():
        if 100 * c >= 80 * (len(sets[a]) + len(sets[b]) - c):
            parent[top(b)] = top(a)
    least = {}
    for r, i, _ in rows:
        if i is not None:
            least[top(r)] = min(i, least.get(top(r), i))
    return {r: (len(sets[r]), least.get(top(r))) for r, _, _ in rows}


def repeats(texts, width=200):
    """Kept bytes, removed bytes and removed runs of each text."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + width] for r in raw for i in range(len(r) - width + 1))
    out = []
    for r in raw:
        gone = bytearray(len(r))
        for i in range(len(r) - width + 1):
            if seen[r[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((bytes(b for b, g in zip(r, gone, strict=True) if not g), sum(gone), runs))
    return out


def statistics(text):
    text = text or ""
    w = words(text)
    tri = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count, covered, seen, dup = Counter(tri), set(), set(), 0
    for i, x in enumerate(tri):
        if count[x] > 1:
            covered |= {i, i + 1, i + 2}
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def secrets(text):
    text, found = text or "", []
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found += [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [f"{('assign', 'access', 'hex')[k]}:{a}:{z}" for a, k, z in sorted(found)]


class _Article(HTMLParser):
    """Blocks inside <article>, for pages that have one and no noise in it."""

    BLOCKS = ("p", "h1", "h2", "ul", "li", "div", "article", "blockquote", "br")

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.deep, self.parts, self.blocks = 0, [], []

    def close_block(self):
        text = " ".join("".join(self.parts).split())
        if text and self.deep:
            self.blocks.append(text)
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag in self.BLOCKS:
            self.close_block()
        self.deep += tag == "article"

    def handle_endtag(self, tag):
        if tag in self.BLOCKS:
            self.close_block()
        self.deep -= tag == "article"

    def handle_data(self, data):
        if self.deep:
            self.parts.append(data)


def article(html):
    parser = _Article()
    parser.feed(html or "")
    parser.close_block()
    return " ".join(parser.blocks)
