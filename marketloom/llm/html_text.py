"""Main text of web pages by consensus host paths.

Every page scores its containers by what reading along them would give: running text counts for a path, links
and scraps of text against it. A path that occurs several times on a page counts once, with all its text, so
an enclosing container wins as soon as it adds running text; but text outside an article (or main part) that has
the headline or most of the running text counts against. The scores, as shares of the page's running text,
are votes for generalised paths (tags and classes, digits as N), summed per host in Spark. Each page is then
read again along the path its host agreed on. A page that has no such path, or no text there, uses its own
best container.

Menus, page headers and footers, sidebars, notices, adverts, forms and reader comments are left out by tag, role,
and the words of class and id, unless that would take an article or most of the page's text away. Names of
headings and paragraphs are not looked at. Inside an article, and in ids, a name must consist of such words
alone (``related-posts``, not ``related-work``); where it could be a title too (``search``, ``copyright``), the
element must also hold a form or mostly links.

Defined results
    null or empty html, or no text: the empty string. Null or malformed url: such pages vote together.
    Ties between paths: the innermost, then the first in order. A page without running text is read whole.
    Unclosed tags end where their parent does, unclosed comments at the end. Repeated rows: the same text.
    Empty table: no rows. Other columns: kept by ``extract``. Paths of over ``PATH_CHARS`` letters are
    shortened to a digest of what lies above.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import Stage, free_name

PATH_CHARS = 256
SCRAP = 80  # letters below which text that stands in no paragraph is a scrap
SHORT = 25  # letters below which a paragraph speaks neither for nor against a path

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<!--|<[!?][^>]*+>""")
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|$)""", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br".split()
)
CONTAINERS = frozenset("article main section div td body html center".split())
SELF_CLOSING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LISTS = frozenset("ul ol dl table article section div body main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = frozenset("p pre blockquote li dd figcaption".split())
CONTROLS = frozenset("form input button select".split())
DROPPED_TAGS = frozenset("head nav footer aside form button select option input dialog menu object applet audio video canvas datalist fieldset".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
DROPPED_WORDS = frozenset(
    """
    ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation breadcrumb breadcrumbs
    masthead header footer sidebar aside widget widgets notice notices cookie cookies consent gdpr alert popup modal overlay subscribe subscription
    newsletter share sharing social related recommended recommendations comment comments respond reply replies disqus login signup
    search pagination pager toolbar skip copyright disclaimer paywall
    """.split()
)
# Of these, the ones that can as well be the title of a section.
TITLES = frozenset("header masthead banner menu notice notices alert share sharing social related search skip copyright disclaimer consent reply replies promotion".split())
# Words that only say what kind of part a name is for.
PARTS = frozenset(
    """
    area articles bar block body bottom box button buttons container content form global group icons inner item items left line links list main
    page parent posts primary right row secondary section site slot text thread top unit wrap wrapper
    """.split()
)

# Words in front of which a class describes the page around it.
MODIFIERS = ("no-", "has-", "with-", "without-", "is-")


class Page:
    """Elements with their parents, and blocks of text with the element they stand in, in page order."""

    def __init__(self, source: str):
        self.tag, self.parent, self.flag, self.within = ["#"], [-1], [0], [False]  # flag 1 asks for evidence
        self.path = [0]  # of each element, as a number: equal paths have equal numbers
        self.steps: dict[tuple[int, str], int] = {}  # (path above, last step) to path
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters in links
        self.controls: list[int] = []  # the elements in which controls of forms stand
        self._read(source)
        self._settle()

    def _read(self, source: str) -> None:
        stack, parts, linked, links, at = [0], [], 0, 0, 0
        opened: Counter[str] = Counter()

        def flush():
            nonlocal parts, linked
            if parts:
                text = " ".join(html.unescape("".join(parts)).split())
                if text:
                    self.blocks.append((stack[-1], text, linked))
                parts, linked = [], 0

        def close(depth: int) -> None:
            flush()
            while len(stack) > depth:
                opened[self.tag[stack.pop()]] -= 1

        n, last = len(source), source.rfind(">")
        while at < n:
            m = TAG.search(source, at) if at <= last else None
            piece = source[at : m.start() if m else n]
            if not m:
                piece = piece.partition("<!--")[0]
            if piece:
                parts.append(piece)
                linked += len(piece) if links else 0
            if not m:
                break
            at = m.end()
            end, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
            if not name:
                if m[0] == "<!--":
                    stop = source.find("-->", at)
                    at = n if stop < 0 else stop + 3
                continue
            name = name.lower()
            if end:
                if name in INLINE:
                    if name == "a":
                        links = max(0, links - 1)
                    continue
                flush()
                if opened[name]:
                    depth = len(stack) - 1
                    while self.tag[stack[depth]] != name:
                        depth -= 1
                    close(depth)
                continue
            if name in RAW:
                if not attributes.endswith("/"):
                    stop = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(source, at)
                    at = stop.start() if stop else n
                if name not in INLINE:
                    parts.append(" ")
                continue
            if name in INLINE:
                if name == "br":
                    parts.append(" ")
                elif name == "a":
                    links += 1
                continue
            flush()
            links = 0
            closes = SELF_CLOSING.get(name, ())
            if name in CONTROLS:
                self.controls.append(stack[-1])
            if name in VOID:
                continue
            if self.tag[stack[-1]] == "p":
                close(len(stack) - 1)
            elif any(opened[t] for t in closes):
                for depth in range(len(stack) - 1, 0, -1):
                    open_tag = self.tag[stack[depth]]
                    if open_tag in closes:
                        close(depth)
                    if open_tag in closes or open_tag in LISTS:
                        break
            self._open(name, attributes, stack)
            opened[name] += 1
        close(1)

    def _open(self, name: str, attributes: str, stack: list[int]) -> None:
        flag, classes = 2 * (name in DROPPED_TAGS), []
        within = self.within[stack[-1]]  # a header inside an article is its own
        if attributes and len(attributes) > 3:
            for m in ATTRIBUTE.finditer(attributes):
                key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
                if key == "class":
                    classes = sorted({re.sub(r"\d+", "N", c).replace(">", "_") for c in value.split()})
                if key in ("class", "id"):
                    if name not in HEADINGS and name != "p":
                        flag = max([flag, *(suspicion(v, key, within) for v in value.split())])
                elif key == "role":
                    flag = 2 if value.lower() in DROPPED_ROLES else flag
                elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
                    flag = 2
                elif key == "style":
                    flag = 2 if "display:none" in value.replace(" ", "").lower() else flag
        if name == "header":
            flag = flag if within else 2
        parent = stack[-1]
        self.within.append(within or name in ("article", "main"))
        self.tag.append(name)
        self.parent.append(parent)
        step = (self.path[parent], ".".join([name, *classes]))
        self.path.append(self.path[parent] if name in ("html", "body") else self.steps.setdefault(step, len(self.steps) + 1))
        self.flag.append(0 if name in ("html", "body", "article", "main") else flag)
        stack.append(len(self.tag) - 1)

    def _settle(self) -> None:
        """Leave out what is flagged, but neither an article nor most of the text with the headline."""
        count = len(self.tag)
        size, letters, links, controls = [0] * count, [0] * count, [0] * count, [False] * count
        article, headline = [t in ("article", "main") for t in self.tag], [t == "h1" for t in self.tag]
        for node, text, linked in self.blocks:
            size[node] += max(0, len(text) - linked)
            letters[node] += len(text)
            links[node] += min(len(text), linked)
        for node in self.controls:
            controls[node] = True
        for i in range(count - 1, 0, -1):
            above = self.parent[i]
            size[above] += size[i]
            letters[above] += letters[i]
            links[above] += links[i]
            controls[above] |= controls[i]
            article[above] |= article[i]
            headline[above] |= headline[i]
        self.out = [False] * count
        self.holder = [0] * count  # the container around each element, or the article that stands for it
        for i in range(1, count):
            above = self.parent[i]
            spared = self.tag[i] not in DROPPED_TAGS and (article[i] or (headline[i] and 2 * size[i] > size[0]))
            flagged = self.flag[i] == 2 or (self.flag[i] == 1 and (controls[i] or 2 * links[i] > letters[i]))
            self.out[i] = self.out[above] or (flagged and not spared)
            inner = self.holder[above]
            if self.tag[inner] == "article" or (self.tag[inner] == "main" and self.tag[i] != "article") or self.tag[i] not in CONTAINERS:
                self.holder[i] = inner
            else:
                self.holder[i] = i

    def gains(self) -> list[float]:
        """What reading each element would give. An article or main part with the headline or most of the running text speaks against the rest."""
        count = len(self.tag)
        own, inside = [0.0] * count, [False] * count
        main = {"article": [False] * count, "main": [False] * count}
        for i in range(1, count):
            for name, within in main.items():
                within[i] = within[self.parent[i]] or self.tag[i] == name
        kept = [(node, gain(self.tag[node], text, linked)) for node, text, linked in self.blocks if not self.out[node]]
        running = sum(max(0.0, g) for _, g in kept)
        for name in ("article", "main"):
            headed = any(self.tag[node] == "h1" for node, _ in kept if main[name][node])
            if headed or 2 * sum(max(0.0, g) for node, g in kept if main[name][node]) > running:
                inside = main[name]
                break
        else:
            inside = [True] * count
        for node, g in kept:
            own[node] += g if inside[node] else -abs(g)
        for i in range(count - 1, 0, -1):
            own[self.parent[i]] += own[i]
        return own

    def keys(self) -> list[str]:
        """The path of each path number; equal paths have equal keys on all pages."""
        out = [""]
        for (above, step), _ in self.steps.items():
            key = f"{out[above]}>{step}" if above else step
            out.append(key if len(key) <= PATH_CHARS else "#" + hashlib.sha256(key.encode("utf-8", "surrogatepass")).hexdigest())
        return out

    def best(self) -> int:
        """The container with the highest gain, the innermost of equal ones; the whole page without running text."""
        own = self.gains()
        top = max((own[i], i) for i in range(len(self.tag)) if self.holder[i] == i and not self.out[i])
        return top[1] if top[0] > 0 else 0

    def at_path(self, path: str) -> set[int]:
        number = {key: n for n, key in enumerate(self.keys())}.get(path)
        return {i for i, p in enumerate(self.path) if p == number}

    def text_under(self, chosen: set[int]) -> str:
        inside = [False] * len(self.tag)
        for i in range(len(self.tag)):
            inside[i] = i in chosen or (i > 0 and inside[self.parent[i]])
        return "\n".join(t for node, t, _ in self.blocks if inside[node] and not self.out[node])


def suspicion(token: str, key: str, within: bool) -> int:
    """What a word of a class or id says: 0 nothing, 1 to be left out on further evidence, 2 to be left out."""
    if token.lower().startswith(MODIFIERS):
        return 0
    words = {w.lower() for w in WORDS.findall(token)}
    named = words & DROPPED_WORDS
    if not named:
        return 0
    if not within and key == "class":
        return 2
    if not words <= DROPPED_WORDS | PARTS:
        return 0
    return 2 if named - TITLES or not within else 1


def gain(tag: str, text: str, linked: int) -> float:
    """What a block speaks for the containers around it."""
    n = len(text)
    if linked:
        return float(n - 2 * min(n, linked))
    if tag in HEADINGS:
        return float(n)
    if tag in PARAGRAPHS:
        return float(n if n >= SHORT else 0)
    return float(n if n >= SCRAP else -n)


def votes(source: str | None) -> list[tuple[str, int, float]]:
    """Every path of a page's containers with its depth and the share of the page's running text it would give."""
    page = Page(source or "")
    own, keys = page.gains(), page.keys()
    running = sum(max(0.0, gain(page.tag[node], text, linked)) for node, text, linked in page.blocks if not page.out[node])
    sums, depth = {0: own[0]}, [0] * len(page.tag)
    for i in range(1, len(page.tag)):
        depth[i] = depth[page.parent[i]] + (page.path[i] != page.path[page.parent[i]])
        if page.holder[i] == i and page.path[i]:
            sums[page.path[i]] = sums.get(page.path[i], 0.0) + (0.0 if page.out[i] else own[i])
    deep = dict(zip(page.path, depth))
    return [(keys[p], deep[p], s / running) for p, s in sums.items() if s > 0]


def main_text(source: str | None, path: str | None) -> str:
    """The text under the path, or under the page's own best container."""
    if not source:
        return ""
    page = Page(source)
    if path is not None:
        text = page.text_under(page.at_path(path))
        if text:
            return text
    return page.text_under({page.best()})


def host(url_col: str) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``host``, ``path``, ``share`` (of the running text of the pages that have it) of the winning paths."""

    @F.pandas_udf("array<struct<path:string,depth:int,share:double>>")
    def cast(sources):
        import pandas as pd

        return pd.Series([[{"path": p, "depth": d, "share": s} for p, d, s in votes(x)] for x in sources])

    each = pages.select(host(url_col).alias("host"), F.explode(cast(F.col(html_col))).alias("v"))
    # Whole numbers sum alike in any order.
    share = F.round(F.col("v.share") * 1e6).cast("long")
    summed = each.groupBy("host", F.col("v.path").alias("path")).agg(F.sum(share).alias("n"), F.max("v.depth").alias("depth"), F.count("*").alias("pages"))
    best = summed.groupBy("host").agg(F.min(F.struct((-F.col("n")).alias("n"), (-F.col("depth")).alias("depth"), "path", "pages")).alias("best"))
    return best.select("host", F.col("best.path").alias("path"), (-F.col("best.n") / F.col("best.pages") / 1e6).alias("share"))


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The rows with ``text`` in place of the html."""
    name, path = free_name(pages.columns, "host"), free_name([*pages.columns, "text"], "path")
    won = host_paths(pages, url_col, html_col).select(F.col("host").alias(name), F.col("path").alias(path))
    # Written first, the table of hosts has a known size: a small one is broadcast and no page moves, with a
    # large one both sides are exchanged and a host with many pages is split.
    won = Stage(pages.sparkSession, "hosts").keep("paths", won)

    @F.pandas_udf("string")
    def read(sources, paths):
        import pandas as pd

        return pd.Series([main_text(x, p) for x, p in zip(sources, paths)], dtype=object)

    keyed = pages.withColumn(name, host(url_col)).join(won, name, "left")
    return keyed.withColumn("text", read(F.col(html_col), F.col(path))).select(*[c for c in pages.columns if c not in (html_col, "text")], "text")
