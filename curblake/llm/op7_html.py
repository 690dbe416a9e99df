"""HTML extraction by site template removal.

A page is read into a tree of block elements.  Every element has two hashes: of its content (element, class,
id, role, texts) and of its skeleton (the same without texts, runs of equal children as one), and a path of
the elements above it.  Spark counts by host on how many pages each hash stands, and how much text outside
links each path holds.  On a host of at least PAGES pages the counts decide:

* The main part is found by going down the paths, as long as one child holds more than half of the text.
* Outside the main part an element goes if its content or its skeleton stands on PAGES pages and SHARE of the
  host's.
* Inside it an element that isn't a paragraph, heading, list, quote or table goes if its content stands on
  PAGES pages and SHARE of the host's, unless such elements hold more than half of the main part: then the
  page is a copy of an article, and nothing of it goes.

Elements that HTML itself declares as no main text (nav, footer, aside, form and the like) go also where
their counts are too low, and so do elements inside the main part that are named as comments or notices,
since counts can't tell a reader's comment from a section.  A host with fewer pages, or a url without one,
can't be counted: there the element, class, id and role names alone decide, and the text is that of the
page's articles, else of its main element, else of its body.

Blocks are joined by two line feeds; white space in a block becomes one space.  A null html counts as empty
and gives an empty text.  Repeated rows count as pages of their own.  Unclosed and stray tags are tolerated,
nesting may be of any depth, and reading takes time linear in the page.  Extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curblake.llm.common import by_batch, spool

PAGES, SHARE = 5, 0.05
#: Paths that hold less of a host's text aren't looked at (a main part holds more).
THIN = 0.1

SCHEMA = "page_id long, url string, text string, n_chars long"

_set = lambda s: frozenset(s.split())
VOID = _set("area base br col embed hr img input link meta param source track wbr")
RAW = _set("script style textarea title xmp iframe noembed noframes noscript template svg math object")
FLOW = _set("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table thead tbody tfoot tr td th caption figure figcaption hgroup address")
BLOCK = FLOW | _set("html head body article main section div nav header footer aside form menu dialog fieldset details summary center button select option label search hr br")
#: Elements that are never main text.
DROPPED = _set("head nav footer aside form menu dialog button select option label fieldset search")
CLOSES_P = BLOCK - _set("br button select option label")
#: A start tag ends these open elements, up to the given containers.
IMPLIED = {
    "li": (_set("li"), _set("ul ol menu")),
    "dt": (_set("dt dd"), _set("dl")),
    "dd": (_set("dt dd"), _set("dl")),
    "tr": (_set("tr td th"), _set("table")),
    "td": (_set("td th"), _set("tr table")),
    "th": (_set("td th"), _set("tr table")),
    "option": (_set("option"), _set("select")),
}
#: Words of a class or id that mark an element as no main text, where counts can't decide.
MARKS = _set("ad ads advert adverts advertisement advertising adsbygoogle sponsor sponsored promo promotion sidebar menu nav navbar navigation breadcrumb breadcrumbs footer cookie cookies consent gdpr notice notices newsletter subscribe signup login comment comments disqus respond replies related recommended share sharing social popup modal overlay toolbar pagination pager skip")
#: The same, but only outside an article: inside, it may hold the title.
OUTER_MARKS = _set("header masthead banner topbar sitename logo")
ROLES = _set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar note")

_open = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_rest = re.compile(r"""(?:[^>"']|"[^"]*+"|'[^']*+')*+>""")
_attribute = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""", re.I)
_word = re.compile(r"[a-z0-9]+")
_number = re.compile(r"[0-9]+")
#: Skeleton of a text, path of the page.
TEXT, ROOT = 1, 0


def _hash(*parts: object) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(repr(parts)) - (1 << 63)


class Element:
    """An open or closed block element; blocks first to end are its text."""

    __slots__ = ("tag", "name", "up", "first", "end", "declared", "named", "part", "path", "content", "skeleton", "size", "plain", "inner", "shape", "counts")

    def __init__(self, tag: str, name: str, up: Element | None, first: int) -> None:
        self.tag, self.name, self.up, self.first, self.end = tag, name, up, first, first
        #: Whether HTML, or a name, marks it (or one above it) as no main text; 1 in a main element, 2 in an article.
        self.declared, self.named, self.part = (up.declared, up.named, up.part) if up else (False, False, 0)
        self.inner: list[int] = []
        self.shape: list[int] = []
        self.size = self.plain = 0
        self.counts: Counter | None = None
        if up is None:
            self.path = ROOT
        else:
            up.counts = Counter() if up.counts is None else up.counts
            self.path = _hash(up.path, name, up.counts[name] if name == tag else 0)
            up.counts[name] += 1

    def close(self, end: int) -> None:
        self.end = end
        self.content, self.skeleton = _hash(self.name, *self.inner), _hash(self.name, *self.shape)
        if self.up:
            self.up.size += self.size
            self.up.plain += self.plain
            if self.size:
                self.up.inner.append(self.content)
                self.up.add_shape(self.skeleton)
        del self.inner, self.shape

    def add_shape(self, key: int) -> None:
        if self.shape[-1:] != [key]:
            self.shape.append(key)


class Page:
    """The blocks of a page (text, element) and its elements with text, in the order of their ends."""

    def __init__(self, source: str) -> None:
        self.blocks: list[tuple[str, Element]] = []
        self.elements: list[Element] = []
        self.text: list[str] = []
        self.plain, self.link = 0, False
        self.root = Element("", "", None, 0)
        self.stack: list[Element] = [self.root]
        self.open: Counter = Counter()
        self._read(source)

    def _flush(self) -> None:
        if self.text:
            joined = " ".join(entities.unescape("".join(self.text)).split())
            plain, self.text, self.plain = self.plain, [], 0
            if joined:
                top = self.stack[-1]
                self.blocks.append((joined, top))
                top.size += len(joined)
                top.plain += min(plain, len(joined))
                top.inner.append(_hash(joined))
                top.add_shape(TEXT)

    def _pop(self) -> None:
        self._flush()
        top = self.stack.pop()
        self.open[top.tag] -= 1
        top.close(len(self.blocks))
        if top.size:
            self.elements.append(top)

    def _close(self, tag: str) -> None:
        if self.open[tag]:
            while self.stack[-1].tag != tag:
                self._pop()
            self._pop()

    def _start(self, tag: str, rest: str) -> None:
        if tag in CLOSES_P and self.open["p"]:
            self._close("p")
        ends, until = IMPLIED.get(tag, ((), ()))
        if any(self.open[e] for e in ends):
            at = len(self.stack) - 1
            while at > 0 and self.stack[at].tag not in until and self.stack[at].tag not in ends:
                at -= 1
            if at > 0 and self.stack[at].tag in ends:
                while len(self.stack) > at:
                    self._pop()
        self._flush()
        self.link = False
        up, found = self.stack[-1], _attribute.findall(rest) if rest else ()
        found = [(key.lower(), (a or b or c).lower()) for key, a, b, c in found]
        new = Element(tag, " ".join([tag, *(f"{key}={_number.sub('0', value)}" for key, value in found)]), up, len(self.blocks))
        new.declared |= tag in DROPPED or tag == "header" and not up.part
        for key, value in found:
            if key == "role":
                new.part = max(new.part, int(value == "main"))
                new.declared |= value in ROLES
            elif key in ("hidden", "aria-hidden"):
                new.declared |= key == "hidden" or value == "true"
            elif tag not in ("html", "body", "article", "main"):
                words = set(_word.findall(value))
                new.named |= bool(words & MARKS or not up.part and words & OUTER_MARKS)
        new.part = max(new.part, 2 if tag == "article" else 1 if tag == "main" else 0)
        self.stack.append(new)
        self.open[tag] += 1

    def _add(self, text: str) -> None:
        if text:
            self.text.append(text)
            self.plain += 0 if self.link else len(text)

    def _read(self, s: str) -> None:
        at, n = 0, len(s)
        while at < n:
            lt = s.find("<", at)
            if lt < 0:
                self._add(s[at:])
                break
            if lt > at:
                self._add(s[at:lt])
            if s.startswith("<!--", lt):
                end = s.find("-->", lt + 4)
                at = n if end < 0 else end + 3
                continue
            m = _open.match(s, lt)
            if not m:
                if s.startswith(("<!", "<?", "</"), lt):
                    end = s.find(">", lt)
                    at = n if end < 0 else end + 1
                else:  # a lone "<" is text
                    self._add("<")
                    at = lt + 1
                continue
            whole = _rest.match(s, m.end())
            end = whole.end() - 1 if whole else s.find(">", m.end())
            end = n if end < 0 else end
            at, tag, rest = end + 1, m[2].lower(), s[m.end() : end]
            if m[1]:
                if tag == "br":
                    self._flush()
                elif tag in BLOCK:
                    self._close(tag)
                elif tag == "a":
                    self.link = False
            elif tag in RAW:
                if not rest.endswith("/"):
                    close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(s, at)
                    end = s.find(">", close.end()) if close else -1
                    at = n if end < 0 else end + 1
            elif tag == "br":
                self._add(" ")
            elif tag == "hr":
                self._flush()
            elif tag in BLOCK:
                self._start(tag, rest)
            elif tag == "a":
                self.link = True
        while len(self.stack) > 1:
            self._pop()
        self._flush()
        self.root.close(len(self.blocks))

    def keys(self) -> tuple[set[int], Counter]:
        """The hashes of contents and skeletons, and the text outside links by path."""
        texts: Counter = Counter({ROOT: self.root.plain})
        for e in self.elements:
            if e.tag not in FLOW and e.plain:
                texts[e.path] += e.plain
        return {h for e in self.elements for h in (e.content, e.skeleton)}, texts

    def by_names(self) -> str:
        """The text that element, class, id and role names leave."""
        best = max((e.part for _, e in self.blocks if not (e.declared or e.named)), default=0)
        return "\n\n".join(text for text, e in self.blocks if e.part == best and not (e.declared or e.named))

    def by_counts(self, many: set[int], heavy: dict[int, int]) -> str:
        """The text that the host's counts leave.  many: hashes on enough pages; heavy: path -> text on the host."""
        way = {self.root: True}  # down to the main part
        for e in reversed(self.elements):
            way[e] = way[e.up] and 2 * heavy.get(e.path, 0) > heavy.get(e.up.path, 0)
        main = {e for e, on in way.items() if on} - {e.up for e in self.elements if way[e]}
        inside = {self.root: self.root in main}
        outer, inner = [], []
        for e in reversed(self.elements):
            inside[e] = inside[e.up] or e in main
            if not inside[e] and not way[e] and (e.content in many or e.skeleton in many):
                outer.append(e)
            elif inside[e] and not way[e] and e.tag not in FLOW and e.content in many:
                inner.append(e)
        keep = [not e.declared and not (e.named and inside[e]) for _, e in self.blocks]
        self._drop(keep, outer)
        held = lambda k: sum(len(text) for (text, e), own in zip(self.blocks, k, strict=True) if own and inside[e])
        without = keep[:]
        self._drop(without, inner)
        if 2 * held(without) >= held(keep):  # else the page is a copy
            keep = without
        return "\n\n".join(text for (text, _), own in zip(self.blocks, keep, strict=True) if own)

    @staticmethod
    def _drop(keep: list[bool], elements: list[Element]) -> None:
        done = len(keep)  # elements come from the last end to the first: a child's blocks lie in its parent's
        for e in elements:
            if e.first < done:
                keep[e.first : min(e.end, done)] = [False] * (min(e.end, done) - e.first)
                done = e.first


def host(url: str | None) -> str:
    rest = (url or "").partition("://")[2]
    return re.match(r"[^/?#]*", rest)[0].lower()


def templates(pages: DataFrame, least: int = PAGES, share: float = SHARE, thin: float = THIN) -> DataFrame:
    """(host, many, heavy) of the hosts with at least ``least`` pages: the hashes on enough of them, and the paths
    with at least ``thin`` of the host's text.  Both are short: a page has few elements, and each hash takes a ``share``.
    """

    def count(urls: list, sources: list) -> list:
        found: Counter = Counter()
        texts: Counter = Counter()
        for url, source in zip(urls, sources, strict=True):
            if site := host(url):
                found[site, None] += 1
                hashes, paths = Page(source).keys()
                found.update((site, key) for key in hashes)
                texts.update({(site, key): size for key, size in paths.items()})
        rows = [*((s, k, n, 0) for (s, k), n in found.items()), *((s, k, 0, n) for (s, k), n in texts.items())]
        return list(map(list, zip(*rows, strict=True))) or [[], [], [], []]

    full = pages.select("url", F.coalesce("html", F.lit("")).alias("html"))
    counted = by_batch(full, "host string, key long, n long, size long", count, "url", "html")
    counted = counted.groupBy("host", "key").agg(F.sum("n").alias("n"), F.sum("size").alias("size"))
    counted = spool(counted.where(F.col("key").isNull() | (F.col("n") >= least) | (F.col("size") > 0)), "subtree-counts")
    pages_of = counted.where(F.col("key").isNull() & (F.col("n") >= least)).select("host", F.col("n").alias("pages"))
    whole = counted.where(F.col("key") == ROOT).select("host", F.col("size").alias("whole"))
    rows = counted.where(F.col("key").isNotNull()).join(spool(pages_of.join(whole, "host", "left"), "hosts"), "host")
    wide = (F.col("n") > 0) & (F.col("n") >= F.greatest(F.lit(least), F.col("pages") * share))
    thick = (F.col("size") > 0) & (F.col("size") >= F.col("whole") * thin)
    kept = rows.where(wide | thick | (F.col("key") == ROOT))
    return kept.groupBy("host").agg(F.collect_list(F.when(wide, F.col("key"))).alias("many"), F.collect_list(F.when(thick, F.struct("key", "size"))).alias("heavy"))


def extract(pages: DataFrame, least: int = PAGES, share: float = SHARE) -> DataFrame:
    """page_id, url, main text and its number of characters."""
    pages = pages.select("page_id", "url", "html")
    table = spool(templates(pages, least, share), "templates")
    site = F.lower(F.regexp_extract(F.expr("substring(url, instr(url, '://') + 3)"), r"^([^/?#]*+)", 1))
    rows = pages.withColumn("_host", F.when(F.col("url").contains("://"), site))
    rows = rows.join(table, F.col("_host") == table["host"], "left")

    def run(ids: list, urls: list, sources: list, many: list, heavy: list) -> list:
        texts = []
        for source, hashes, paths in zip(sources, many, heavy, strict=True):
            page = Page(source) if source else None
            texts.append("" if not page else page.by_names() if hashes is None else page.by_counts(set(hashes), {p["key"]: p["size"] for p in paths}))
        return [ids, urls, texts, list(map(len, texts))]

    return by_batch(rows, SCHEMA, run, "page_id", "url", "html", "many", "heavy")
