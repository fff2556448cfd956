"""Main text of HTML pages by tree scoring.

Blocks of text pass points for length and commas to their ancestors, halved
and thirded on the way up and discounted by link density; article-like elements
get a bonus. The best container is taken (widened to the article around it) and
so are its siblings with enough points. Menus, page headers, footers, sidebars,
forms, scripts, styles and reader comments are never read.

Names (class, id, role) mark containers only, never headings, paragraphs or
inline elements. Outside what is taken a marked container is not read; inside, it goes
if it is short or mostly links, as share bars and the like are, and whatever its length if it is named as an
advert, a notice, a newsletter box or reader comments; paragraphs and list items go only with such a word as
a whole class. The header of an article, or of a container named like one, keeps its headings, and an
article's lists of links (references) stay. A form goes unless it is wrapped around an article or long paragraphs.

Parsing is tolerant: unclosed and stray tags, broken attributes and a page that
ends inside a tag or a reference are all read to the end. Inline elements make
no tree nodes, so an unclosed one changes nothing.

Defined results: null or empty html, and pages without main text, give the
empty text; repeated rows give equal texts.
"""

from __future__ import annotations

import re
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinion_spark.llm.common import map_text, table

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    # a quote opens a value after = only; anywhere else, and where it is never closed, the tag ends at the next >
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))*+)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"?|'[^']*'?|[^\s>]+))?""")

# HTML element names by their part in a page.
RAW = {"script", "style", "template", "textarea", "title", "iframe", "noembed", "noframes"}
SKIPPED = {"svg", "select", "canvas", "video", "audio"}  # elements whose markup is read, their text not
VOID = {"area", "base", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
DROPPED = {"head", "nav", "footer", "aside", "button", "dialog", "menu", "label"}
FORMS = {"form", "fieldset"}  # not read unless they are wrapped around the text
BLOCKS = {"html", "body", "head", "address", "article", "aside", "blockquote", "button", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
          "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "label", "legend", "li", "main", "menu", "nav",
          "ol", "option", "p", "pre", "search", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
TEXT_BLOCKS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "pre", "dd", "dt", "td", "th", "blockquote", "figcaption", "caption", "summary"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BARRIER = {"html", "body", "article", "main", "section", "div", "table", "ul", "ol", "dl", "blockquote", "form", "aside", "nav", "header", "footer"}
# Words of class, id and role attributes that mark what is not the article, and what is.
NOT_MAIN = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "sponsor", "sponsored", "promo", "promotion", "nav", "navbar",
            "navigation", "menu", "menubar", "breadcrumb", "breadcrumbs", "sidebar", "aside", "complementary", "footer", "contentinfo", "header", "masthead",
            "cookie", "cookies", "consent", "gdpr", "notice", "alert", "popup", "modal", "overlay", "dialog", "newsletter", "subscribe", "subscription", "signup",
            "login", "search", "share", "sharing", "social", "comment", "comments", "commentlist", "reply", "replies", "respond", "disqus", "discussion", "related",
            "recommended", "recommendations", "widget", "toolbar", "pagination", "pager", "copyright", "hidden"}
# Of these also long containers, and paragraphs, list items and the like with such a class.
NEVER = {"comment", "comments", "commentlist", "replies", "respond", "disqus", "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor",
         "sponsored", "promo", "promotion", "cookie", "cookies", "consent", "gdpr", "notice", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login"}
OF_SITE = {"site", "page", "global", "top", "masthead", "banner", "nav", "navbar", "menu"}  # of a header that is not an article's
CONTAINERS = {"div", "section", "ul", "ol", "dl", "table", "center", "search"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
SHORT, WRAPPED = 100, 250  # characters outside links: of a marked container that goes, and in paragraphs of a form that stays
MAIN = {"article", "main", "content", "post", "entry", "story", "body", "text"}


class Page:
    """Block elements as a tree (parallel lists) and the text blocks in page order."""

    def __init__(self, html: str, by_name: bool = True):
        self.parent, self.tag, self.dropped, self.bonus = [-1], ["#"], [False], [0.0]
        self.marked, self.loose, self.article = [False], [False], [False]  # by its name not the article, a section by its id only; inside article or main
        self.blocks: list[tuple[int, str, int]] = []  # node, text, characters inside links
        self._by_name, self._open, self._pieces, self._link = by_name, [0], [], 0
        self._linked: list[str] = []
        at = 0
        while at < len(html):
            m = TAG.search(html, at)
            if m is None:
                self._text(html[at:])
                break
            if m.start() > at:
                self._text(html[at:m.start()])
            at = m.end()
            if m[2] is None:
                if m[0].startswith("<![CDATA["):
                    self._text(m[0][9:].removesuffix("]]>"))
                continue
            name = m[2].lower()
            if m[1]:
                self._close(name)
            elif name in RAW:
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(html, at)
                if not m[3].rstrip().endswith("/"):
                    at = end.end() if end else len(html)
            else:
                self._start(name, m[3])
        self._flush()
        self._drop_forms()

    def _drop_forms(self) -> None:
        """Blocks inside forms go, but for forms around an article or around WRAPPED characters of paragraphs."""
        forms = [k for k, tag in enumerate(self.tag) if tag in FORMS]
        if not forms:
            return
        plain, whole = [0] * len(self.tag), [tag in ("article", "main") for tag in self.tag]
        for node, text, linked in self.blocks:
            if self.tag[node] == "p" and not self.marked[node]:
                plain[node] += len(text) - linked
        for k in range(len(self.tag) - 1, 0, -1):
            plain[self.parent[k]] += plain[k]
            whole[self.parent[k]] |= whole[k]
        gone = [False] * len(self.tag)
        for k in range(1, len(self.tag)):
            gone[k] = gone[self.parent[k]] or self.tag[k] in FORMS and not whole[k] and plain[k] < WRAPPED
        self.blocks = [b for b in self.blocks if not gone[b[0]]]

    def _text(self, raw: str) -> None:
        if not self.dropped[self._open[-1]]:
            self._pieces.append(raw)
            if self._link:
                self._linked.append(raw)

    def _flush(self) -> None:
        if self._pieces:
            text = " ".join(unescape("".join(self._pieces)).split())
            if text:
                self.blocks.append((self._open[-1], text, min(len(text), len(" ".join(unescape("".join(self._linked)).split())))))
            self._pieces, self._linked = [], []

    def _start(self, name: str, attributes: str) -> None:
        if name == "br" or name in VOID:
            if name == "hr":
                self._flush()
            elif name == "br":
                self._text(" ")
            return
        words, ids, classes, hidden = set(), set(), set(), False
        if attributes.strip(" /\t\n\r\f"):
            for m in ATTRIBUTE.finditer(attributes):
                k, v = m[1].lower(), (m[2] or "").strip("\"'").lower()
                if k in ("class", "id", "role"):
                    (ids if k == "id" else words).update(re.split(r"[^a-z]+", v))
                    classes.update(v.split() if k == "class" else ())
                hidden |= k == "hidden" or k == "aria-hidden" and v == "true" or k == "style" and bool(re.search(r"display\s*:\s*none", v))
        if name == "a":
            self._link += 1
        never = (words if name == "section" else words | ids) & NEVER if name in CONTAINERS else classes & NEVER if name in TEXT_BLOCKS - HEADINGS else None
        loose, words = name == "section" and not words & NOT_MAIN, words | ids
        named = self._by_name and name in CONTAINERS and bool(words & NOT_MAIN)
        dropped = hidden or name in SKIPPED or self._by_name and bool(never)
        if name in SKIPPED and attributes.rstrip().endswith("/") or name not in BLOCKS and not dropped:
            return
        if name in BLOCKS:
            self._flush()
            if name not in ("option", "button", "label"):
                self._pop_to({"p"})
            self._pop_to(CLOSES.get(name, ()))
        self.parent.append(self._open[-1])
        # an article's header, or that of a container named like one, keeps its headings
        own = name == "header" and (self.article[self._open[-1]] or self.bonus[self._open[-1]] > 0 and not words & OF_SITE)
        self.dropped.append(self.dropped[self._open[-1]] or name in DROPPED or name == "header" and not own or dropped)
        self.marked.append(named or own)
        self.loose.append(loose)
        self.article.append(self.article[self._open[-1]] or name in ("article", "main"))
        self.tag.append(name)
        self.bonus.append(25.0 if name in ("article", "main") else 10.0 if words & MAIN and name in ("div", "section", "td") else 0.0)
        self._open.append(len(self.parent) - 1)

    def _pop_to(self, names) -> None:
        """Close the innermost open element of these names, unless a container stands between."""
        for k in range(len(self._open) - 1, 0, -1):
            if self.tag[self._open[k]] in names:
                del self._open[k:]
                return
            if self.tag[self._open[k]] in BARRIER:
                return

    def _close(self, name: str) -> None:
        if name == "a":
            self._link = max(0, self._link - 1)
        if name in BLOCKS:
            self._flush()
            self._link = 0
        for k in range(len(self._open) - 1, 0, -1):
            if self.tag[self._open[k]] == name:
                if any(self.tag[j] in BLOCKS for j in self._open[k:]):  # an inline element splits no block
                    self._flush()
                del self._open[k:]
                return
            if name not in BARRIER and self.tag[self._open[k]] in BARRIER:
                return


def _density(page: Page, blocks: list) -> tuple[list[int], list[int]]:
    size, linked = [0] * len(page.parent), [0] * len(page.parent)
    for node, text, in_links in blocks:
        size[node] += len(text)
        linked[node] += in_links
    for k in range(len(page.parent) - 1, 0, -1):
        size[page.parent[k]] += size[k]
        linked[page.parent[k]] += linked[k]
    return size, linked


def _kept(page: Page) -> list[str]:
    under = page.marked[:]  # inside a marked container, which scores nothing
    for k in range(1, len(under)):
        under[k] = under[k] or under[page.parent[k]]
    scored = [x for x in page.blocks if not under[x[0]]]
    if not scored:
        return []
    size, linked = _density(page, scored)
    plain = lambda k: 1 - linked[k] / size[k] if size[k] else 0.0
    points = [0.0] * len(page.parent)
    for node, text, in_links in scored:
        worth = (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - in_links / len(text))
        k = page.parent[node] if page.tag[node] in TEXT_BLOCKS else node
        for share in (1, 1 / 2, 1 / 3):
            if k < 0:
                break
            points[k] += worth * share
            k = page.parent[k]
    score = [(p + page.bonus[k]) * plain(k) if p else 0.0 for k, p in enumerate(points)]
    best = max(range(len(score)), key=lambda k: (score[k], -k))
    top, k = best, best
    while k > 0:  # the article around it, if there is one
        if page.tag[k] in ("article", "main"):
            top = k
            break
        k = page.parent[k]
    enough = max(10.0, 0.2 * score[top])
    keep = {top}
    if top:
        for k in range(1, len(page.parent)):
            if page.parent[k] == page.parent[top] and k != top:
                para = page.tag[k] == "p" and size[k] > 80 and plain(k) > 0.75
                if score[k] >= enough or para:
                    keep.add(k)
    all_size, all_linked = _density(page, page.blocks)
    titles = [0] * len(under)
    for node, text, _ in page.blocks:
        if page.tag[node] in HEADINGS:
            k = node
            while k > 0 and page.tag[k] != "header":
                k = page.parent[k]
            titles[k] += len(text)
    inside, cut = [k in keep for k in range(len(page.parent))], [False] * len(page.parent)
    # a page without a container of its own for the article: its marked containers are not read, sections named by id may be parts of the text
    bare = page.tag[top] in ("#", "html", "body")
    for k in range(1, len(inside)):
        parent, tag = page.parent[k], page.tag[k]
        body = all_size[k] - (titles[k] if tag == "header" else 0)
        weak = page.marked[k] and (not page.loose[k] and (bare or body - all_linked[k] < SHORT) or 2 * all_linked[k] > body)
        if weak and tag == "header":  # its headings stay
            cut[k], weak = True, False
        elif tag in HEADINGS:
            cut[k] = False
        else:
            cut[k] = cut[parent]
        menu = tag in ("ul", "ol") and k not in keep and not page.article[k] and all_size[k] and all_linked[k] > 0.6 * all_size[k]
        inside[k] = inside[k] or inside[parent] and not menu and not weak
    return [text for node, text, _ in page.blocks if inside[node] and not cut[node]]


def main_text(html: str | None) -> str:
    """Blocks of the page's main content, joined by an empty line."""
    if not html:
        return ""
    return "\n\n".join(_kept(Page(html)) or _kept(Page(html, by_name=False)))


def _extractor():
    return lambda html: (main_text(html),)


def extract(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """Columns ``keep`` of every page with its main ``text`` and ``n_chars``."""
    return map_text(pages, keep, F.col(html), _extractor, "text string").withColumn("n_chars", F.length("text").cast("long"))


def query(spark, sf_dir):
    """op7: the main text of every page."""
    return extract(table(spark, sf_dir, "pages"), ["page_id", "url"])
