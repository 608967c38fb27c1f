"""Main text of web pages by composite text density.

A tolerant pass over the tags gives the DOM as flat lists (nodes in page order, with their parents), so nesting of any
depth needs no recursion. Elements that are never article text (menus, forms, scripts, adverts, reader comments and the
like) are cut by tag, role and class. Names cut by themselves only where they are plain ("sidebar", "ad"); words that name content
as well ("share", "related", "widget"), and within an article all parts of longer names, cut only what is mostly links or a
scrap of text. Neither names nor forms cut where all elements of that name together hold most of the unlinked text of their
article, or of a page without one. For every node that is left the density is its characters per tag, adjusted by the
share of link text; a node's sum is that of its children's densities. The node with the largest sum fixes a threshold, the
smallest density on its path to the body; walking down from the body, each node at or over the threshold gives its
largest-sum descendant as content. Content inside an article or main element stands for that whole element.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Element names of HTML and words that mark page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td "
    "tfoot th thead tr ul".split())
CUT_TAGS = frozenset(
    "aside button canvas datalist dialog footer form head header iframe input menu nav noscript object option script search "
    "select style svg template textarea title".split())
CUT_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
PLAIN_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising breadcrumb breadcrumbs consent cookie cookies footer gdpr login masthead menu "
    "modal nav navbar navigation newsletter pager pagination popup sidebar signup sponsor sponsored subscribe subscription toolbar".split())
DOUBTFUL_WORDS = frozenset(
    "banner dialog notice notices notification overlay promo promoted promotion recommended related share sharing social widget".split())
SCRAP = 25  # characters; a doubtful element with less is no part of an article
COMMENT_WORDS = frozenset("comment comments commentlist disqus replies respond".split())
CLOSED_BY = {  # a start tag of the key ends an open element of the values
    **{t: ("p",) for t in BLOCKS - {"html", "body", "li", "dt", "dd", "option", "tr", "td", "th", "tbody", "thead", "tfoot"}},
    "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "option": ("option",), "tr": ("td", "th", "tr"),
    "td": ("td", "th"), "th": ("td", "th"), "tbody": ("tr", "thead", "tbody"), "thead": ("tr", "tbody"), "tfoot": ("tr", "tbody")}
FENCES = frozenset("article aside body button dialog div footer form header main nav section table td th ul ol".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'=/]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
NAMES = re.compile(r"[^\s]+")

FURNITURE = PLAIN_WORDS | DOUBTFUL_WORDS
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NO_WORDS: frozenset[str] = frozenset()
NOTHING = (False, "", NO_WORDS, NO_WORDS)


class Page:
    """The DOM of a page as lists, and its text pieces and block borders in page order."""

    def __init__(self, html: str):
        self.tag, self.parent, self.attrs = ["#"], [-1], [""]
        self.events: list[tuple[int, str | None]] = []  # (node, text), or (node, None) for a border between blocks
        stack, at = [0], 0
        for m in TOKEN.finditer(html):
            if m.start() < at:
                continue
            if m.start() > at:
                self.events.append((stack[-1], html[at:m.start()]))
            at = m.end()
            if m[2] is None:
                continue
            name = m[2].lower()
            if m[1]:
                self._end(stack, name)
                continue
            for closed in CLOSED_BY.get(name, ()):
                self._close(stack, closed)
            self.tag.append(name)
            self.parent.append(stack[-1])
            self.attrs.append(m[3])
            node = len(self.tag) - 1
            if name in BLOCKS:
                self.events.append((node, None))
            elif name == "br":
                self.events.append((node, " "))
            if name in RAW:
                end = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(html, at)
                at = end.end() if end else len(html)
            elif name not in VOID and not m[3].endswith("/"):
                stack.append(node)
            elif name not in VOID and name in BLOCKS:
                stack.append(node)  # a slash in a block's start tag means nothing
        if at < len(html):
            self.events.append((stack[-1], html[at:]))

    def _close(self, stack: list[int], name: str) -> None:
        """End an open element that a start tag ends, if no fence stands between."""
        for i in range(len(stack) - 1, 0, -1):
            tag = self.tag[stack[i]]
            if tag == name:
                self.events.append((self.parent[stack[i]], None))
                del stack[i:]
                return
            if tag in FENCES and tag not in (name,):
                return

    def _end(self, stack: list[int], name: str) -> None:
        for i in range(len(stack) - 1, 0, -1):
            tag = self.tag[stack[i]]
            if tag == name:
                if name in BLOCKS:
                    self.events.append((self.parent[stack[i]], None))
                del stack[i:]
                return
            if name not in BLOCKS and tag in BLOCKS:
                return  # an inline end tag does not end a block

    def cut(self) -> list[bool]:
        """Which nodes are no article text, by themselves or by what they stand in."""
        n = len(self.tag)
        main, inside = [t in ("article", "main") for t in self.tag], [False] * n
        holds = list(main)
        for i in range(n - 1, 0, -1):
            if holds[i]:
                holds[self.parent[i]] = True
        out, named = [False] * n, [self._named(i) if self.attrs[i] else NOTHING for i in range(n)]
        share, kinds, linked = self._shares(main, named)
        for i in range(1, n):
            inside[i] = main[i] or inside[self.parent[i]]
            out[i] = out[self.parent[i]] or self._furniture(i, holds[i], inside[i], share[i], kinds[i], linked[i], named[i])
        return out

    def _named(self, i: int) -> tuple[bool, str, frozenset[str], frozenset[str]]:
        """Of an element's attributes: hidden or not, its role, its whole names, first and last words of names."""
        hidden, role, whole, words = False, "", set(), set()
        for m in ATTRIBUTE.finditer(self.attrs[i]):
            name, value = m[1].lower(), (m[2] or "").strip("\"'")
            if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
                hidden = True
            elif name == "role":
                role = value.lower()
            elif name in ("class", "id"):
                for one in NAMES.findall(value):
                    parts = [w.lower() for w in WORDS.findall(one)]
                    if parts and parts[0] not in ("has", "with", "no", "without"):
                        words.update((parts[0], parts[-1]))
                        whole.add("".join(parts))
        return hidden, role, frozenset(whole), frozenset(words)

    def _shares(self, main: list[bool], named: list[tuple]) -> tuple[list[float], list[float], list[tuple[int, int, bool]]]:
        """For each node its share of the unlinked text of the article or main element around it, else of the body; the share
        of all elements there that have one of its furniture words; and (characters in links, others, outside all articles).

        Beside an article or main element that is no comment, nodes outside it have no share.
        """
        n = len(self.tag)
        apart, scope, chars, linked = [False] * n, [0] * n, [0] * n, [0] * n
        body = next((i for i in range(n) if self.tag[i] == "body"), 0)
        for i in range(1, n):
            p = self.parent[i]
            apart[i] = apart[p] or self.tag[i] == "a" or self.tag[i] in CUT_TAGS and self.tag[i] not in ("form", "header")
            scope[i] = p if main[p] else body if p == body else scope[p]
        for node, text in self.events:
            if text is not None:
                (linked if apart[node] else chars)[node] += len(text.strip())
        for i in range(n - 1, 0, -1):
            chars[self.parent[i]] += chars[i]
            linked[self.parent[i]] += linked[i]
        above, together = [NO_WORDS] * n, {}
        for i in range(1, n):
            own = named[i][3] & FURNITURE
            above[i] = above[self.parent[i]] if main[self.parent[i]] is False else NO_WORDS
            for w in own - above[i]:  # an element within one of its kind is counted with that one
                together[scope[i], w] = together.get((scope[i], w), 0) + chars[i]
            above[i] = above[i] | own if own else above[i]
        beside = any(main[i] and chars[i] and not COMMENT_WORDS & {w.lower() for w in WORDS.findall(self.attrs[i])} for i in range(n))
        none = [beside and not main[scope[i]] for i in range(n)]
        kinds = [0.0 if none[i] else max((together.get((scope[i], w), 0) for w in named[i][3] & FURNITURE), default=0) / max(chars[scope[i]], 1)
                 for i in range(n)]
        return [0.0 if none[i] else chars[i] / max(chars[scope[i]], 1) for i in range(n)], kinds, list(zip(linked, chars, none))

    def _furniture(self, i: int, holds_main: bool, in_main: bool, share: float, kind: float, text: tuple[int, int, bool], named: tuple) -> bool:
        tag = self.tag[i]
        if tag == "form" and share > 0.5:
            return False
        if tag in CUT_TAGS and not (tag == "header" and in_main) and not (holds_main and tag in ("form", "header")):
            return True
        if not self.attrs[i] or tag in ("html", "body"):
            return False
        hidden, role, whole, words = named
        if hidden:
            return not holds_main
        if role in CUT_ROLES:
            return not holds_main and not (role == "form" and share > 0.5)
        if words & COMMENT_WORDS and share < 0.9:
            return tag != "main" and not (holds_main and tag not in ("article", "section", "div", "ol", "ul", "li"))
        if whole & {"header", "siteheader", "pageheader"} and not in_main:
            words = words | {"masthead"}
        if not words & FURNITURE or holds_main or tag in HEADINGS:
            return False
        if max(share, kind) > 0.5:
            return False
        linked, plain, outside = text
        if outside or whole & PLAIN_WORDS or words & PLAIN_WORDS and not in_main:
            return True
        return linked > plain or linked + plain < SCRAP

    def content(self, cut: list[bool]) -> list[bool]:
        """Which nodes are content: the subtrees chosen by their sums of densities."""
        n = len(self.tag)
        chars, links, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
        in_link = [False] * n
        for i in range(1, n):
            in_link[i] = self.tag[i] == "a" or in_link[self.parent[i]]
        for node, text in self.events:
            if text is not None and not cut[node]:
                k = len(text.strip())
                chars[node] += k
                links[node] += k * in_link[node]
        counted = [not cut[i] and (self.tag[i] in BLOCKS or self.tag[i] == "a") for i in range(n)]
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            chars[p] += chars[i]
            links[p] += links[i]
            tags[p] += tags[i] + counted[i]
            link_tags[p] += link_tags[i] + (counted[i] and self.tag[i] == "a")
        share = links[0] / max(chars[0], 1)
        density, sums = [0.0] * n, [0.0] * n
        for i in range(n - 1, 0, -1):
            if cut[i] or not chars[i]:
                continue
            c, t, lc, lt = chars[i], max(tags[i], 1), max(links[i], 1), max(link_tags[i], 1)
            base = math.log(c / max(c - links[i], 1) * lc + share * c + math.e)
            density[i] = c / t * math.log(max(c / lc * t / lt, 1.0) + 1e-9) / math.log(max(base, 1.0 + 1e-9)) if base > 1 else c / t
            sums[self.parent[i]] += density[i]
        body = next((i for i in range(n) if self.tag[i] == "body"), 0)
        top = max(range(n), key=lambda i: sums[i])
        threshold, i = math.inf, top
        while i > 0 and i != body:
            threshold, i = min(threshold, density[i]), self.parent[i]
        best = list(range(n))  # the descendant with the largest sum, the node itself included
        for i in range(n - 1, 0, -1):
            if sums[best[i]] > sums[best[self.parent[i]]]:
                best[self.parent[i]] = best[i]
        chosen, reached = [False] * n, [False] * n
        for i in range(n):
            walked = i in (0, body) or reached[self.parent[i]]
            if walked and not cut[i] and (i in (0, body) or density[i] >= threshold > 0):
                reached[i] = True
                if sums[best[i]] or i not in (0, body):
                    chosen[self._whole(best[i])] = True
            elif i == body or (i > 0 and self.tag[i] == "html"):
                reached[i] = True
        if not any(chosen):
            chosen[body] = True
        for i in range(1, n):
            chosen[i] = chosen[i] or chosen[self.parent[i]]
        return chosen

    def _whole(self, node: int) -> int:
        """The outermost article or main element around a node, else the node."""
        found, i = node, node
        while i > 0:
            if self.tag[i] in ("article", "main"):
                found = i
            i = self.parent[i]
        return found

    def text(self) -> str:
        cut = self.cut()
        keep = self.content(cut)
        blocks, piece = [], []
        for node, text in self.events:
            if text is None:
                blocks.append("".join(piece))
                piece = []
            elif keep[node] and not cut[node]:
                piece.append(text)
        blocks.append("".join(piece))
        return "\n\n".join(b for b in (" ".join(unescape(x).split()) for x in blocks) if b)


def main_text(html: str | None) -> str:
    return Page(html).text() if html else ""


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h.as_py()) for h in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages`` (page_id, url, html).

    Null and empty pages, and pages without any text, give an empty text. A page that ends inside a tag or element is read
    to its end. Rows are independent, so ties and repeated rows give equal rows; an empty table gives none; other columns
    are not read.
    """
    return pages.select("page_id", "url", "html").mapInArrow(_extracted, "page_id long, url string, text string").withColumn(
        "n_chars", F.length("text").cast("long"))
