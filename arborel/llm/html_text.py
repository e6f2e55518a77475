"""HTML extraction by tree scoring.

A page is read once into a light tree of its block elements. Blocks of text give points for
their length and commas to the element around them; an element passes half of its points on to its
parent, so every paragraph counts for all that is above it. Names (class, id, role) of menus, headers,
sidebars, notices, adverts, forms and comments discount what a block is worth, they do not rule
it out. An element's points are discounted by the share of its text that stands in links. The element
with the most points is the container; it and those siblings that are text as well are kept, without
the parts of it that such names or tags mark.

Where nothing is left so, the page is scored again without the marks, at first with the tags that
mean no article for sure still ruled out, then with none. Nothing else is dropped or cut.

Character references are decoded, white space inside a block becomes one space, and the
blocks are joined in page order by one line end. A null or empty page, or one without text, gives
the empty string. The parser takes anything: elements that are not closed end with their parents,
stray end tags and unfinished tags are passed over.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborel.llm.common import over_texts

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*\"|'[^']*')?)*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?<![^\s/\"'])(class|id|role|style|hidden|aria-hidden|itemprop)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

# How elements behave.
_BLOCKS = frozenset(
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table thead tbody tfoot tr caption figure figcaption "
    "address details summary center header footer nav aside form fieldset legend hgroup hr menu dialog search option optgroup select button template noscript".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style title textarea iframe xmp noembed noframes svg math object audio video canvas".split())
_DRAWN = frozenset("svg math object audio video canvas".split())
_CLOSE = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for tag in _RAW}
_CUT = frozenset("nav footer aside form noscript template select button dialog menu search fieldset option optgroup head".split())
#: Of these, elements that a whole page is wrapped in at times.
_WRAPS = frozenset("form aside fieldset dialog".split())
_SPACED = frozenset("br td th img wbr input".split()) - {"wbr"}
#: A start tag ends these when they are open within the nearest boundary.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "option": ("option",), "tbody": ("thead", "tbody", "tfoot"), "tfoot": ("thead", "tbody"), "body": ("head",)}
_BOUNDARY = frozenset("html body ul ol dl table div article section main blockquote td th form select".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# Words in class, id and role that name what is not the article, and what may be.
_UNLIKELY = frozenset(
    "ad ads advert adverts advertisement advertising adbox adslot banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies "
    "disqus discussion footer gdpr login masthead menu modal nav navbar navigation navigator newsletter notice notification overlay pager pagination paywall popup "
    "promo promoted promotion recommended recommendations related reply replies respond share sharing shoutbox sidebar signup skip skyscraper social sponsor sponsored "
    "subscribe subscription tags toolbar widget widgets complementary contentinfo alert dialog search".split()
)
_PAGE_HEADER = frozenset("header banner masthead topbar".split())
_LIKELY = frozenset("article articlebody body content entry hentry main page post story text blog".split())
_NEVER = frozenset("comment comments ad advert related promo sponsored".split())
_ARTICLES = frozenset(("article", "main"))

#: Words of layout rather than content: what follows them in a name says what stands beside the element.
_BESIDE = frozenset("with has have no without hide show is".split())
#: What a block within a marked element is worth.
MARKED = 0.2

#: A list whose text is mostly links, with this many items or more, is a menu.
MENU_ITEMS = 3
MENU_LINKS = 0.8


def _names(attributes: str) -> tuple[list[list[str]], bool]:
    """Words of each name in class, id and role, and whether the element is hidden."""
    names: list[list[str]] = []
    hidden = False
    for m in _ATTRIBUTE.finditer(attributes):
        name = m[1].lower()
        value = m[2] or m[3] or m[4] or ""
        if name in ("class", "id", "role", "itemprop"):
            names += [[w.lower() for w in _WORDS.findall(x)] for x in value.split()]
        elif name == "hidden":
            hidden = True
        elif name == "aria-hidden":
            hidden |= value.lower() == "true"
        elif name == "style":
            hidden |= re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I) is not None
    return names, hidden


def _judged(names: list[list[str]], tag: str, inside: bool) -> tuple[bool, bool]:
    """Whether names mark an element as no part of the article, and whether they make it likely.

    A name is as a whole one or the other: one with a word of the first kind marks, unless another name of the element is likely.
    """
    unlikely = _UNLIKELY if inside else _UNLIKELY | _PAGE_HEADER
    marks = likely = False
    for words in names:
        if words and words[0] in _BESIDE:
            continue
        if any(w in unlikely for w in words):
            marks = True
        elif any(w in _LIKELY for w in words):
            likely = True
    if tag in _ARTICLES and not inside and marks:
        marks = any(w in _NEVER for words in names for w in words)
    return marks and not likely and tag not in ("html", "body", "main") and tag not in _HEADINGS, likely


class _Page:
    """Elements in page order with their parents, and the blocks of text they hold."""

    def __init__(self, text: str):
        self.tags, self.parents, self.bonus = ["#"], [-1], [0.0]
        self.cut = [0]  # 2: the tag or its attributes rule the element out, 1: its tag, but not for sure, 0: neither; of it or of what is above it
        self.marked = [False]  # names of this very element
        self.inside = [False]  # of an article or main element
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters in links
        self.items: dict[int, int] = {}
        self._read(text)

    def _open(self, tag: str, attributes: str, top: int) -> int:
        names, hidden = _names(attributes) if attributes else ([], False)
        inside = self.inside[top]
        marked, likely = _judged(names, tag, inside)
        cut = 2 if hidden or tag in _CUT and tag not in _WRAPS else 1 if tag in _WRAPS or tag == "header" and not inside else 0
        bonus = 25.0 * (tag in _ARTICLES) + (25.0 if likely and tag != "body" else 0.0)
        if tag in ("ul", "ol", "dl", "li", "dd", "dt", "address"):
            bonus -= 3
        elif tag in _HEADINGS:
            bonus -= 5
        elif tag == "div":
            bonus += 5
        self.tags.append(tag)
        self.parents.append(top)
        self.cut.append(max(cut, self.cut[top]))
        self.marked.append(marked)
        self.inside.append(inside or tag in _ARTICLES)
        self.bonus.append(bonus)
        if tag == "li":
            self.items[top] = self.items.get(top, 0) + 1
        return len(self.tags) - 1

    def _read(self, text: str) -> None:
        stack = [0]
        standing: Counter[str] = Counter()  # open elements by tag
        parts: list[str] = []
        linked = 0  # depth of links
        links: list[str] = []
        unclosed: set[str] = set()
        at, end = 0, len(text)

        def flush() -> None:
            if parts:
                block = " ".join(html.unescape("".join(parts)).split())
                if block:
                    inside = len(" ".join(html.unescape("".join(links)).split())) if links else 0
                    self.blocks.append((stack[-1], block, inside))
                parts.clear()
                links.clear()

        def drop(i: int) -> None:
            standing.subtract(self.tags[x] for x in stack[i:])
            del stack[i:]

        while at < end:
            m = _TOKEN.search(text, at)
            stop = m.start() if m else end
            if stop > at and self.cut[stack[-1]] < 2:
                parts.append(text[at:stop])
                if linked:
                    links.append(text[at:stop])
            if not m:
                break
            at = m.end()
            tag = m[2]
            if tag is None:
                continue
            tag = tag.lower()
            if m[1]:
                if tag == "a":
                    linked = max(0, linked - 1)
                elif tag in _BLOCKS and standing[tag]:
                    for i in range(len(stack) - 1, 0, -1):
                        if self.tags[stack[i]] == tag:
                            flush()
                            drop(i)
                            break
                        if tag == "p" and self.tags[stack[i]] in _BOUNDARY:
                            break
                if tag in _BLOCKS:
                    linked = 0
                continue
            if tag in _RAW:
                if m[3].rstrip().endswith("/"):
                    continue
                close = _CLOSE[tag].search(text, at) if tag not in unclosed else None
                if close:
                    at = close.end()
                elif tag in _DRAWN:
                    unclosed.add(tag)  # nor is a later one of this tag closed
                else:
                    at = end
                continue
            if tag in _SPACED:
                parts.append(" ")
            if tag == "a":
                linked += 1
            if tag not in _BLOCKS:
                continue
            flush()
            linked = 0
            if tag in _VOID:
                continue
            if self.tags[stack[-1]] == "p" or self.tags[stack[-1]] in _HEADINGS and tag in _HEADINGS:
                drop(len(stack) - 1)
            for i in range(len(stack) - 1, 0, -1) if tag in _ENDS else ():
                open_tag = self.tags[stack[i]]
                if open_tag in _ENDS.get(tag, ()):
                    drop(i)
                    break
                if open_tag in _BOUNDARY:
                    break
            stack.append(self._open(tag, m[3], stack[-1]))
            standing[tag] += 1
        flush()


def _density(links: int, size: int) -> float:
    return links / size if size else 0.0


def extract(page: str) -> str:
    """The main text of a page."""
    tree = _Page(page)
    for cut, names in ((1, True), (1, False), (2, False)):
        found = _container_text(tree, cut, names)
        if found:
            return found
    # no text of any length: whatever blocks there are, without those that are ruled out if that leaves some
    blocks = [(node, b) for node, b, _ in tree.blocks]
    marked = _marked(tree, 0)
    for fit in (lambda i: not tree.cut[i] and not marked[i], lambda i: not tree.cut[i], lambda i: True):
        if kept := [b for node, b in blocks if fit(node)]:
            return "\n".join(kept)
    return ""


def _marked(tree: _Page, top: int) -> list[bool]:
    """Whether the names of an element, or of one between it and ``top``, mark it."""
    out = [False] * len(tree.tags)
    for i in range(top + 1, len(out)):
        out[i] = tree.marked[i] or out[tree.parents[i]]
    return out


def _container_text(tree: _Page, cut: int, names: bool) -> str:
    """The text of the best container, empty where no element has points; elements are ruled out from the level ``cut`` on."""
    n = len(tree.tags)
    out = [tree.cut[i] >= cut for i in range(n)]
    sizes, links = [0] * n, [0] * n
    for node, block, inside in tree.blocks:
        if not out[node]:
            sizes[node] += len(block)
            links[node] += inside
    for i in range(n - 1, 0, -1):
        sizes[tree.parents[i]] += sizes[i]
        links[tree.parents[i]] += links[i]
    menus = [tree.tags[i] in ("ul", "ol") and tree.items.get(i, 0) >= MENU_ITEMS and _density(links[i], sizes[i]) >= MENU_LINKS for i in range(n)]
    for i in range(1, n):
        menus[i] = menus[i] or menus[tree.parents[i]]
    blocks = [b for b in tree.blocks if not menus[b[0]] and not out[b[0]]]
    doubtful = _marked(tree, 0) if names else [False] * n
    points = [0.0] * n
    for node, block, inside in blocks:
        if len(block) < 25 or tree.tags[node] in _HEADINGS:
            continue
        worth = 1 + block.count(",") + block.count("，") + min(len(block) / 100, 3)
        # text of a paragraph counts for what holds the paragraph, text that stands in a container for the container
        up = tree.parents[node] if tree.tags[node] in ("p", "pre", "li", "dd", "dt", "blockquote", "figcaption", "tr", "summary", "caption") else node
        points[up] += worth * (MARKED if doubtful[node] else 1)
    for i in range(n - 1, 0, -1):
        points[tree.parents[i]] += points[i] / 2
    best, most = -1, 0.0
    scored = [p > 0 for p in points]
    for i in range(1, n):
        if out[i] or menus[i] or not sizes[i] or not (scored[i] or tree.tags[i] in _ARTICLES):
            continue
        points[i] = (points[i] + tree.bonus[i] * (MARKED if doubtful[i] else 1)) * (1 - _density(links[i], sizes[i]))
        if best < 0 or points[i] > most:
            best, most = i, points[i]
    if best < 0:
        return ""
    keep = [False] * n
    keep[best] = True
    limit = max(10.0, most * 0.2)
    for i in range(1, n):
        if i != best and tree.parents[i] == tree.parents[best] and tree.parents[i] > 0 and tree.tags[best] != "body":
            low = _density(links[i], sizes[i])
            if scored[i] and points[i] >= limit and not out[i] and not (names and tree.marked[i]):
                keep[i] = True
            elif tree.tags[i] == "p" and not tree.inside[best] and sizes[i] > 80 and low < 0.25:
                keep[i] = True
    # within what is kept, marked parts go; marks of what is above do not count
    for i in range(1, n):
        keep[i] = keep[i] or (tree.parents[i] > 0 and keep[tree.parents[i]] and not (names and tree.marked[i]))
    return "\n".join(b for node, b, _ in blocks if keep[node])


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Per row of ``pages``: page_id, url, text, n_chars (code points)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [extract(p) if p else "" for p in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(page).cast("string").alias("html"))
    return rows.mapInArrow(over_texts(run, "html"), "page_id long, url string, text string, n_chars long")
