"""Main text of web pages by line-block distribution.

1. Strip markup: elements that hold no prose (scripts, styles, menus, page headers, footers,
   sidebars, forms) and containers whose class, id or role names an advert, notice, comment list
   and the like go with all they contain; what is left becomes one line for each block
   element, with character references decoded and white space turned into one space.
   Leaving or entering a container, or leaving out an element, leaves ``WINDOW`` empty lines, as its markup would.
2. Sum text lengths (link text does not count) over windows of ``WINDOW`` lines of the whole page.
3. A stretch is where lines follow each other without ``WINDOW`` empty ones: the text rises from nothing at its start and falls back to
   nothing at its end.  It surges where a window's sum reaches ``SURGE``.  Text is kept from the first surging stretch to
   the dive after the last one.  On pages where nothing surges, the stretch with the most text counts as the surge.
4. Ties of containers decide what belongs to a surge: if an ``article`` or ``main`` element has one, all stretches of such elements
   that have one are kept, whole, and the rest of the page is not.  Elsewhere stretches of the same innermost container as a surge are
   kept like it, and headings right before the first.

Class, id and role names count for containers only (an element such as ``h2`` or ``p`` is never left out for its name), and only where every word
of a name tells of something other than the article or of the layout (``cookie-banner``, ``site-footer``; not ``search-trees``).

Defined results: null or empty html, or html without prose (link text alone is none), gives an empty text and 0; each repeated
row gives a result of its own; unclosed elements end with their parent; a truncated tag at the
end is markup; a quote that is never closed ends with its tag.  Whole pages are read, whatever their length, in time in proportion to it.
"""

from __future__ import annotations

import html as htmllib
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from aerolith.llm.common import table

WINDOW = 3
#: Characters of prose in a window from which it is a surge.
SURGE = 80

# Element names of the HTML standard by their role here.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
NO_PROSE = {"head", "nav", "footer", "aside", "form", "button", "select", "option", "menu", "dialog", "svg", "math",
            "object", "audio", "video", "canvas", "map", "datalist", "fieldset"}
CONTAINER = {"article", "main", "section", "div", "body", "header", "table", "ul", "ol", "dl", "hgroup"}
BLOCK = CONTAINER | {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "tr", "caption", "thead", "tbody", "tfoot",
                     "blockquote", "pre", "figure", "figcaption", "address", "details", "summary", "hr", "center", "html"}
#: Elements that an opening tag of the same kind (or of the block kinds, for p) ends.
CLOSES_ITSELF = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
                 "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Words in a class, id or role that mark an element as something other than the article.
HINTS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored", "promo",
         "promotion", "banner", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup", "modal",
         "overlay", "nav", "navbar", "navigation", "menu", "menubar", "breadcrumb", "breadcrumbs", "sidebar", "aside",
         "footer", "masthead", "topbar", "toolbar", "comment", "comments", "commentlist", "disqus", "replies", "respond",
         "share", "sharing", "social", "newsletter", "subscribe", "subscription", "signup", "login", "related", "widget",
         "widgets", "pagination", "pager", "skip", "search", "contentinfo", "complementary", "dialog", "form", "copyright",
         "legal", "disclaimer", "paywall", "recommended", "trending"}
#: Words of class names that tell of the layout and not of what an element holds.
LAYOUT = {"site", "page", "global", "main", "post", "article", "top", "bottom", "left", "right", "center", "box", "wrap", "wrapper", "container",
          "block", "area", "section", "bar", "list", "item", "items", "slot", "unit", "inner", "outer", "text", "content", "panel", "primary",
          "secondary", "header", "js", "id", "col", "row", "group", "zone", "region", "large", "small", "icons", "links", "buttons", "button"}
#: Elements that hold the article, whatever their class names.
NEVER_DROPPED = {"html", "body", "main"}
#: Elements that hold the article or a part of it.
HOMES = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

_START = re.compile(r"<(?:!--|[!?]|/?[a-zA-Z])")
_NAME = re.compile(r"[^\s/>]+")
_STOP = re.compile(r">|=\s*([\"'])")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SLASH_OF_VALUE = re.compile(r"=\s*[^\s\"'>]*/$")  # href=/ without quotes: the slash does not close the element
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)


def _tags(page: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """Start, end, whether it closes, name and attributes of each tag; comments and declarations have no name."""
    at, size, never = 0, len(page), set()
    while found := _START.search(page, at):
        start = found.start()
        name, attributes, closes = "", "", False
        if found[0] == "<!--":
            end = page.find("-->", start + 4) + 3
            at = end if end > 2 else size
        elif found[0] in ("<!", "<?"):
            at = page.find(">", start) + 1 or size
        else:
            closes = found[0][1] == "/"
            word = _NAME.match(page, start + 1 + closes)
            name, pos, end = word[0].lower(), word.end(), -1
            while end < 0:
                stop = _STOP.search(page, pos)
                if not stop:
                    end = size
                elif not stop[1]:
                    end = stop.start()
                else:  # a value in quotes may hold anything; one that is never closed ends with the tag
                    close = -1 if stop[1] in never else page.find(stop[1], stop.end())
                    if close < 0:
                        never.add(stop[1])
                        end = page.find(">", word.end())
                        end = size if end < 0 else end
                    pos = close + 1
            attributes, at = page[word.end():end], min(end + 1, size)
        yield start, at, closes, name, attributes


def _is_other(name: str, attributes: str, in_article: bool) -> bool:
    """Does this element hold something other than the article?"""
    if name in NO_PROSE or name == "header" and not in_article:
        return True
    if not attributes or name in NEVER_DROPPED:
        return False
    if _HIDDEN.search(attributes):
        return True
    if name not in CONTAINER:
        return False
    for value in _NAMES.findall(attributes):
        for token in value.strip("\"'").split():
            pieces = [p.lower() for p in _PIECES.findall(token)]
            if any(p in HINTS or p == "header" and not in_article for p in pieces) and all(p in HINTS or p in LAYOUT for p in pieces):
                return True
    return False


class Lines:
    """The lines of a page (empty ones mark borders), in step: text, length of its link text, number of the outermost article or main
    element (0: none) and of the innermost container that it lies in, and whether it is a heading."""

    def __init__(self) -> None:
        self.text: list[str] = []
        self.link: list[int] = []
        self.home: list[int] = []
        self.box: list[int] = []
        self.heading: list[bool] = []

    def add(self, text: str, link: int, home: int, box: int, heading: bool) -> None:
        self.text.append(text)
        self.link.append(link)
        self.home.append(home)
        self.box.append(box)
        self.heading.append(heading)


def to_lines(page: str) -> Lines:
    lines = Lines()
    parents = [0]
    box = 0
    text: list[str] = []
    link = 0  # link text in this line
    prose: list[str] = []  # and the pieces of it outside links
    stack: list[str] = []
    count: Counter = Counter()  # of the names in the stack
    marks: list[int] = []  # where the stack has blocks, cells and options
    home = n_homes = 0
    depth_of_home = dropped_at = -1  # stack depths; -1: not inside

    def end_line(border: bool) -> None:
        nonlocal link
        line = " ".join(htmllib.unescape("".join(text)).split())
        text.clear()
        if link and not htmllib.unescape("".join(prose)).strip():
            link = len(line)  # space between links is no prose
        prose.clear()
        if line:
            lines.add(line, link, home, box, any(count[h] for h in HEADINGS))
        link = 0
        if border and lines.text and lines.text[-1]:
            for _ in range(WINDOW):
                lines.add("", 0, home, box, False)

    def add(piece: str) -> None:
        nonlocal link
        text.append(piece)
        if count["a"]:
            link += len(piece)
        else:
            prose.append(piece)

    def pop_to(depth: int) -> None:
        nonlocal dropped_at, home, depth_of_home, box
        while len(stack) > depth:
            name = stack[-1]
            if dropped_at < 0 and name in BLOCK:
                end_line(name in CONTAINER)  # a heading's line ends inside it
            stack.pop()
            count[name] -= 1
            if marks and marks[-1] == len(stack):
                marks.pop()
            if dropped_at == len(stack):
                dropped_at = -1
                text.append(" ")
            elif dropped_at < 0 and name in CONTAINER:
                box = parents[box]
            if depth_of_home == len(stack):
                end_line(True)
                home, depth_of_home = 0, -1

    at, size = 0, len(page)
    for start, end, closes, name, attributes in _tags(page):
        if start < at:  # inside an element that is left out as a whole
            continue
        if start > at and dropped_at < 0:
            add(page[at:start])
        at = end
        if not name:
            continue
        if closes:
            if count[name]:
                depth = len(stack) - 1
                while stack[depth] != name:
                    depth -= 1
                pop_to(depth)
            continue
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, at)
            at = size if not close else (page.find(">", close.start()) + 1 or size)
            continue
        if name in VOID or attributes.endswith("/") and not _SLASH_OF_VALUE.search(attributes):
            if dropped_at < 0:
                if name == "hr":
                    end_line(False)
                elif name == "br":
                    add(" ")
            continue
        ends = CLOSES_ITSELF.get(name, {"p"} if name in BLOCK else ())
        for depth in reversed(marks) if ends else ():
            if stack[depth] in ends:
                pop_to(depth)
                break
            if stack[depth] in BLOCK and not (stack[depth] in {"tr", "tbody", "thead", "tfoot"} and name in {"tr", "td", "th"}):
                break
        if dropped_at < 0:
            if name in BLOCK:
                end_line(name in CONTAINER)
            elif name in {"td", "th"}:
                text.append(" ")
            if _is_other(name, attributes, home > 0):
                dropped_at = len(stack)
            elif name in CONTAINER:
                parents.append(box)
                box = len(parents) - 1
            if dropped_at < 0 and name in HOMES and not home:
                n_homes += 1
                home, depth_of_home = n_homes, len(stack)
        if name in BLOCK or name in CLOSES_ITSELF:
            marks.append(len(stack))
        stack.append(name)
        count[name] += 1
    if at < size and dropped_at < 0:
        add(page[at:])
    pop_to(0)
    end_line(False)
    return lines


class Stretch(NamedTuple):
    """Lines start to end (without it), their prose, the largest windowed sum, home and container."""

    start: int
    end: int
    prose: int
    peak: int
    home: int
    box: int


def stretches(lines: Lines) -> list[Stretch]:
    """From rise to dive of the text: the windowed sums and the borders between which they are not zero."""
    length = np.array([max(0, len(x) - y) for x, y in zip(lines.text, lines.link, strict=True)], np.int64)
    there = np.array([bool(x) for x in lines.text])
    window = np.ones(WINDOW, np.int64)
    sums = np.convolve(length, window)[: len(length)]  # the last WINDOW lines
    present = np.convolve(there, window)[: len(length)] > 0
    edge = np.diff(present.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    out = []
    for start, end in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
        out.append(Stretch(start, end, int(length[start:end].sum()), int(sums[start:end].max()), lines.home[start], lines.box[start]))
    return out


def main_lines(lines: Lines) -> list[str]:
    """The lines of the surging stretches and of those tied to them."""
    if not lines.text:
        return []
    every = stretches(lines)
    if not any(s.prose for s in every):  # nothing, or link text only
        return []
    surges = [s for s in every if s.peak >= SURGE]
    if not surges:
        at_home = [s for s in every if s.home and s.prose]
        surges = at_home or [max(every, key=lambda s: (s.prose, -s.start))]
    homes = {s.home for s in surges if s.home}
    if homes:
        kept = [s for s in every if s.home in homes]
    else:
        boxes = {s.box for s in surges}
        own = [i for i, s in enumerate(every) if s in surges or s.prose and s.box in boxes]
        kept = every[own[0] : own[-1] + 1]
        start = kept[0].start
        while start and (lines.heading[start - 1] or not lines.text[start - 1]):
            start -= 1
        kept[0] = kept[0]._replace(start=start)
    return [x for s in kept for x in lines.text[s.start : s.end] if x]


def extract(page: str | None) -> str:
    return "\n".join(main_lines(to_lines(page))) if page else ""


def main_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with ``text`` (the main text of column ``html``) and ``n_chars`` in its place."""
    keep = [f for f in pages.schema.fields if f.name not in {html, "text", "n_chars"}]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keep), "text string", "n_chars long"])
    names = [f.name for f in keep]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = [extract(x.as_py()) for x in batch.column(html)]
            columns = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                [*names, "text", "n_chars"])

    return pages.select(*names, html).mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
