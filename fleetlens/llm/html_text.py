"""Main text of HTML pages: parser events, text-to-tag ratio per line, Gaussian smoothing, threshold clustering.

1.  The standard library's parser reads a page as a stream of events.  Block elements end a *line*; a line has its text and
    the number of tags in it.  What shows no text (scripts, styles, controls, ...) is left out.
2.  A line's ratio is its characters, without spaces and without those of links, per tag.  Ratios are smoothed over
    neighbouring lines by a Gaussian kernel; lines whose smoothed ratio reaches the page's threshold (its standard deviation,
    at most its mean) are content clusters.
3.  Elements that by their name or by a word of their class, id or role may be no content (navigation, forms, adverts, ...)
    are doubtful.  What they hold of the clusters decides, where it can:
    * navigation, page footers and reader comments go, and so does whatever is doubtful beside an `article` or `main`;
    * an element whose class merely has such a word among others goes, inside an `article`, if none of its lines is a
      cluster's; beside one, or on a page without any, if it holds no more than half of the clusters' text;
    * others go if they hold no more than half of it.
    An element with an `article` or `main` inside doesn't go; those within reader comments don't count as such.
4.  The clusters select the region: `main`, else the outermost `article`, else the innermost container, that holds all of
    them.  All its lines are the result, so that neither a cluster nor short lines between, before and after long ones are lost.
5.  Outside of `article` and `main` names may tell nothing.  Elements that are mostly links, and lines on copyright or cookies
    beside the container with most of the clusters' text, are no content there.

White space inside a line is one space, lines are joined by one space.  Null, empty and textless pages give an empty text;
repeated pages give repeated rows.  Unclosed elements end with their parent; stray end tags are ignored; a comment or tag
that the page doesn't end lasts to the page's end, as in browsers.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fleetlens.llm.common import ship

# Names of HTML elements, and words that authors give to what is no content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rt rp s samp small span strike "
    "strong sub sup time tt u var wbr img br".split()
)
NEVER = frozenset("head script style noscript template button select option textarea iframe object svg canvas video audio map".split())
#: No content wherever they are; and those of which the text may say otherwise.
EDGES = frozenset("nav footer dialog menu".split())
SELDOM = frozenset("aside form".split())
#: Elements that can be the region: a single paragraph, list, table, quotation or section can hold all clusters, but what holds it
#: is the region.
CONTAINERS = frozenset(["", "html", "body", "div", "article", "main", "center"])
#: They open a line of their own only at these names if an element of the same name is open.
SELF_CLOSING = {"body": {"head"}, "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_SCOPES = frozenset("ul ol dl table body article main section div td th".split())
_P_ENDERS = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section "
    "table ul".split()
)
NO_CONTENT = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense adbox banner sponsor sponsored promo promos promotion "
    "promotions menu nav navbar navigation breadcrumb breadcrumbs sidebar widget widgets footer masthead cookie cookies consent gdpr "
    "notice notices notification popup modal newsletter subscribe subscription share sharing social related recommended "
    "pagination pager toolbar login signup search".split()
)
COMMENTS = frozenset("comment comments commentlist respond reply replies disqus".split())
#: Words that say nothing beside those above.
NEUTRAL = frozenset(
    "box block container wrapper wrap area section list item items inner outer top bottom left right header head title links link "
    "button buttons icons icon bar panel main site page content side row col column text form posts articles post global primary "
    "secondary thread reader user".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
_NAME_PARTS = re.compile(r"[a-z]+|[A-Z]+[a-z]*|\d+")
_COPYRIGHT = re.compile(r"(?:©|\(c\) ?\d|copyright\b)", re.IGNORECASE)
_COOKIES = re.compile(r"\bcookies?\b", re.IGNORECASE)
#: Share of an element's characters that links have if it is a menu.
LINKED = 0.6
#: Standard deviation of the smoothing kernel, in lines.
SIGMA = 1.0

#: Pieces of a line's text with the number of the element they stand in, tags, and the number of the element the line ends in.
Line = tuple[list[tuple[str, int]], int, int]


class _Reader(HTMLParser):
    """Lines outside of what is never content, and the numbers of the elements that seldom are (`doubtful`).

    Elements are numbered as they begin, so an element's descendants are the numbers up to its `last` one.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool]] = [("", 0, False)]  # name, number, left out
        self.open_names: Counter[str] = Counter()
        self.names, self.parents, self.last = [""], [0], [0]
        self.doubtful: list[tuple[int, str]] = []
        self.lines: list[Line] = []
        self.parts: list[tuple[str, int]] = []
        self.tags = 0

    def _end_line(self):
        if any(not part.isspace() for part, _ in self.parts):
            self.lines.append((self.parts, self.tags, self.open[-1][1]))
        self.parts, self.tags = [], 0

    def _close(self, index: int):
        if any(name not in INLINE for name, _, _ in self.open[index:]):
            self._end_line()
        for name, number, _ in self.open[index:]:
            self.open_names[name] -= 1
            self.last[number] = len(self.names) - 1
        del self.open[index:]

    def _implied_end(self, tag: str):
        """Elements that `tag` ends though their end tag is missing."""
        ended = set(SELF_CLOSING.get(tag, ())) | ({"p"} if tag in _P_ENDERS else set())
        for i in range(len(self.open) - 1, 0, -1):
            name = self.open[i][0]
            if name in ended:
                self._close(i)
                return
            if name in _SCOPES:
                return

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.parts.append((" ", self.open[-1][1]))
        if tag in VOID:
            if tag == "hr":
                self._end_line()
            self.tags += 1
            return
        if tag not in INLINE:
            self._implied_end(tag)
            self._end_line()
        named = dict(attrs)
        out = self.open[-1][2] or tag in NEVER or "hidden" in named
        if not out and (doubt := self._doubt(tag, named)):
            self.doubtful.append((len(self.names), doubt))
        self.parents.append(self.open[-1][1])
        self.open.append((tag, len(self.names), out))
        self.open_names[tag] += 1
        self.names.append(tag)
        self.last.append(0)
        self.tags += 1

    def _doubt(self, tag: str, named: dict[str, str | None]) -> str | None:
        """Why an element may be no content: edge, comments, seldom, named, or partly (named so by one word among others)."""
        role = (named.get("role") or "").lower()
        if tag in EDGES or role in ("navigation", "contentinfo", "menu", "menubar"):
            return "edge"
        # A page's own header; that of an article holds its title.
        own_header = tag == "header" and not (self.open_names["article"] or self.open_names["main"])
        doubt = "seldom" if own_header or tag in SELDOM or role in ROLES else None
        if tag in ("html", "body", "main") or not named:
            return doubt
        for token in f"{named.get('class') or ''} {named.get('id') or ''}".split():
            words = {part.lower() for part in _NAME_PARTS.findall(token)}
            known = all(word in NO_CONTENT or word in COMMENTS or word in NEUTRAL or word.isdigit() for word in words)
            if words & COMMENTS and known:
                return "comments"
            if words & (NO_CONTENT | COMMENTS) and tag != "article":
                doubt = "named" if known else doubt or "partly"
        return doubt

    def updatepos(self, i: int, j: int) -> int:
        return j  # line numbers aren't used

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if not self.open_names[tag]:
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == tag:
                self.tags += 1
                self._close(i)
                return

    def handle_data(self, data):
        if not self.open[-1][2]:
            self.parts.append((data, self.open[-1][1]))

    def finish(self):
        self.close()
        self._end_line()
        self._close(0)


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Weighted means over neighbouring lines; beyond the ends there is nothing to weigh."""
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    total = np.convolve(ratios, kernel)[reach : reach + len(ratios)]
    return total / np.convolve(np.ones(len(ratios)), kernel)[reach : reach + len(ratios)]


def content_lines(lines: list[tuple[int, int]]) -> np.ndarray:
    """Which lines, of so many characters and tags each, are in a content cluster."""
    smooth = smoothed(np.array([chars / max(tags, 1) for chars, tags in lines]))
    return smooth >= min(smooth.std(), smooth.mean())


class _Page:
    """A page's lines and, by element, sums over what it contains."""

    def __init__(self, html: str):
        self.tree = _Reader()
        self.tree.feed(_ended(html))
        self.tree.finish()
        self.names, self.parents = self.tree.names, self.tree.parents
        self.lines = self.tree.lines
        self.linked = self._down([name == "a" for name in self.names])
        comments = [False] * len(self.names)
        for number, doubt in self.tree.doubtful:
            comments[number] = doubt == "comments"
        comments = self._down(comments)
        marks = [name in ("article", "main") for name in self.names]
        own = [mark and not c for mark, c in zip(marks, comments)]
        self.marks = own if any(own) else marks
        self.inside = self._down(self.marks)

    def _down(self, flags: list[bool]) -> list[bool]:
        """Flags of elements, and of all they contain."""
        flags = list(flags)
        for number in range(1, len(flags)):  # parents come before their children
            flags[number] |= flags[self.parents[number]]
        return flags

    def up(self, weight: list[int]) -> list[int]:
        """The weights of elements with those of all they contain."""
        for number in range(len(weight) - 1, 0, -1):
            weight[self.parents[number]] += weight[number]
        return weight

    def chars(self, line: Line, out: list[bool]) -> tuple[int, int]:
        """A line's characters, without spaces, and those outside of links."""
        of = [("".join(part.split()), number) for part, number in line[0] if not out[number]]
        return sum(len(part) for part, _ in of), sum(len(part) for part, number in of if not self.linked[number])

    def clusters(self, out: list[bool]) -> tuple[list[bool], list[int]]:
        """Which lines are clusters', without what is left out; and by element the characters of these lines."""
        counts = [self.chars(line, out) for line in self.lines]
        shown = [i for i, (n, _) in enumerate(counts) if n]
        chosen, weight = [False] * len(self.lines), [0] * len(self.names)
        if shown:
            for i, is_content in zip(shown, content_lines([(counts[i][1], self.lines[i][1]) for i in shown])):
                chosen[i] = bool(is_content) and counts[i][1] > 0
        if shown and not any(chosen):  # nothing but links
            chosen = [n > 0 for n, _ in counts]
        for line, is_content in zip(self.lines, chosen):
            for part, number in line[0]:
                weight[number] += len("".join(part.split())) * (is_content and not out[number])
        return chosen, self.up(weight)

    def left_out(self) -> list[bool]:
        """By element, whether it goes for its name and what it holds of the clusters, with all it contains."""
        _, weight = self.clusters([False] * len(self.names))
        marked = self.up([int(mark) for mark in self.marks])
        text = [0] * len(self.names)
        for line in self.lines:
            text[line[2]] += 1
        text = self.up(text)
        beside = any(mark and text[number] for number, mark in enumerate(self.marks))
        out = [False] * len(self.names)
        for number, doubt in self.tree.doubtful:
            less = 2 * weight[number] <= weight[0]
            if marked[number] and not (self.marks[number] and doubt == "comments"):
                goes = False
            elif doubt in ("edge", "comments"):
                goes = True
            elif doubt == "partly":
                goes = not weight[number] if self.inside[number] else less
            else:
                goes = less or (beside and not self.inside[number])
            out[number] = goes
        return self._down(out)

    def menus(self, out: list[bool]) -> list[bool]:
        """Block elements outside of marked ones that are links mostly, two at least, and what they contain."""
        links = self.up([int(name == "a") for name in self.names])
        every, linked = [0] * len(self.names), [0] * len(self.names)
        for line in self.lines:
            for part, number in line[0]:
                n = len("".join(part.split())) * (not out[number])
                every[number] += n
                linked[number] += n * self.linked[number]
        every, linked = self.up(every), self.up(linked)
        marked = self.up([int(mark) for mark in self.marks])
        found = [
            name not in INLINE and links[number] > 1 and linked[number] >= LINKED * every[number] > 0
            and not (marked[number] or self.inside[number])
            for number, name in enumerate(self.names)
        ]
        return self._down(found) if not found[0] else [False] * len(self.names)


def _ended(html: str) -> str:
    """The page up to a comment or tag that it doesn't end: the parser would look for that end again and again."""
    comment = html.find("<!--", html.rfind("-->") + 1)
    if comment >= 0:
        html = html[:comment]
    tag = re.compile(r"</?[a-zA-Z]").search(html, html.rfind(">") + 1)
    return html[: tag.start()] if tag else html


def main_text(html: str | None) -> str:
    if not html:
        return ""
    page = _Page(html)
    out = page.left_out()
    menus = page.menus(out)
    out = [a or b for a, b in zip(out, menus)]
    chosen, weight = page.clusters(out)
    if not weight[0]:
        return ""
    last = page.tree.last
    holders = [number for number, of in enumerate(weight) if of == weight[0]]
    mains = [number for number, name in enumerate(page.names) if name == "main" and page.marks[number] and weight[number]]
    marked = mains or [number for number in holders if page.marks[number]]
    # Elements that hold all clusters lie inside each other: the first one is the outermost.
    region = min(marked) if marked else max(number for number in holders if page.names[number] in CONTAINERS)
    # The container with most of the clusters' text; on one line beside it may be what every page has.
    heaviest = max((number for number, of in enumerate(weight) if 2 * of > weight[0] and page.names[number] in CONTAINERS), default=0)
    lines = []
    for parts, _, number in page.lines:
        if not region <= number <= last[region]:
            continue
        text = " ".join("".join(part for part, of in parts if not out[of]).split())
        apart = not (page.inside[number] or heaviest <= number <= last[heaviest])
        if text and not (apart and (_COPYRIGHT.match(text) or _COOKIES.search(text))):
            lines.append(text)
    return " ".join(lines)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per page."""
    ship(pages.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html) for html in batch.column("html").to_pylist()]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())]
            columns.append(pa.array([len(text) for text in texts], pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(*[pages[name].alias(name) for name in ("page_id", "url", "html")])
    return rows.mapInArrow(read, f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")
