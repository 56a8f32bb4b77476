"""Main text of web pages by composite text density (after Sun, Song and Liao, 2011).

Every node of a page's tree has a density: its characters per tag, scaled by how much of them stands in links, here and in
the whole body. The sum of its children's densities is a node's density sum; the node with the greatest one is the core of
the article. The least density on the path from it up to the body is the threshold: a subtree counts as content if its
density reaches it. Of an article or main element that holds the core, all is content but its menus: blocks under the
threshold that hold three links or more and next to no other text.

Elements that are furniture by their name or role are no part of the tree. Those that are by a word of their class or id
neither, unless they turn out to hold the article: most of the unlinked text of all article and main elements or, on a page
without, of the body. A discussion may be longer than its article, so on such a page it stays only if nothing else is left.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.llm.tables import slices, texts_of

#: A comment, the start of a tag, or another declaration.
_TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)|<[!?/][^>]*+>""", re.S)
#: The rest of a tag with its quoted values.
_REST = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
_MARK = re.compile(r"""[>"']""")
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|([^\s=/>"']+)""")
_UNENDED = re.compile(r"<[a-zA-Z/!?]")

_VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody tfoot thead tr ul".split()
)
#: Start tags that end an open element of the second set, unless one of the third stands between.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
_KEEPS_P = {"table", "td", "th", "caption", "button", "object", "html"}
#: Elements, roles and words of a class or id that mark furniture.
_FURNITURE = frozenset("nav footer aside form button select datalist dialog noscript template svg canvas audio video menu search head".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu menubar breadcrumb breadcrumbs"
    " sidebar footer cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup login share sharing social"
    " related recommended recommendations comment comments commentlist disqus respond replies pagination pager toolbar widget skip".split()
)
#: Words of discussions, and parts of a class that tell about a word and not what the element is (has-sidebar, comments-open).
_DISCUSSION = frozenset("comment comments commentlist disqus respond replies".split())
_ABOUT = re.compile(r"(?<![a-z])(?:has|no|not|with|without)[-_]+[a-z]+(?:[-_]+[a-z]+)*|(?<![a-z])[a-z]++(?:[-_]+status)?[-_]+(?:open|closed|enabled|disabled)(?![a-z])")


def _attributes(rest: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(rest):
        found.setdefault((m[1] or m[5]).lower(), m[2] or m[3] or m[4] or "")
    return found


def _furniture(tag: str, rest: str, in_article: bool) -> tuple[bool, frozenset[str]]:
    """Whether an element is furniture whatever it holds, and the words of its class or id that say so otherwise."""
    none: frozenset[str] = frozenset()
    if tag in _FURNITURE or tag == "header" and not in_article:
        return True, none
    if tag in ("html", "body", "main") or tag == "article" and not re.search(r"comment", rest, re.I) or not rest.strip(" /\t\n\r"):
        return False, none
    own = _attributes(rest)
    if "hidden" in own or own.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", own.get("style", ""), re.I):
        return True, none
    names = re.sub(r"([a-z])([A-Z])", r"\1-\2", f"{own.get('class', '')} {own.get('id', '')}").lower()
    return own.get("role", "").lower() in _ROLES, _WORDS.intersection(re.findall(r"[a-z]+", _ABOUT.sub(" ", names)))


class _Page:
    """Nodes in page order (parents before children) and the texts and block ends between them."""

    def __init__(self, source: str):
        self.tag, self.parent, self.cut = ["#"], [-1], [False]
        self.named: list[frozenset[str]] = [frozenset()]  # furniture words of the node's class or id
        self.events: list[tuple[int, str] | None] = []  # (node, text), or None at the edge of a block
        self._open = [0]
        self._places: defaultdict[str, list[int]] = defaultdict(list)  # places in _open, by tag
        self._walls = [0]  # and of blocks and cells
        self._read(source)
        if any(self.named):
            self._cut_named()

    def _text(self, text: str) -> None:
        if text and not self.cut[self._open[-1]]:
            self.events.append((self._open[-1], html.unescape(text) if "&" in text else text))

    def _cut_named(self) -> None:
        """Cut what a class or id calls furniture, but not what holds the article."""
        n = len(self.tag)
        in_link, in_article, in_named = [False] * n, [False] * n, [False] * n
        for k in range(1, n):
            up = self.parent[k]
            in_link[k] = in_link[up] or self.tag[k] == "a"
            in_named[k] = in_named[up] or bool(self.named[k])
            in_article[k] = not self.named[k] and (in_article[up] or self.tag[k] in ("article", "main"))
        # Unlinked characters of each subtree: all, those of articles, and those in no named element.
        plain, article, free = [0] * n, [0] * n, 0
        for event in self.events:
            if event and not in_link[event[0]] and not self.cut[event[0]]:
                size = len("".join(event[1].split()))
                plain[event[0]] += size
                article[event[0]] += size * in_article[event[0]]
                free += size * (not in_named[event[0]])
        for k in range(n - 1, 0, -1):
            plain[self.parent[k]] += plain[k]
            article[self.parent[k]] += article[k]
        for k in range(1, n):
            if self.named[k] and not self.cut[k]:
                holds = 2 * article[k] > article[0] if article[0] else 2 * plain[k] > plain[0]
                if not self.named[k].isdisjoint(_DISCUSSION):
                    most = 2 * plain[k] > plain[0]
                    holds = most and (not free or self.tag[k] == "article" and not article[0] or bool(article[0]) and holds)
                self.cut[k] = not holds
            self.cut[k] = self.cut[k] or self.cut[self.parent[k]]
        self.events = [e for e in self.events if e is None or not self.cut[e[0]]]

    def _last(self, tags: set[str]) -> int:
        """Place of the last open element of ``tags``; 0 if none is open."""
        return max((self._places[t][-1] for t in tags if self._places[t]), default=0)

    def _close(self, ends: set[str], wall: int) -> None:
        """Close the last open element of ``ends`` with all it holds, unless an element that stops it stands behind it."""
        place = self._last(ends)
        if place and place >= wall:
            for node in self._open[place:]:
                self._places[self.tag[node]].pop()
            del self._open[place:]
            while self._walls[-1] >= place:
                self._walls.pop()

    def _start(self, tag: str, rest: str) -> None:
        if tag in _BLOCK:
            self.events.append(None)
            self._close({"p"}, self._last(_KEEPS_P) if self._places["p"] else 0)
        if tag in _ENDS:
            ends, stops = _ENDS[tag]
            self._close(ends, self._last(stops))
        if tag in ("br", "td", "th", "wbr"):
            self._text("" if tag == "wbr" else " ")
        if tag in _VOID:
            return
        if tag in ("html", "body") and self._places[tag]:
            return
        above = self._open[-1]
        if tag == "body":
            self._close({"head"}, 0)
            above = self._open[-1]
        inside = bool(self._places["article"] or self._places["main"])
        self.tag.append(tag)
        self.parent.append(above)
        furniture, named = _furniture(tag, rest, inside)
        self.cut.append(self.cut[above] or furniture)
        self.named.append(named)
        self._places[tag].append(len(self._open))
        if tag in _BLOCK or tag in ("td", "th"):
            self._walls.append(len(self._open))
        self._open.append(len(self.tag) - 1)

    def _end(self, tag: str) -> None:
        if tag in _BLOCK:
            self.events.append(None)
        if tag not in ("html", "body"):
            # An inline end tag does not reach out of its block.
            self._close({tag}, 0 if tag in _BLOCK else self._walls[-1])

    def _read(self, source: str) -> None:
        """Tags in page order. Each is read a bounded number of times, whatever its quotes, so the work grows with the page."""
        at, last, ends = 0, source.rfind(">"), None
        while (m := _TOKEN.search(source, at)) is not None and m.start() < last:
            self._text(source[at : m.start()])
            at = m.end()
            if not m["tag"]:
                continue
            tag, begin = m["tag"].lower(), at
            if ends is None:
                rest = _REST.match(source, begin)
                if rest is None:  # a quote never ends; from here on ends of tags are looked up
                    ends = _tag_ends(source, begin)
                else:
                    at = rest.end()
            if ends is not None:
                place = bisect_left(ends[0], begin)
                at = ends[1][place] if place < len(ends[1]) and ends[1][place] else source.index(">", begin) + 1
            if m["end"]:
                self._end(tag)
            elif tag in _RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(source, at)
                at = end.end() if end else len(source)
            else:
                self._start(tag, source[begin : at - 1])
        rest = source[at:]
        unended = _UNENDED.search(rest)
        self._text(rest[: unended.start()] if unended else rest)


def _tag_ends(source: str, begin: int) -> tuple[list[int], list[int]]:
    """Places of quotes and > from ``begin`` on, and the end of a tag whose first such mark this is; 0 if its quotes leave none."""
    places = [m.start() for m in _MARK.finditer(source, begin)]
    ends = [0] * len(places)
    plain = double = single = 0  # the end from here on: outside of quotes, within double ones, within single ones
    for k in range(len(places) - 1, -1, -1):
        mark = source[places[k]]
        if mark == ">":
            plain = places[k] + 1
        elif mark == '"':
            plain, double = double, plain
        else:
            plain, single = single, plain
        ends[k] = plain
    return places, ends


def _densities(page: _Page) -> tuple[list[float], list[float], list[bool], int]:
    """Density and density sum of each node, whether it is a block of links, and the body."""
    n = len(page.tag)
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    in_link = [False] * n
    for k in range(1, n):
        in_link[k] = in_link[page.parent[k]] or page.tag[k] == "a"
    for event in page.events:
        if event:
            node, text = event
            size = len(text) if not text[:1].isspace() and not text[-1:].isspace() else len(text.strip())
            chars[node] += size
            link_chars[node] += size * in_link[node]
    for k in range(n - 1, 0, -1):
        if not page.cut[k]:
            up = page.parent[k]
            chars[up] += chars[k]
            link_chars[up] += link_chars[k]
            tags[up] += tags[k] + 1
            link_tags[up] += link_tags[k] + (page.tag[k] == "a")
    body = next((k for k in range(n) if page.tag[k] == "body"), 0)
    linked = link_chars[body] / max(chars[body], 1)
    density, sums = [0.0] * n, [0.0] * n
    for k in range(n - 1, -1, -1):
        if chars[k] and not page.cut[k]:
            c, t, lc, lt = chars[k], max(tags[k], 1), max(link_chars[k], 1), max(link_tags[k], 1)
            base = math.log(c / max(c - link_chars[k], 1) * link_chars[k] + linked * c + math.e)
            density[k] = c / t * (math.log(max(c / lc * t / lt, 1)) / math.log(base) if base > 1 + 1e-9 else 1.0)
            if k:
                sums[page.parent[k]] += density[k]
    menu = [page.tag[k] in _BLOCK and link_tags[k] >= 3 and 5 * link_chars[k] > 4 * chars[k] for k in range(n)]
    return density, sums, menu, body


def main_text(source: str) -> str:
    """Main text of one page: blocks in page order, each in one line; empty if the page has none."""
    page = _Page(source)
    density, sums, menu, body = _densities(page)
    n = len(page.tag)
    inside = [False] * n
    for k in range(n):
        inside[k] = k == body or k > 0 and inside[page.parent[k]]
    core = max((k for k in range(n) if inside[k] and not page.cut[k]), key=lambda k: (sums[k], -k), default=body)
    path = [core]
    while path[-1] != body:
        path.append(page.parent[path[-1]])
    threshold, on_path = min(density[k] for k in path), set(path)
    holder = next((k for tag in ("article", "main") for k in reversed(path) if page.tag[k] == tag), None)
    content = [False] * n
    for k in range(n):
        if inside[k] and not page.cut[k]:
            above = k > 0 and content[page.parent[k]] and not (holder is not None and menu[k] and density[k] < threshold and k not in on_path)
            own = k == holder if holder is not None else k in (core, body) and (k == core or not sums[k]) or density[k] >= threshold and k not in on_path
            content[k] = above or own
    if not sums[core]:
        content[body] = True
    blocks, current = [], []
    for event in [*page.events, None]:
        if event is None:
            if current:
                blocks.append(" ".join("".join(current).split()))
                current = []
        elif content[event[0]]:
            current.append(event[1])
    return "\n".join(b for b in blocks if b)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` per row of ``pages``.

    A null page is empty and has the empty text; null ids and addresses stay null. Unended tags, comments and elements end
    with the page. Repeated rows stay; an empty table gives none; other columns are ignored.
    """
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [main_text(t) for t in texts_of(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema=schema)

    whole = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return whole.mapInArrow(extract, "page_id long, url string, text string, n_chars long")
