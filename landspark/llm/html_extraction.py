"""Main-text extraction from HTML by minimum cut.

A page is read into blocks of text, cut at block-level tags. For every block a linear
classifier gives the log-odds that it is content, from the tags and names of its
ancestors, its share of linked text, its length and its punctuation; these are terminal
capacities of a graph. No single sign is beyond what text and neighbours can outweigh, but
for what the page hides. Neighbours in page order, and nearest blocks under one parent,
are joined by smoothness edges, which are weak where one block has a sign of an aside that
the other lacks. A maximum flow finds the labelling of least total cost: blocks on the
source's side of the minimum cut are the main text. So a link or a short line amid
paragraphs is kept with them, and a sentence amid links goes with these. A page is one
row's work; nothing is shuffled, and the graph of a page has at most two edges per block.

Names are read token by token. A token of words for asides ("comments", "cookie-notice", "footer-wrapper")
counts in full; one with other words beside ("comments-on-theory", "ad-hoc-networks") by the
share of such words, and not at all as the id of a heading or section, where it is an anchor. A token
that says what the page has ("has-sidebar", "no-comments") says nothing of the element. An outermost article
or main part is not an aside by its id, nor if it has a name of main parts too.

Where the cut finds no content, the page is read once more: signs of layout ("menu", "sidebar", "header") that
lie on every block but those that other signs rule out are left out if three paragraphs of prose lie there, and failing that the likeliest
blocks without a sign of an aside are content, if they are not links.

The text of scripts, styles, titles, form controls and comments never forms a block.
Character references are decoded, white space within a block is one space, blocks are
joined by line feeds in page order. Null and blank pages, and pages without content, give
an empty text. Repeated pages give equal rows. Columns other than those named are ignored.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landspark.llm.common import small_batches

_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_UNREAD = frozenset("script style title template noscript textarea select option button svg annotation annotation-xml iframe object canvas audio video map datalist".split())
#: Start tags that end an open element of these names.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_MAIN_NAMES = frozenset("article main content post entry story articlebody maincontent".split())
_ASIDE_NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs masthead header footer sidebar aside complementary contentinfo ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login share sharing social related recommended recommendations trending outbrain taboola byline discussion discussions feedback comment comments reply replies respond disqus widget copyright toolbar pagination pager skip commentlist commentbox topnav mainnav subnav sidenav footernav adbox adslot adunit sharebar socialbar cookiebar cookiebanner".split()
)
#: Words that say nothing of their own beside those.
_PLAIN_NAMES = frozenset(
    "site page global main primary secondary top bottom left right inner outer box block container section area list item items link links head title body bar row col column group unit slot module panel form button btn text content post posts article articles story stories icon icons js buttons boxes blocks bars lists tabs tab thread threads user users reader readers visitor visitors author name date time meta info image img count number my our your sticky fixed floating mobile desktop small large new popular latest more news media toggle inline wide narrow half full layout wrapper wrappers wrap open closed is".split()
)
#: Before a word for asides, these say what a page has, as "has-sidebar" does.
_HAVING = frozenset("has have having with no non without".split())
#: Tokens with a word of each of these hold the main part and an aside beside it, as "content-sidebar-wrap" does.
_HOLDING = (frozenset("content main primary".split()), frozenset("sidebar aside nav".split()), frozenset("layout wrapper wrap".split()))
#: Of readers, these are asides.
_READERS, _VOICES = frozenset("user users reader readers visitor visitors customer customers member members".split()), frozenset("review reviews opinions voices questions".split())
#: Words for asides that a whole page may be called by mistake.
_LAYOUT_ASIDES = frozenset("nav navbar navigation menu header footer sidebar aside masthead banner widget toolbar topnav mainnav subnav sidenav".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: Log-odds of content; fixed by hand. Signs of tags, of a name in full, of what is hidden.
ASIDE_TAGS = {"nav": -7.0, "footer": -7.0, "menu": -7.0, "search": -7.0, "aside": -6.0, "dialog": -6.0, "form": -6.0, "fieldset": -6.0, "header": -6.0}
NAMED, HIDDEN = -6.0, -12.0
INSIDE, INSIDE_NAMED = 2.5, 1.0
#: Signs of the text.
PRIOR, LINKED, SENTENCE, LONG, HEADING, SHORT = 0.25, -3.0, 1.0, 1.5, 0.5, -1.5
#: Costs of parting two neighbours, and two nearest blocks of one parent; and the share of it where only one has a sign of an aside.
NEXT, SIBLING, ACROSS = 0.8, 1.5, 0.1


def _words_for_asides(words: list[str]) -> int:
    """How many of a token's words are words for asides."""
    if all(any(w in kind for w in words) for kind in _HOLDING):
        return 0
    first = next((k for k, w in enumerate(words) if w in _ASIDE_NAMES), len(words))
    if any(w in _HAVING for w in words[:first]):
        return 0
    voices = sum(w in _VOICES for w in words) if any(w in _READERS for w in words) else 0
    return voices + sum(w in _ASIDE_NAMES for w in words)


@lru_cache(maxsize=10_000)
def _read_token(token: str) -> tuple[bool, float, bool, bool]:
    """Of a token of names: whether it names a main part, its odds, whether it says nothing else than aside, whether by words of layout alone."""
    words = [w.lower() for w in _WORD.findall(token)]
    known = _words_for_asides(words)
    main = any(w in _MAIN_NAMES for w in words)
    if not known or main and known == sum(w in ("header", "footer") for w in words):  # the head or foot of the main part itself
        return main and not known, 0.0, False, True
    own = all(w in _ASIDE_NAMES or w in _PLAIN_NAMES or w in _READERS or w in _VOICES for w in words)
    layout = all(w in _LAYOUT_ASIDES for w in words if w in _ASIDE_NAMES or w in _VOICES)
    return False, NAMED if own else NAMED * known / len(words), own, layout


def _named(tag: str, attrs: dict[str, str], outermost: bool) -> tuple[float, bool, bool]:
    """The odds that an element's names give, 0 at most; whether one is a name of main parts; whether words of layout alone gave the odds."""
    odds, main, layout = 0.0, False, True
    for key in ("class", "id", "role", "itemprop"):
        if key not in attrs or key == "id" and (tag in _HEADINGS or outermost):
            continue
        for token in attrs[key].split():
            of_main, its, own, by_layout = _read_token(token)
            main |= of_main
            if its and (own or not (key == "id" and tag == "section")):
                odds = min(odds, its)
                layout &= by_layout
    return (0.0 if outermost and main else odds), main, layout


class _Element:
    """An open element, with the signs that its place gives its blocks: ``aside`` (0 at most) and ``inside``.

    The strongest sign of an aside around a block counts. A form may hold the whole page,
    so an article or main part within it counts as if it were outside of it. ``ruled_out`` is the strongest sign
    that is not one of layout. ``home`` is the nearest block-level element, the element itself if it is one.
    """

    __slots__ = ("aside", "depth", "home", "in_article", "inside", "only_form", "parent", "ruled_out", "tag")

    def __init__(self, tag: str, attrs: list, parent: _Element | None):
        self.tag, self.parent, self.depth = tag, parent, parent.depth + 1 if parent else 0
        self.home = self if parent is None or tag in _BLOCK else parent.home
        self.aside, self.inside, self.only_form = (parent.aside, parent.inside, parent.only_form) if parent else (0.0, 0.0, True)
        self.ruled_out, self.in_article = (parent.ruled_out, parent.in_article or tag == "article") if parent else (0.0, False)
        if tag in ("html", "body"):
            return
        named = {k: v or "" for k, v in attrs}
        outermost = tag in ("article", "main") and not (parent and parent.in_article)
        odds, main, layout = _named(tag, named, outermost) if named else (0.0, False, True)
        if tag in ASIDE_TAGS and not (tag == "header" and self.inside > 0 and self.aside == 0):
            odds, layout = min(odds, ASIDE_TAGS[tag]), False
        if "hidden" in named or named.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", named.get("style", "")):
            odds, layout = HIDDEN, False
        if tag in ("article", "main") and self.only_form and odds == 0:
            self.aside = self.ruled_out = 0.0
        if odds < self.aside:
            self.only_form = self.only_form and tag in ("form", "fieldset") and odds == ASIDE_TAGS[tag]
            self.aside = odds
        if not layout:
            self.ruled_out = min(self.ruled_out, odds)
        if self.aside == 0:
            self.inside = max(self.inside, INSIDE if tag in ("article", "main") else INSIDE_NAMED if main else 0.0)


class _Reader(HTMLParser):
    """Collects ``element, text, characters in links`` of every block."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[_Element, str, int]] = []
        self.stack: list[_Element] = [_Element("html", [], None)]
        self.open: dict[str, list[int]] = {}  # places in the stack of the open elements of a tag
        self.unread, self.links = 0, 0
        self.parts: list[str] = []
        self.linked, self.owner = 0, None

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append((self.owner, text, self.linked))
        self.parts, self.linked, self.owner = [], 0, None

    def _pop(self, upto: int) -> None:
        for e in self.stack[upto:]:
            self.unread -= e.tag in _UNREAD
            self.links -= e.tag == "a"
            self.open[e.tag].pop()
        del self.stack[upto:]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _BLOCK:
            self.flush()
            ends = _ENDS.get(tag, ()) if tag in _ENDS else {"p"}
            e = self.stack[-1].home
            while e.depth > 0:
                if e.tag in ends:
                    self._pop(e.depth)
                    break
                if e.tag != "p":
                    break
                e = e.parent.home
        elif tag == "br":
            self.handle_data("\n")
        if tag in _VOID:
            return
        if tag == "html" or tag == "body" and self.open.get("body"):
            return
        self.open.setdefault(tag, []).append(len(self.stack))
        self.stack.append(_Element(tag, attrs, self.stack[-1]))
        self.unread += tag in _UNREAD
        self.links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID and tag in _UNREAD:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in _BLOCK:
            self.flush()
        at = self.open.get(tag)
        # the end of an inline element does not reach out of its block
        if at and (tag in _BLOCK or at[-1] > self.stack[-1].home.depth):
            self._pop(at[-1])

    def handle_data(self, data: str) -> None:
        if not self.unread:
            if self.owner is None and not data.isspace():
                self.owner = self.stack[-1]
            self.parts.append(data)
            self.linked += len(data.strip()) if self.links else 0


def read_blocks(html: str | None) -> list[tuple[_Element, str, int]]:
    """The blocks of a page in order."""
    reader = _Reader()
    reader.feed(html or "")
    reader.close()
    reader.flush()
    return reader.blocks


def log_odds(element: _Element, text: str, linked: int) -> float:
    """The linear classifier: log-odds that a block is content."""
    words = text.count(" ") + 1
    odds = PRIOR + element.aside + element.inside
    odds += LINKED * (linked > 0.5 * len(text))
    odds += SENTENCE * (text[-1] in ".!?…\"”。")
    odds += LONG * (words >= 12) + SHORT * (words < 4)
    return odds + HEADING * (element.home.tag in ("h1", "h2", "h3"))


def minimum_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes are on the source's side of a minimum cut (Dinic's maximum flow).

    Node i is tied to the source by its odds if they are positive, else to the sink.
    """
    n = len(odds)
    source, sink = n, n + 1
    to, room, out = [], [], [[] for _ in range(n + 2)]

    def tie(a: int, b: int, forth: float, back: float) -> None:
        out[a].append(len(to))
        out[b].append(len(to) + 1)
        to.extend((b, a))
        room.extend((forth, back))

    for i, x in enumerate(odds):
        tie(source, i, x, 0.0) if x > 0 else tie(i, sink, -x, 0.0)
    for a, b, w in edges:
        tie(a, b, w, w)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        at, path, a = [0] * (n + 2), [], source
        while True:  # augmenting paths of this level graph, by depth-first search
            if a == sink:
                push = min(room[e] for e in path)
                for e in path:
                    room[e] -= push
                    room[e ^ 1] += push
                cut = next(k for k, e in enumerate(path) if room[e] <= 1e-9)
                a = to[path[cut] ^ 1]
                del path[cut:]
            elif at[a] < len(out[a]):
                e = out[a][at[a]]
                if room[e] > 1e-9 and level[to[e]] == level[a] + 1:
                    path.append(e)
                    a = to[e]
                else:
                    at[a] += 1
            elif a == source:
                break
            else:
                e = path.pop()
                a = to[e ^ 1]
                at[a] += 1


def smoothness(blocks: list[tuple[_Element, str, int]]) -> list[tuple[int, int, float]]:
    """The edges of adjacency and of proximity in the document's tree."""
    edges, last = [], {}

    def join(a: int, b: int, cost: float) -> None:
        edges.append((a, b, cost if blocks[a][0].aside == blocks[b][0].aside else cost * ACROSS))

    for k, (element, _, _) in enumerate(blocks):
        if k:
            join(k - 1, k, NEXT)
        parent = id(element.home.parent or element)
        if parent in last:
            join(last[parent], k, SIBLING)
        last[parent] = k
    return edges


def _likeliest(blocks: list[tuple[_Element, str, int]], odds: list[float]) -> list[float] | None:
    """Odds by which a page is read once more where no block of it is content; None where it has none."""
    prose = [k for k, (e, text, linked) in enumerate(blocks) if e.ruled_out == 0 and linked <= 0.5 * len(text) and text.count(" ") >= 11]
    if len(prose) >= 3 and all(e.aside < 0 for e, _, _ in blocks):
        return [x - e.aside + e.ruled_out for (e, _, _), x in zip(blocks, odds, strict=True)]
    plain = [x for (e, text, linked), x in zip(blocks, odds, strict=True) if e.aside == 0 and linked <= 0.5 * len(text)]
    best = max(plain, default=None)
    return None if best is None else [x + 0.25 - best for x in odds]


def labelled(html: str | None) -> list[tuple[str, float, bool]]:
    """``text, log-odds, whether it is content`` of each block of a page."""
    blocks = read_blocks(html)
    odds, edges = [log_odds(*b) for b in blocks], smoothness(blocks)
    keep = minimum_cut(odds, edges)
    if not any(keep) and (again := _likeliest(blocks, odds)):
        odds = again
        keep = minimum_cut(odds, edges)
        if not any(keep):  # neighbours outweigh the likeliest blocks
            keep = [x > 0 for x in odds]
    return [(text, x, k) for (_, text, _), x, k in zip(blocks, odds, keep, strict=True)]


def main_text(html: str | None) -> str:
    """The main text of a page."""
    return "\n".join(text for text, _, is_content in labelled(html) if is_content)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page; map-only."""
    small_batches(pages.sparkSession)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(t.as_py()) for t in b.column(2)]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(run, f"page_id {types['page_id']}, url {types['url']}, text string, n_chars long")
