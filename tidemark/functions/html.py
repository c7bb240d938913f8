"""Reading records out of HTML pages.

Pages are rarely well-formed, so the standard library's tolerant parser reads them, inside the
Arrow-batched worker. A page with nothing but plain markup is read several times faster by a regular
expression, to the same tree. Only the blocks that hold records are kept, as small trees. Texts and
attributes are returned as found; cleaning is left to columns.
"""

from __future__ import annotations

import gc
import re
from collections import Counter
from collections.abc import Callable, Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
SILENT_TAGS = frozenset(("script", "style", "template"))


class Node:
    """An element with its children, which are nodes and texts."""

    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag = tag
        self.attrs = attrs
        self.children: list[Node | str] = []

    def has_class(self, css: str | None) -> bool:
        own = self.attrs.get("class", "")
        return css is None or css == own or css in own.split()

    def inside(self, silent: bool = True) -> Iterator[Node | str]:
        """Everything in this element, in the order of the page."""
        stack = self.children[::-1]
        while stack:
            item = stack.pop()
            yield item
            if isinstance(item, Node) and (silent or item.tag not in SILENT_TAGS):
                stack.extend(reversed(item.children))

    def nodes(self) -> list[Node]:
        """The nodes in this element, in the order of the page."""
        found, stack = [], self.children[::-1]
        while stack:
            item = stack.pop()
            if item.__class__ is Node:
                found.append(item)
                if item.children:
                    stack += item.children[::-1]
        return found

    def find_all(self, *tags: str, css: str | None = None) -> Iterator[Node]:
        return (n for n in self.nodes() if n.tag in tags and n.has_class(css))

    def find(self, *tags: str, css: str | None = None) -> Node | None:
        return next(self.find_all(*tags, css=css), None)

    def text(self) -> str:
        if len(self.children) == 1 and isinstance(self.children[0], str):
            return self.children[0]
        return "".join(item for item in self.inside(silent=False) if isinstance(item, str))

    def only_text(self) -> str | None:
        """The text if this element holds nothing but one text, possibly nested."""
        node = self
        while len(node.children) == 1:
            child = node.children[0]
            if isinstance(child, str):
                return child
            node = child
        return None

    def first_text(self) -> str:
        """Text of the first child. An element without children is an error."""
        child = self.children[0]
        return child if isinstance(child, str) else child.text()


class _Blocks(HTMLParser):
    """Keeps the elements with one of the given tags and classes, and what is in them."""

    def __init__(self, wanted: Blocks | None):
        super().__init__(convert_charrefs=True)
        self.wanted, self.page = wanted, Node("", {})
        # Open elements, with their nodes where they are kept, and how many of each tag there are.
        self.open: list[tuple[str, Node | None]] = [("", self.page if wanted is None else None)]
        self.tags: Counter[str] = Counter()

    def handle_starttag(self, tag, attrs, closed=False):
        parent, node = self.open[-1][1], None
        if parent is not None or tag in self.wanted:
            node = Node(tag, {name: value or "" for name, value in attrs})
            if parent is None:
                node, parent = (node, self.page) if node.has_class(self.wanted[tag]) else (None, None)
            if node is not None:
                parent.children.append(node)
        if not closed and tag not in VOID_TAGS:
            self.open.append((tag, node))
            self.tags[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs, closed=True)

    def handle_endtag(self, tag):
        while self.tags[tag]:
            last = self.open.pop()[0]
            self.tags[last] -= 1
            if last == tag:
                break

    def handle_data(self, data):
        node = self.open[-1][1]
        if node is not None:
            if node.children and isinstance(node.children[-1], str):
                node.children[-1] += data
            else:
                node.children.append(data)

    def handle_comment(self, data):
        if self.open[-1][1] is not None:
            self.open[-1][1].children.append(Node("!", {}))


# Tags of the elements to keep, each with the class it must have or None.
Blocks = dict[str, str | None]


# Markup that can be read in one way only: tags whose attributes, if any, have quoted values without
# references, simple comments and document types. Tags whose content is no markup aren't among it.
_ATTRIBUTE = r"""[ \t\n\r\f]++([a-zA-Z][a-zA-Z0-9_:-]*+)(?:=(?:"([^"<>&]*+)"|'([^'<>&]*+)'))?+"""
_TAG = (
    r"(/?+)((?!(?i:script|style|title|textarea|iframe|noembed|noframes|noscript|xmp|plaintext)[ \t\n\r\f/>])[a-zA-Z][a-zA-Z0-9]*+)"
    rf"((?:{re.sub(r'[(](?![?])', '(?:', _ATTRIBUTE)})*+)[ \t\n\r\f]*+(/?+)>"
)
_TOKEN = rf"([^<]*+)<(?:{_TAG}|(!--[^<>-]++--|!(?i:doctype)[ \t\n\r\f][^<>]*+)>)"
_ATTRIBUTES, _TOKENS = re.compile(_ATTRIBUTE), re.compile(_TOKEN)
_PLAIN = re.compile(rf"(?:{re.sub(r'[(](?![?])', '(?:', _TOKEN)})*+[^<]*+")


def _attributes(text: str) -> dict[str, str]:
    return {name.lower(): double or single for name, double, single in _ATTRIBUTES.findall(text)}


def _read_plain(html: str, wanted: Blocks | None) -> Node | None:
    """What ``_Blocks`` makes of a page if all of its markup is plain, else None."""
    if not _PLAIN.fullmatch(html):
        return None
    page = Node("", {})
    node = page if wanted is None else None
    # Open elements, as in ``_Blocks``.
    opened: list[tuple[str, Node | None]] = [("", node)]
    tags: Counter[str] = Counter()
    known: dict[str, dict[str, str]] = {"": {}}
    for text, end, tag, attributes, closed, other in _TOKENS.findall(html):
        if text and node is not None:
            _add_text(node, text)
        if other:
            if other[1] == "-" and node is not None:
                node.children.append(Node("!", {}))
            continue
        if not tag.islower():
            tag = tag.lower()
        if end:
            while tags[tag]:
                last = opened.pop()[0]
                tags[last] -= 1
                if last == tag:
                    break
            node = opened[-1][1]
            continue
        new = None
        if node is not None or tag in wanted:
            attrs = known.get(attributes)
            if attrs is None:
                attrs = known[attributes] = _attributes(attributes)
            new = Node(tag, attrs)
            if node is not None:
                node.children.append(new)
            elif new.has_class(wanted[tag]):
                page.children.append(new)
            else:
                new = None
        if not closed and tag not in VOID_TAGS:
            opened.append((tag, new))
            tags[tag] += 1
            node = new
    last = html.rfind("<")
    text = html if last < 0 else html[_TOKENS.match(html, last).end():]
    if text and node is not None:
        _add_text(node, text)
    return page


def _add_text(node: Node, text: str) -> None:
    if "&" in text:
        text = unescape(text)
    if node.children and isinstance(node.children[-1], str):
        node.children[-1] += text
    else:
        node.children.append(text)


def read_page(html: str, wanted: Blocks | None = None) -> Node:
    """The wanted elements of a page, or all of it."""
    page = _read_plain(html, wanted)
    if page is not None:
        return page
    reader = _Blocks(wanted)
    reader.feed(html)
    reader.close()
    return reader.page


# Calendar pages ---------------------------------------------------------------------------

CALENDAR_BLOCKS: Blocks = {"ul": "events"}

_NAME = pa.struct([("link", pa.string()), ("text", pa.string())])
CALENDAR_RECORD = pa.struct([
    ("badge", pa.string()),
    ("name", pa.string()),
    ("profile_href", pa.string()),
    ("venue", pa.string()),
    ("dates", pa.string()),
    ("winners", pa.list_(pa.struct([("label", pa.string()), ("names", pa.list_(_NAME))]))),
    ("results_href", pa.string()),
    ("error", pa.string()),
])


def _text_of(node: Node | None) -> str | None:
    return None if node is None else node.text()


def _calendar_event(li: Node) -> dict:
    info = li.find("div", css="tournament-info")
    if info is None:
        return {"error": "no tournament-info"}
    badge = info.find("img", css="events_banner")
    record = {"badge": badge.attrs.get("alt") if badge else None, "winners": []}
    profile = info.find("a", css="tournament__profile")
    if profile is not None:
        record["name"] = _text_of(profile.find("span", css="name"))
        if record["name"] is None:
            return {"error": "profile without a name"}
        record["profile_href"] = profile.attrs.get("href")
        record["venue"] = _text_of(profile.find("span", css="venue"))
        record["dates"] = _text_of(profile.find("span", css="Date"))
    holder = li.find("div", css="cta-holder")
    for winner in holder.find_all("dl", css="winner") if holder else []:
        label = winner.find("dt")
        if label is not None:
            names = [
                {"link": _text_of(dd.find("a")), "text": dd.text()} for dd in winner.find_all("dd")
            ]
            record["winners"].append({"label": label.text(), "names": names})
    links = li.find("div", css="non-live-cta")
    results = links.find("a", css="results") if links else None
    record["results_href"] = results.attrs.get("href") if results else None
    return record


def calendar_events(page: Node) -> list[dict]:
    items = (ul.find("li") for ul in page.find_all("ul", css="events"))
    return [_calendar_event(li) for li in items if li is not None]


# Results pages ----------------------------------------------------------------------------

RESULTS_BLOCKS: Blocks = {"div": "atp_accordion-item"}

MATCH_RECORD = pa.struct([
    ("heading", pa.string()),
    ("stats_href", pa.string()),
    ("scores", pa.list_(pa.list_(pa.list_(pa.string())))),
    ("players", pa.list_(pa.struct([
        ("name", pa.string()), ("href", pa.string()), ("seed", pa.string()), ("broken", pa.bool_()),
    ]))),
    ("flags", pa.list_(pa.string())),
    ("error", pa.string()),
])


def _player(node: Node) -> dict:
    info = node.find("a", "p")
    try:
        name = None if info is None else " ".join(info.first_text().split())
    except IndexError:
        name = None
    return {
        "name": name,
        "broken": info is not None and name is None,
        "href": None if info is None else info.attrs.get("href"),
        "seed": _text_of(node.find("span")),
    }


def _flag(svg: Node) -> str | None:
    use = svg.find("use")
    return None if use is None else use.attrs.get("href", "")


def _match(node: Node) -> dict:
    inner = node.nodes()
    divs = [n for n in inner if n.tag == "div"]
    cta = next((n for n in divs if n.has_class("match-cta")), None)
    links = cta.find_all("a") if cta else ()
    stats = next((a for a in links if "Stats" in (a.only_text() or "")), None)
    if stats is not None and "href" not in stats.attrs:
        return {"error": "stats link without an address"}
    return {
        "heading": _text_of(next((n for n in inner if n.tag == "strong"), None)),
        "stats_href": stats.attrs["href"] if stats else None,
        "scores": [
            [
                [span.text() for span in item.find_all("span")]
                for item in block.find_all("div", css="score-item")
            ]
            for block in divs if block.has_class("scores")
        ],
        "players": [_player(n) for n in divs if n.has_class("name")],
        "flags": [_flag(n) for n in inner if n.tag == "svg"],
    }


def matches(page: Node) -> list[dict]:
    days = page.find_all("div", css="atp_accordion-item")
    return [_match(node) for day in days for node in day.find_all("div", css="match")]


# Any page ---------------------------------------------------------------------------------

LINK_BLOCKS: Blocks = {"title": None, "h1": None, "nav": None}

LINK_RECORD = pa.struct([
    ("title", pa.string()),
    ("heading", pa.string()),
    ("href", pa.string()),
    ("text", pa.string()),
    ("error", pa.string()),
])


def navigation_links(page: Node) -> list[dict]:
    """One record per link of the page's navigation, with the page's title and first heading."""
    title, heading = _text_of(page.find("title")), _text_of(page.find("h1"))
    return [
        {"title": title, "heading": heading, "href": a.attrs.get("href"), "text": a.text()}
        for nav in page.find_all("nav") for a in nav.find_all("a")
    ]


# ------------------------------------------------------------------------------------------

# The same types, as Spark writes them.
CALENDAR_DDL = (
    "badge string, name string, profile_href string, venue string, dates string, "
    "winners array<struct<label string, names array<struct<link string, text string>>>>, "
    "results_href string, error string"
)
MATCH_DDL = (
    "heading string, stats_href string, scores array<array<array<string>>>, "
    "players array<struct<name string, href string, seed string, broken boolean>>, "
    "flags array<string>, error string"
)
LINK_DDL = "title string, heading string, href string, text string, error string"


PAGE_ERROR = "unreadable page: "


def records(html: Column, read: Callable[[Node], list[dict]], wanted: Blocks, ddl: str, record: pa.DataType) -> Column:
    """Array of the records that ``read`` finds in each page. Only the page text goes to Python.

    A page that the parser gives up on yields one record, whose ``error`` begins with ``PAGE_ERROR``.
    """
    list_type = pa.list_(record)

    def read_one(html: str | None) -> list[dict] | None:
        if html is None:
            return None
        try:
            return read(read_page(html, wanted))
        except Exception as e:  # whatever is in a page, the others go on
            return [{"error": f"{PAGE_ERROR}{type(e).__name__}: {e}"}]

    @F.arrow_udf(returnType=f"array<struct<{ddl}>>")
    def read_pages(pages: pa.Array) -> pa.Array:
        # Trees have no cycles; looking for some in so many nodes takes longer than reading them.
        collects = gc.isenabled()
        gc.disable()
        try:
            return pa.array([read_one(html) for html in pages.to_pylist()], type=list_type)
        finally:
            if collects:
                gc.enable()

    return read_pages(html)
