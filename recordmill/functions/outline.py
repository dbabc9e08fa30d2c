"""Markup to nested columns.

One Arrow step turns a page into an *outline*: the few facts extraction rules look at,
as a struct of arrays. It applies no rule itself; which heading is the title, which table
holds events and what a label's value is are decided by column expressions on the outline.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from functools import lru_cache
from html import unescape
from itertools import accumulate
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from recordmill.functions.text import HIDDEN_ELEMENTS, VOID_ELEMENTS
from recordmill.functions.urls import url_origin

# Elements and selectors the extraction rules name, in their order.
TITLE_SELECTORS = [
    "h1", "h2", "h3", "#ContentPlaceHolder1_lbTitulo", ".titulo-proyecto", ".proyecto-titulo",
]
AUTHOR_SELECTORS = [
    "#ContentPlaceHolder1_lbAutores", ".autores", ".proyecto-autores", "#autores",
]
_SELECTORS = frozenset(TITLE_SELECTORS + AUTHOR_SELECTORS)
_TAG_SELECTORS = [s for s in TITLE_SELECTORS + AUTHOR_SELECTORS if s[0] not in "#."]
LABEL_ELEMENTS = frozenset({"td", "th", "span", "label", "strong", "b", "dt"})
VALUE_ELEMENTS = frozenset({"td", "dd", "span"})

# What an opening tag implicitly ends:
# the elements it closes, and the containers past which it does not look.
_BLOCKS = frozenset(
    "address article aside blockquote center dir div dl fieldset footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split()
)
_SECTIONS = frozenset({"thead", "tbody", "tfoot"})
_CELLS = frozenset({"td", "th"})
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir", "td", "th", "table"}),
    "dt": ({"dt", "dd"}, {"dl", "td", "th", "table"}),
    "dd": ({"dt", "dd"}, {"dl", "td", "th", "table"}),
    "option": ({"option"}, {"select"}),
    "td": (_CELLS, {"tr", "table"}),
    "th": (_CELLS, {"tr", "table"}),
    "tr": ({"tr"} | _CELLS, {"table"}),
    **{s: (_SECTIONS | {"tr"} | _CELLS, {"table"}) for s in _SECTIONS},
    **{b: ({"p"}, {"td", "th", "table", "li", "div", "body"}) for b in _BLOCKS},
}
# How far an end tag reaches: it never closes an element of higher rank.
_RANK = {
    "p": 10, "div": 150, "td": 160, "th": 160, "tr": 170, "thead": 180, "tbody": 180,
    "tfoot": 180, "table": 190, "head": 200, "body": 200, "html": 220,
}
_OTHER_RANK = 100

_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
# What a tag holds up to its ">" with all quotes closed.
_REST = re.compile(r"""[^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+""")
# A tag behind its "<", if all its quotes are closed.
_TEXT_AND_TAG = re.compile(rf"(/?{_NAME.pattern})({_REST.pattern})>")
_TAG_MARK = re.compile(r"""[>"']""")
_ATTRIBUTE = re.compile(
    r"([^\s=/>\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']*))"
)
# A link that ``urljoin`` puts behind the site as it is: a path from the root without dot segments, and a query.
_ROOT_PATH = re.compile(r"(?:/[A-Za-z0-9_-][A-Za-z0-9_.-]*)+/?(?:\?[A-Za-z0-9_.=&%+-]+)?")
# Elements whose content is text up to their end tag, whatever it looks like.
_RAW_TEXT = {
    tag: re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE)
    for tag in ("script", "style", "title", "textarea")
}

# Date forms of an event row, without their first digit: a search skips other text faster than a lookahead does.
_DATE = re.compile(
    r"[0-9](?=([0-9]?/[0-9]{1,2}/[0-9]{4}"
    r"|[0-9]{3}-[0-9]{2}-[0-9]{2}"
    r"|[0-9]?\s+[A-Za-zÁÉÍÓÚáéíóú.]+\s+[0-9]{4}))"
)
#: Cells of a row that the rules can ask for, besides the first dated one.
ROW_CELLS = 5

_TEXTS = pa.list_(pa.string())
# Words are kept once; cells are spans of them, and rows of a table are neighbours.
_SPANS = pa.list_(pa.struct([("at", pa.int32()), ("size", pa.int32())]))
_ROW = pa.struct([
    ("n_cells", pa.int32()),
    ("date_cell", pa.int32()),  # number of the first dated cell, from 1; 0 for none
    ("cells", _SPANS),  # the first ``ROW_CELLS``
    ("date", _SPANS),  # the first dated cell
    ("all_heads", pa.bool_()),
    ("link", pa.string()),
    ("link_error", pa.string()),
])
_TABLE = pa.struct([("first", pa.int32()), ("rows", pa.int32()), ("dated", pa.int32())])
_OUTLINE = pa.struct([
    ("headings", _TEXTS),
    ("authors", pa.string()),
    ("canonical_link", pa.string()),
    ("labels", pa.list_(pa.struct([("label", pa.string()), ("value", pa.string())]))),
    ("words", pa.string()),
    ("tables", pa.list_(_TABLE)),
    ("rows", pa.list_(_ROW)),
    ("canonical_link_error", pa.string()),
    ("error", pa.string()),
])


def _attributes(text: str) -> dict[str, str]:
    """Attribute values by lower-case name; the first of a repeated name wins."""
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), unescape(double or single or bare))
    return found


def _tag_ends(html: str) -> tuple[list[int], list[int]]:
    """Places of all ``>`` and quotes, and where a tag that is open and unquoted at each of them ends (-1: a quote stays open).

    Filled from right to left: a quote goes on after its partner.
    """
    places = [m.start() for m in _TAG_MARK.finditer(html)]
    ends = [-1] * (len(places) + 1)
    partner = {'"': len(places), "'": len(places)}
    for i in range(len(places) - 1, -1, -1):
        mark = html[places[i]]
        if mark == ">":
            ends[i] = places[i]
        else:
            ends[i] = ends[min(partner[mark] + 1, len(places))]
            partner[mark] = i
    return places, ends


def _kind(name: str) -> tuple:
    """Of a tag's name with the slash of an end tag: whether it is one, the element, what its start ends, past what it does
    not look, what its end tag does not close, whether it is hidden and void, the end of its raw text."""
    end = name.startswith("/")
    tag = name[end:].lower()
    closes, stops = _ENDS.get(tag, (None, None))
    return end, tag, closes, stops, _RANK.get(tag, _OTHER_RANK), tag in HIDDEN_ELEMENTS, tag in VOID_ELEMENTS, _RAW_TEXT.get(tag)


_KINDS = {
    name: _kind(name)
    for tag in {*_ENDS, *_RANK, *_RAW_TEXT, *HIDDEN_ELEMENTS, *VOID_ELEMENTS, *LABEL_ELEMENTS, *VALUE_ELEMENTS, "a", "em", "i", "u"}
    for name in (tag, tag.upper(), f"/{tag}", f"/{tag.upper()}")
}


class _Page:
    """All elements and visible text nodes of a page in document order.

    An element is its number; a list for each of its facts holds no reference to other
    elements, so a page is freed without a cycle search.
    """

    def __init__(self, html: str) -> None:
        self.tags: list[str] = []
        self.attribute_texts: dict[int, str] = {}  # of the elements that have any, in order
        self.parents: list[int] = []  # -1 for none
        self.stops: list[int] = []  # the first element after those inside
        self.text_starts: list[int] = []
        self.text_stops: list[int] = []
        self.text_nodes: list[str] = []
        self._open: list[int] = []
        self._open_tags: list[str] = []
        self._hidden = 0
        self._read(html)
        self._close_from(0)

    def _read(self, html: str) -> None:
        """One pass: no part of a page is looked at more than a fixed number of times.

        The page is split at each "<". A piece is a tag up to its ">", and the text after it; what
        is neither goes by the rules one by one, from the text before it on.
        """
        self._ends, self._last_end, starts = None, html.rfind(">"), None
        pieces = html.split("<")
        n_pieces, text, i = len(pieces), pieces[0], 1
        kinds, tag_of, texts = _KINDS.get, _TEXT_AND_TAG.match, self.text_nodes
        tags, parents, stops, attribute_texts = self.tags, self.parents, self.stops, self.attribute_texts
        text_starts, text_stops, open_, open_tags = self.text_starts, self.text_stops, self._open, self._open_tags
        while i < n_pieces:
            piece = pieces[i]
            name, closed, after = piece.partition(">")
            kind, attributes = kinds(name) if closed else None, ""
            at = -1  # known where the rules were followed one by one
            if kind is None:
                if closed and name.startswith(("!", "?")) and not name.startswith("!--"):  # a declaration
                    self._text(text)
                    i, text = i + 1, after
                    continue
                found = tag_of(piece) if closed and self._ends is None else None
                if found is None:
                    if starts is None:
                        starts = list(accumulate((len(p) + 1 for p in pieces), initial=0))
                    at, tag = self._next_tag(html, starts[i] - 1 - len(text))
                    if at < 0:
                        return
                    if tag is None:
                        i, text = self._piece_at(html, starts, at)
                        continue
                    name, attributes = tag
                else:
                    name, attributes = found.groups()
                    after = piece[found.end():]
                kind = kinds(name) or _kind(name)
            if at < 0 and text and not self._hidden:
                texts.append(unescape(text) if "&" in text else text)
            end, tag, closes, limits, rank, hidden, void, raw_text = kind
            if end:
                if open_tags and open_tags[-1] == tag:  # the usual case of _close_last, without a call
                    open_tags.pop()
                    element = open_.pop()
                    stops[element] = len(tags)
                    text_stops[element] = len(texts)
                    if hidden:
                        self._hidden -= 1
                else:
                    self._end(tag, rank)
            else:
                if closes and open_tags and open_tags[-1] not in limits:
                    self._end_implied(closes, limits)
                element, n_texts = len(tags), len(texts)
                tags.append(tag)
                if "=" in attributes:
                    attribute_texts[element] = attributes
                    if "&#" in attributes:  # a number that cannot be read is the page's error, whoever asks for the value
                        _attributes(attributes)
                parents.append(open_[-1] if open_ else -1)
                text_starts.append(n_texts)
                text_stops.append(n_texts)
                stops.append(element + 1)
                if not void:
                    open_.append(element)
                    open_tags.append(tag)
                    if hidden:
                        self._hidden += 1
                if raw_text and at < 0 and i + 1 < n_pieces and pieces[i + 1].startswith(f"/{tag}>"):
                    self._text(after)  # the usual case: its end is the next tag
                    after = ""
                elif raw_text:
                    if starts is None:
                        starts = list(accumulate((len(p) + 1 for p in pieces), initial=0))
                    if at < 0:
                        at = starts[i + 1] - 1 - len(after)
                    raw_end = raw_text.search(html, at)
                    stop = raw_end.start() if raw_end else len(html)
                    self._text(html[at:stop])
                    at = stop
            if at < 0:
                text = after
                i += 1
            else:
                i, text = self._piece_at(html, starts, at)
        self._text(text)

    def _piece_at(self, html: str, starts: list[int], at: int) -> tuple[int, str]:
        """The number of the next piece after ``at``, and the text up to it; ``starts`` are those of the pieces, and the end's."""
        i = bisect_right(starts, at)
        return i, html[at:starts[i] - 1] if i < len(starts) else ""

    def attributes(self, element: int) -> dict[str, str]:
        text = self.attribute_texts.get(element)
        return _attributes(text) if text else {}

    def _next_tag(self, html: str, at: int) -> tuple[int, tuple[str, str] | None]:
        """Text, a comment or a tag by the rules one by one: where to go on (-1 at the end), and the tag's name and the rest."""
        tag = html.find("<", at)
        if html.startswith("<!--", tag) and tag >= 0:
            self._text(html[at:tag])
            end = html.find("-->", tag + 4)
            return (len(html) if end < 0 else end + 3), None
        if tag < 0 or tag > self._last_end:  # no tag can end any more
            self._text(html[at:])
            return -1, None
        slash = html.startswith("/", tag + 1)
        name = _NAME.match(html, tag + 1 + slash)
        if name is None:
            if slash or html[tag + 1:tag + 2] in ("!", "?"):
                self._text(html[at:tag])
                return html.find(">", tag) + 1, None
            self._text(html[at:tag + 1])
            return tag + 1, None
        self._text(html[at:tag])
        end = self._tag_end(html, name.end())
        return end + 1, (html[tag + 1:name.end()], html[name.end():end])

    def _tag_end(self, html: str, at: int) -> int:
        """The first ``>`` outside quotes, or the first one if a quote is never closed."""
        if self._ends is None:
            end = _REST.match(html, at).end()
            if html.startswith(">", end):
                return end
            self._ends = _tag_ends(html)  # a quote stays open: from here on ends are looked up
        places, ends = self._ends
        end = ends[bisect_left(places, at)]
        if end >= 0:
            return end
        end = html.find(">", at)
        return len(html) if end < 0 else end

    def _text(self, text: str) -> None:
        if text and not self._hidden:
            self.text_nodes.append(unescape(text) if "&" in text else text)

    def _end_implied(self, closes, stops) -> None:
        tags = self._open_tags
        cut = None
        for depth in range(len(tags) - 1, -1, -1):
            tag = tags[depth]
            if tag in stops:
                break
            if tag in closes:
                cut = depth
        if cut is not None:
            self._close_from(cut)

    def _end(self, tag: str, rank: int) -> None:
        tags = self._open_tags
        for depth in range(len(tags) - 1, -1, -1):
            open_tag = tags[depth]
            if open_tag == tag:
                self._close_from(depth)
                return
            if _RANK.get(open_tag, _OTHER_RANK) > rank:
                return

    def _close_last(self) -> None:
        element = self._open.pop()
        self.stops[element] = len(self.tags)
        self.text_stops[element] = len(self.text_nodes)
        self._hidden -= self._open_tags.pop() in HIDDEN_ELEMENTS

    def _close_from(self, depth: int) -> None:
        while len(self._open) > depth:
            self._close_last()

    def next_sibling(self, element: int) -> int | None:
        """The element that begins where this one ends, if both have one parent."""
        after = self.stops[element]
        return after if after < len(self.tags) and self.parents[after] == self.parents[element] else None

    def words(self, element: int) -> str:
        return " ".join(" ".join(self.text_nodes[self.text_starts[element]:self.text_stops[element]]).split())

    def all_words(self) -> str:
        return " ".join(" ".join(self.text_nodes).split())

    def first_texts(self) -> dict[str, str]:
        """Text of the first element for each selector the rules name."""
        found: dict[str, int] = {}
        for selector in _TAG_SELECTORS:
            if selector in self.tags:
                found[selector] = self.tags.index(selector)
        for element in self.attribute_texts:
            attrs = self.attributes(element)
            if attrs.get("id"):
                found.setdefault("#" + attrs["id"], element)
            for name in attrs.get("class", "").split():
                found.setdefault("." + name, element)
        return {selector: self.words(element) for selector, element in found.items() if selector in _SELECTORS}


class _Words:
    """All words of a page as one text, and where those of each text node begin."""

    def __init__(self, page: _Page) -> None:
        pieces = [" ".join(node.split()) for node in page.text_nodes]
        self.starts = list(accumulate([len(own) + 1 if own else 0 for own in pieces], initial=0))
        self.text = " ".join([own for own in pieces if own])

    def spans(self, page: _Page, elements: list[int]) -> list[tuple[int, int]]:
        """``at, size`` of each element's words as a span of ``text``."""
        at, starts, stops = self.starts, page.text_starts, page.text_stops
        return [((a := at[starts[e]]), max(at[stops[e]] - a - 1, 0)) for e in elements]


def _offsets(texts: list[str]) -> list[int]:
    """Where each text begins when they are joined, and the end."""
    return list(accumulate(map(len, texts), initial=0))


def _first_ends(places: list[tuple[int, int]], offsets: list[int]) -> list[int]:
    """For each offset the least end of the places that begin there or later; past all offsets if none does.

    A span of texts holds a place if its start's value does not pass its end's offset.
    """
    out, least, i = [0] * len(offsets), offsets[-1] + 1, len(places)
    for k in range(len(offsets) - 1, -1, -1):
        while i and places[i - 1][0] >= offsets[k]:
            i -= 1
            least = min(least, places[i][1])
        out[k] = least
    return out


def _dates(text: str) -> list[tuple[int, int]]:
    return [(m.start(), m.end(1)) for m in _DATE.finditer(text)]


def _all_of(wanted: str, text: str) -> list[tuple[int, int]]:
    found, at = [], text.find(wanted)
    while at >= 0:
        found.append((at, at + len(wanted)))
        at = text.find(wanted, at + 1)
    return found


def _label_facts(page: _Page, labels: list[str]) -> list[dict]:
    """For each of ``labels`` the value beside the first element that contains it."""
    names = [node.strip().lower() for node in page.text_nodes]
    joined = "".join(names)
    labels = [label for label in labels if label in joined]
    if not labels:
        return []
    offsets = _offsets(names)
    tags, parents = page.tags, page.parents
    beside: list[tuple[int, int, int]] = []
    # Backwards, so that the nearest later sibling that may hold a value is at hand.
    after: dict[int, int] = {}
    for e in range(len(tags) - 1, -1, -1):
        tag, parent = tags[e], parents[e]
        if tag in LABEL_ELEMENTS:
            value = after.get(parent)
            if value is None and parent >= 0:
                value = page.next_sibling(parent)
            if value is not None:
                beside.append((page.text_starts[e], page.text_stops[e], value))
        if tag in VALUE_ELEMENTS:
            after[parent] = e
    beside.reverse()
    facts = []
    for label in labels:
        places = _all_of(label, joined)
        if len(places) == 1:
            (start, stop), = places
            value = next((v for a, b, v in beside if offsets[a] <= start and stop <= offsets[b]), None)
        else:
            first_end = _first_ends(places, offsets)
            value = next((v for a, b, v in beside if first_end[a] <= offsets[b]), None)
        if value is not None:
            facts.append({"label": label, "value": page.words(value)})
    return facts


_NO_ROW = {"n_cells": 0, "date_cell": 0, "cells": [], "date": [], "all_heads": False, "link": ""}


def _table_facts(page: _Page, words: _Words, base: str) -> tuple[list[dict], list[dict]]:
    """Tables with the rows and dated rows inside them, and the rows of the tables with most."""
    tags, stops = page.tags, page.stops
    numbers = [i for i, tag in enumerate(tags) if tag == "tr"]
    outer = [i for i, tag in enumerate(tags) if tag == "table"]
    rows = [_NO_ROW] * len(numbers)  # those that are not wanted keep their places only
    starts, ends = page.text_starts, page.text_stops
    joined = "".join(page.text_nodes)
    dates = _dates(joined) if numbers and outer else []
    if dates:
        offsets = _offsets(page.text_nodes)
        first_date = _first_ends(dates, offsets)
        before = list(accumulate([first_date[starts[i]] <= offsets[ends[i]] for i in numbers], initial=0))
    else:
        before = [0] * (len(numbers) + 1)
    tables = []
    for i in outer:
        first, last = bisect_left(numbers, i), bisect_left(numbers, stops[i])
        tables.append({"first": first, "rows": last - first, "dated": before[last] - before[first]})
    most = max([t["dated"] for t in tables], default=0)
    if not most:
        return tables, rows
    wanted = set()
    for t in tables:
        if t["dated"] == most:
            wanted.update(range(t["first"], t["first"] + t["rows"]))
    # Cells and links inside the wanted rows, which lie between the first and the last of them.
    low, high = numbers[min(wanted)], max([stops[numbers[k]] for k in wanted])
    cells = [i for i in range(low, high) if tags[i] in _CELLS]
    spans = words.spans(page, cells)
    next_dated = _next([first_date[starts[i]] <= offsets[ends[i]] for i in cells])
    heads = list(accumulate([tags[i] == "th" for i in cells], initial=0))
    hrefs = {i: page.attributes(i).get("href", "").strip() for i in page.attribute_texts if tags[i] == "a" and low <= i < high}
    links = [i for i, href in hrefs.items() if href not in ("", "#")]
    for k in wanted:
        i = numbers[k]
        stop = stops[i]
        a, b = bisect_left(cells, i), bisect_left(cells, stop)
        at = next_dated[a] if a < b and next_dated[a] < b else None
        nearest = bisect_left(links, i)
        link, error = "", None
        if nearest < len(links) and links[nearest] < stop:
            link, error = _resolved(base, hrefs[links[nearest]])
        rows[k] = {
            "n_cells": b - a,
            "date_cell": 0 if at is None else at - a + 1,
            "cells": spans[a:min(b, a + ROW_CELLS)],
            "date": [] if at is None else [spans[at]],
            "all_heads": heads[b] - heads[a] == b - a,
            "link": link or "",
            "link_error": error,
        }
    return tables, rows


def _next(flags: list[bool]) -> list[int]:
    """For each place the next one, itself included, that is set; the list's length if none is."""
    out, at = [0] * len(flags), len(flags)
    for i in range(len(flags) - 1, -1, -1):
        at = i if flags[i] else at
        out[i] = at
    return out


@lru_cache(256)
def _site(base: str) -> str:
    """What ``urljoin`` puts before a path from the root."""
    return urljoin(base, "/")[:-1]


def _resolved(base: str, link: str | None) -> tuple[str | None, str | None]:
    try:
        if link and _ROOT_PATH.fullmatch(link):
            return _site(base) + link, None
        return (urljoin(base, link) if link else None), None
    except ValueError as exc:
        return None, str(exc)


def _facts(html: str, base: str, labels: list[str], project: bool = True, events: bool = True) -> dict:
    page = _Page(html)
    facts = _event_facts(page, base) if events else {}
    return {**facts, **_project_facts(page, base, labels)} if project else facts


def _event_facts(page: _Page, base: str) -> dict:
    words = _Words(page)
    tables, rows = _table_facts(page, words, base)
    return {"words": words.text if rows else "", "tables": tables, "rows": rows}


def _project_facts(page: _Page, base: str, labels: list[str]) -> dict:
    texts = page.first_texts()
    links = (page.attributes(i) for i in page.attribute_texts if page.tags[i] == "link")
    canonical = next((attrs for attrs in links if "canonical" in attrs.get("rel", "").split()), None)
    link, link_error = _resolved(base, canonical.get("href") if canonical else None)
    return {
        "headings": [texts.get(s) for s in TITLE_SELECTORS],
        "authors": next((texts[s] for s in AUTHOR_SELECTORS if s in texts), None),
        "canonical_link": link,
        "canonical_link_error": link_error,
        "labels": _label_facts(page, labels),
    }


def _outline(
    html: str | None, base: str | None, labels: list[str], project: bool = True, events: bool = True
) -> dict | None:
    if html is None:
        return None
    try:
        return _facts(html, base or "", labels, project, events)
    except Exception as exc:  # the page is reported, the task goes on
        return {"error": str(exc) or type(exc).__name__}


def _outlines(labels: list[str]):
    """The Arrow step; the labels go to the workers with it, not with each row."""

    @F.arrow_udf(from_arrow_type(_OUTLINE))
    def outlines(html: pa.Array, base: pa.Array, project: pa.Array, events: pa.Array) -> pa.Array:
        return pa.array([
            _outline(h.as_py(), b.as_py(), labels, p.as_py(), e.as_py())
            for h, b, p, e in zip(html, base, project, events)
        ], type=_OUTLINE)

    return outlines


def page_outline(
    html: Column, base_url: Column, labels: list[str], project: Column | None = None, events: Column | None = None
) -> Column:
    """Outline of a page; links are resolved against the site of ``base_url``.

    Of the page's label elements only the values beside ``labels`` are kept. Where ``project`` is
    not true, what a project is read from (headings, authors, the canonical link, labels) is not
    looked for and null; where ``events`` is not true, tables, rows and their words.
    """
    outlines = _outlines([label.lower() for label in labels])
    return outlines(html, url_origin(base_url), *(F.lit(True) if c is None else c for c in (project, events)))


def clean_node_text(html: Column) -> Column:
    """All visible text of a fragment, its words joined by one space; blank if it cannot be read."""
    return F.coalesce(_words(html), F.lit(""))


@F.arrow_udf(T.StringType())
def _words(html: pa.Array) -> pa.Array:
    def words(markup: str) -> str | None:
        try:
            return _Page(markup).all_words()
        except Exception:  # the value is blank, the task goes on
            return None

    return pa.array([None if h is None else words(h) for h in html.to_pylist()], pa.string())
