"""Text normalization.

Plain text, the common case, never leaves the JVM. Only values holding ``<`` or ``&``
go through an Arrow batch to the standard library's tokenizer; all others cross as null.
"""

from __future__ import annotations

from collections.abc import Iterable
from html import unescape
from html.entities import html5
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from recordmill.functions.strings import or_blank, strip

# Elements whose text is not part of the visible text.
HIDDEN_ELEMENTS = frozenset({"script", "style", "template", "rt", "rp"})
# HTML elements without content.
VOID_ELEMENTS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)

_MARKUP_TYPE = pa.struct([("value", pa.string()), ("error", pa.string())])


class _VisibleText(HTMLParser):
    """Collects the visible text nodes of a fragment, in document order."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)
        self.nodes: list[str] = []
        self._run: list[str] = []
        self._open: list[str] = []
        self._count: dict[str, int] = {}
        self._hidden = 0

    def _break(self) -> None:
        if self._run:
            self.nodes.append("".join(self._run))
            self._run = []

    def handle_starttag(self, tag, attrs):
        self._break()
        if tag not in VOID_ELEMENTS:
            self._open.append(tag)
            self._count[tag] = self._count.get(tag, 0) + 1
            self._hidden += tag in HIDDEN_ELEMENTS

    def handle_startendtag(self, tag, attrs):
        self._break()

    def handle_endtag(self, tag):
        """Ends the last open element of that name, and those inside it that are still open."""
        self._break()
        if self._count.get(tag):
            ended = None
            while ended != tag:
                ended = self._open.pop()
                self._count[ended] -= 1
                self._hidden -= ended in HIDDEN_ELEMENTS

    def handle_comment(self, data):
        self._break()

    handle_decl = handle_comment
    handle_pi = handle_comment

    def unknown_decl(self, data):
        self._break()
        if data.upper().startswith("CDATA["):
            self.handle_data(data[len("CDATA["):])
            self._break()

    def handle_data(self, data):
        if not self._hidden:
            self._run.append(data)

    def handle_entityref(self, name):
        self.handle_data(html5.get(name + ";", "&" + name))

    def handle_charref(self, name):
        self.handle_data(unescape(f"&#{name};"))

    def close(self):
        super().close()
        self._break()


def _visible(markup: str) -> dict[str, str | None]:
    try:
        reader = _VisibleText()
        reader.feed(markup)
        reader.close()
        return {"value": unescape(" ".join(reader.nodes)), "error": None}
    except Exception as exc:  # the row is rejected, the task goes on
        return {"value": None, "error": f"{type(exc).__name__}: {exc}"}


def _visible_batch(values: Iterable[str | None]) -> pa.Array:
    return pa.array([None if v is None else _visible(v) for v in values], type=_MARKUP_TYPE)


@F.arrow_udf(from_arrow_type(_MARKUP_TYPE))
def visible_text(markup: pa.Array) -> pa.Array:
    """Visible text of a fragment, text nodes joined by one space; null stays null."""
    return _visible_batch(markup.to_pylist())


def has_markup(c: Column) -> Column:
    return F.contains(c, F.lit("<")) | F.contains(c, F.lit("&"))


def parse_markup(c: Column) -> Column:
    """``struct<value,error>`` for values that need the tokenizer, null for all others."""
    return visible_text(F.when(has_markup(c), c))


def squeeze(c: Column) -> Column:
    """One space for each run of blanks, tabs and line ends; both ends stripped."""
    spaced = c
    for mark in "\t\r\n":
        spaced = F.replace(spaced, F.lit(mark), F.lit(" "))
    # Literal search is much cheaper than a pattern, and most text has no run of spaces.
    return strip(
        F.when(F.contains(spaced, F.lit("  ")), F.regexp_replace(spaced, " {2,}", " "))
        .otherwise(spaced)
    )


def finish_text(c: Column, parsed: Column) -> Column:
    return squeeze(F.coalesce(parsed["value"], or_blank(c)))


def normalize_text(c: Column) -> Column:
    return finish_text(c, parse_markup(c))
