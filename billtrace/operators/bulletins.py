"""Text of the anchored blocks of an HTML page.

A page is read tag by tag, as a browser would: attributes in any order and quoting, ``>`` inside
quotes, comments, scripts and styles, entities, tags left open. An element with a ``name`` or an ``id``
(or another attribute that is asked for) starts a block; it lasts until the next such element.
"""

from __future__ import annotations

from collections.abc import Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = "array<struct<ancora:string,elemento:string,testo:string>>"
# Elements whose content is no text, and those that end a line or cell and so separate words.
SILENT = {"script", "style", "template", "noscript"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "cite", "code", "em", "font", "i", "kbd", "mark", "q", "s", "samp", "small", "span", "strong", "sub", "sup", "u", "var"}


class _Reader(HTMLParser):
    def __init__(self, marks: Sequence[str]):
        super().__init__(convert_charrefs=True)
        self.marks, self.blocks, self.silent = marks, [], None

    def handle_starttag(self, tag, attrs):
        if self.silent:
            return
        if tag in SILENT:
            self.silent = tag
            return
        given = dict(reversed(attrs))  # of an attribute given twice the first counts
        anchor = next((given[m] for m in self.marks if given.get(m)), None)
        if anchor is not None:
            self.blocks.append((anchor, tag, []))
        elif tag not in INLINE:
            self._add(" ")

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag == self.silent:
            self.silent = None

    def handle_endtag(self, tag):
        if tag == self.silent:
            self.silent = None
        elif tag not in INLINE:
            self._add(" ")

    def handle_data(self, data):
        if not self.silent:
            self._add(data)

    def _add(self, text):
        if self.blocks:
            self.blocks[-1][2].append(text)


def read_blocks(html: str | None, marks: Sequence[str] = ("name", "id")) -> list[tuple[str, str, str]]:
    """(anchor, element, text) of each block of a page in order, white space collapsed."""
    reader = _Reader(marks)
    reader.feed(html or "")
    reader.close()
    return [(anchor, tag, " ".join("".join(text).split())) for anchor, tag, text in reader.blocks]


def html_blocks(html: Column | str, marks: Sequence[str] = ("name", "id")) -> Column:
    """The blocks of each page, as an array. NULL and pages without anchors have none."""

    @F.pandas_udf(BLOCK)
    def blocks(pages: pd.Series) -> pd.Series:
        return pages.map(lambda page: [dict(zip(("ancora", "elemento", "testo"), b, strict=True)) for b in read_blocks(page, marks)])

    return blocks(F.col(html) if isinstance(html, str) else html)


def block_text(html: Column | str, anchor: Column | str, marks: Sequence[str] = ("name", "id")) -> Column:
    """Text of the first block with this anchor, NULL where there is none."""
    wanted = F.lit(anchor) if isinstance(anchor, str) else anchor
    return F.get(F.filter(html_blocks(html, marks), lambda b: b["ancora"] == wanted), F.lit(0))["testo"]
