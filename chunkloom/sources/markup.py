"""Raw markup to elements."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame

from ..operators.tables import find_tables

# What each element of a page becomes, and what is skipped.
CATEGORY = {
    "h1": "Title",
    "h2": "Title",
    "h3": "Title",
    "h4": "Title",
    "h5": "Title",
    "h6": "Title",
    "p": "NarrativeText",
    "pre": "NarrativeText",
    "blockquote": "NarrativeText",
    "li": "ListItem",
    "header": "Header",
    "nav": "Header",
    "footer": "Footer",
    "table": "Table",
}
SKIPPED = {"script", "style", "head", "template", "noscript"}
BLOCKS = {"div", "article", "section", "main", "aside", "ul", "ol", "body", "html", "br"}


FRAME_CHARS = 1 << 20  # of markup, after which its elements leave Python


class _Page(HTMLParser):
    """Text runs of a page with the category of the innermost element that names one."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[str] = []
        self.words: list[str] = []
        self.kind = "Text"
        self.found: list[tuple[str, str]] = []

    def _flush(self) -> None:
        text = re.sub(r"\s+", " ", "".join(self.words)).strip()
        if text or self.kind == "Table":
            self.found.append((self.kind, text))
        self.words = []

    def _name_kind(self) -> None:
        named = [CATEGORY[t] for t in self.open if t in CATEGORY]
        framed = [k for k in ("Table", "Header", "Footer") if k in named]
        self.kind = framed[0] if framed else named[-1] if named else "Text"

    def _close(self, tag) -> None:
        at = len(self.open) - 1 - self.open[::-1].index(tag)
        del self.open[at:]

    def handle_starttag(self, tag, attrs):
        if tag not in CATEGORY and tag not in BLOCKS and tag not in SKIPPED:
            return
        if "table" in self.open:
            # Everything inside a table is one text; only the depth of nested tables is kept.
            if tag == "table":
                self.open.append(tag)
            return
        self._flush()
        if tag == "br":
            return
        # A block ends a paragraph that was left open, and a list item the one before it.
        if "p" in self.open:
            self._close("p")
        if tag == "li" and [t for t in self.open if t in ("li", "ul", "ol")][-1:] == ["li"]:
            self._close("li")
        self.open.append(tag)
        self._name_kind()

    def handle_endtag(self, tag):
        if tag not in self.open or ("table" in self.open and tag != "table"):
            return
        if self.open.count("table") < 2:
            self._flush()
        self._close(tag)
        self._name_kind()

    def handle_data(self, data):
        if not SKIPPED.intersection(self.open):
            self.words.append(data)

    def close(self):
        super().close()
        self._flush()


def _outer_tables(html: str) -> Iterator[str]:
    found, at = find_tables(html), 0
    while at < len(found):
        yield found[at]
        at += found[at].count("<table")  # itself and the tables nested in it


def page_elements(html: str) -> list[tuple[str, str, str | None]]:
    page = _Page()
    page.feed(html)
    page.close()
    tables = _outer_tables(html) if any(kind == "Table" for kind, _ in page.found) else iter(())
    paired = [(kind, text, next(tables, None) if kind == "Table" else None) for kind, text in page.found]
    return [element for element in paired if element[1]]


def html_to_elements(pages: DataFrame, key: str = "doc_id", content: str = "html") -> DataFrame:
    """Elements of raw pages: ``doc_id, pos, category, text, page_number, html``.

    Pages are independent, so this is a map over partitions; only key and markup enter Python.
    """
    key_type = pages.schema[key].dataType.simpleString()
    names = ["doc_id", "pos", "category", "text", "page_number", "html"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, held = [], 0
            for doc, html in zip(batch[key], batch[content]):
                rows.extend((doc, pos, kind, text, 1, table) for pos, (kind, text, table) in enumerate(page_elements(html or "")))
                held += len(html or "")
                if held >= FRAME_CHARS:
                    yield pd.DataFrame(rows, columns=names)
                    rows, held = [], 0
            yield pd.DataFrame(rows, columns=names)

    schema = f"doc_id {key_type}, pos long, category string, text string, page_number int, html string"
    return pages.select(key, content).mapInPandas(run, schema)
