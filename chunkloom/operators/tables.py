"""HTML tables inside chunk text: find them, and cut those that are too long between rows."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import escape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.tokens import Counter, token_estimate

# Elements that have no end tag.
VOID_TAGS = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
    "track", "wbr",
}


def _attribute(name: str, value: str | None) -> str:
    value = escape(value or "", quote=False)
    quote = "'" if '"' in value and "'" not in value else '"'
    return f" {name}={quote}{value.replace(quote, '&quot;')}{quote}"


class _TableFinder(HTMLParser):
    """Keeps the markup of every table, nested ones too, in the order they open."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[list[str]] = []
        self.path: list[tuple[str, int | None]] = []  # open tags, with the table slot of table tags

    def _write(self, markup: str) -> None:
        for tag, slot in self.path:
            if slot is not None:
                self.found[slot].append(markup)

    def handle_starttag(self, tag, attrs):
        slot = None
        if tag == "table":
            slot = len(self.found)
            self.found.append([])
            self.path.append((tag, slot))
        if not self.path:
            return
        if slot is None and tag not in VOID_TAGS:
            self.path.append((tag, None))
        self._write(f"<{tag}{''.join(_attribute(k, v) for k, v in dict(attrs).items())}"
                    f"{'/' if tag in VOID_TAGS else ''}>")  # fmt: skip

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in (t for t, _ in self.path):
            while True:
                last = self.path[-1][0]
                self._write(f"</{last}>")
                self.path.pop()
                if last == tag:
                    break

    def handle_data(self, data):
        if self.path:
            self._write(escape(data, quote=False))

    def close(self):
        super().close()
        while self.path:
            self._write(f"</{self.path[-1][0]}>")
            self.path.pop()


def find_tables(html: str) -> list[str]:
    finder = _TableFinder()
    finder.feed(html)
    finder.close()
    return ["".join(parts) for parts in finder.found]


class _RowReader(HTMLParser):
    """Rows of the outermost table as cells ``(text, is_header, colspan, rowspan)`` with their section."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.depth = 0
        self.section = ""
        self.rows: list[tuple[str, list[list]]] = []
        self.cell: list | None = None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.depth += 1
        if self.depth != 1:
            return
        if tag in ("thead", "tbody", "tfoot"):
            self.section = tag
        elif tag == "tr":
            self.rows.append((self.section, []))
            self.cell = None
        elif tag in ("td", "th") and self.rows:
            spans = dict(attrs)
            span = [int(spans.get(k) or 1) if (spans.get(k) or "1").isdigit() else 1
                    for k in ("colspan", "rowspan")]
            self.cell = ["", tag == "th", *span]
            self.rows[-1][1].append(self.cell)

    def handle_endtag(self, tag):
        if tag == "table":
            self.depth -= 1
        elif self.depth == 1 and tag in ("td", "th", "tr"):
            self.cell = None

    def handle_data(self, data):
        if self.cell is not None:
            self.cell[0] += data


def _spread(rows: list[list[list]]) -> list[list[str]]:
    """Repeat cells over their column and row spans."""
    out, pending = [], {}
    for cells in rows:
        line, column, queue = [], 0, list(cells)
        waiting, pending = pending, {}
        while queue or column in waiting:
            if column in waiting:
                text, left = waiting.pop(column)
                line.append(text)
                if left > 1:
                    pending[column] = (text, left - 1)
                column += 1
                continue
            text, _, colspan, rowspan = queue.pop(0)
            text = re.sub(r"[\r\n]+|\s{2,}", " ", text).strip()
            for _ in range(colspan):
                line.append(text)
                if rowspan > 1:
                    pending[column] = (text, rowspan - 1)
                column += 1
        out.append(line)
    return out


def table_lines(html: str) -> tuple[list[list[str]], int]:
    """Cells of the first table, all rows equally long, and how many rows at the top are its header."""
    reader = _RowReader()
    reader.feed(html)
    reader.close()
    head = [r for s, r in reader.rows if s == "thead"]
    body = [r for s, r in reader.rows if s not in ("thead", "tfoot")]
    foot = [r for s, r in reader.rows if s == "tfoot"]
    if not head:
        while body and body[0] and all(cell[1] for cell in body[0]):
            head.append(body.pop(0))
    lines = _spread(head) + _spread(body + foot)
    width = max((len(line) for line in lines), default=0)
    return [line + [""] * (width - len(line)) for line in lines], len(head)


def table_frame(lines: list[list[str]], n_head: int) -> pd.DataFrame:
    """The table as a frame, typed the way pandas types text tables."""
    from pandas.io.parsers import TextParser

    header = None
    if n_head == 1:
        header = 0
    elif n_head:
        header = [i for i, line in enumerate(lines[:n_head]) if any(line)]
    with TextParser(lines, header=header, thousands=",") as parser:
        return parser.read()


# Cells that are read as missing.
MISSING = {
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
    "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
}
_GROUPED_NUMBER = re.compile(r"[-\d.]*,[-\d,.]*")


def _is_word(cell: str) -> bool:
    try:
        float(cell)
    except ValueError:
        return cell.lower() not in ("true", "false")
    return False


def _plain_columns(lines: list[list[str]], n_head: int) -> list[str] | None:
    """Column names when every cell would stay the text it is, otherwise nothing."""
    body = lines[n_head:]
    if n_head > 1 or not body or not body[0]:
        return None
    if any(c in MISSING or _GROUPED_NUMBER.fullmatch(c) for line in body for c in line):
        return None
    if not all(any(_is_word(line[k]) for line in body) for k in range(len(body[0]))):
        return None
    names = lines[0] if n_head else [str(k) for k in range(len(body[0]))]
    return names if len(set(names)) == len(names) and all(names) else None


def _frame_html(frame: pd.DataFrame) -> str:
    return frame.to_html(index=False, border=0, classes=None)


def _cell(tag: str, text: str) -> str:
    shown = text.replace("\t", r"\t").replace("\r", r"\r").replace("\n", r"\n")
    return f"      <{tag}>{escape(shown, quote=False).strip()}</{tag}>\n"


def _table_writer(html: str):
    """Number of rows of a table, and a function from row numbers to the html of these rows.

    Tables of plain text, by far the most common, are written directly; going through pandas costs
    milliseconds per row. Rows of other tables are rebuilt one by one, so that they lose their common
    type the way a row-wise copy does.
    """
    lines, n_head = table_lines(html)
    names = _plain_columns(lines, n_head)
    if names is None:
        frame = table_frame(lines, n_head)
        return len(frame), lambda rows: _frame_html(pd.concat([frame.iloc[i].to_frame().T for i in rows]))
    head = "".join(_cell("th", n) for n in names)
    written = ["    <tr>\n" + "".join(_cell("td", c) for c in row) + "    </tr>\n" for row in lines[n_head:]]
    before = (
        f'<table class="dataframe">\n  <thead>\n    <tr style="text-align: right;">\n{head}    </tr>\n'
        "  </thead>\n  <tbody>\n"
    )
    return len(written), lambda rows: before + "".join(written[i] for i in rows) + "  </tbody>\n</table>"


def split_table(html: str, limit: int, count) -> list[str]:
    """Greedy row groups of at most ``limit`` tokens; each row is measured as a table of its own."""
    n_rows, write = _table_writer(html)
    groups: list[list[int]] = []
    used = 0
    for i in range(n_rows):
        size = count(write([i]))
        if not groups or used + size > limit:
            groups.append([])
            used = 0
        groups[-1].append(i)
        used += size
    return [write(rows) for rows in groups]


def cut_to_size(html: str, limit: int, count) -> list[str]:
    """Parts of a table below ``limit`` tokens; one whose rows cannot be read stays whole, unless it holds nothing."""
    if count(html) < limit:
        return [html] if html else []
    try:
        return split_table(html, limit, count)
    except (ValueError, IndexError):
        return [html] if re.sub("<[^>]*>", "", html).strip() else []


# ---------------------------------------------------------------- tables cut with their own markup


class _Cell:
    def __init__(self, tag: str, opening: str, begin: int, spans: dict):
        self.tag, self.opening, self.begin, self.inner, self.text = tag, opening, begin, "", ""
        self.colspan, self.rowspan = (
            int(v) if (v := (spans.get(k) or "1").strip()).isdecimal() and int(v) else 1 for k in ("colspan", "rowspan")
        )

    def written(self, inner: str) -> str:
        opening = self.opening
        if self.rowspan > 1:
            opening = re.sub(r"""\srowspan\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", "", opening, flags=re.IGNORECASE)
        return f"{opening}{inner}</{self.tag}>"


class _MarkupReader(HTMLParser):
    """Rows ``(section, cells)`` of the outermost tables; cells keep their markup as it is written.

    A caption, and text outside of cells, are rows of the section ``caption``.
    """

    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.html, self.lines = html, [0, *(m.end() for m in re.finditer("\n", html))]
        self.depth, self.section, self.opening = 0, "", ""
        self.rows: list[tuple[str, list[_Cell]]] = []
        self.row: list[_Cell] | None = None
        self.cell: _Cell | None = None
        self.feed(html)
        self.close()
        self._end_cell(len(html))

    def _at(self) -> int:
        line, offset = self.getpos()
        return self.lines[line - 1] + offset

    def _end_cell(self, at: int) -> None:
        if self.cell is not None:
            self.cell.inner, self.cell = self.html[self.cell.begin : at], None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.depth += 1
            if self.depth == 1:
                self.opening, self.section, self.row = self.opening or self.get_starttag_text(), "", None
            return
        if self.depth != 1 or tag not in ("thead", "tbody", "tfoot", "tr", "td", "th", "caption"):
            return
        self._end_cell(self._at())
        if tag in ("thead", "tbody", "tfoot"):
            self.section, self.row = tag, None
            return
        if tag == "tr" or self.row is None:
            self.row = []
            self.rows.append(("caption" if tag == "caption" else self.section, self.row))
        if tag != "tr":
            opening = self.get_starttag_text()
            self.cell = _Cell(tag, opening, self._at() + len(opening), dict(attrs))
            self.row.append(self.cell)

    def handle_endtag(self, tag):
        if tag == "table":
            if self.depth == 1:
                self._end_cell(self._at())
                self.row = None
            self.depth = max(self.depth - 1, 0)
        elif self.depth == 1 and tag in ("thead", "tbody", "tfoot", "tr", "td", "th", "caption"):
            self._end_cell(self._at())
            if tag not in ("td", "th"):
                self.row = None
            if tag.startswith("t") and tag not in ("td", "th", "tr"):
                self.section = ""

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.text += data
        elif data.strip():
            stray = _Cell("caption", "<caption>", 0, {})
            stray.inner, stray.text = escape(data, quote=False), data
            self.rows.append(("caption", [stray]))


def _single_rows(rows: list[tuple[str, list[_Cell]]]) -> list[tuple[str, list[tuple[_Cell | None, bool]]]]:
    """Cells ``(cell, is its own row)``, those that span rows repeated in each, so that any row can begin a table."""
    out, pending, last = [], {}, None
    for section, cells in rows:
        if section == "caption":
            out.append((section, [(c, True) for c in cells]))
            continue
        waiting, pending, last = pending if section == last else {}, {}, section
        line, column, queue = [], 0, list(cells)
        while queue or any(k >= column for k in waiting):
            if column in waiting:
                cell, left = waiting.pop(column)
                line.append((cell, False))
            elif queue:
                cell = queue.pop(0)
                left = cell.rowspan
                line.append((cell, True))
            else:
                cell, left = None, 1
                line.append((None, False))
            if left > 1:
                pending[column] = (cell, left - 1)
            column += cell.colspan if cell else 1
        out.append((section, line))
    return out


def _dense(text: str) -> str:
    return "".join(text.split())


def cut_table(text: str, html: str | None, limit: int, cut) -> list[tuple[str, str | None]]:
    """Pieces ``(text, html)`` of a table whose text is longer than ``limit`` characters.

    Pieces end between rows and have a table of their own with the header repeated; their texts together are the
    text of the table. A row longer than the limit is continued in further rows of as many columns, between cells
    or, by ``cut``, inside a cell (that cell keeps its text, not the markup in it). When text and markup do not say
    the same, the text is cut by itself and the rows are dealt over its pieces in order. Markup without rows stays
    whole with the first piece.
    """
    if not isinstance(html, str) or not html.strip():
        return [(p, None) for p in cut(text, limit)]
    reader = _MarkupReader(html)
    rows = _single_rows(reader.rows)
    own = [cell for _, line in rows for cell, mine in line if mine]
    if not any(section != "caption" for section, _ in rows):
        return [(p, None if i else html) for i, p in enumerate(cut(text, limit))]
    agree = _dense(text) == "".join(_dense(c.text) for c in own)
    body = text if agree else " ".join(" ".join(c.text.split()) for c in own)

    # Where the text of each cell lies in the body; both have the same characters, spaces apart.
    solid = [i for i, c in enumerate(body) if not c.isspace()]
    place, used = {}, 0
    for cell in own:
        size = len(_dense(cell.text))
        if size:
            place[id(cell)] = solid[used], solid[used + size - 1] + 1
        used += size

    def extent(line) -> tuple[int, int] | None:
        spans = [place[id(c)] for c, mine in line if mine and id(c) in place]
        return (spans[0][0], spans[-1][1]) if spans else None

    def written(section, line, shown=None, inner=None) -> str:
        """A row; with ``shown``, of the cells that have text only this one."""
        out = []
        for cell, mine in line:
            if cell is None:
                out.append("<td></td>")
                continue
            bare = (id(cell) in place and cell is not shown) if shown else not mine and len(cell.text) > limit
            out.append(cell.written("" if bare else inner if cell is shown and inner is not None else cell.inner))
        return "".join(out) if section == "caption" else f"<tr>{''.join(out)}</tr>"

    def units(section, line):
        """``(begin and end in the body, markup)`` of a row or of its parts."""
        whole = extent(line)
        if whole is None or whole[1] - whole[0] <= limit:
            yield whole, written(section, line)
            return
        for cell, mine in line:
            if not mine or id(cell) not in place:
                continue
            begin, end = place[id(cell)]
            if end - begin <= limit:
                yield (begin, end), written(section, line, cell)
                continue
            for piece in cut(body[begin:end], limit):
                begin = body.index(piece, begin)
                yield (begin, begin + len(piece)), written(section, line, cell, escape(piece, quote=False))
                begin += len(piece)

    lines = [i for i, (section, _) in enumerate(rows) if section != "caption"]
    is_head = [rows[i][0] == "thead" for i in lines]
    if not is_head[0]:
        is_head = [bool(rows[i][1]) and all(c is not None and c.tag == "th" for c, _ in rows[i][1]) for i in lines]
    n_head = next((k for k, h in enumerate(is_head) if not h), 0)
    head = set(lines[:n_head])
    spans = [e for i in sorted(head) if (e := extent(rows[i][1]))]
    if spans and spans[-1][1] - spans[0][0] > limit:
        head = set()
    top = "".join(written(*rows[i]) for i in sorted(head))

    texts = None if agree else cut(text, limit)
    groups = [[None, None, "", ""] for _ in texts or [0]]  # begin, end, captions, rows
    at = 0
    for i, (section, line) in enumerate(rows):
        for where, markup in units(section, line):
            if where and not agree:
                at = where[0] * len(groups) // max(len(body), 1)
            elif where:
                if groups[at][0] is not None and where[1] - groups[at][0] > limit:
                    groups.append([None, None, "", ""])
                    at += 1
                groups[at][0] = where[0] if groups[at][0] is None else groups[at][0]
                groups[at][1] = where[1]
            if i not in head:
                groups[at][2 if section == "caption" else 3] += markup
    top = f"<thead>{top}</thead>" if top else ""
    tables = [f"{reader.opening}{captions}{top}<tbody>{inside}</tbody></table>" for _, _, captions, inside in groups]
    return list(zip(texts if texts is not None else [body[g[0] : g[1]] for g in groups], tables))


def extract_tables(text: Column) -> Column:
    """Array with the markup of every table in the text."""

    @F.pandas_udf("array<string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(find_tables)

    return run(text)


def split_table_rows(table: Column, limit: int = 8100, counter: Counter = token_estimate) -> Column:
    """Array of sub-tables, header repeated, for a table that is too long."""
    count = counter.text

    @F.pandas_udf("array<string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for tables in batches:
            yield tables.map(lambda t: split_table(t, limit, count))

    return run(table)


def tables_of(text: Column, limit: int = 8100, counter: Counter = token_estimate) -> Column:
    """Array with the tables of a chunk, each below ``limit`` tokens; null text gives null."""
    count = counter.text

    @F.pandas_udf("array<string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(
                lambda t: None if t is None else [p for h in find_tables(t) for p in cut_to_size(h, limit, count)]
            )

    return run(text)
