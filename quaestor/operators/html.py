"""Flat text of HTML pages, with tables as markdown.

Element trees are beyond regular expressions, so pages go through a small
parser in Arrow batches. (On pages without tables a chain of regular
expressions gave the same text, but took twice as long as the parser.)
"""

from __future__ import annotations

import re
from collections import defaultdict
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

# Elements that never hold anything.
VOID = frozenset("area base basefont bgsound br col command embed frame hr image img input isindex keygen "
                 "link menuitem meta nextid param source spacer track wbr".split())

# Elements whose content is not read as markup.
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript plaintext".split())
BARE_START, BARE_END = re.compile("<([a-zA-Z][a-zA-Z0-9]*)>"), re.compile("</([a-zA-Z][a-zA-Z0-9]*)>")


def markdown_table(rows: list[list[str]]) -> str:
    """Rows with any text as markdown lines, with a separator behind the first of several."""
    lines = ["| " + " | ".join(cells) + " |" for cells in rows if any(cells)]
    if len(lines) > 1:
        lines.insert(1, "|" + "---|" * (lines[0].count("|") - 1))
    return "\n".join(lines)


class _Cell:
    def __init__(self, span: int):
        self.words: list[str] = []
        self.span = span


class FlatText(HTMLParser):
    """Collects stripped text runs in document order.

    ``open_tags`` mirrors the element tree. Inside the outermost table, text
    goes to every open cell and cells go to every open row, so nested tables
    repeat in their surroundings.
    """

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.parts: list[str] = []
        self.run: list[str] = []
        self.open_tags: list[str] = []
        self.places: dict[str, list[int]] = defaultdict(list)  # depths of the open tags of each name
        self.rows: list[tuple[int, list[_Cell]]] = []
        self.open_rows: list[tuple[int, list[_Cell]]] = []
        self.open_cells: list[tuple[int, _Cell]] = []
        self.table_depth: int | None = None
        self.body: list[int] | None = None

    def updatepos(self, i, j):
        """Line numbers are not kept."""
        return j

    def parse_starttag(self, i):
        bare = BARE_START.match(self.rawdata, i)
        if bare is None or (tag := bare[1].lower()) in RAW:
            return super().parse_starttag(i)
        self.lasttag = tag
        self.handle_starttag(tag, ())
        return bare.end()

    def parse_endtag(self, i):
        bare = BARE_END.match(self.rawdata, i) if self.cdata_elem is None else None
        if bare is None:
            return super().parse_endtag(i)
        self.handle_endtag(bare[1].lower())
        return bare.end()

    def _flush(self) -> None:
        if not self.run:
            return
        text = "".join(self.run).strip()
        self.run = []
        if not text or self.places["script"] or self.places["style"]:
            return
        if self.table_depth is None:
            self.parts.append(text + " ")
        else:
            for _, cell in self.open_cells:
                cell.words.append(text)

    def _aside(self, text: str) -> None:
        """Comments and declarations count as text outside of tables only."""
        self._flush()
        if self.table_depth is None:
            self.run = [text]
            self._flush()

    def _close_to(self, depth: int) -> None:
        while len(self.open_tags) > depth:
            self.places[self.open_tags.pop()].pop()
        for opened in (self.open_rows, self.open_cells):
            while opened and opened[-1][0] >= depth:
                opened.pop()
        if self.table_depth is not None and depth <= self.table_depth:
            table = markdown_table([[w for c in cells for w in
                                     [" ".join(" ".join(c.words).split()), *[""] * (c.span - 1)]]
                                    for _, cells in self.rows])
            if table:
                self.parts.append(f"\n\n{table}\n\n")
            self.table_depth, self.rows = None, []
        if self.body and len(self.body) == 2 and depth <= self.body[1]:
            self.body = [self.body[0], self.body[1], len(self.parts)]

    def handle_starttag(self, tag, attrs):
        self._flush()
        depth = len(self.open_tags)
        if tag == "body" and self.body is None:
            self.body = [len(self.parts), depth]
        if self.table_depth is None:
            if tag == "table":
                self.table_depth = depth
        elif tag == "tr":
            row = (depth, [])
            self.rows.append(row)
            self.open_rows.append(row)
        elif tag in ("td", "th"):
            span = dict(attrs).get("colspan") or "1" if attrs else "1"
            cell = _Cell(int(span) if span.strip().isdecimal() else 1)
            for _, cells in self.open_rows:
                cells.append(cell)
            self.open_cells.append((depth, cell))
        self.open_tags.append(tag)
        self.places[tag].append(depth)
        if tag in VOID:
            self._close_to(depth)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._flush()
        if self.places[tag]:
            self._close_to(self.places[tag][-1])

    def handle_data(self, data):
        self.run.append(data)

    def handle_entityref(self, name):
        self.run.append(html5.get(name + ";", "&" + name))

    def handle_charref(self, name):
        """Numbers below 256 mean Windows-1252 where that has a character; numbers of no character are replaced."""
        digits, base = (name[1:], 16) if name[:1] in "xX" else (name, 10)
        digits = digits.lstrip("0")
        code = int(digits, base) if 0 < len(digits) <= 7 else 0
        if code == 0 or code > 0x10FFFF or 0xD800 <= code < 0xE000:
            self.run.append("\N{REPLACEMENT CHARACTER}")
        elif code < 256:
            self.run.append(bytes([code]).decode("cp1252", errors="ignore") or chr(code))
        else:
            self.run.append(chr(code))

    def handle_comment(self, data):
        self._aside(data)

    def handle_decl(self, decl):
        self._aside(decl[len("DOCTYPE "):] if decl[:8].upper() == "DOCTYPE " else decl)

    def unknown_decl(self, data):
        self._aside(data[6:] if data.upper().startswith("CDATA[") else data)

    def handle_pi(self, data):
        self._aside(data)

    def text(self) -> str:
        self._flush()
        self._close_to(0)
        if self.body is None:
            return "".join(self.parts)
        return "".join(self.parts[self.body[0]:self.body[2]])


def page_text(html: str | bytes) -> tuple[str | None, str | None]:
    """Text and error; one of them is None, so one bad page does not end a run. Bad bytes are replaced."""
    parser = FlatText()
    try:
        parser.feed(bytes(html).decode("utf-8", errors="replace") if not isinstance(html, str) else html)
        parser.close()
        return parser.text(), None
    except Exception as failure:  # whatever the parser rejects stays with its row
        return None, f"{type(failure).__name__}: {failure}"


PARSED = T.StructType([T.StructField("text", T.StringType()), T.StructField("error", T.StringType())])


@F.pandas_udf(PARSED)
def _parsed_text(pages: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([(None, None) if page is None else page_text(page) for page in pages], columns=["text", "error"])


def html_to_text(pages: DataFrame, html: str = "html", name: str = "text", error: str | None = None) -> DataFrame:
    """``html`` holds text or bytes. With ``error`` a column of that name says why a page has no text."""
    parsed = pages.withColumn("_parsed_page", _parsed_text(F.col(html)))
    out = parsed.withColumn(name, F.col("_parsed_page.text"))
    return (out.withColumn(error, F.col("_parsed_page.error")) if error else out).drop("_parsed_page")
