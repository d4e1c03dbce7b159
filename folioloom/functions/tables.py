"""Table markup: HTML to cell tokens and back.

A cell is <fcel> with text or <ecel> without; <lcel> goes on from the left, <ucel> from above, <xcel> from both;
<nl> ends a row.
"""

from __future__ import annotations

import html
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

FULL, EMPTY, LEFT, UP, CROSS, NEW_LINE = "<fcel>", "<ecel>", "<lcel>", "<ucel>", "<xcel>", "<nl>"


class _Rows(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[list[list]] = []  # cells: text, colspan, rowspan
        self.inside = False

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self.rows.append([])
        elif tag in ("td", "th"):
            if not self.rows:
                self.rows.append([])
            spans = dict(attrs)
            self.rows[-1].append(["", *(self._span(spans.get(k)) for k in ("colspan", "rowspan"))])
            self.inside = True

    @staticmethod
    def _span(value: str | None) -> int:
        return max(1, int(value)) if value and value.strip().isdigit() else 1

    def handle_endtag(self, tag):
        if tag in ("td", "th"):
            self.inside = False

    def handle_data(self, data):
        if self.inside:
            self.rows[-1][-1][0] += data


def to_cells(markup: str | None) -> str:
    parser = _Rows()
    parser.feed(markup or "")
    rows = [r for r in parser.rows if r]
    grid: dict[tuple[int, int], str] = {}
    for y, row in enumerate(rows):
        x = 0
        for text, wide, high in row:
            while (y, x) in grid:
                x += 1
            text = text.strip()
            for dy in range(min(high, len(rows) - y)):
                for dx in range(wide):
                    if (y + dy, x + dx) not in grid:
                        grid[y + dy, x + dx] = (FULL + text if text else EMPTY) if not dx and not dy else CROSS if dx and dy else LEFT if dx else UP
            x += wide
    width = max((x for _, x in grid), default=-1) + 1
    return "".join("".join(grid.get((y, x), EMPTY) for x in range(width)) + NEW_LINE for y in range(len(rows)))


def to_html(cells: str | None) -> str:
    cells = (cells or "").strip()
    if re.fullmatch(r"(?s)<table.*</table>", cells):
        return cells
    rows = []
    for line in cells.split(NEW_LINE):
        parts = re.split(r"(<(?:f|e|l|u|x)cel>)", line)[1:]
        if parts:
            rows.append(list(zip(parts[::2], (t.strip() for t in parts[1::2]), strict=True)))
    width = max(map(len, rows), default=0)
    rows = [r + [(EMPTY, "")] * (width - len(r)) for r in rows]
    out = ["<table>"]
    for y, row in enumerate(rows):
        out.append("<tr>")
        for x, (kind, text) in enumerate(row):
            if kind not in (FULL, EMPTY):
                continue
            wide, high = 1, 1
            while x + wide < width and row[x + wide][0] == LEFT:
                wide += 1
            while y + high < len(rows) and rows[y + high][x][0] in (UP, CROSS):
                high += 1
            spans = (f' colspan="{wide}"' if wide > 1 else "") + (f' rowspan="{high}"' if high > 1 else "")
            out.append(f"<td{spans}>{html.escape(text)}</td>")
        out.append("</tr>")
    return "".join([*out, "</table>"])


@F.pandas_udf(StringType())
def html_to_cells(markup: pd.Series) -> pd.Series:
    return markup.map(to_cells)


@F.pandas_udf(StringType())
def cells_to_html(cells: pd.Series) -> pd.Series:
    return cells.map(to_html)


def cells_of_rows(rows: Column) -> Column:
    """Arrays of arrays of texts, without spans, as cell tokens: no UDF needed."""
    cell = lambda t: F.when(F.coalesce(t, F.lit("")) == "", EMPTY).otherwise(F.concat(F.lit(FULL), t))
    return F.array_join(F.transform(rows, lambda r: F.concat(F.array_join(F.transform(r, cell), ""), F.lit(NEW_LINE))), "")
