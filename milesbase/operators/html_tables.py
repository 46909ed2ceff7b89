"""HTML table extraction (htm_bonus_table, htm_bank_tables).

Pages are parsed where they live: ``mapInPandas`` runs a small stdlib
``html.parser`` pass per page and emits one row per table row (cells as
``array<string>``); everything after that (lookups, classification, stats) is
column expressions. No page is ever sent to the driver.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from milesbase.operators.transfers import BANK_SECTIONS

_HEADINGS = {"h1", "h2", "h3", "h4"}

ROWS_SCHEMA = "page_id long, section_id int, table_found boolean, row_idx int, cells array<string>"


class _PageEvents(HTMLParser):
    """Document-order events: ('h', text) for h1-h4 and ('table', rows) for top-level tables."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.events: list = []
        self._heading: list | None = None
        self._hidx = -1
        self._depth = 0
        self._rows: list | None = None
        self._row: list | None = None
        self._cell: list | None = None

    def handle_starttag(self, tag, attrs):
        if tag in _HEADINGS and self._heading is None:
            self._heading = []
            self._hidx = len(self.events)
            self.events.append(["h", ""])
        elif tag == "table":
            self._depth += 1
            if self._depth == 1:
                self._rows = []
                self.events.append(["table", self._rows])
        elif tag == "tr" and self._rows is not None:
            self._row = []
            self._rows.append(self._row)
        elif tag in ("td", "th") and self._row is not None:
            self._cell = []
            self._row.append(self._cell)

    def handle_endtag(self, tag):
        if tag in _HEADINGS and self._heading is not None:
            self.events[self._hidx][1] = "".join(self._heading)
            self._heading = None
        elif tag == "table" and self._depth:
            self._depth -= 1
            if self._depth == 0:
                self._rows = self._row = self._cell = None
        elif tag in ("td", "th"):
            self._cell = None
        elif tag == "tr":
            self._row = self._cell = None

    def handle_data(self, data):
        piece = data.strip()
        if not piece:
            return
        if self._heading is not None:
            self._heading.append(piece)
        if self._cell is not None:
            self._cell.append(piece)


def page_events(html: str) -> list:
    p = _PageEvents()
    p.feed(html or "")
    p.close()
    out = []
    for kind, val in p.events:
        if kind == "h":
            out.append(("h", val))
        else:
            out.append(("table", [["".join(c) for c in row] for row in val]))
    return out


EVENTS = "page_id long, events array<struct<pos: int, kind: string, text: string, rows: array<array<string>>>>"


def _events(batches):
    for pdf in batches:
        found = [[{"pos": i, "kind": k, "text": v if k == "h" else None, "rows": v if k == "table" else None}
                  for i, (k, v) in enumerate(page_events(html))] for html in pdf["html"]]
        yield pd.DataFrame({"page_id": pdf["page_id"], "events": found})


def _first_table_rows(batches):
    for pdf in batches:
        out = []
        for page_id, html in zip(pdf["page_id"], pdf["html"]):
            table = next((v for k, v in page_events(html) if k == "table"), None)
            out.append((page_id, None, table is not None, None, None))
            for idx, cells in enumerate((table or [])[1:]):
                out.append((page_id, None, True, idx, cells))
        yield pd.DataFrame(out, columns=["page_id", "section_id", "table_found", "row_idx", "cells"])


def bank_table_rows(pages: DataFrame) -> DataFrame:
    """Per page and managed bank: a marker row (row_idx null) and one row per data row.

    A bank's section starts at the first heading with its marker; its table is the next table
    of the page, provided that no other 'transfer partners' heading stands before it."""
    sections = F.array(*[F.struct(F.lit(i).alias("section_id"), F.lit(m).alias("marker")) for m, i in BANK_SECTIONS])
    s = pages.select("page_id", "html").mapInPandas(_events, EVENTS).select("page_id", "events", F.explode(sections).alias("s"))
    start = F.array_min(F.transform(F.filter("events", lambda e: F.lower(e["text"]).contains(F.col("s.marker"))), lambda e: e["pos"]))
    s = s.withColumn("start", start)
    stop = F.array_min(F.transform(
        F.filter("events", lambda e: (e["pos"] > F.col("start")) & ((e["kind"] == "table") | F.lower(e["text"]).contains("transfer partners"))),
        lambda e: F.struct(e["pos"], e["kind"].alias("kind"), e["rows"].alias("rows"))))
    s = s.withColumn("stop", stop).withColumn("table", F.when(F.col("stop.kind") == "table", F.col("stop.rows")))
    none = F.struct(F.lit(None).cast("int").alias("row_idx"), F.lit(None).cast("array<string>").alias("cells"))
    data = F.transform(F.slice("table", 2, F.greatest(F.size("table") - 1, F.lit(0))), lambda r, i: F.struct(i.alias("row_idx"), r.alias("cells")))
    listed = F.concat(F.array(none), F.coalesce(data, F.array().cast("array<struct<row_idx:int,cells:array<string>>>")))
    s = s.select("page_id", F.col("s.section_id").alias("section_id"), F.col("table").isNotNull().alias("table_found"), F.explode(listed).alias("r"))
    return s.select("page_id", "section_id", "table_found", "r.row_idx", "r.cells")


def first_table_rows(pages: DataFrame) -> DataFrame:
    """Per page: a marker row (table_found) and the first table's data rows (header skipped)."""
    return pages.select("page_id", "html").mapInPandas(_first_table_rows, ROWS_SCHEMA)
