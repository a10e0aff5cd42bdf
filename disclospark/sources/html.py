"""HTML tables, read by a standard-library parser inside a mapInArrow operator."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import collapse_blanks, wide_trim
from ..schemas import RAW_FIELDS

# Header texts of the report tables and the place a column has where no header names it.
HEADER_SYNONYMS = {
    "senator": "politician",
    "filer": "politician",
    "name": "politician",
    "transaction date": "transaction_date",
    "date of transaction": "transaction_date",
    "filing date": "filing_date",
    "date filed": "filing_date",
    "owner": "owner",
    "ticker": "ticker",
    "asset": "asset_name",
    "asset name": "asset_name",
    "asset type": "asset_type",
    "type": "type",
    "transaction type": "type",
    "amount": "amount",
}
DEFAULT_ORDER = (
    "politician", "filing_date", "transaction_date", "owner", "ticker", "asset_name", "asset_type", "type", "amount",
)
_BLANKS = re.compile(r"\s+")


class _Tables(HTMLParser):
    """Collects (table number, row number, in tbody, class, id, header flags, cells)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple] = []
        self.open: list[dict] = []
        self.count = 0

    def _end_cell(self) -> None:
        t = self.open[-1] if self.open else None
        if t and t["cell"] is not None:
            t["cells"].append(_BLANKS.sub(" ", "".join(t["cell"])).strip())
            t["cell"] = None

    def _end_row(self) -> None:
        self._end_cell()
        t = self.open[-1] if self.open else None
        if t and t["cells"] is not None:
            self.rows.append((t["no"], t["row"], t["body"], t["class"], t["id"], t["heads"], t["cells"]))
            t["row"] += 1
            t["cells"] = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "table":
            a = dict(attrs)
            self.open.append(
                {"no": self.count, "row": 0, "body": False, "class": a.get("class") or "", "id": a.get("id") or "", "cells": None, "cell": None, "heads": None}
            )
            self.count += 1
        if not self.open:
            return
        t = self.open[-1]
        if tag == "tr":
            self._end_row()
            t["cells"], t["heads"] = [], []
        elif tag in ("td", "th") and t["cells"] is not None:
            self._end_cell()
            t["cell"] = []
            t["heads"].append(tag == "th")
        elif tag in ("tbody", "thead", "tfoot"):
            self._end_row()
            t["body"] = tag == "tbody"

    def handle_endtag(self, tag: str) -> None:
        if not self.open:
            return
        if tag in ("td", "th"):
            self._end_cell()
        elif tag == "tr":
            self._end_row()
        elif tag in ("tbody", "thead", "tfoot"):
            self._end_row()
            self.open[-1]["body"] = False
        elif tag == "table":
            self._end_row()
            self.open.pop()

    def handle_data(self, data: str) -> None:
        for t in self.open:
            if t["cell"] is not None:
                t["cell"].append(data)

    def close(self) -> None:
        super().close()
        while self.open:
            self.handle_endtag("table")


# Marks of the table that holds the rows, the best first; any other table comes last.
TABLE_MARKS = (("class", "table-striped"), ("id", "filedReports"), ("class", "efts-table"))


def _rows_of(text: str) -> list[tuple]:
    p = _Tables()
    p.feed(text)
    p.close()
    return p.rows


def _data_cells(heads: list[bool], cells: list[str]) -> list[str]:
    return [c for h, c in zip(heads, cells, strict=True) if not h]


def detail_rows(text: str) -> Iterator[tuple[int, list[str]]]:
    """(row number, data cells) of a detail page. Rows inside a tbody win; without one, rows with data cells count."""
    rows = _rows_of(text)
    bodied = any(body for _, _, body, *_ in rows)
    no = -1
    for _, _, body, _, _, heads, cells in sorted(rows, key=lambda r: r[:2]):
        td = _data_cells(heads, cells)
        if body if bodied else td:
            no += 1
            yield no, td


def _rung(table_class: str, table_id: str) -> int:
    return next((i for i, (kind, mark) in enumerate(TABLE_MARKS) if (mark in table_class.split() if kind == "class" else table_id == mark)), len(TABLE_MARKS))


def header_mapped_rows(text: str) -> Iterator[tuple[list[str], list[str]]]:
    """(fields in DEFAULT_ORDER, data cells) of the rows below the header of the table that the marks prefer. The last header that names a field wins."""
    rows = _rows_of(text)
    if not rows:
        return
    _, best = min((_rung(r[3], r[4]), r[0]) for r in rows)
    own = sorted((r for r in rows if r[0] == best), key=lambda r: r[1])
    if own[0][1] != 0:
        return
    place = {f: i for i, f in enumerate(DEFAULT_ORDER)}
    place |= {HEADER_SYNONYMS[h]: i for i, c in enumerate(own[0][6]) if (h := c.lower()) in HEADER_SYNONYMS}
    for r in own[1:]:
        td = _data_cells(r[5], r[6])
        if td:
            yield [td[place[f]] if place[f] < len(td) else "" for f in DEFAULT_ORDER], td


def _read_pages(df: DataFrame, column: str, keep: list[str], read: Callable[[str], Iterator[tuple]], made: list[tuple[str, str, pa.DataType]]) -> DataFrame:
    """`keep` and the read values, a row each; one pass over the pages. Texts without a `<tr` never reach Python."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, out = [], []
            for i, text in enumerate(b.column(b.num_columns - 1).to_pylist()):
                for r in read(text):
                    at.append(i)
                    out.append(r)
            values = list(zip(*out, strict=True)) if out else [[] for _ in made]
            where = pa.array(at, pa.int64())
            yield pa.record_batch(
                [*[c.take(where) for c in b.columns[:-1]], *[pa.array(list(v), t) for v, (_, _, t) in zip(values, made, strict=True)]],
                names=[*keep, *[n for n, _, _ in made]],
            )

    chosen = df.filter(F.lower(F.col(column)).contains("<tr")).select(*keep, column)
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1]] + [f"`{n}` {t}" for n, t, _ in made]
    return chosen.mapInArrow(parse, ", ".join(schema))


def parse_ptr_tables(meta: DataFrame, column: str = "html") -> DataFrame:
    """Detail tables of electronic reports: at least eight cells, read by position.

    `meta` has politician, filing_date, ptr_uuid, office and the HTML column. The row number in source_id also counts rows that are left out.
    """
    read = lambda text: ((no, td) for no, td in detail_rows(text) if len(td) >= 8 and td[4] != "")
    keep = ["politician", "filing_date", "ptr_uuid", "office"]
    rows = _read_pages(meta, column, keep, read, [("idx", "int", pa.int32()), ("td", "array<string>", pa.list_(pa.string()))])
    c = lambda i: F.get(F.col("td"), F.lit(i))
    return rows.select(
        "politician",
        c(1).alias("transaction_date"),
        "filing_date",
        c(3).alias("ticker"),
        c(4).alias("asset_name"),
        c(5).alias("asset_type"),
        c(6).alias("type"),
        c(7).alias("amount"),
        c(2).alias("owner"),
        F.concat_ws("|", "ptr_uuid", "idx").alias("source_id"),
        F.to_json(F.struct("ptr_uuid", F.col("idx").alias("row_index"), F.col("td").alias("cells"), "office")).alias("raw_json"),
    )


def parse_header_tables(df: DataFrame, column: str = "html") -> DataFrame:
    """Raw transactions of header-mapped tables; rows without cells or politician vanish; the source id is made of content."""
    texts = pa.list_(pa.string())
    rows = _read_pages(df, column, [], header_mapped_rows, [("fields", "array<string>", texts), ("td", "array<string>", texts)])
    c = {f: F.get("fields", F.lit(i)) for i, f in enumerate(DEFAULT_ORDER)}
    source = collapse_blanks(F.concat_ws("|", c["politician"], c["transaction_date"], c["asset_name"], c["amount"]))
    raw = F.to_json(F.map_from_arrays(F.transform("td", lambda x, i: F.concat(F.lit("col_"), i.cast("string"))), F.col("td")))
    out = {**c, "source_id": source}
    return rows.filter(wide_trim(c["politician"]) != "").select(*[out[f].alias(f) for f in RAW_FIELDS], raw.alias("raw_json"))


def fallback_needed(raw: DataFrame) -> bool:
    """True if there are rows and every asset name is blank (then the kept HTML is to be read again)."""
    from ..functions.text import is_blank

    row = raw.agg(F.count(F.lit(1)).alias("n"), F.bool_and(is_blank("asset_name")).alias("blank")).first()
    return bool(row["n"] and row["blank"])


def parse_with_fallback(raw: DataFrame) -> DataFrame:
    """The rows themselves, or those of the HTML kept in raw_json.html if no row has an asset name."""
    if not fallback_needed(raw):
        return raw
    return parse_header_tables(raw.select(F.get_json_object("raw_json", "$.html").alias("html")).filter("html is not null"))


