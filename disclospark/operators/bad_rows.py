"""Delimited records that fail to parse, apart from those that load.

Each Arrow batch is one byte buffer. Structural indexing: a quote mask, its prefix parity (from the start of each record) tells what lies
inside quotes, and separators and record ends outside of them bound the fields. Only records whose quotes, column count and values hold
are typed.

The first reason that holds: broken_quoting (a quote may only enclose a whole field, doubled inside it), wrong_column_count,
invalid_value (the checks the caller names). Cases: a carriage return or line feed at the record's end doesn't count; a null record counts as
an empty one; a null or empty separator means none, so the record is one field; separators may have several characters; records may be
of any length; repeated records each keep their row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import amount_range, calendar_date, ticker_symbol
from ..functions.text import is_blank, wide_trim
from ..schemas import RAW_FIELDS

_QUOTE = 0x22
_MONEY = r"\$?(?:\d{1,3}(?:,\d{3})+|\d+)"


def _index(texts: list[str], separators: list[str]) -> tuple[np.ndarray, list[list[str]]]:
    """Broken flags and the fields of each record."""
    records = [t.rstrip("\r\n").encode() for t in texts]
    lengths = np.fromiter(map(len, records), np.int64, len(records))
    starts = np.concatenate(([0], np.cumsum(lengths + 1)))[:-1]
    ends = starts + lengths  # each record ends in one byte that no UTF-8 text has
    buf = np.frombuffer(b"\xff".join(records) + b"\xff", np.uint8)
    row = np.repeat(np.arange(len(records)), lengths + 1)
    quote = buf == _QUOTE
    before = np.cumsum(quote) - quote
    inside = (before - before[starts][row]) & 1  # parity of the quotes before each byte of its record
    first = np.array([s.encode()[0] if s else 0xFE for s in separators], np.uint8)
    delimiter = (buf == first[row]) & (inside == 0) & ~quote
    long = [i for i, s in enumerate(separators) if len(s.encode()) > 1]
    width = np.ones(len(records), np.int64)
    for i in long:  # keep only full matches, which don't overlap
        sep, free = separators[i].encode(), starts[i]
        width[i] = len(sep)
        for p in np.flatnonzero(delimiter[starts[i] : ends[i]]) + starts[i]:
            hit = p >= free and buf[p : p + len(sep)].tobytes() == sep
            delimiter[p] = hit
            free = p + len(sep) if hit else free
    edge = delimiter.copy()
    edge[ends] = True
    at = np.flatnonzero(quote)
    opens = inside[at] == 0
    after_edge = np.zeros(len(buf), bool)  # the first byte of a field
    after_edge[starts] = True
    d = np.flatnonzero(delimiter)
    after_edge[d + width[row[d]]] = True
    previous_quote = np.concatenate(([False], quote[:-1]))
    next_quote = np.concatenate((quote[1:], [False]))
    next_edge = np.concatenate((edge[1:], [False]))
    sound = np.where(opens, after_edge[at] | previous_quote[at], next_edge[at] | next_quote[at])
    broken = np.zeros(len(records), bool)
    broken[row[at[~sound]]] = True
    quotes = np.bincount(row[at], minlength=len(records))
    broken |= (quotes & 1) == 1
    cuts = np.flatnonzero(edge)
    per_row = np.bincount(row[cuts], minlength=len(records))
    bounds = np.split(cuts, np.cumsum(per_row)[:-1])
    fields = []
    for i, r in enumerate(records):
        if broken[i]:
            fields.append([])
            continue
        begin, out = starts[i], []
        for c in bounds[i]:
            f = r[begin - starts[i] : c - starts[i]].decode()
            out.append(f[1:-1].replace('""', '"') if f[:1] == '"' and len(f) > 1 else f)
            begin = c + width[i]
        fields.append(out)
    return broken, fields


def split_records(df: DataFrame, text: str, separator: str) -> DataFrame:
    """All columns of `df` plus `broken` and `fields`. The only Python step; one Arrow batch in, one out."""
    names = [f.name for f in df.schema.fields]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields] + ["`#broken` boolean", "`#fields` array<string>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            t, s = ([x or "" for x in b.column(names.index(c)).to_pylist()] for c in (text, separator))
            broken, fields = _index(t, s)
            yield pa.record_batch(
                [*b.columns, pa.array(broken), pa.array(fields, pa.list_(pa.string()))], names=[*names, "#broken", "#fields"]
            )

    return df.mapInArrow(run, schema)


def amount_is_valid(c: Column) -> Column:
    """Blank, one value, low to high (hyphen or en dash), Over a value, or a value - Over; whole dollars, commas in thousands."""
    t = wide_trim(c)
    pair = rf"\A({_MONEY})\s*[-\x{{2013}}]\s*({_MONEY})\z"
    bare = lambda n: F.regexp_replace(F.regexp_extract(t, pair, n), r"[$,]", "").try_cast("decimal(38,0)")
    return (
        is_blank(c)
        | t.rlike(rf"\A{_MONEY}\z")
        | t.rlike(rf"(?i)\Aover\s+{_MONEY}\z")
        | t.rlike(rf"(?i)\A{_MONEY}\s*[-\x{{2013}}]\s*over\z")
        | (t.rlike(pair) & (bare(1) <= bare(2)))
    )


def load_lines(df: DataFrame, text: str = "line_text", separator: str = "separator", columns: tuple[str, ...] = RAW_FIELDS) -> DataFrame:
    """`df` plus `reason` (null for rows that load), the ten fields as text and, typed, tx_day, filed_day, symbol, amount_min, amount_max.

    Columns of `df` that bear one of these names make way.
    """
    f = lambda name: F.get("#fields", F.lit(columns.index(name)))
    letter = lambda name: F.coalesce(f(name).rlike(r"\p{L}"), F.lit(False))
    sound = letter("politician") & letter("asset_name") & F.coalesce(amount_is_valid(f("amount")), F.lit(False))
    reason = (
        F.when(F.col("#broken"), "broken_quoting")
        .when(F.size("#fields") != len(columns), "wrong_column_count")
        .when(~sound, "invalid_value")
    )
    out = split_records(df, text, separator).withColumn("#reason", reason)
    ok = F.col("#reason").isNull()
    lo, hi = amount_range(f("amount"))
    made = {"reason", "tx_day", "filed_day", "symbol", "amount_min", "amount_max", *columns}
    return out.select(
        *[F.col(c) for c in df.columns if c.lower() not in made],
        F.col("#reason").alias("reason"),
        *[F.when(ok, f(c)).alias(c) for c in columns],
        F.when(ok, calendar_date(f("transaction_date"))).alias("tx_day"),
        F.when(ok, calendar_date(f("filing_date"))).alias("filed_day"),
        F.when(ok, ticker_symbol(f("ticker"))).alias("symbol"),
        F.when(ok, lo).alias("amount_min"),
        F.when(ok, hi).alias("amount_max"),
    )
