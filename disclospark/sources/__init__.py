"""Readers of landed files; no connector here talks to a network."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .html import parse_header_tables, parse_ptr_tables
from .json_hits import parse_hits

__all__ = ["parse", "parse_header_tables", "parse_hits", "parse_ptr_tables"]


def parse(df: DataFrame, kind: str, column: str) -> DataFrame:
    """Raw transactions of a text column: `json` holds hit arrays, `html` header-mapped tables; no rows for another kind."""
    if kind == "json":
        return parse_hits(df, column)
    if kind == "html":
        return parse_header_tables(df, column)
    return parse_hits(df.limit(0), column)
