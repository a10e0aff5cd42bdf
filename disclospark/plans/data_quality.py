"""Queries of the core data-quality operators (problems 2, 3, 5, 6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.normalize import calendar_date
from ..functions.text import collapse_blanks, wide_trim
from ..operators.bad_rows import load_lines
from ..operators.schema_drift import schema_changes, unified_table
from ..operators.snapshots import snapshot_changes
from ..operators.timestamps import has_clock_time, normalize_times, utc_text
from ..session import read_table
from .data_quality_sql import ORACLE

__all__ = ["ORACLE", "QUERIES"]

#: Zones tried for rows whose office names none.
OFFICE_ZONES = [
    "America/New_York", "America/Chicago", "America/Denver", "America/Phoenix", "America/Los_Angeles",
    "America/Anchorage", "Pacific/Honolulu", "America/Puerto_Rico",
]


def tidy_docid(c: str = "docid") -> Column:
    """Without white space around and without a decimal tail; null for blank."""
    t = F.regexp_replace(wide_trim(c), r"\.0+\z", "")
    return F.when(t != "", t)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = read_table(spark, sf_dir, "filing_index").select(
        "line_no",
        "snapshot_no",
        tidy_docid().alias("docid"),
        calendar_date(F.regexp_replace(wide_trim("filingdate"), r"(?s)[T ]+\d{1,2}:\d{2}.*\z", "")).alias("day"),
        F.coalesce(collapse_blanks("member"), F.lit("")).alias("member"),
    )
    return snapshot_changes(index, "snapshot_no", "docid", ["day", "member"], "line_no").select("docid", "snapshot_no", "change_kind")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_table(spark, sf_dir, "raw_lines").select("line_id", "separator", "line_text")
    return load_lines(lines).filter("reason is not null").select("line_id", "reason")


def p3_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that load, typed."""
    lines = read_table(spark, sf_dir, "raw_lines").select("line_id", "separator", "line_text")
    return (
        load_lines(lines).filter("reason is null")
        .select("line_id", "politician", "tx_day", "filed_day", "symbol", "asset_name", "asset_type", "type", "amount_min", "amount_max", "owner", "source_id")
    )


def _times(df: DataFrame, table: str, row: str, column: str, group: str, ingested: str | None) -> DataFrame:
    """Clock times of a column; zones that the office doesn't name are estimated from ingestion times, or else from the order of the rows."""
    clocks = df.filter(has_clock_time(column))  # plain dates are no cases
    out = normalize_times(clocks, column, "office_tz", group, ingested, OFFICE_ZONES, None if ingested else row)
    return out.filter("utc is not null").select(
        F.lit(table).alias("source_table"),
        F.col(row).alias("row_id"),
        F.lit(column).alias("field_name"),
        utc_text(F.col("utc")).alias("utc"),
    )


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = read_table(spark, sf_dir, "raw_transactions").select("row_id", "feed", "transaction_date", "filing_date", "office_tz", "fetched_at")
    members = read_table(spark, sf_dir, "raw_members").select("member_row", "statedst", "filingdate", "office_tz")
    return (
        _times(raw, "raw_transactions", "row_id", "transaction_date", "feed", "fetched_at")
        .unionByName(_times(raw, "raw_transactions", "row_id", "filing_date", "feed", "fetched_at"))
        .unionByName(_times(members, "raw_members", "member_row", "filingdate", "statedst", None))
    )


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_changes(read_table(spark, sf_dir, "raw_transactions"), "raw_json", "feed", "batch_no")


def p6_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every payload in one layout."""
    return unified_table(read_table(spark, sf_dir, "raw_transactions"), "raw_json", "feed", "batch_no", "row_id")


QUERIES = {"p2_found": p2_found, "p3_found": p3_found, "p3_loaded": p3_loaded, "p5_found": p5_found, "p6_found": p6_found, "p6_table": p6_table}
