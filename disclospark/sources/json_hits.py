"""Search hits: a JSON array of {_id, _source} objects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to_null
from ..schemas import HITS


def parse_hits(df: DataFrame, column: str = "payload") -> DataFrame:
    """One raw transaction a hit; hits that aren't objects or have no _source vanish, missing fields become ''.

    A lone object counts as an array of one. Numbers and booleans come out as their text.
    """
    whole = F.when(F.col(column).rlike(r"\A\s*\{"), F.concat(F.lit("["), F.col(column), F.lit("]"))).otherwise(F.col(column))
    s = lambda name: F.col(f"hit._source.{name}")
    text = lambda c: F.coalesce(c, F.lit(""))
    first = lambda *cs: F.coalesce(*[blank_to_null(c) for c in cs], F.lit(""))
    full: Column = F.trim(F.concat_ws(" ", blank_to_null(s("first_name")), blank_to_null(s("last_name"))))
    return (
        df.select(F.explode(F.from_json(whole, HITS)).alias("hit"))
        .filter(F.col("hit").isNotNull() & F.col("hit._source").isNotNull())
        .select(
            first(s("senator_name"), full).alias("politician"),
            text(s("transaction_date")).alias("transaction_date"),
            first(s("date_filed"), s("filing_date")).alias("filing_date"),
            text(s("ticker")).alias("ticker"),
            text(s("asset_name")).alias("asset_name"),
            text(s("asset_type")).alias("asset_type"),
            text(s("transaction_type")).alias("type"),
            text(s("amount")).alias("amount"),
            text(s("owner")).alias("owner"),
            first(F.col("hit._id"), s("report_id")).alias("source_id"),
            F.to_json("hit._source").alias("raw_json"),
        )
    )
