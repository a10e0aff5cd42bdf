"""Content identity of a transaction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import wide_trim


def dedup_key() -> Column:
    """politician|date|asset|low|high, lower case; an open range leaves the last part empty (concat_ws would drop it)."""
    return F.concat_ws(
        "|",
        F.coalesce(F.lower(wide_trim("politician")), F.lit("")),
        F.coalesce(F.date_format("transaction_date", "yyyy-MM-dd"), F.lit("")),
        F.coalesce(F.lower(wide_trim("asset_name")), F.lit("")),
        F.coalesce(F.col("amount_min").cast("string"), F.lit("")),
        F.coalesce(F.col("amount_max").cast("string"), F.lit("")),
    )


def stable_id() -> Column:
    return F.sha2(dedup_key(), 256)
