"""Read API: each endpoint as a function."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.normalize import midpoint
from .store import ParquetStore, QueryFilters

_DATE = re.compile(r"\d{4}-\d{2}-\d{2}")


class InvalidParameters(ValueError):
    """Carries a list of messages for each bad field."""

    def __init__(self, errors: dict[str, list[str]]) -> None:
        super().__init__(str(errors))
        self.errors = errors


def check_parameters(params: dict[str, str]) -> QueryFilters:
    """Filters of request parameters; raises InvalidParameters if any is out of its domain."""
    errors: dict[str, list[str]] = {}
    out: dict = {k: params[k] for k in ("politician", "ticker") if k in params}
    for k in ("date_from", "date_to"):
        if k in params:
            out[k] = params[k]
            if not _DATE.fullmatch(params[k]):
                errors.setdefault(k, []).append("expected YYYY-MM-DD")
    for k, allowed in (("type", ("buy", "sell")), ("owner", ("self", "joint", "spouse", "child"))):
        if k in params:
            out[k] = params[k]
            if params[k] not in allowed:
                errors.setdefault(k, []).append(f"expected one of {', '.join(allowed)}")
    for k, low, high in (("limit", 1, 1000), ("offset", 0, None)):
        if k in params:
            try:
                out[k] = int(params[k])
            except ValueError:
                errors.setdefault(k, []).append("expected a whole number")
                continue
            if out[k] < low or high is not None and out[k] > high:
                errors.setdefault(k, []).append("out of range")
    if errors:
        raise InvalidParameters(errors)
    return QueryFilters(**out)


def serialize(df: DataFrame) -> DataFrame:
    """The served projection: renamed and recoded columns, constants and typed nulls."""
    null = lambda t: F.lit(None).cast(t)
    created = F.col("inserted_at") if "inserted_at" in df.columns else null("timestamp")
    return df.select(
        F.col("id"),
        F.col("politician").alias("filer_name"),
        F.lit("congress").alias("filer_type"),
        null("string").alias("party"),
        F.when(F.col("type") == "buy", "purchase").otherwise("sale").alias("trade_type"),
        "ticker",
        null("string").alias("company_name"),
        "asset_name",
        "asset_type",
        F.col("amount_min").alias("amount_low"),
        F.col("amount_max").alias("amount_high"),
        midpoint("amount_min", "amount_max").alias("amount_midpoint"),
        F.col("transaction_date").alias("trade_date"),
        "filing_date",
        null("int").alias("filing_delay_days"),
        "owner",
        null("int").alias("score"),
        null("string").alias("score_breakdown"),
        F.array().cast("array<string>").alias("filters_passed"),
        null("string").alias("cluster_id"),
        null("array<string>").alias("committees"),
        F.lit(True).alias("is_active"),
        created.alias("created_at"),
    )


class Service:
    """Endpoint functions over one store."""

    def __init__(self, store: ParquetStore) -> None:
        self.store = store

    def transactions(self, **params: str) -> dict:
        """`count` is the size of the page. The page holds at most 1000 rows."""
        rows = serialize(self.store.query(check_parameters(params))).collect()
        return {"data": [r.asDict(recursive=True) for r in rows], "count": len(rows)}

    def last_updated(self) -> dt.datetime | None:
        return self.store.read().agg(F.max("inserted_at")).first()[0]

    def health(self) -> dict:
        return {"status": "ok", "db_count": self.store.count(), "last_run": self.last_updated()}

    def debug(self) -> dict:
        n = self.store.count()
        sample = serialize(self.store.query(QueryFilters(limit=2))).collect()
        return {
            "rawCount": n,
            "sourceCounts": {"congress": n, "insiders": 0},
            "fetchErrors": {},
            "filterResult": None,
            "sampleTrades": {"congress": [r.asDict(recursive=True) for r in sample], "insiders": []},
        }
