"""Ingest: raw rows to stored transactions, with run statistics and a run log."""

from __future__ import annotations

import datetime as dt
import logging
import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.normalize import normalize
from ..sources.html import parse_with_fallback
from .store import ParquetStore, with_id

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Config:
    """Settings from the environment, with defaults and checked ranges."""

    cron_schedule: str = "0 */6 * * *"
    fetch_days_back: int = 90
    last_run_path: str = "./data/last_run"
    log_level: str = "info"
    #: Where the store is; PORT, NODE_ENV, CRON_SECRET and FRONTEND_ORIGIN configure a web server, which this engine isn't.
    store_path: str = "./data/transactions"

    @classmethod
    def load(cls, env: dict[str, str] | None = None) -> Config:
        e = os.environ if env is None else env
        try:
            days = int(e.get("FETCH_DAYS_BACK", "90"))
        except ValueError as x:
            raise ValueError("FETCH_DAYS_BACK: expected a whole number") from x
        if not 1 <= days <= 365:
            raise ValueError("FETCH_DAYS_BACK: expected 1 to 365")
        level = e.get("LOG_LEVEL", "info")
        if level not in ("debug", "info", "warn", "error"):
            raise ValueError("LOG_LEVEL: unknown level")
        return cls(e.get("CRON_SCHEDULE", cls.cron_schedule), days, e.get("LAST_RUN_PATH", cls.last_run_path), level, e.get("DB_PATH", cls.store_path))


def window_bounds(days_back: int, today: dt.date) -> tuple[dt.date, dt.date]:
    return today - dt.timedelta(days=days_back), today


def statistics(normalized: DataFrame) -> DataFrame:
    """ingested, kept and skipped rows, one row."""
    skipped = F.count_if(F.col("skip_reason").isNotNull())
    n = F.count(F.lit(1))
    return normalized.agg(n.alias("ingested"), (n - skipped).alias("kept"), skipped.alias("skipped"))


def run_pipeline(raw: DataFrame, store: ParquetStore, order: str = "source_id", fallback: bool = False) -> dict:
    """Normalise, identify and save a batch in one pass; `inserted` counts rows really inserted. A failed save is counted, logged and told as `error`."""
    if fallback:
        raw = parse_with_fallback(raw)
    seen = Observation()
    skipped = F.count_if(F.col("skip_reason").isNotNull()).alias("skipped")
    n = normalize(raw, (order,)).observe(seen, F.count(F.lit(1)).alias("ingested"), skipped)
    try:
        inserted = store.save(with_id(n.filter(F.col("skip_reason").isNull()).drop("skip_reason")), order)
    except Exception as e:
        log.exception("save failed")
        stats = statistics(normalize(raw, (order,))).first()
        return {"ingested": stats["ingested"], "inserted": 0, "skipped": stats["skipped"], "errors": 1, "error": str(e)}
    stats = seen.get
    return {"ingested": stats["ingested"], "inserted": inserted, "skipped": stats["skipped"], "errors": 0}


def tick(spark, run: Callable[[], dict], log_path: str) -> dict:  # noqa: ANN001
    """One scheduled run: its statistics, or errors = 1 and the error's text if it raised, go to the run log."""
    try:
        stats = run()
    except Exception as e:
        log.exception("run failed")
        stats = {"ingested": 0, "inserted": 0, "skipped": 0, "errors": 1, "error": str(e)}
    log_run(spark, stats, log_path)
    return stats


def refresh(run: Callable[[], dict], store: ParquetStore) -> dict:
    """A run on request: {ok, signals, lastUpdated}, or {ok, error}. Signals aren't made here, so their number is 0."""
    try:
        stats = run()
    except Exception as e:
        return {"ok": False, "error": str(e)}
    if stats.get("errors"):
        return {"ok": False, "error": stats.get("error", "run failed")}
    newest = store.read().agg(F.max("inserted_at")).first()[0]
    return {"ok": True, "signals": 0, "lastUpdated": newest or dt.datetime.now(dt.timezone.utc)}


def cron(run: Callable[[], dict]) -> dict:
    """A scheduled run on request: {ok, summary}, or {ok, error}."""
    try:
        stats = run()
    except Exception as e:
        return {"ok": False, "error": str(e)}
    return {"ok": True, "summary": stats} if not stats.get("errors") else {"ok": False, "error": stats.get("error", "run failed")}


def log_run(spark, stats: dict, path: str, at: dt.datetime | None = None) -> None:  # noqa: ANN001
    """Append one line to the JSON run log."""
    at = at or dt.datetime.now(dt.timezone.utc)
    spark.createDataFrame([{"timestamp": at.isoformat(), **stats}]).coalesce(1).write.mode("append").json(path)
