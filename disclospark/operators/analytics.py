"""Summaries over stored trades. The formulas are this engine's own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def volume_by_day(df: DataFrame, ts: str, days: int = 30) -> DataFrame:
    """Rows a day over the last `days` days up to the newest one present (no clock is asked)."""
    day = F.col(ts).cast("date")
    newest = df.agg(F.max(day)).scalar()
    return (
        df.select(day.alias("date"))
        .filter(F.col("date") > F.date_sub(newest, days))
        .groupBy("date")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def filer_leaderboard(df: DataFrame, top: int = 25) -> DataFrame:
    """Filers by number of trades: trades, buys, share of buys, sum of low ends, last trade."""
    buys = F.count_if(F.col("type") == "buy")
    return (
        df.groupBy("politician")
        .agg(
            F.count(F.lit(1)).alias("total_trades"),
            buys.alias("buys"),
            F.round(buys / F.count(F.lit(1)), 6).alias("buy_share"),
            F.sum("amount_min").alias("amount_low_sum"),
            F.max("transaction_date").alias("last_trade"),
        )
        .orderBy(F.desc("total_trades"), F.asc("politician"))
        .limit(top)
    )


def ticker_clusters(df: DataFrame, min_filers: int = 2) -> DataFrame:
    """Tickers traded by several filers. Members are counted, not collected, so a hot ticker stays one small row."""
    return (
        df.filter(F.col("ticker").isNotNull())
        .groupBy("ticker")
        .agg(
            F.count_distinct("politician").alias("filers"),
            F.count(F.lit(1)).alias("trades"),
            F.min("transaction_date").alias("first_trade"),
            F.max("transaction_date").alias("last_trade"),
        )
        .filter(F.col("filers") >= min_filers)
        .withColumn("cluster_id", F.sha2("ticker", 256))
    )


def filing_delay(trade: str = "transaction_date", filed: str = "filing_date") -> Column:
    return F.datediff(F.col(filed), F.col(trade))


def stale(trade: str, newest: Column, days: int) -> Column:
    return F.datediff(newest, F.col(trade)) > days
