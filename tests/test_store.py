"""Stores, serving, pipeline and streaming over the twenty-row seed."""

import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F

from disclospark.functions.identity import stable_id
from disclospark.operators import analytics, pipeline, serve, store
from disclospark.schemas import RAW_FIELDS, RAW_TRANSACTION
from disclospark.streaming.ingest import ingest_available, windowed_counts

FIXTURES = pathlib.Path(__file__).parent.parent / "FIXTURES.md"


def read_seed():
    """The canonical seed rows and their expected ids."""
    rows, ids = [], []
    for text in FIXTURES.read_text().split("## 2.")[0].splitlines():
        cells = [c.strip() for c in text.strip("|").split("|")]
        if len(cells) == 12 and cells[0].isdigit():
            rows.append((*cells[1:4], *(None if c == "null" else c for c in cells[4:5]), *cells[5:8], int(cells[8]), None if cells[9] == "null" else int(cells[9]), cells[10]))
            ids.append(cells[11].strip("`"))
    return rows, ids


SEED, IDS = read_seed()


@pytest.fixture
def seed(spark):
    names = "politician string, transaction_date string, filing_date string, ticker string, asset_name string, asset_type string, type string, amount_min long, amount_max long, owner string, source_id int"
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(SEED)], names)
    return df.withColumns({c: F.col(c).cast("date") for c in ("transaction_date", "filing_date")}).withColumn("id", stable_id())


@pytest.fixture
def full(spark, seed, tmp_path):
    s = store.ParquetStore(spark, f"file://{tmp_path}/s")
    assert s.count() == 0
    assert s.save(seed, "source_id") == 20
    return s


def test_saving_twice(full, seed):
    assert full.save(seed, "source_id") == 0
    assert full.count() == 20
    ids = {r["id"] for r in full.read().collect()}
    assert ids == set(IDS)
    assert full.read().agg(F.sum("amount_min"), F.sum("amount_max")).first()[:] == (7779019, 8810000)


def test_first_row_wins_in_any_order(spark, seed):
    twice = seed.unionByName(seed.withColumn("source_id", F.col("source_id") + 100)).orderBy(F.rand(3)).repartition(3)
    got = store.first_by_id(twice, "source_id").collect()
    assert sorted(r["source_id"] for r in got) == list(range(20))


def test_null_in_a_required_column_is_ignored(spark, full, seed):
    bad = seed.limit(1).withColumn("asset_name", F.lit(None).cast("string")).withColumn("id", F.lit("new"))
    assert full.save(bad, "source_id") == 0


@pytest.mark.parametrize(
    ("filters", "rows"),
    [
        ({}, 20), ({"ticker": "aapl"}, 3), ({"ticker": "NVDA"}, 3), ({"type": "sell"}, 3), ({"owner": "joint"}, 6), ({"politician": "PELOSI"}, 4), ({"politician": "n%i"}, 6),
        ({"date_from": "2026-04-22"}, 14), ({"date_from": "2026-04-22", "date_to": "2026-04-28"}, 11), ({"type": "buy", "owner": "joint"}, 5), ({"politician": "", "ticker": ""}, 20),
        ({"limit": 3, "offset": 18}, 2), ({"politician": "\\"}, 0),
    ],
)
def test_filters(full, filters, rows):
    if filters == {"politician": "n%i"}:
        rows = sum("n" in r[0].lower() and "i" in r[0].lower()[r[0].lower().index("n") :] for r in SEED)
    assert full.query(store.QueryFilters(**filters)).count() == rows


def test_order_and_top_k_plan(full):
    q = full.query(store.QueryFilters(limit=5))
    days = [r["transaction_date"] for r in q.collect()]
    assert days == sorted(days, reverse=True)
    assert "TakeOrderedAndProject" in q._jdf.queryExecution().toString()


def test_filters_reach_the_scan(full):
    plan = full.query(store.QueryFilters(ticker="AAPL", date_from="2026-01-01"))._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(ticker)" in plan or "EqualTo(ticker,AAPL)" in plan


def test_append_store(spark, seed, tmp_path):
    s = store.AppendStore(spark, f"file://{tmp_path}/a")
    s.save(seed, "source_id")
    s.save(seed, "source_id")
    assert s.count() == 40
    assert s.query(store.QueryFilters(politician="pelosi")).count() == 8


def test_service(full):
    api = serve.Service(full)
    out = api.transactions(ticker="aapl", limit="2")
    assert out["count"] == len(out["data"]) == 2
    assert set(out["data"][0]) >= {"filer_name", "trade_type", "amount_midpoint", "filters_passed", "created_at"}
    assert len(out["data"][0]) == 23
    assert api.health()["db_count"] == api.debug()["rawCount"] == 20
    assert api.last_updated() is not None
    mid = serve.serialize(full.read()).agg(F.sum("amount_midpoint")).first()[0]
    assert mid == 5794518


@pytest.mark.parametrize("bad", [{"date_from": "4/9/2026"}, {"type": "swap"}, {"owner": "me"}, {"limit": "0"}, {"limit": "1001"}, {"limit": "x"}, {"offset": "-1"}])
def test_bad_parameters(bad):
    with pytest.raises(serve.InvalidParameters) as e:
        serve.check_parameters(bad)
    assert list(e.value.errors) == list(bad)


def raw(spark, n=6):
    base = {"transaction_date": "1/2/2026", "filing_date": "1/3/2026", "ticker": "--", "asset_type": "Stock", "type": "Purchase", "amount": "$1,001 - $15,000", "owner": "Self"}
    rows = [tuple({**base, "politician": "Ann" if i else "", "asset_name": f"A{i % 4}", "source_id": f"s{i}"}[c] for c in RAW_FIELDS) + (None,) for i in range(n)]
    return spark.createDataFrame(rows, RAW_TRANSACTION)


def test_pipeline(spark, tmp_path):
    s = store.ParquetStore(spark, f"file://{tmp_path}/p")
    assert pipeline.run_pipeline(raw(spark), s) == {"ingested": 6, "inserted": 4, "skipped": 1, "errors": 0}
    assert pipeline.run_pipeline(raw(spark), s, fallback=True) == {"ingested": 6, "inserted": 0, "skipped": 1, "errors": 0}
    pipeline.log_run(spark, {"inserted": 4}, f"file://{tmp_path}/log")
    pipeline.log_run(spark, {"inserted": 0}, f"file://{tmp_path}/log")
    assert spark.read.json(f"file://{tmp_path}/log").count() == 2


def test_tick(spark, tmp_path):
    def broken():
        raise OSError("no source")

    assert pipeline.tick(spark, broken, f"file://{tmp_path}/log")["errors"] == 1
    assert spark.read.json(f"file://{tmp_path}/log").first()["errors"] == 1


def test_catalogue_table(spark, full):
    full.create_table("trades_of_test")
    full.create_table("trades_of_test")
    spark.catalog.recoverPartitions("trades_of_test")
    assert spark.table("trades_of_test").count() == 20
    spark.sql("DROP TABLE trades_of_test")


def test_config():
    assert pipeline.Config.load({}).fetch_days_back == 90
    assert pipeline.Config.load({"FETCH_DAYS_BACK": "7"}).fetch_days_back == 7
    for bad in ({"FETCH_DAYS_BACK": "0"}, {"FETCH_DAYS_BACK": "x"}, {"LOG_LEVEL": "loud"}):
        with pytest.raises(ValueError):
            pipeline.Config.load(bad)
    assert pipeline.window_bounds(90, dt.date(2026, 4, 9))[0] == dt.date(2026, 1, 9)


def test_stream(spark, tmp_path):
    s = store.ParquetStore(spark, f"file://{tmp_path}/st")
    landing, cp = f"file://{tmp_path}/landing", f"file://{tmp_path}/cp"
    raw(spark).write.parquet(landing)
    ingest_available(spark, landing, RAW_TRANSACTION, s, cp)
    assert s.count() == 4
    ingest_available(spark, landing, RAW_TRANSACTION, s, cp)
    raw(spark, 9).write.mode("append").parquet(landing)
    ingest_available(spark, landing, RAW_TRANSACTION, s, cp)
    assert s.count() == 4


def test_windows_of_a_stream(spark, tmp_path):
    rows = [(dt.datetime(2026, 1, 1, 10, m),) for m in (1, 2, 59)] + [(dt.datetime(2026, 1, 1, 12, 0),)]
    spark.createDataFrame(rows, "ts timestamp").coalesce(1).write.parquet(f"file://{tmp_path}/in")
    stream = spark.readStream.schema("ts timestamp").parquet(f"file://{tmp_path}/in")
    q = windowed_counts(stream, "ts").writeStream.format("memory").queryName("wc").outputMode("append").option("checkpointLocation", f"file://{tmp_path}/wcp").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [r["count"] for r in spark.table("wc").collect()] == [3]


def test_summaries(full):
    df = full.read()
    top = analytics.filer_leaderboard(df, 1).first()
    assert (top["politician"], top["total_trades"]) == ("Nancy Pelosi", 4)
    assert {r["ticker"]: r["filers"] for r in analytics.ticker_clusters(df).collect()} == {"NVDA": 3, "AAPL": 2}
    assert sum(r["count"] for r in analytics.volume_by_day(df, "transaction_date").collect()) == 14
