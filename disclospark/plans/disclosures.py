"""Queries of the disclosure engine's own operators. Their SQL is in disclosures_sql."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import normalize as N
from ..functions import text as X
from ..functions.identity import dedup_key, stable_id
from .. import sources
from ..operators import analytics, pipeline, serve, store
from ..operators.pipeline import statistics
from ..schemas import MEMBER_XML, RAW_FIELDS, RAW_TRANSACTION
from ..session import read_table, shared_dir
from ..sources import html, json_hits, listing, ptr_text, xml_index
from ..streaming.ingest import ingest_available
from .disclosures_sql import ORACLE

__all__ = ["ORACLE", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "raw_transactions")


def _normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.normalize(_raw(spark, sf_dir), ("row_id", "batch_no"))


def _kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.kept(_normalized(spark, sf_dir))


def _accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = read_table(spark, sf_dir, "transactions")
    return t.withColumns({c: F.col(c).cast("date") for c in ("transaction_date", "filing_date")})


# scalars


@query
def normalize_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept(spark, sf_dir).drop("batch_no")


@query
def type_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).groupBy("type", N.trade_side("type").alias("side")).agg(F.count(F.lit(1)).alias("n"))


@query
def owner_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).groupBy("owner", N.owner_code("owner").alias("code")).agg(F.count(F.lit(1)).alias("n"))


@query
def ticker_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).select("row_id", N.ticker_symbol("ticker").alias("symbol"))


@query
def amount_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo, hi = N.amount_range("amount")
    return _raw(spark, sf_dir).select("row_id", lo.alias("amount_min"), hi.alias("amount_max"))


@query
def amount_integer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).select("row_id", N.dollars("amount").alias("dollars"))


@query
def date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).select("row_id", N.calendar_date("transaction_date").alias("tx"), N.calendar_date("filing_date").alias("filed"))


@query
def cross_fill_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normalized(spark, sf_dir).select("row_id", "transaction_date", "filing_date")


@query
def trim_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).select("row_id", *[X.wide_trim(c).alias(c) for c in ("politician", "asset_name", "asset_type")])


@query
def midpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _accepted(spark, sf_dir).select("id", N.midpoint("amount_min", "amount_max").alias("midpoint"))


@query
def form_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _accepted(spark, sf_dir).select("id", N.form_date("filing_date").alias("form_date"))


@query
def member_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "raw_members").select("member_row", N.member_name("first", "last", "suffix").alias("member"))


@query
def rolling_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filings of the last 90 days up to the newest one present."""
    t = _accepted(spark, sf_dir)
    newest = t.agg(F.max("filing_date")).scalar()
    return t.filter(F.col("filing_date") >= F.date_sub(newest, 90)).select("id", "filing_date")


# predicates


@query
def skip_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.rejected(_normalized(spark, sf_dir)).select("row_id", "skip_reason")


@query
def skip_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    reason = F.coalesce("skip_reason", F.lit("kept")).alias("reason")
    return _normalized(spark, sf_dir).groupBy(reason).agg(F.count(F.lit(1)).alias("n"))


@query
def validation_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normalized(spark, sf_dir).select("row_id", F.array_join(N.validation_errors(), "; ").alias("errors"))


def _filtered(df: DataFrame, f: store.QueryFilters, literal: bool = False) -> DataFrame:
    return df.filter(store.predicate(f, literal))


@query
def filter_politician_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ASCII folding: the accent must match as written, % is a wildcard."""
    return _filtered(_kept(spark, sf_dir), store.QueryFilters(politician="URSULA%GRYVé")).select("row_id", "politician")


@query
def filter_politician_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filtered(_kept(spark, sf_dir), store.QueryFilters(politician="GRYVÉL"), literal=True).select("row_id", "politician")


@query
def filter_ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades of the ticker traded most, asked for in lower case."""
    t = _accepted(spark, sf_dir)
    most = t.filter("ticker is not null").groupBy("ticker").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "ticker").first()
    return _filtered(t, store.QueryFilters(ticker=(most["ticker"] if most else "none").lower())).select("id", "ticker")


@query
def filter_type_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filtered(_accepted(spark, sf_dir), store.QueryFilters(type="buy", owner="joint", politician="")).select("id", "type", "owner")


@query
def filter_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filtered(_accepted(spark, sf_dir), store.QueryFilters(date_from="2018-01-01", date_to="2019-12-31")).select("id", "transaction_date")


@query
def conjunction_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From raw rows to a served page: normalise, identify, first of each id, filter, top-k, serialise."""
    unique = store.first_by_id(store.with_id(_kept(spark, sf_dir)).drop("batch_no"), "row_id")
    f = store.QueryFilters(type="buy", owner="self", date_from="2016-01-01", limit=200, offset=20)
    return serve.serialize(store.page(unique, f, "row_id")).drop("filters_passed", "committees", "created_at")


# joins, sinks


@query
def dedup_key_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept(spark, sf_dir).select("row_id", dedup_key().alias("key"))


@query
def stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept(spark, sf_dir).select("row_id", stable_id().alias("id"))


@query
def stored_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The id rule over the accepted trades gives the ids they bear."""
    return _accepted(spark, sf_dir).select("id", stable_id().alias("computed"))


@query
def dedup_in_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.first_by_id(store.with_id(_kept(spark, sf_dir)), "row_id").select("id", "row_id")


@query
def dedup_vs_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incoming rows whose id isn't stored; repeats inside the batch stay."""
    return store.new_rows(store.with_id(_kept(spark, sf_dir)), _accepted(spark, sf_dir)).select("id", "row_id")


@query
def insert_or_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.insert_or_ignore(store.with_id(_kept(spark, sf_dir)), _accepted(spark, sf_dir), "row_id").select("id", "row_id")


@query
def known_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.known_ids(store.with_id(_kept(spark, sf_dir)), _accepted(spark, sf_dir))


@query
def source_id_antifilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of later batches whose source_id no earlier half has."""
    raw = _raw(spark, sf_dir)
    known = raw.filter("batch_no <= 6").select("source_id")
    return raw.filter("batch_no > 6").join(known, "source_id", "left_anti").select("row_id", "source_id")


@query
def union_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    parts = [raw.filter(F.col("batch_no") % 3 == k).select("feed", "row_id") for k in range(3)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("feed").agg(F.count(F.lit(1)).alias("n"), F.sum("row_id").alias("ids"))


@query
def union_chambers(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    house = raw.filter(F.col("feed") == "house_ptr").withColumn("chamber", F.lit("house"))
    senate = raw.filter(F.col("feed").startswith("senate")).withColumn("chamber", F.lit("senate"))
    archive = raw.filter(~F.col("feed").startswith("senate") & (F.col("feed") != "house_ptr")).withColumn("chamber", F.lit("archive"))
    return house.unionByName(senate).unionByName(archive).groupBy("chamber").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("politician").alias("filers"))


@query
def append_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends of one batch leave every row twice."""
    s = store.AppendStore(spark, f"{shared_dir(spark)}/append")
    rows = store.with_id(_kept(spark, sf_dir))
    s.save(rows, "row_id")
    s.save(rows, "row_id")
    return s.read().groupBy("type").agg(F.count(F.lit(1)).alias("n"))


@query
def unique_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two saves of one batch leave every id once."""
    s = store.ParquetStore(spark, f"{shared_dir(spark)}/unique")
    rows = store.with_id(_kept(spark, sf_dir))
    s.save(rows, "row_id")
    s.save(rows, "row_id")
    return s.read().drop("inserted_at")


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A streaming read of the landed rows into a unique store, run twice from one checkpoint."""
    base = shared_dir(spark)
    s = store.ParquetStore(spark, f"{base}/store")
    landed = _raw(spark, sf_dir)
    landed.select(*RAW_FIELDS, F.col("raw_json")).write.parquet(f"{base}/landing")
    for _ in range(2):
        ingest_available(spark, f"{base}/landing", RAW_TRANSACTION, s, f"{base}/checkpoint")
    return s.read().select("id")


@query
def row_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _accepted(spark, sf_dir).select(
        "id", F.coalesce("asset_type", F.lit("")).alias("asset_type"), F.coalesce("amount_min", F.lit(0)).alias("amount_min"),
        F.coalesce("owner", F.lit("self")).alias("owner"),
    )


# serving, counts


@query
def serve_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    served = serve.serialize(_accepted(spark, sf_dir).withColumnRenamed("created_at", "inserted_at"))
    return served.withColumn("filters_passed", F.size("filters_passed")).drop("committees")


@query
def limit_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.page(_accepted(spark, sf_dir), store.QueryFilters(limit=100, offset=50), "id").select("id", "transaction_date")


@query
def page_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = store.page(_accepted(spark, sf_dir), store.QueryFilters(owner="child", limit=1000), "id")
    return p.agg(F.count(F.lit(1)).alias("count"))


@query
def count_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _accepted(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))


@query
def source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _accepted(spark, sf_dir).agg(F.count(F.lit(1)).alias("congress"), F.lit(0).cast("bigint").alias("insiders"))


@query
def run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics(_normalized(spark, sf_dir))


@query
def latest_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _accepted(spark, sf_dir).agg(F.date_format(F.max("created_at"), "yyyy-MM-dd HH:mm:ss").alias("last_updated"))


@query
def every_asset_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).groupBy("feed", "batch_no").agg(F.bool_and(X.is_blank("asset_name")).alias("all_blank"))


@query
def partial_failure_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    errors = F.count_if(F.col("event_type") == "error")
    n = F.count(F.lit(1))
    return e.groupBy("user_id").agg(errors.alias("errors"), n.alias("filings"), listing.listing_is_partial(errors, n).alias("partial"))


# readers


@query
def json_hits_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows packed into arrays of hits and read back."""
    raw = _raw(spark, sf_dir).filter("source_id is not null")
    source = F.struct(
        F.col("politician").alias("senator_name"), "transaction_date", F.col("filing_date").alias("date_filed"), "ticker", "asset_name",
        "asset_type", F.col("type").alias("transaction_type"), "amount", "owner",
    )
    hit = F.struct(F.concat(F.col("row_id").cast("string"), F.lit("/"), F.col("source_id")).alias("_id"), source.alias("_source"))
    packed = raw.select(F.to_json(F.array(hit)).alias("payload"))
    return json_hits.parse_hits(packed).drop("raw_json")


@query
def events_props_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return e.select("event_id", F.json_object_keys("props").alias("k")).select("event_id", F.array_join(F.array_sort("k"), ",").alias("keys"))


def _escaped(c: str) -> Column:
    return F.replace(F.replace(F.coalesce(F.col(c), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


@query
def listing_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of cells built of the register: electronic reports come out, paper ones and short rows don't."""
    r = read_table(spark, sf_dir, "filers")
    kind = F.when(F.col("filer_id") % 3 == 0, "paper").otherwise("ptr")
    link = F.concat(F.lit('<a href="/search/view/'), kind, F.lit("/"), F.lower(F.hex("filer_id")), F.lit('-ab/">Report</a>'))
    cells = F.array("first", F.concat(F.lit("<b>"), F.col("last"), F.lit("</b>")), F.col("chamber"), link, F.lit("04/09/2026"))
    page = F.struct(F.lit(1).alias("draw"), F.lit(1).alias("recordsTotal"), F.lit(1).alias("recordsFiltered"), F.array(cells, F.array(F.lit("x"))).alias("data"))
    return listing.filing_meta(listing.scan_pages(r.select(F.to_json(page).alias("payload"))))


@query
def debug_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing.first_filings(read_table(spark, sf_dir, "filing_index").select("docid", "line_no"), 25, "line_no")


@query
def html_strip_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = F.concat(F.lit("<td>\n <b>"), F.coalesce(F.col("asset_name"), F.lit("")), F.lit("</b> <br/></td>"))
    return _raw(spark, sf_dir).select("row_id", X.strip_tags(tagged).alias("text"))


@query
def html_href_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = read_table(spark, sf_dir, "transactions").select("id", F.concat(F.lit("<p><a class='x' href='/view/ptr/"), F.col("id"), F.lit("/'>x</a>")).alias("cell"))
    path = listing.link_target("cell")
    return t.select("id", path.alias("path"), listing.report_uuid(path).alias("uuid"))


def _table(df: DataFrame, *columns: str) -> Column:
    tds = [F.concat(F.lit("<td> "), _escaped(c), F.lit(" </td>")) for c in columns]
    return F.concat(F.lit("<tr>"), *tds, F.lit("</tr>"))


@query
def html_table_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One detail page a row, with a short and a data row in its body."""
    raw = _raw(spark, sf_dir).withColumn("no", F.lit("1"))
    row = _table(raw, "no", "transaction_date", "owner", "ticker", "asset_name", "asset_type", "type", "amount")
    page = F.concat(F.lit("<html><table><thead><tr><th>#</th></tr></thead><tbody><tr><td>none</td></tr>"), row, F.lit("</tbody></table></html>"))
    meta = raw.select(
        F.col("row_id").alias("doc_key"), F.col("politician"), F.lit("2026-04-09").alias("filing_date"), F.col("row_id").cast("string").alias("ptr_uuid"),
        F.lit("x").alias("office"), page.alias("html"),
    )
    return html.parse_ptr_tables(meta).select("source_id", "transaction_date", "owner", "ticker", "asset_name", "asset_type", "type", "amount")


@query
def html_header_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables whose headers name the columns in another order than the usual one."""
    raw = _raw(spark, sf_dir)
    names = {"amount": "Amount", "politician": "Filer", "asset_name": "Asset Name", "transaction_date": "Transaction Date", "filing_date": "Date Filed", "owner": "Owner", "ticker": "Ticker", "asset_type": "Asset Type", "type": "Type"}
    head = "".join(f"<th>{h}</th>" for h in names.values())
    page = F.concat(F.lit(f"<table class='x table-striped'><tr>{head}</tr>"), _table(raw, *names), F.lit("</table>"))
    return html.parse_header_tables(raw.select(page.alias("html"))).drop("raw_json")


@query
def xml_index_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Member fragments built of the raw members, read as XML and filtered to periodic reports of two years."""
    m = read_table(spark, sf_dir, "raw_members")
    tags = [F.concat(F.lit(f"<{t}>"), _escaped(c), F.lit(f"</{t}>")) for t, c in zip(MEMBER_XML.names, ("prefix", "last", "first", "suffix", "filingtype", "statedst", "year", "filingdate", "docid"), strict=True)]
    fragments = m.select(F.concat(F.lit("<Member>"), *tags, F.lit("</Member>")).alias("xml"))
    out = xml_index.periodic_filings(xml_index.members_of(fragments), "2023-01-01", "2024-12-31")
    return out.select("member", "filingDate", "docId", "year")


@query
def ptr_text_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report texts built of all accepted trades, with and without ticker, glued as PDF extraction glues them, read back."""
    t = _accepted(spark, sf_dir)
    us = lambda c: F.date_format(c, "MM/dd/yyyy")
    dollars = lambda c: F.concat(F.lit("$"), F.format_number(c, 0))
    money = F.when(F.col("amount_max").isNull(), F.concat(F.lit("Over "), dollars("amount_min"))).otherwise(F.concat(dollars("amount_min"), F.lit(" - "), dollars("amount_max")))
    marker = F.coalesce(F.concat(F.lit("("), F.col("ticker"), F.lit(") ")), F.lit(""))
    text = F.concat(F.lit("SP "), F.col("asset_name"), F.lit("\x00 "), marker, F.lit("[ST] P "), us("transaction_date"), us("filing_date"), money)
    docs = t.select(F.col("politician").alias("member"), F.col("filing_date").alias("filingDate"), F.col("id").alias("docId"), text.alias("text"))
    return ptr_text.parse_ptr_text(docs).drop("raw_json", "filing_date")


@query
def source_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of both kinds and of an unknown one through the one entry point."""
    raw = _raw(spark, sf_dir).select(F.coalesce("politician", F.lit("")).alias("p"))
    hits = raw.select(F.to_json(F.array(F.struct(F.struct(F.col("p").alias("senator_name")).alias("_source")))).alias("x"))
    page = raw.select(F.concat(F.lit("<table><tr><th>Filer</th></tr><tr><td>"), _escaped("p"), F.lit("</td></tr></table>")).alias("x"))
    parts = [sources.parse(df, kind, "x").select(F.lit(kind).alias("kind"), "politician") for df, kind in ((hits, "json"), (page, "html"), (hits, "other"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query
def html_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No row has an asset name, so the page kept in each payload is read again."""
    page = F.concat(F.lit("<table><tr><th>Filer</th><th>Asset</th></tr><tr><td>x</td><td>"), _escaped("asset_name"), F.lit("</td></tr></table>"))
    raw = _raw(spark, sf_dir).select(F.lit(" ").alias("asset_name"), F.to_json(F.struct(page.alias("html"))).alias("raw_json"))
    return html.parse_with_fallback(raw).groupBy("asset_name").agg(F.count(F.lit(1)).alias("n"))


@query
def run_partial_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors over a quarter, or a listing that was itself cut off (here: a user without a purchase)."""
    e = read_table(spark, sf_dir, "events")
    errors, n = F.count_if(F.col("event_type") == "error"), F.count(F.lit(1))
    cut = F.count_if(F.col("event_type") == "purchase") == 0
    return e.groupBy("user_id").agg(listing.run_is_partial(errors, n, cut).alias("partial"))


# runs and the served state


def _stored(spark: SparkSession, sf_dir: str) -> tuple[store.ParquetStore, DataFrame]:
    return store.ParquetStore(spark, f"{shared_dir(spark)}/store"), _raw(spark, sf_dir).select(*RAW_FIELDS, "raw_json")


@query
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three ticks: a run, the same again, and one that fails; the log has a line each."""
    s, raw = _stored(spark, sf_dir)
    path = f"{shared_dir(spark)}/log"

    def broken() -> dict:
        raise OSError("no source")

    for run in (lambda: pipeline.run_pipeline(raw, s), lambda: pipeline.run_pipeline(raw, s), broken):
        pipeline.tick(spark, run, path)
    return spark.read.schema("ingested long, inserted long, skipped long, errors long, error string").json(path)


@query
def health_and_debug(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the service tells of a store after a refresh and a cron run, and through a catalogue table."""
    s, raw = _stored(spark, sf_dir)
    told, again = pipeline.refresh(lambda: pipeline.run_pipeline(raw, s), s), pipeline.cron(lambda: pipeline.run_pipeline(raw, s))
    api = serve.Service(s)
    health, debug = api.health(), api.debug()
    name = f"trades_{s.path.rstrip('/').split('/')[-2]}"
    s.create_table(name)
    spark.catalog.recoverPartitions(name)
    rows = spark.table(name).count()
    spark.sql(f"DROP TABLE {name}")
    fresh = told["lastUpdated"] is not None and health["last_run"] == api.last_updated()
    row = (health["status"], health["db_count"], debug["rawCount"], debug["sourceCounts"]["congress"], rows, told["ok"] and again["ok"] and fresh, again["summary"]["inserted"])
    return spark.createDataFrame([row], "status string, db_count long, raw_count long, congress long, table_rows long, ok boolean, inserted_again long")


@query
def parameter_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields refused of a request each, the first letters of real values among them."""
    cases = [
        {"type": "buy", "limit": "10"}, {"type": "swap"}, {"owner": "me", "limit": "0"}, {"limit": "1001", "offset": "-1"}, {"date_from": "4/9/2026", "date_to": "2026-04-09"},
        {"limit": "x"}, {"politician": "%", "ticker": "a"}, {},
    ]
    rows = []
    for i, case in enumerate(cases):
        try:
            serve.check_parameters(case)
            rows.append((i, ""))
        except serve.InvalidParameters as e:
            rows.append((i, ",".join(sorted(e.errors))))
    return spark.createDataFrame(rows, "case_no int, refused string")


@query
def configuration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defaults, given settings, and settings refused."""
    rows = []
    for i, env in enumerate(({}, {"FETCH_DAYS_BACK": "7", "LOG_LEVEL": "warn", "DB_PATH": "/x"}, {"FETCH_DAYS_BACK": "0"}, {"FETCH_DAYS_BACK": "366"}, {"LOG_LEVEL": "loud"})):
        try:
            c = pipeline.Config.load(env)
            rows.append((i, c.fetch_days_back, c.cron_schedule, c.log_level, c.store_path))
        except ValueError:
            rows.append((i, None, None, None, None))
    return spark.createDataFrame(rows, "case_no int, days int, schedule string, level string, store string")


# summaries


@query
def volume_last_30d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.volume_by_day(read_table(spark, sf_dir, "events"), "ts")


@query
def filer_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.filer_leaderboard(_accepted(spark, sf_dir))


@query
def ticker_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.ticker_clusters(_accepted(spark, sf_dir))


@query
def filing_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _accepted(spark, sf_dir).select("id", analytics.filing_delay().alias("days"))


@query
def stale_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _accepted(spark, sf_dir)
    newest = t.agg(F.max("transaction_date")).scalar()
    return t.select("id", analytics.stale("transaction_date", newest, 365).alias("stale"))
