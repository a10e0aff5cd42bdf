"""Readers over landed files and hand-made texts."""

import datetime as dt
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from disclospark import sources
from disclospark.sources import html, json_hits, landing, listing, ptr_text, xml_index

from .compare import SF, sparked

UUID = "0A1b2c3d-0000-1111-2222-333344445555"
MEMBER = "<Member><Prefix>Hon.</Prefix><Last>{last}</Last><First>Ann</First><Suffix>{suffix}</Suffix><FilingType>{kind}</FilingType><StateDst>CA1</StateDst><Year>2026</Year><FilingDate>{day}</FilingDate><DocID>{doc}</DocID></Member>"


def page(*rows):
    return json.dumps({"draw": 1, "recordsTotal": len(rows), "recordsFiltered": len(rows), "data": rows})


def test_listing(spark):
    link = f'<a href="/search/view/ptr/{UUID}/">PTR</a>'
    rows = [["<b>Ann</b>", " Lee ", "Senator", link, "04/09/2026"], ["A", "B", "c", link.replace("/ptr/", "/paper/"), "04/09/2026"], ["A", "B", "c", link], ["", "B", "c", link, "x"], ["A", "B", "c", link, None]]
    df = spark.createDataFrame([(page(*rows),), ("broken",), (None,)], "payload string")
    got = listing.filing_meta(listing.scan_pages(df)).collect()
    assert [tuple(r) for r in got] == [("Ann Lee", "04/09/2026", f"/search/view/ptr/{UUID}/", UUID, "Senator")]


def test_landing_source(spark, tmp_path):
    (tmp_path / "a.json").write_text(page(["x", "y"]))
    (tmp_path / "b.json").write_text("not json")
    spark.dataSource.register(landing.ListingPages)
    rows = spark.read.format("disclosure_listing").option("path", f"{tmp_path}/*.json").load().collect()
    assert sorted((r["path"][-6:], r["cells"], r["error"] is not None) for r in rows) == [("a.json", ["x", "y"], False), ("b.json", None, True)]


def test_retry():
    calls, pauses = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("again")
        return "done"

    assert landing.with_retry(flaky, retries=3, delay_s=1, sleep=pauses.append) == "done"
    assert len(pauses) == 2 and 0.75 <= pauses[0] <= 1.25 and 1.5 <= pauses[1] <= 2.5
    with pytest.raises(ZeroDivisionError):
        landing.with_retry(lambda: 1 / 0, retries=1, sleep=pauses.append)


def test_hits(spark):
    hits = [{"_id": "i1", "_source": {"senator_name": "Ann Lee", "date_filed": "1/2/2026", "amount": 5}}, {"_id": "i2"}, 7, {"_source": {"first_name": "Bo", "last_name": "Ray", "report_id": "r9", "filing_date": "x"}}]
    df = spark.createDataFrame([(json.dumps([h for h in hits if h != 7]),), (json.dumps(hits[0]),), ("nope",), (None,)], "payload string")
    got = json_hits.parse_hits(df).collect()
    assert [(r["politician"], r["filing_date"], r["amount"], r["source_id"]) for r in got] == [("Ann Lee", "1/2/2026", "5", "i1"), ("Bo Ray", "x", "", "r9"), ("Ann Lee", "1/2/2026", "5", "i1")]
    assert sources.parse(df, "other", "payload").collect() == []


def test_ptr_tables(spark):
    body = "<tr><td>1</td></tr><tr><td>2</td><td>1/2/2026</td><td>Self</td><td> -- </td><td>A <b>&amp;</b> B</td><td>Stock</td><td>Purchase</td><td>$1</td><td>note</td></tr>"
    docs = [(1, f"<table><tr><td>outside</td></tr><tbody>{body}</tbody></table>"), (2, f"<table class='table'>{body}</table>"), (3, "<p>none</p>"), (4, None), (5, "<table><tbody><tr><td>a</td></tr></tbody></table>")]
    df = spark.createDataFrame([(i, "Ann", "1/3/2026", f"u{i}", "o", h) for i, h in docs], "doc_key long, politician string, filing_date string, ptr_uuid string, office string, html string")
    got = {r["source_id"]: r for r in html.parse_ptr_tables(df).collect()}
    assert set(got) == {"u1|1", "u2|1"}
    assert (got["u1|1"]["asset_name"], got["u1|1"]["ticker"], got["u1|1"]["type"]) == ("A & B", "--", "Purchase")


def test_header_tables(spark):
    first = "<table><tr><th>x</th></tr><tr><td>wrong</td></tr></table>"
    good = "<table class='a table-striped'><tr><th>Amount</th><th> Name </th><th>?</th></tr><tr><td>$5</td><td>Ann</td><td>t</td></tr><tr></tr><tr><td>$6</td><td> </td></tr></table>"
    df = spark.createDataFrame([(first + good,), ("<table><tr><td>only header</td></tr></table>",)], "html string")
    rows = html.parse_header_tables(df).collect()
    assert [(r["politician"], r["amount"], r["transaction_date"]) for r in rows] == [("Ann", "$5", "t")]
    assert json.loads(rows[0]["raw_json"]) == {"col_0": "$5", "col_1": "Ann", "col_2": "t"}


def test_fallback(spark):
    page_html = "<table><tr><th>Filer</th></tr><tr><td>Ann</td></tr></table>"
    df = spark.createDataFrame([(" ", json.dumps({"html": page_html})), (None, None)], "asset_name string, raw_json string")
    assert html.fallback_needed(df)
    assert html.parse_with_fallback(df).first()["politician"] == "Ann"
    assert not html.fallback_needed(df.limit(0))
    assert not html.fallback_needed(df.withColumn("asset_name", F.lit("x")))


def test_archive(spark, tmp_path):
    members = [("Lee", "Jr.", "P", "1/2/2026", "0012"), ("Ray", "", "C", "1/2/2026", "2"), ("Old", "", "P", "1/2/2020", "3"), ("Bad", "", "P", "n/d", "4"), ("None", "", "P", "1/2/2026", "")]
    xml = "<FinancialDisclosure>" + "".join(MEMBER.format(last=a, suffix=b, kind=c, day=d, doc=e) for a, b, c, d, e in members) + "</FinancialDisclosure>"
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("2026FD.xml", xml)
        z.writestr("2026FD.txt", "x")
    (tmp_path / "2026FD.zip").write_bytes(buffer.getvalue())
    got = xml_index.read_archives(spark, str(tmp_path)).collect()
    assert [(r["name"], r["xml"]) for r in got] == [("2026FD.xml", xml)]
    flow = xml_index.periodic_filings(xml_index.archive_members(spark, str(tmp_path)), "2026-01-01", "2026-12-31").collect()
    assert [(r["member"], r["docId"]) for r in flow] == [("Ann Lee Jr.", "0012")]
    (tmp_path / "x.xml").write_text(xml)
    out = xml_index.periodic_filings(xml_index.read_members(spark, str(tmp_path / "x.xml")), "2026-01-01", "2026-12-31").collect()
    assert [(r["member"], r["docId"], r["filingDate"]) for r in out] == [("Ann Lee Jr.", "0012", dt.date(2026, 1, 2))]


def test_ptr_text(spark):
    text = "Header\x00\nSP Apple Inc. (AAPL) [ST]P 01/02/202601/03/2026$1,001 - $15,000\ncomment: none\nLong name\nof a fund (X.B) [MF] S (partial) 1/2/2026 1/3/2026 Over $50,000,000 tail"
    df = spark.createDataFrame([("Ann", "1/5/2026", "d1", text), ("Bo", "x", "d2", ""), ("Bo", "x", "d3", None)], "member string, filingDate string, docId string, text string")
    a, b = ptr_text.parse_ptr_text(df).collect()
    assert (a["ticker"], a["owner"], a["type"], a["transaction_date"], a["filing_date"], a["amount"], a["source_id"]) == ("AAPL", "Spouse", "Purchase", "01/02/2026", "1/5/2026", "$1,001 - $15,000", "d1|0")
    assert a["asset_name"].endswith("Apple Inc.")
    assert (b["ticker"], b["owner"], b["type"], b["amount"]) == ("X.B", "Self", "Sale (Partial)", "Over $50,000,000")
    assert b["asset_name"].endswith("of a fund")


def test_ptr_text_without_ticker(spark):
    text = (
        "SP US Treasury Bond 1.875% due 08/15/2047\x00 [GS] P 01/02/202601/03/2026$1,001 - $15,000\nSP Apple Inc. (AAPL) [ST]P 01/02/202601/03/2026$1,001 - $15,000\n"
        "comment: none\nKrorackley County (Dist. 4) School 3.00% [MS]S (partial) 1/2/2026 1/3/2026 Over $50,000,000 tail"
    )
    df = spark.createDataFrame([("Ann", "1/5/2026", "d1", text)], "member string, filingDate string, docId string, text string")
    got = [(r["ticker"], r["asset_name"], r["asset_type"], r["owner"], r["type"], r["amount"], r["source_id"]) for r in ptr_text.parse_ptr_text(df).collect()]
    assert got == [
        (None, "US Treasury Bond 1.875% due 08/15/2047", "GS", "Spouse", "Purchase", "$1,001 - $15,000", "d1|0"),
        ("AAPL", "Apple Inc.", "ST", "Spouse", "Purchase", "$1,001 - $15,000", "d1|1"),
        (None, "Krorackley County (Dist. 4) School 3.00%", "MS", "Self", "Sale (Partial)", "Over $50,000,000", "d1|2"),
    ]


def test_ptr_text_of_all_accepted_trades(spark):
    """With and without ticker, open ranges as `Over`: every accepted trade is read back as it was."""
    t = spark.read.parquet(f"{SF}/transactions.parquet")
    dollars = lambda c: F.concat(F.lit("$"), F.format_number(c, 0))
    amount = F.when(F.col("amount_max").isNull(), F.concat(F.lit("Over "), dollars("amount_min"))).otherwise(F.concat(dollars("amount_min"), F.lit(" - "), dollars("amount_max")))
    day = F.date_format("transaction_date", "MM/dd/yyyy")
    marker = F.coalesce(F.concat(F.lit("("), F.col("ticker"), F.lit(") ")), F.lit(""))
    text = F.concat(F.lit("SP "), "asset_name", F.lit("\x00 "), marker, F.lit("[ST] P "), day, F.date_format("filing_date", "MM/dd/yyyy"), amount)
    docs = t.select(F.col("politician").alias("member"), F.col("filing_date").alias("filingDate"), F.col("id").alias("docId"), text.alias("text"))
    columns = ["politician", "transaction_date", "ticker", "asset_name", "amount", "source_id"]
    want = t.select("politician", day.alias("transaction_date"), "ticker", "asset_name", amount.alias("amount"), F.concat("id", F.lit("|0")).alias("source_id"))
    assert t.filter("ticker is null").count() > 0
    assert sparked(ptr_text.parse_ptr_text(docs).select(*columns)) == sparked(want)
