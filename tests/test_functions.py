"""Truth tables of the scalar functions and the edge cases of validation."""

import datetime as dt

import pytest

from disclospark.functions import normalize as N
from disclospark.functions import text as X
from disclospark.functions.identity import dedup_key, stable_id
from disclospark.schemas import RAW_FIELDS


def one(spark, expression, value):
    df = spark.createDataFrame([(value,)], "v string")
    return df.select(*[e.alias(f"e{i}") for i, e in enumerate(expression if isinstance(expression, tuple) else (expression,))]).first()


@pytest.mark.parametrize(
    ("raw", "lo", "hi"),
    [
        ("$1,001 - $15,000", 1001, 15000), ("$1,001 – $15,000", 1001, 15000), ("$500,000 - Over", 500000, None),
        ("$5,000,000 - Over $1", 5000000, None), ("Over $50,000,000", 50000000, None), ("OVER 5", 5, None), ("$15,001", 15001, 15001),
        ("$15,001 -", 15001, 15001), ("", 0, None), ("  ", 0, None), (None, 0, None), ("$1 - OVER", 1, 0), ("None", 0, 0), ("-5", -5, -5),
        ("$1,001.50 - $2,000", 1001, 2000),
    ],
)
def test_amounts(spark, raw, lo, hi):
    assert tuple(one(spark, N.amount_range("v"), raw)) == (lo, hi)


@pytest.mark.parametrize(
    ("raw", "day"),
    [
        ("2026-04-09", dt.date(2026, 4, 9)), ("4/9/2026", dt.date(2026, 4, 9)), (" 04/09/2026\t", dt.date(2026, 4, 9)), ("2026-4-9", dt.date(2026, 4, 9)),
        ("3/4/24", dt.date(2024, 3, 4)), ("2/30/2026", None), ("2/29/2024", dt.date(2024, 2, 29)), ("garbage", None), ("", None), (None, None), ("13/1/2026", None),
    ],
)
def test_dates(spark, raw, day):
    assert one(spark, N.calendar_date("v"), raw)[0] == day


def test_legacy_years(spark):
    assert one(spark, N.calendar_date("v", legacy_years=True), "3/4/24")[0] == dt.date(24, 3, 4)


@pytest.mark.parametrize(
    ("raw", "side", "owner", "ticker"),
    [
        ("Purchase", "buy", "self", "PURCHASE"), (" SALE (Full) ", "sell", "self", "SALE (FULL)"), ("sale_partial", "sell", "self", "SALE_PARTIAL"),
        ("Exchange", None, "self", "EXCHANGE"), ("JT", None, "self", "JT"), ("SP", None, "spouse", "SP"), ("dc", None, "child", "DC"),
        ("Joint (Self)", None, "joint", "JOINT (SELF)"), ("n/a", None, "self", None), ("--", None, "self", None), ("", None, "self", None),
        (" nvda\xa0", None, "self", "NVDA"), (None, None, "self", None),
    ],
)
def test_codes(spark, raw, side, owner, ticker):
    assert tuple(one(spark, (N.trade_side("v"), N.owner_code("v"), N.ticker_symbol("v")), raw)) == (side, owner, ticker)


def test_trim_strips_every_blank(spark):
    assert one(spark, X.wide_trim("v"), "﻿ \x0b a b 　\n")[0] == "a b"
    assert one(spark, X.strip_tags("v"), "<td>\n a <b>b</b> </td>")[0] == "a b"


def test_golden_id(spark):
    df = spark.createDataFrame([("Mark Alford", dt.date(2026, 3, 16), "Amazon.com, Inc. - Common Stock", 1001, 15000), ("A", dt.date(2026, 3, 16), "b", 5, None)], "politician string, transaction_date date, asset_name string, amount_min long, amount_max long")
    r = df.select(stable_id(), dedup_key()).collect()
    assert r[0][0] == "4d6016b44239f646476ffac6798f21ae3e32c8ed75ea6c5b50a0bbdf9e5d3296"
    assert r[1][1] == "a|2026-03-16|b|5|"


def raw_frame(spark, *rows):
    base = dict.fromkeys(RAW_FIELDS, "x") | {"transaction_date": "2026-01-02", "filing_date": "2026-01-03", "type": "Purchase", "amount": "$1"}
    return spark.createDataFrame([tuple((base | r)[c] for c in RAW_FIELDS) for r in rows], ", ".join(f"{c} string" for c in RAW_FIELDS))


def test_skip_reasons_in_order(spark):
    rows = [
        {"politician": " ", "asset_name": ""}, {"transaction_date": "", "filing_date": None, "asset_name": ""}, {"asset_name": "\t", "type": "?"}, {"type": "Exchange"},
        {"transaction_date": "2/30/2026", "filing_date": "n/d"}, {"transaction_date": "n/d"},
    ]
    got = [r["skip_reason"] for r in N.normalize(raw_frame(spark, *rows)).collect()]
    assert got == ["missing_politician", "missing_both_dates", "missing_asset_name", "unrecognized_type", "unparseable_dates", None]


def test_validation(spark):
    df = spark.createDataFrame([(None, dt.date(2026, 1, 1), 5, 1, "swap", None), (dt.date(2026, 1, 1),) * 2 + (1, None, "buy", "self")], "transaction_date date, filing_date date, amount_min long, amount_max long, type string, owner string")
    a, b = (r[0] for r in df.select(N.validation_errors()).collect())
    assert a == ["invalid transaction_date", "amount_min exceeds amount_max", "invalid type", "invalid owner"]
    assert b == []


def test_empty_input(spark):
    assert N.kept(N.normalize(raw_frame(spark, {}).limit(0))).collect() == []
