"""Snapshots, bad rows, clock times and drifting payloads against brute force and by hand."""

import csv
import datetime as dt
import io
import json
import random
import zoneinfo

import pytest
from pyspark.sql import functions as F

from disclospark.operators.bad_rows import load_lines, split_records
from disclospark.operators.schema_drift import payload_problems, schema_changes, similarity_flooding, unified_table
from disclospark.operators.snapshots import snapshot_changes
from disclospark.operators.timestamps import has_clock_time, normalize_times, parse_clock, utc_text
from disclospark.schemas import RAW_FIELDS

# snapshots


def brute_changes(rows):
    snaps = {}
    for line, snap, key, value in rows:
        if key is not None and snap is not None:
            old = snaps.setdefault(snap, {}).get(key)
            if old is None or old[0] < line:
                snaps[snap][key] = (line, value)
    out, order = set(), sorted(snaps)
    for a, b in zip(order, order[1:], strict=False):
        x, y = snaps[a], snaps[b]
        out |= {(b, k, "added") for k in y.keys() - x.keys()} | {(b, k, "removed") for k in x.keys() - y.keys()}
        out |= {(b, k, "changed") for k in x.keys() & y.keys() if x[k][1] != y[k][1]}
    return out


@pytest.mark.parametrize(("keys", "churn"), [(60, 0.1), (3000, 0.05), (3000, 0.6)])
def test_snapshot_changes(spark, keys, churn):
    rng = random.Random(keys)
    rows, line = [], 0
    state = {f"k{i}": "a" for i in range(keys)}
    for snap in (2, 3, 7):
        for k in list(state):
            if rng.random() < churn:
                state[k] = rng.choice(["b", "c", None]) or None
        for k in rng.sample(sorted(state), int(keys * churn / 3)):
            del state[k]
        state |= {f"n{snap}_{i}": "z" for i in range(int(keys * churn / 3))}
        for k, v in state.items():
            line += 1
            rows.append((line, snap, k, v))
            if rng.random() < 0.02:
                line += 1
                rows.append((line, snap, k, "again"))
    rows += [(line + 1, 7, None, "x"), (line + 2, None, "k1", "x")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "line long, snap int, key string, value string").withColumn("h_key", F.lit("clash"))
    got = {tuple(r) for r in snapshot_changes(df, "snap", "key", ["value"], "line", rows_per_bucket=512, cells=64).collect()}
    assert got == brute_changes(rows)


def test_snapshots_without_rows(spark):
    df = spark.createDataFrame([], "line long, snap int, key string, value string")
    assert snapshot_changes(df, "snap", "key", ["value"], "line").collect() == []
    one = spark.createDataFrame([(1, 1, "a", "x")], df.schema)
    assert snapshot_changes(one, "snap", "key", ["value"], "line").collect() == []


# bad rows


def good(**change):
    base = ["Ann Lee", "1/2/2026", "1/3/2026", "", "Asset, Inc.", "Stock", "Sale", "$1,001 - $15,000", "Self", "r|1"]
    for i, v in change.items():
        base[int(i[1:])] = v
    return base


def line(fields, sep=",", quoting=csv.QUOTE_MINIMAL):
    s = io.StringIO()
    csv.writer(s, delimiter=sep, quoting=quoting, lineterminator="").writerow(fields)
    return s.getvalue()


LINES = [
    (line(good()), ",", None), (line(good(), ",", csv.QUOTE_ALL) + "\r", ",", None), (line(good(_4='A "b" c')), ",", None),
    (line(good(_4="two\nlines, here")), ",", None), (line(good(_4="é\x01ü" * 5000)), ",", None), ("", ",", "wrong_column_count"),
    (None, ",", "wrong_column_count"), (line(good(_7="", _4="b")), None, "wrong_column_count"), (line(good(), ";"), ",", "wrong_column_count"),
    ('"' + line(good()), ",", "broken_quoting"), (line(good()).replace("Ann", 'An"n'), ",", "broken_quoting"),
    ('"Ann" Lee' + line(good())[7:], ",", "broken_quoting"), ('"""",' + line(good())[8:], ",", "invalid_value"),
    (line(good(_0="--")), ",", "invalid_value"), (line(good(_4="12")), ",", "invalid_value"), (line(good(_7="$15,000 - $1")), ",", "invalid_value"),
    (line(good(_7="over $5")), ",", None), (line(good(_7="$5 - Over")), ",", None), (line(good(_7=" ")), ",", None), (line(good(_7="1e6")), ",", "invalid_value"),
    (line(good(_7="-$5")), ",", "invalid_value"), (line(good(_7="$5.50")), ",", "invalid_value"), (line(good(_7="$1,00")), ",", "invalid_value"),
    (line(good(), "|").replace("r|1", "r1").replace('"', ""), "|", None), ("||".join(good(_9="x")), "||", None), ("||".join(good(_9="x")) + "|", "||", None),
]


def test_lines(spark):
    rows = [(i, t, s, "mine") for i, (t, s, _) in enumerate(LINES)]
    df = spark.createDataFrame(rows, "line_id long, line_text string, separator string, amount string").repartition(2)
    got = {r["line_id"]: r for r in load_lines(df).collect()}
    assert {i: r["reason"] for i, r in got.items()} == {i: why for i, (_, _, why) in enumerate(LINES)}
    assert got[2]["asset_name"] == 'A "b" c'
    assert got[3]["asset_name"] == "two\nlines, here"
    assert (got[0]["amount_min"], got[0]["amount_max"], got[0]["tx_day"], got[0]["symbol"]) == (1001, 15000, dt.date(2026, 1, 2), None)


def test_split_equals_csv(spark):
    rng = random.Random(3)
    rows = [["".join(rng.choice('ab ,;"\n') for _ in range(rng.randint(0, 6))) for _ in range(10)] for _ in range(300)]
    texts = [line(r) for r in rows]
    df = spark.createDataFrame([(i, t, ",") for i, t in enumerate(texts)], "line_id long, line_text string, separator string")
    got = {r["line_id"]: (r["#broken"], r["#fields"]) for r in split_records(df, "line_text", "separator").collect()}
    for i, r in enumerate(rows):
        want = [*r]
        if want[-1].endswith("\n") and '"' not in texts[i][-1:]:
            want[-1] = want[-1].rstrip("\n")
        assert got[i] == (False, want), texts[i]


def test_no_lines(spark):
    assert load_lines(spark.createDataFrame([], "line_text string, separator string")).collect() == []


# clock times

CLOCKS = [
    ("2026-04-09T11:15:07.12-04:00", "2026-04-09T15:15:07.120000Z"), ("2026-04-09 11:15", "2026-04-09T15:15:00.000000Z"),
    ("4/9/2026 11:15 a.m. ET", "2026-04-09T15:15:00.000000Z"), ("04/09/2026 12:00:00 AM EST", "2026-04-09T05:00:00.000000Z"),
    ("04/09/2026 12:30 PM", "2026-04-09T16:30:00.000000Z"), ("09-Apr-2026 11:15:07.5", "2026-04-09T15:15:07.500000Z"),
    ("April 9, 2026 11:15:07", "2026-04-09T15:15:07.000000Z"), ("Thu, 09 Apr 2026 11:15:07 -0400", "2026-04-09T15:15:07.000000Z"),
    ("Thu Apr 09 2026 11:15:07 GMT-0400", "2026-04-09T15:15:07.000000Z"), ("Thu Apr 09 2026 11:15:07 GMT-0400 (Eastern Daylight Time)", "2026-04-09T15:15:07.000000Z"),
    ("20260409T151507Z", "2026-04-09T15:15:07.000000Z"), ("1775747707", "2026-04-09T15:15:07.000000Z"), ("1775747707120", "2026-04-09T15:15:07.120000Z"),
    ("2026-04-09T08:15:07[America/Los_Angeles]", "2026-04-09T15:15:07.000000Z"), ("2026-04-09 11:15:07-04", "2026-04-09T15:15:07.000000Z"),
    ("2026-04-09T15:15:07.123456789Z", "2026-04-09T15:15:07.123456Z"), ("11/1/2026 1:30 am", "2026-11-01T05:30:00.000000Z"), ("3/8/2026 2:30 am", "2026-03-08T07:30:00.000000Z"),
    ("11/01/2026 01:30:00 AM EST", "2026-11-01T06:30:00.000000Z"), ("2/30/2026 10:00", None), ("2026-04-09", None), ("4/9/2026", None), ("10/17/2018 25:61", None),
    ("2026-04-09T99:00:00-05:00", None), ("13:00 PM", None), ("04/09/2026 13:00 PM", None), ("2026-04-09T10:00[Mars/Base]", None), ("", None), (None, None), ("x" * 100_000, None), ("1" * 30, None),
]


def test_clock_times(spark):
    df = spark.createDataFrame([(i, t, "America/New_York", "u") for i, (t, _) in enumerate(CLOCKS)], "i long, t string, tz string, extra string")
    got = {r["i"]: r["u"] for r in normalize_times(df, "t", "tz").withColumn("u", utc_text(F.col("utc"))).collect()}
    assert got == {i: u for i, (_, u) in enumerate(CLOCKS)}


def clock_texts():
    """Combinations of all that the grammar of clock times takes."""
    dates = ("2026-04-09", "2026/4/9", "2026.4.9", "4/9/2026", "04.09.26", "9-Apr-2026", "09 April. 2026", "Thu, 9 apr, 2026", "Apr. 9, 2026", "April 9th 2026", "20260409")
    gaps, times, zones = ("T", "t", " ", ", ", " at ", "  AT ", "\u202f"), ("9:15", "09:15:07", "09:15:07.12", "09:15:07,123456789", "091507"), ("", " am", "a.m.", " PM ET", "Z", " EST", "-04", " +0530", " GMT-0400 (x)", "[America/New_York]")
    return [d + g + t + z for d in dates for g in gaps for t in times for z in zones] + ["1775747707", "1775747707.5", "1775747707120", "1775747707120000", " 1775747707 "]


def test_first_look_loses_no_clock_time(spark):
    df = spark.createDataFrame([(t,) for t in clock_texts()], "t string")
    read = parse_clock(df, "t").filter("local is not null")
    assert read.count() > 3000
    assert read.filter(~has_clock_time("t")).collect() == []
    for t in ("20260409 151507", "2026-04-09 151507", "2026-04-09t151507", "04/09/2026 at 101530"):
        row = normalize_times(spark.createDataFrame([(t, "America/New_York")], "t string, tz string"), "t", "tz").first()
        assert row["utc"] is not None, t


def zoned(zone, when):
    return when.replace(tzinfo=dt.timezone.utc).astimezone(zoneinfo.ZoneInfo(zone)).strftime("%Y-%m-%d %H:%M:%S")


ZONES = ["America/New_York", "America/Los_Angeles", "Pacific/Honolulu"]


def told(df, want, **how):
    """Share of rows whose time comes out within a minute of the true one."""
    got = {r["i"]: r["utc"] for r in normalize_times(df, "t", "tz", "feed", candidates=ZONES, **how).collect()}
    assert len(got) == len(want)
    return sum(got[i] is not None and abs(got[i] - want[i]) < dt.timedelta(minutes=1) for i in want) / len(want)


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_missing_zones_are_estimated(spark, kind):
    """A constant zone a group, and one that moves from coast to coast and back."""
    rows, want = [], {}
    for g, zones in enumerate((ZONES[:1], ZONES[1:2], ZONES[2:], [ZONES[0], ZONES[1], ZONES[0]])):
        for k in range(240):
            when = dt.datetime(2026, 1, 3) + dt.timedelta(days=k * 1.5, minutes=k)
            i = len(rows)
            rows.append((i, f"f{g}", zoned(zones[k * len(zones) // 240], when), when + dt.timedelta(minutes=4 + k % 50), None))
            want[i] = when
    df = spark.createDataFrame(rows, "i long, feed string, t string, seen timestamp_ntz, tz string")
    if kind == "timestamp":
        df = df.withColumn("seen", F.expr("timestamp_micros(timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01', seen))"))
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert told(df, want, ingested="seen") >= 0.95
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_missing_zones_from_sequence_order(spark):
    """Rows of known zone before and after a row bound its time; a row without any bound takes the usual zone."""
    rows, want = [], {}
    for i in range(30_000):
        when = dt.datetime(2026, 1, 3) + dt.timedelta(minutes=9 * i)
        bare = i % 7 == 3
        zone = ZONES[1] if bare else ZONES[0]
        rows.append((i, "f", zoned(zone, when), None if bare else zone))
        if bare:
            want[i] = when
    df = spark.createDataFrame(rows, "i long, feed string, t string, tz string")
    got = {r["i"]: r["utc"] for r in normalize_times(df, "t", "tz", "feed", candidates=ZONES, sequence="i").collect()}
    assert sum(got[i] == w for i, w in want.items()) >= 0.95 * len(want)


def test_no_zone_can_be_told(spark):
    df = spark.createDataFrame([(1, "f", "2026-04-09 10:00", None, None), (2, None, "2026-04-09 10:00Z", None, "x/y")], "i long, feed string, t string, seen timestamp_ntz, tz string")
    got = {r["i"]: r["utc"] for r in normalize_times(df, "t", "tz", "feed", "seen", ZONES).collect()}
    assert got == {1: None, 2: dt.datetime(2026, 4, 9, 10)}
    assert normalize_times(df.limit(0), "t", "tz", "feed", "seen", ZONES).collect() == []


# drifting payloads


def test_drift(spark):
    def row(i, batch, payload, feed="f"):
        own = {c: f"{c}{i}" for c in RAW_FIELDS}
        return (i, feed, batch, *[own[c] for c in RAW_FIELDS], payload(own) if callable(payload) else payload)

    def one(o):
        return json.dumps({"who": o["politician"], "when": o["transaction_date"], "amt": o["amount"], "page": 3, "note": "x"})

    def two(o):
        return json.dumps({"filer": o["politician"], "when": {"text": o["transaction_date"]}, "amt": o["amount"], "page": "3", "extra": True})

    rows = [row(i, 1, one) for i in range(5)] + [row(10, 1, None), row(11, 1, "not json"), row(12, 1, "[1]")]
    rows += [row(20 + i, 2, two) for i in range(5)] + [row(30, 4, lambda o: json.dumps({"filer": None, "when": None, "amt": o["amount"]}))]
    rows += [row(40, 1, None, "empty"), row(41, 2, one, "empty")]
    df = spark.createDataFrame(rows, "row_id long, feed string, batch_no int, " + ", ".join(f"{c} string" for c in RAW_FIELDS) + ", raw_json string")
    got = {tuple(r) for r in schema_changes(df, "raw_json", "feed", "batch_no").collect()}
    assert {r for r in got if r[0] == "f" and r[1] == 2} == {
        ("f", 2, "renamed", "who", "filer"), ("f", 2, "retyped", "when", "when"), ("f", 2, "retyped", "page", "page"), ("f", 2, "removed", "note", ""), ("f", 2, "added", "", "extra"),
    }
    assert {r[2:] for r in got if r[0] == "empty"} == {("added", "", k) for k in ("who", "when", "amt", "page", "note")}
    table = {r["row_id"]: r for r in unified_table(df, "raw_json", "feed", "batch_no", "row_id").collect()}
    assert len(table) == len(rows)
    assert table[21]["politician"] == "politician21"
    assert table[21]["transaction_date"] == "transaction_date21"
    assert json.loads(table[0]["others"]) == {"page": "3", "note": "x"}


def drift_frame(spark, rows):
    """rows: (batch, payload made of the row's own columns or a text, columns that are null); one feed."""
    out = []
    for i, (batch, payload, *gone) in enumerate(rows):
        own = {c: None if gone and c in gone[0] else f"{c}{i}" for c in RAW_FIELDS}
        out.append((i, "f", batch, *own.values(), payload(own) if callable(payload) else payload))
    return spark.createDataFrame(out, "row_id long, feed string, batch_no int, " + ", ".join(f"{c} string" for c in RAW_FIELDS) + ", raw_json string")


def changes(df):
    return {tuple(r)[1:] for r in schema_changes(df, "raw_json", "feed", "batch_no").collect()}


def test_all_members_of_nested_values_are_read(spark):
    def one(o):
        return json.dumps({"asset": {"isin": "X", "a.b": 1, "name": o["asset_name"]}, "amount": [o["amount"], "4", {"deep": [True, None]}], "when": {"tx": o["transaction_date"], "filed": o["filing_date"]}})

    df = drift_frame(spark, [(1, one), (1, one), (1, '{"asset": {}}')])
    rows = {r["row_id"]: r for r in unified_table(df, "raw_json", "feed", "batch_no", "row_id").collect()}
    r = rows[0]
    assert (r["asset_name"], r["amount"], r["transaction_date"], r["filing_date"]) == ("asset_name0", "amount0", "transaction_date0", "filing_date0")
    assert json.loads(r["others"]) == {"asset.isin": "X", "asset.a\\.b": "1", "amount[1]": "4", "amount[2].deep[0]": "true", "amount[2].deep[1]": None}
    assert rows[2]["others"] == "{}"


def test_null_in_place_of_a_nested_value_that_bears_a_column(spark):
    nested = lambda o: json.dumps({"when": {"tx.day": [o["transaction_date"]]}, "page": {"no": 3}})
    df = drift_frame(spark, [(1, nested), (1, nested), (1, '{"when": null, "page": null}'), (1, '{"when": {"tx.day": null}, "page": {"no": null}}')])
    rows = {r["row_id"]: r for r in unified_table(df, "raw_json", "feed", "batch_no", "row_id").collect()}
    assert [rows[i]["transaction_date"] for i in range(4)] == ["transaction_date0", "transaction_date1", None, None]
    assert [rows[i]["others"] for i in range(4)] == ['{"page.no":"3"}', '{"page.no":"3"}', '{"page":null}', '{"page.no":null}']


def test_repeated_keys_and_broken_payloads(spark):
    df = drift_frame(spark, [(1, '{"who": "x", "n": 1, "who": "politician0"}'), (1, "no"), (1, "[1]"), (1, None), (1, '{"n": NaN}'), (1, "[" * 100_000)])
    rows = {r["row_id"]: r for r in unified_table(df, "raw_json", "feed", "batch_no", "row_id").collect()}
    assert (rows[0]["politician"], rows[0]["others"]) == ("politician0", '{"n":"1"}')
    assert [rows[i]["others"] for i in range(1, 6)] == [None] * 5
    assert {(r["problem"], r["rows"]) for r in payload_problems(df, "raw_json", "feed", "batch_no").collect()} == {("malformed", 3), ("not_an_object", 1), ("repeated_key", 1)}


def test_flooding_knows_what_content_cannot_tell(spark):
    """In file 2 the filer is null throughout and stands under another key, in file 3 nested: types, order and names of the graph carry its meaning."""
    first = lambda o: json.dumps({"docLine": "z", "filer": o["politician"], "txDate": o["transaction_date"], "amt": o["amount"], "page": 3})
    second = lambda o: json.dumps({"docLine": "z", "filerName": "somebody", "txDate": o["transaction_date"], "amt": o["amount"], "page": 3})
    third = lambda o: json.dumps({"docLine": "z", "filer": {"name": None}, "txDate": o["transaction_date"], "amt": o["amount"], "page": 3})
    df = drift_frame(spark, [(1, first), (1, first), (2, second, RAW_FIELDS[:1]), (2, second, RAW_FIELDS[:1]), (3, third), (4, first)])
    assert changes(df) == {(2, "renamed", "filer", "filerName"), (3, "renamed", "filerName", "filer"), (3, "retyped", "filer", "filer"), (4, "retyped", "filer", "filer")}
    # content that speaks against it is not overruled
    other = lambda o: json.dumps({"docLine": "z", "filerName": "somebody", "txDate": o["transaction_date"], "amt": o["amount"], "page": 3})
    df = drift_frame(spark, [(1, first), (2, other)])
    assert changes(df) == {(2, "removed", "filer", ""), (2, "added", "", "filerName")}


def test_flooding_of_two_graphs():
    a = [("r", "child", "x"), ("r", "child", "y"), ("x", "type", "t"), ("y", "type", "u")]
    b = [("R", "child", "p"), ("R", "child", "q"), ("p", "type", "T"), ("q", "type", "U")]
    s = similarity_flooding(a, b, {("r", "R"): 1.0, ("t", "T"): 1.0, ("u", "U"): 1.0, ("t", "U"): 0.0, ("u", "T"): 0.0})
    assert s["x", "p"] > s["x", "q"] and s["y", "q"] > s["y", "p"]
    assert max(s.values()) == 1.0


def test_no_payloads(spark):
    df = spark.createDataFrame([], "row_id long, feed string, batch_no int, " + ", ".join(f"{c} string" for c in RAW_FIELDS) + ", raw_json string")
    assert schema_changes(df, "raw_json", "feed", "batch_no").collect() == []
