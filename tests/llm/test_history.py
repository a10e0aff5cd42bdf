"""History dedup: equal to brute force, and the same however rows are cut into batches."""

import datetime as dt
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from disclospark.llm import history_dedup as H

NAMES = ["Dralorquin Mining Corp.", "Drilorvane Foods, Inc.", "Velgard Token", "Ziosockley Textiles Corporation", "US Treasury Note 4.250% due 11/15/2033"]
TAILS = ["", " - Common Stock", " - Class A Common Stock", " Call Option $160 exp 11/20/2022", " Put $160.00 expires 11/20/2022", " 5.00% DUE: 03/15/2040 Note", " [DRX]", " Com Stk"]


def test_asset_text(spark):
    same = [
        ["Dralorquin  Mining, Corp. - Common Stock", "DRALORQUIN MINING CORPORATION", "dralorquin mining corp. [DRX]", "Dralorquin Mining Corp. Com Stk"],
        ["X Inc. Call Option $160.00 exp 01/02/2022", "x incorporated call $160 expires 1/2/2022", "X, Inc. Call Option $160 exp 2022-01-02"],
        ["X PLC 5.250% due 03/05/2040", "x plc 5.25% DUE: 3/5/2040 Note", "X PLC 5.25% due 2040-03-05"],
        ["X Class A Common Stock", "X - Class A Common Stock"], ["X Class B Common Stock"], ["US Treasury Note 1% due 2030-1-1"], ["US Treasury Bond 1% due 2030-1-1"],
    ]
    df = spark.createDataFrame([(i, s) for i, g in enumerate(same) for s in g], "i int, s string")
    df = H.with_asset_text(df, "s", "t")
    seen = df.groupBy("i").agg(F.collect_set("t").alias("t")).collect()
    assert all(len(r["t"]) == 1 for r in seen)
    assert len({r["t"][0] for r in seen}) == len(same)


def typo(s, rng):
    i = rng.randrange(2, min(9, len(s) - 1))
    return s[:i] + rng.choice(["", "q", s[i] + s[i]]) + s[i + 1 :]


def make(spark, n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a = rng.choice(NAMES)
        a = typo(a, rng) if rng.random() < 0.25 else a
        hot = rng.random() < 0.35
        rows.append((i, 1 + i * 4 // n, "hot" if hot else rng.choice("abc"), a + rng.choice(TAILS), dt.date(2026, 1, 1 if hot else rng.randint(1, 3)), 1001, rng.choice([None, 15000])))
    return spark.createDataFrame(rows, "row_id long, batch int, who string, asset string, day date, lo long, hi long")


def contents(df):
    texts = H.asset_texts(df.select(F.col("asset").alias("asset_name")))
    rows = H.with_content(df.withColumn("asset_name", F.col("asset")), texts, "who", "day", "lo", "hi")
    rows = rows.select("row_id", "batch", "salt", "content", "text_id", F.col("row_id").alias("seq"), F.col("row_id").cast("string").alias("original"))
    return rows.cache(), texts.select("text_id", "text").distinct().cache()


def run(spark, rows, texts, cuts, reopen=False):
    """cuts: batch number to step; rows of one step are one batch."""
    rows = rows.withColumn("batch", F.create_map(*[F.lit(x) for kv in cuts.items() for x in kv])[F.col("batch")])
    made = H.prepare(rows, rows.select("text_id").distinct().join(texts, "text_id").withColumn("grams", H.winnowed("text")))
    store = H.HistoryStore(spark, parts=3, bits=1 << 12)
    for no in sorted(set(cuts.values())):
        store.check(made.filter(F.col("batch") == no))
        if reopen:
            store = H.HistoryStore(spark, store.path)
            assert (store.parts, store.bits) == (3, 1 << 12)
    return {r["row_id"]: r["original"] for r in H.repeated_rows(rows, store.decided()).collect()}


def brute(rows, texts):
    """Every row against all earlier distinct contents, recognised ones too; the least root of those that agree."""
    text = {r["text_id"]: r["text"] for r in texts.collect()}
    first, out = {}, {}
    for r in sorted(rows, key=lambda r: r["seq"]):
        if r["content"] not in first:
            met = [root for c, (salt, t, root) in first.items() if salt == r["salt"] and H.same_text(t, text[r["text_id"]])]
            first[r["content"]] = (r["salt"], text[r["text_id"]], min(met, key=int) if met else r["original"])
        root = first[r["content"]][2]
        if root != r["original"]:
            out[r["row_id"]] = root
    return out


@pytest.mark.parametrize("cuts", [{1: 1, 2: 2, 3: 3, 4: 4}, {1: 1, 2: 1, 3: 1, 4: 1}])
@pytest.mark.parametrize("small", [True, False])
def test_against_brute_force(spark, monkeypatch, cuts, small):
    if not small:
        monkeypatch.setattr(H, "BROADCAST_ROWS", 0)  # the ways beyond the broadcasts
    rows, texts = contents(make(spark, 400, 5))
    want = brute(rows.collect(), texts)
    assert len(want) > 100
    assert run(spark, rows, texts, cuts, reopen=True) == want


def test_short_words_may_be_mistyped():
    for a, b in (("ford", "frod"), ("west bank corp", "west banc corp"), ("motor", "moto"), ("dralor corp", "dralor cor"), ("velgard token", "velgardtoken"), ("grabowskell inc", "grxbowskyll inc")):
        assert H.same_text(a, b), (a, b)
    for a, b in (("fund ii", "fund iii"), ("x class a", "x class b"), ("acme call", "acme put"), ("acme etf", "acme etn"), ("x llc", "x plc"), ("ford", "frdx"), ("ab", "ac"), ("", "ab")):
        assert not H.same_text(a, b), (a, b)


def test_recall_of_the_fingerprints_by_length():
    """Whatever the verification takes shares a fingerprint: measured on one and two typos in texts of every length."""
    rng = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz"

    def edit(t):
        i = rng.randrange(len(t))
        return rng.choice([t[:i] + t[i + 1 :], t[:i] + rng.choice(letters) + t[i:], t[:i] + rng.choice(letters) + t[i + 1 :], t[:i] + t[i + 1 : i + 2] + t[i] + t[i + 2 :]])

    seen = Counter()
    for _ in range(20_000):
        words = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 12))) for _ in range(rng.randint(1, 6))]
        a = " ".join(words)
        b = edit(a) if rng.random() < 0.5 else edit(edit(a) or a)
        if a != b and H.same_text(a, b):
            seen["taken", len(a) // 10] += 1
            seen["met", len(a) // 10] += bool(set(H.text_grams(a)) & set(H.text_grams(b)))
    assert seen["taken", 0] > 500
    assert all(seen["met", k] == n for (kind, k), n in seen.items() if kind == "taken")
    assert max(len(H.text_grams("".join(rng.choice(letters) for _ in range(n)))) for n in (60, 400, 3000)) < 25


def test_seeded_store_and_empty_batches(spark):
    rows, texts = contents(make(spark, 60, 9))
    made = H.prepare(rows.withColumn("batch", F.lit(1)), texts.withColumn("grams", H.winnowed("text")))
    store = H.HistoryStore(spark, parts=2, bits=1 << 10)
    store.seed(made)
    again = store.check(made.withColumn("batch", F.lit(2)))
    assert again.filter("fresh").count() == 0
    assert again.filter("root.batch = 1").count() == made.count()
    assert store.check(made.limit(0)).count() == 0
    assert store.check(made.limit(0)).count() == 0


def test_an_asset_without_words(spark):
    rows = [(1, 1, "a", "123 4.5%", dt.date(2026, 1, 1), 1, None), (2, 2, "a", " 123  4.50% ", dt.date(2026, 1, 1), 1, None), (3, 2, "a", "124 4.5%", dt.date(2026, 1, 1), 1, None)]
    rows, texts = contents(spark.createDataFrame(rows, "row_id long, batch int, who string, asset string, day date, lo long, hi long"))
    assert run(spark, rows, texts, {1: 1, 2: 2}) == {2: "1"}


def test_filters_hold_what_was_added(spark):
    """No false negatives, even in filters far too small."""
    rng = np.random.default_rng(1)
    fps = rng.integers(-(1 << 62), 1 << 62, 500)
    roll = H._roll(1 << 9)
    none = pd.DataFrame({"part": pd.Series([], dtype="int32"), "bits": pd.Series([], dtype="object")})
    first = roll((0,), none, pd.DataFrame({"fp": fps, "content": np.arange(500)}))
    assert len(first) == 1 or first["fp"].notna().sum() < 500
    out = roll((0,), pd.DataFrame({"part": [0], "bits": [first["bits"].iloc[0]]}), pd.DataFrame({"fp": fps[::-1], "content": np.arange(500)}))
    assert set(out["content"].dropna()) == set(range(500))
    twice = roll((0,), none, pd.DataFrame({"fp": [5, 6, 5], "content": [1, 2, 3]}))
    assert set(zip(twice["fp"].dropna(), twice["content"].dropna(), strict=True)) >= {(5, 1), (5, 3)}


def test_a_batch_takes_few_plans_and_exchanges(spark):
    """Each exchange takes a thread of the driver for a minute, and the driver keeps every plan: fingerprints are dealt out once, and one search meets batch and store."""
    rows, texts = contents(make(spark, 200, 3))
    made = H.prepare(rows, texts.withColumn("grams", H.winnowed("text")))
    store = H.HistoryStore(spark, parts=3, bits=1 << 12)
    for no in (1, 2):
        store.check(made.filter(F.col("batch") == no))
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    status = spark._jsparkSession.sharedState().statusStore()
    before = status.executionsCount()
    assert store.check(made.filter(F.col("batch") == 3)).filter("root.batch < 3").count()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    runs = status.executionsList(before, 100)
    names = []
    for i in range(runs.size() - 1):  # the last one is the count above
        nodes = status.planGraph(runs.apply(i).executionId()).allNodes()
        names += [nodes.apply(k).name() for k in range(nodes.size())]
    assert sum(n.startswith("Execute InsertIntoHadoop") for n in names) == 3
    assert sum(n in ("Exchange", "BroadcastExchange") for n in names) <= 12


def test_a_batch_leaves_the_contents_of_the_store_where_they_are(spark):
    """Few pairs: one exchange deals fingerprints and filters, one broadcast looks them up and one finds the stored texts, and only pairs and the batch are dealt out."""
    rows, texts = contents(make(spark, 200, 3))
    made = H.prepare(rows, texts.withColumn("grams", H.winnowed("text")))
    store = H.HistoryStore(spark, parts=3, bits=1 << 12)
    for no in (1, 2):
        store.check(made.filter(F.col("batch") == no))
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    status = spark._jsparkSession.sharedState().statusStore()
    before = status.executionsCount()
    store.check(made.filter(F.col("batch") == 3))
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    runs = status.executionsList(before, 100)
    names = Counter()
    for i in range(runs.size()):
        nodes = status.planGraph(runs.apply(i).executionId()).allNodes()
        names.update(nodes.apply(k).name() for k in range(nodes.size()))
    assert (names["Exchange"], names["BroadcastExchange"]) == (4, 2)


def test_a_content_ends_in_bits_of_its_salt(spark):
    rows, _ = contents(make(spark, 60, 4))
    assert rows.select("content").distinct().count() == rows.select("salt", "text_id").distinct().count()
    assert rows.filter((F.col("content").bitwiseAND(4095)) != F.col("salt").bitwiseAND(4095)).isEmpty()
