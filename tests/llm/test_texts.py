"""Tokenizer, mixing and look-alikes."""

import os
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from disclospark.llm import lookalikes as L
from disclospark.llm import mixing as M
from disclospark.llm import tokenizer as T

ODD = ["", " ", "a" * 5000, "\n\n \t x  ", "<|endoftext|>", "don't  stop\r\n", "é日本🙂", "1234 5,6", "a   \n", "x​y", "ÀÈ" * 300, "ab\n \n c"]


# tokenizer


@pytest.fixture(scope="module")
def peer():
    tiktoken = pytest.importorskip("tiktoken")
    public = pytest.importorskip("public_tokenizers")
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=T.read_ranks(), special_tokens={})


def test_ids_equal_a_peer(spark, peer):
    rng = random.Random(2)
    texts = ODD + ["".join(rng.choice("abcde fg\n.é日1 ") for _ in range(rng.randint(1, 400))) for _ in range(200)]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(-1, None, "x")], "doc_id long, text string, ids string").repartition(3)
    got = {r["doc_id"]: r["ids"] for r in T.encode_texts(df, "text", ["doc_id"]).collect()}
    assert got.pop(-1) == []
    assert got == {i: peer.encode_ordinary(t) for i, t in enumerate(texts)}
    counts = {r["doc_id"]: r["n_tokens"] for r in T.count_tokens(df, "text", ["doc_id"]).collect()}
    assert counts == {i: len(x) for i, x in got.items()} | {-1: 0}


def test_both_merges_agree():
    ranks, rng = T.read_ranks(), random.Random(4)
    for n in (1, 2, 3, 63, 64, 65, 700):
        w = bytes(rng.choice(b"abc eth\n\xc3\xa9") for _ in range(n))
        assert T.encode_long(w, ranks) == T.encode_short(w, ranks)


def test_round_trip():
    ranks = T.read_ranks()
    back = {v: k for k, v in ranks.items()}
    encode = T.encoder(ranks)
    for t in ODD:
        assert b"".join(back[i] for i in encode(t)).decode() == t


def test_no_texts(spark):
    assert T.encode_texts(spark.createDataFrame([], "doc_id long, text string"), "text", ["doc_id"]).collect() == []


# mixing


def counted(spark, n=3000):
    rng = random.Random(7)
    rows = [(i, rng.choice(["big"] * 6 + ["mid"] * 3 + ["small", "unlisted"]), rng.choice([0, 5, 50, 500])) for i in range(n)]
    rows += [(n, None, 9), (n + 1, "big", None)]
    return spark.createDataFrame(rows, "doc_id long, source string, n_tokens long")


def targets(spark, *rows):
    return spark.createDataFrame(list(rows), "source string, target_share double, max_repeats int")


def test_shares_and_caps(spark):
    c = counted(spark)
    t = targets(spark, ("big", 0.5, 1), ("mid", 0.25, 2), ("small", 0.2, 4), ("absent", 0.05, 9), (None, 0.5, 1))
    mixed, report = M.mix(c, t, rows_per_bucket=100)
    rows = mixed.collect()
    size = {r["doc_id"]: (r["source"], r["n_tokens"]) for r in c.collect()}
    assert len({r["doc_id"] for r in rows}) == len(rows)
    assert all(size[r["doc_id"]] == (r["source"], r["n_tokens"]) for r in rows)
    rep = {r["source"]: r for r in report.collect()}
    assert set(rep) == {"big", "mid", "small", "absent"}
    for s, cap in (("big", 1), ("mid", 2), ("small", 4)):
        own = [r for r in rows if r["source"] == s]
        used = sum(r["copies"] * r["n_tokens"] for r in own)
        assert used == rep[s]["tokens"] <= rep[s]["budget"]
        assert rep[s]["budget"] - used < 500 + 1
        assert max(r["copies"] for r in own) <= cap
        assert max(r["copies"] for r in own) - min(r["copies"] for r in own) <= 1
        assert abs(rep[s]["actual_share"] - {"big": 0.5, "mid": 0.25, "small": 0.2}[s] / 0.95) < 0.02
    assert rep["absent"]["tokens"] == 0
    again = {tuple(r) for r in M.mix(c.repartition(5), t, rows_per_bucket=100)[0].collect()}
    assert again == {tuple(r) for r in rows}


def test_cut_is_that_of_a_plain_prefix_sum(spark):
    c = counted(spark, 800)
    t = targets(spark, ("big", 1.0, 1))
    mixed, report = M.mix(c, t, total=10_000, rows_per_bucket=50)
    keyed = c.filter("source = 'big' and n_tokens > 0").withColumn("r", F.xxhash64(F.lit(17), F.col("doc_id").cast("string"))).collect()
    want, total = set(), 0
    for r in sorted(keyed, key=lambda r: (r["r"] % (1 << 64), r["doc_id"])):
        total += r["n_tokens"]
        if total > 10_000:
            break
        want.add(r["doc_id"])
    assert {r["doc_id"] for r in mixed.collect()} == want
    assert report.first()["budget"] == 10_000


def test_total_beyond_a_cap(spark):
    c = counted(spark, 500)
    report = {r["source"]: r for r in M.mix(c, targets(spark, ("small", 0.9, 2), ("big", 0.1, 1)), total=10**9)[1].collect()}
    assert report["small"]["tokens"] == 2 * report["small"]["available"]


def test_nothing_to_mix(spark):
    mixed, report = M.mix(counted(spark).limit(0), targets(spark, ("a", 1.0, 1)))
    assert mixed.collect() == []
    assert report.first()["tokens"] == 0
    assert M.mix(counted(spark, 20), targets(spark).limit(0))[0].collect() == []


# look-alikes

SAME = [("ＡＢ　Ｃ", "AB C"), ("РЕRІОD", "PERIOD"), ("é", "é"), ("е́", "é"), ("naїve", "naïve"), ("ﬁn Ⅲ", "fin III"), ("a​b\xad﻿", "ab"), ("x‐y‑z", "x-y-z"), ("a\xa0b c", "a b c"), ("Ａ́", "Á"), ("e​́", "é"), ("q̣̇", "q̣̇"), ("ɡo", "go")]
DIFFERENT = [("a", "A"), ("e", "é"), ("1", "2"), ("-", "–"), ("–", "—"), ("a\nb", "a\r\nb"), ("a\tb", "a b"), ("a b", "a  b"), ("²", "2"), ("½", "1/2"), (".", ";")]


@pytest.fixture(scope="module")
def form():
    return L.canonicaliser(*L.tables())


def test_forms(form):
    for a, b in SAME:
        assert form(a) == form(b) == b if unicodedata.is_normalized("NFC", b) else form(a) == form(b)
    for a, b in DIFFERENT:
        assert form(a) != form(b)
    assert form(None) is None
    assert form("") == form("​") == ""


def test_form_of_a_form_and_of_pieces(form):
    rng = random.Random(3)
    alphabet = "ab é́̈е​Ａﬁ가가ї-‐\xa0\n日Ⅱ"
    for _ in range(3000):
        s = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12)))
        f = form(s)
        assert form(f) == f
        assert form(s + "x " + s) == form(form(s) + "x " + form(s))
    assert form("é" * 200_000) == "é" * 200_000


KEPT = ["хорошо", "сосна и рама", "Ελληνικά το νερό", "Привет, мир: а он", "日本語 ｶ".replace("ｶ", "カ"), "ünïcödé", "он и она о том"]
CLEANED = [("РЕRІОD", "PERIOD"), ("хорoшо", "хорошо"), ("naїve", "naïve"), ("РЕР", "PEP"), ("Ｐrice оf ɡold", "Price of gold"), ("νiew", "view"), ("Мocква и рамa", "Мосkва и рама".replace("k", "к")), ("a\u200bb x\u2010y", "ab x-y")]


def test_texts_of_other_scripts_keep_their_letters():
    clean = L.cleaner(*L.tables())
    for t in KEPT:
        assert clean(t) == t, t
    for t, want in CLEANED:
        assert clean(t) == want, (t, clean(t))
        assert clean(want) == want
    assert clean(None) is None and clean("") == ""
    form = L.canonicaliser(*L.tables())
    rng = random.Random(5)
    for _ in range(2000):
        s = "".join(rng.choice("ab xоеѕ дш λό é\u0301Ａﬁ\u200b-‐") for _ in range(rng.randint(0, 14)))
        assert form(clean(s)) == form(s)
        assert clean(clean(s)) == clean(s), s


def test_classes(spark):
    rows = [(1, "РЕR one"), (2, "PER one"), (3, "PER one"), (4, "alone"), (5, "alone"), (6, None), (9, "ＰER one")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r["doc_id"], r["representative"]) for r in L.form_classes(df).collect()} == {(1, 1), (2, 1), (3, 1), (9, 1)}
    many = spark.range(400).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "РЕR").otherwise("PER").alias("text"))
    assert L.same_looking(many).count() == 200 * 200


def test_offsets_beyond_the_broadcast(spark, monkeypatch):
    t = targets(spark, ("big", 0.5, 1), ("mid", 0.5, 2))
    want = {tuple(r) for r in M.mix(counted(spark), t, rows_per_bucket=100)[0].collect()}
    monkeypatch.setattr(M, "BROADCAST_BUCKETS", 0)
    assert {tuple(r) for r in M.mix(counted(spark), t, rows_per_bucket=100)[0].collect()} == want


def test_pairs(spark):
    rows = [(1, "РЕR one"), (2, "PER one"), (3, "PER one"), (4, "per one"), (5, None), (6, ""), (7, " "), (8, "\xa0"), (9, "ＰER one"), (10, "alone é"), (11, "alone é"), (12, "twin"), (13, "twin")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, form string")
    got = {tuple(r) for r in L.same_looking(df).collect()}
    assert got == {(1, 2), (1, 3), (1, 9), (2, 9), (3, 9), (10, 11)}
    assert L.same_looking(df.limit(0)).collect() == []


def test_whole_tables(spark):
    """Every registered text query runs on the smallest tables with the columns it promises."""
    from disclospark.llm.queries import QUERIES

    sf = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    promised = {"p1_found": ["row_id", "original"], "p4_found": ["row_id", "field_name", "code"], "p7_found": ["source_table", "row_id", "filer_id"], "p8_ids": ["doc_id", "ids"], "p10_found": ["doc_a", "doc_b"]}
    for name, columns in promised.items():
        df = QUERIES[name](spark, sf)
        assert df.columns == columns
        assert df.count() > 0, name


@pytest.mark.parametrize("composed", ["한글 ab", "가나", "ো", "ொ", "ො", "ᬆ", "é"])
def test_decomposed_text_without_another_unstable_character(composed):
    form = L.canonicaliser(*L.tables())
    assert form(unicodedata.normalize("NFD", composed)) == form(composed) == composed
