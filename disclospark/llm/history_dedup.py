"""Each new batch against everything accepted before.

Content of a trade: who, which asset, which day, which amounts. The salt hashes what must agree exactly (person, day, both ends of the amount, and every
word of the asset that holds a digit); the other words of the asset, of any length, are run together and winnowed. Fingerprints of a content are its
winnowed grams, each salted, and the hash of the whole content. The window grows with the text such that two typos always leave one gram that both
spellings chose, so the prescreen loses nothing the verification would take.

A batch goes through three steps, its own rows and history alike: (1) partitioned Bloom filters, one part of the fingerprints each, prescreen the batch's
fingerprints and take them in, which are stored by part on the way; a fingerprint that two contents of the batch share is a positive too; (2) positives are looked up
among themselves and in the persistent store, of which only the parts with positives are read; (3) the pairs that met are verified, an equal content at once, others if they share
all grams that two typos can spare and agree word by word, and the decided contents are added to the store. Pairs never leave a salt, and a content ends in bits of its salt: up to
`BROADCAST_ROWS` pairs find the stored texts by a broadcast, so the store is not shuffled, and are verified and settled beside the batch's contents, bucket by bucket. A step is one plan with
few exchanges: the driver keeps a thread for each for a while. History is never fingerprinted again. Asset names are normalised
and winnowed once for each distinct text, and equal contents of a batch are one row before any fingerprint is made, so hot trades cost no more than others.

What a content repeats (its root) is the earliest root of all earlier contents that agree with it; it is settled when the content first arrives and holds for
every later equal content. Recognised spellings stay in the store too, so it doesn't matter how rows are cut into batches.

Cases: rows whose person or asset is blank or that have no real day are neither cases nor originals; an open upper end equals only an open one;
repeated rows have the first as original; an asset without words is compared by its salt alone; very long asset names are winnowed
whole; rows of one place in the order are settled by their name; an empty batch changes nothing; further columns don't matter.
"""

from __future__ import annotations

import json
import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import wide_trim
from ..session import materialize, path_exists, shared_dir, write_text
from .names import edits

BLOOM_HASHES = 6
ROOT = "struct<batch:int,seq:long,content:long>"
#: Tables of distinct texts and the positives of a batch are broadcast up to this many rows (each under 300 bytes); more are joined by a shuffle.
BROADCAST_ROWS = 100_000
#: The last bits of a content are those of its salt.
SALT_BITS = 12

# Spellings of legal forms and of contract words that mean the same.
SAME_WORDS = {
    "corporation": "corp", "incorporated": "inc", "company": "co", "limited": "ltd", "expires": "exp", "expiring": "exp", "expiry": "exp",
    "expiration": "exp", "maturing": "due", "matures": "due", "maturity": "due",
}
# Short words that name kinds of contracts and forms; one of them is never a mistyped other one.
MARKS = frozenset("call put note bond bill etf etn adr ads gdr inc corp co ltd plc llc lp llp".split())
_NUMERAL = re.compile(r"[ivxlc]+")


def with_asset_text(df: DataFrame, asset: str, out: str) -> DataFrame:
    """Adds one spelling of an asset: blanks, case, punctuation, ticker in brackets, forms of dates, rates, prices and legal forms don't matter.

    Every pattern runs only where a plain look finds what it changes; each step is a column of its own, so none is evaluated twice.
    """
    x = F.col(out)
    has = lambda s: x.contains(s)
    steps = [
        (x.endswith("]") | x.endswith(")"), r" *[\[(][^\])]*[\])]\z", ""),
        (has("/"), r"\b0?(\d{1,2})/0?(\d{1,2})/(\d{4})\b", "$3-$1-$2"),
        (has("-0"), r"\b(\d{4})-0?(\d{1,2})-0?(\d{1,2})\b", "$1-$2-$3"),
        (has(","), r"(?<=\d),(?=\d{3}\b)", ""),
        (has("%"), r"(\d+(?:\.\d*?[1-9])?)\.?0* ?%", "$1%"),
        (has("$"), r"\$ ?(\d+(?:\.\d*?[1-9])?)\.?0*(?= |\z)", r"\$$1"),
        (None, r"[^\p{L}\p{N}$%.&-]+|(?<![^ ])-+(?![^ ])", " "),
        (has("."), r"\.(?!\d)", " "),
        (None, r" {2,}", " "),
    ]
    df = df.withColumn(out, F.lower(wide_trim(F.regexp_replace(asset, r"[^\S ]+|[\x{A0}\x{2000}-\x{200B}\x{202F}\x{3000}\x{FEFF}]+", " "))))
    for guard, pattern, to in steps:
        new = F.regexp_replace(x, pattern, to)
        df = df.withColumn(out, new if guard is None else F.when(guard, new).otherwise(x))
    padded = F.concat(F.lit(" "), F.trim(x), F.lit(" "))
    for word, same in (SAME_WORDS | {"call option": "call", "put option": "put", "call options": "call", "put options": "put"}).items():
        padded = F.replace(padded, F.lit(f" {word} "), F.lit(f" {same} "))
    df = df.withColumn(out, F.trim(padded))
    df = df.withColumn(out, F.when(x.endswith(" note") | x.endswith(" notes"), F.regexp_replace(x, r"(due [\d-]+) notes?\z", "$1")).otherwise(x))
    # the plain share of an issuer is often left unsaid; a class is not
    plain = F.regexp_replace(x, r" ?\b(?:common|com|ordinary) (?:stock|stk|shares?|shs)\z", "")
    return df.withColumn(out, F.when(has("com") | has("ordinary"), F.trim(plain)).otherwise(x))


def amount_ends(amount: str) -> tuple[Column, Column]:
    """(low, high) of an amount as written: its first and last whole number; no high end if it says over."""
    numbers = F.regexp_extract_all(F.replace(F.col(amount), F.lit(","), F.lit("")), F.lit(r"(\d+)(?:\.\d+)?"), 1)
    end = lambda i: F.try_element_at(numbers, F.lit(i)).try_cast("bigint")
    return end(1), F.when(~F.lower(amount).contains("over"), end(-1))


# texts and their grams


def gram_hash(gram: str) -> int:
    h = xxhash.xxh3_64_intdigest(gram)
    return h - (1 << 64) if h >> 63 else h


def winnow(hashes: list[int], window: int) -> set[int]:
    """Of every `window` neighbouring hashes the smallest. A wider window chooses among what a narrower one does, so both meet in a shared run."""
    if window <= 1 or len(hashes) <= window:
        return set(hashes) if window <= 1 else {min(hashes)}
    return {min(hashes[i : i + window]) for i in range(len(hashes) - window + 1)}


def text_grams(text: str) -> list[int]:
    """Winnowed grams of the words of a text, run together.

    An edit spoils at most four of the `n` three-letter grams, so two leave a clean run of (n - 8) / 3 in the longer text: that is the window. Texts up to
    twelve letters have all their two-letter grams as well, of which an edit spoils three at most; texts about as long as that have both
    kinds and so meet shorter and longer ones.
    """
    run = text.replace(" ", "")
    if not run:
        return []
    padded = f"^{run}$"
    out: set[int] = set()
    if len(run) <= 12:
        out |= {gram_hash(padded[i : i + 2]) for i in range(len(padded) - 1)}
    if len(run) >= 9:
        out |= winnow([gram_hash(padded[i : i + 3]) for i in range(len(run))], (len(run) - 8) // 3)
    return sorted(out)


@F.pandas_udf(T.ArrayType(T.LongType()))
def winnowed(text: pd.Series) -> pd.Series:
    return text.map(text_grams)


def coverage_holds(a: str, b: str) -> bool:
    """True if the texts share all three-letter grams that two typos can spare (none, up to eight letters)."""
    x, y = (Counter(p[i : i + 3] for i in range(len(p) - 2)) for p in (f"^{a}$", f"^{b}$"))
    return sum((x & y).values()) >= max(len(a), len(b)) - 8


def _word_gap(p: str, q: str) -> int | None:
    """Typos between two words: one, or two if both have seven letters; none in words of one or two letters, numerals and marks."""
    if p == q:
        return 0
    short, long = sorted((len(p), len(q)))
    if long < 3 or (p in MARKS and q in MARKS) or (_NUMERAL.fullmatch(p) and _NUMERAL.fullmatch(q)):
        return None
    most = 2 if short >= 7 else 1
    d = edits(p, q, most)
    return d if d <= most else None


def same_text(a: str, b: str) -> bool:
    """Coverage, then word by word: at most two typos in all, one in texts under eight letters. A blank more or less doesn't matter."""
    p, q = a.replace(" ", ""), b.replace(" ", "")
    if p == q:
        return True
    if abs(len(p) - len(q)) > 2 or not coverage_holds(p, q):
        return False
    x, y = a.split(" "), b.split(" ")
    if len(x) != len(y):
        return False
    total, most = 0, 2 if min(len(p), len(q)) >= 8 else 1
    for s, t in zip(x, y, strict=True):
        d = _word_gap(s, t)
        if d is None or (total := total + d) > most:
            return False
    return True


@F.pandas_udf(T.BooleanType())
def agree(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([same_text(x, y) for x, y in zip(a, b, strict=True)], dtype="bool")


def asset_texts(names: DataFrame) -> DataFrame:
    """(asset_name, exact, text_id, text, grams) of each distinct name: `exact` are its words with a digit, `text` its other words."""
    with_digit = r"(?<![^ ])[^ ]*\d[^ ]*(?![^ ])"
    split = (
        with_asset_text(names.select("asset_name").distinct(), "asset_name", "#asset")
        .withColumn("exact", F.array_join(F.regexp_extract_all("#asset", F.lit(with_digit), F.lit(0)), " "))
        .withColumn("text", F.trim(F.regexp_replace(F.regexp_replace("#asset", with_digit, " "), " {2,}", " ")))
    )
    return materialize(split.withColumn("grams", winnowed("text")).select("asset_name", "exact", F.xxhash64("text").alias("text_id"), "text", "grams"))


def if_small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """The frame, to be broadcast if it has few rows; its size is counted."""
    return F.broadcast(df) if df.count() <= most else df


def _salt_bits(column: str) -> Column:
    return F.col(column).bitwiseAND((1 << SALT_BITS) - 1)


def with_content(df: DataFrame, texts: DataFrame, person: str, day: str, low: str, high: str) -> DataFrame:
    """Joins `texts` by asset_name and adds salt, text_id and content (long), the last bits of which tell the salt's bucket."""
    named = df.join(if_small(texts.select("asset_name", "exact", "text_id")), "asset_name")
    return (
        named.withColumn("salt", F.xxhash64(F.col(person), F.col(day), F.col(low), F.coalesce(F.col(high), F.lit(-1)), "exact"))
        .withColumn("content", F.shiftleft(F.xxhash64("salt", "text_id"), SALT_BITS).bitwiseOR(_salt_bits("salt")))
        .drop("exact")
    )


def prepare(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Contents of all batches with their texts and fingerprints, written by batch: batch, content, text, seq, rows, fps.

    `rows`: batch, salt, text_id, content (of with_content()), seq (long, order in the batch). Equal contents of a batch are aggregated on numbers alone, map-side
    first, before anything is fingerprinted. `rows` counts them.
    """
    contents = rows.groupBy("batch", "salt", "text_id", "content").agg(F.min("seq").alias("seq"), F.count(F.lit(1)).alias("rows"))
    grams = texts.select("text_id", "text", "grams").dropDuplicates(["text_id"])
    salted = F.transform(F.col("grams"), lambda g: F.xxhash64("salt", g))
    joined = contents.join(if_small(grams), "text_id").withColumn("fps", F.array_append(salted, F.col("content")))
    return materialize(joined.select("batch", "content", "text", "seq", "rows", "fps"), ("batch",))


# filters


def _bits(fp: np.ndarray, m: int) -> np.ndarray:
    x = fp.astype(np.uint64)
    a = (x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
    b = ((x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)) | np.uint64(1)
    i = np.arange(BLOOM_HASHES, dtype=np.uint64)
    return (((a[:, None] + i * (b >> np.uint64(18))[:, None]) & np.uint64(0xFFFFFFFFFFFF)) % np.uint64(m)).astype(np.int64)


def _roll(m: int, whole: bool = False):  # noqa: ANN202
    """One filter with a batch's fingerprints: which of them it may hold or two contents share (`hit`); then it takes all in. The others come out too if `whole`."""

    def run(key: tuple, known: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        filters = known["bits"]
        bits = np.unpackbits(np.frombuffer(filters.iloc[0], np.uint8), count=m).astype(bool) if len(filters) else np.zeros(m, bool)
        fps, content = new["fp"].to_numpy(np.int64), new["content"].to_numpy(np.int64)
        _, where, times = np.unique(fps, return_inverse=True, return_counts=True)
        hit = times[where] > 1
        for i in range(0, len(fps), 1 << 16):  # a slice at a time: memory stays that of the filter
            hit[i : i + (1 << 16)] |= bits[_bits(fps[i : i + (1 << 16)], m)].all(axis=1)
        for i in range(0, len(fps), 1 << 16):
            bits[_bits(fps[i : i + (1 << 16)], m).ravel()] = True
        out = np.ones(len(fps), bool) if whole else hit
        none = np.arange(1 + out.sum()) < 1
        longs = lambda x: pd.arrays.IntegerArray(np.append(np.int64(0), x[out]), none)  # noqa: E731 floats would lose digits
        packed = [np.packbits(bits).tobytes(), *[None] * int(out.sum())]
        return pd.DataFrame({"part": np.int32(key[0]), "bits": packed, "fp": longs(fps), "content": longs(content), "hit": np.append(False, hit[out])})

    return run


def _rolled(m: int):  # noqa: ANN202
    """The same for filter and fingerprints in one frame, the row with bits being the filter: one exchange deals out both."""
    roll = _roll(m, whole=True)

    def run(key: tuple, dealt: pd.DataFrame) -> pd.DataFrame:
        is_filter = dealt["bits"].notna().to_numpy()
        return roll(key, dealt[is_filter], dealt[~is_filter])

    return run


class HistoryStore:
    """Contents with what they repeat, and by part their fingerprints with the Bloom filters over these, in a shared folder.

    There are `parts` filters of `bits` bits; a fingerprint's part is its hash. That is a capacity, not a limit: beyond about bits / 10
    fingerprints a filter lets more through, which costs look-ups, never rows. A step counts once its line in the log stands; opening the folder again,
    by another process too, goes on behind the last one.
    """

    DECIDED = "batch int, content long, text string, seq long, rows long, root struct<batch:int,seq:long,content:long>, fresh boolean"
    ROLLED = "part int, bits binary, fp long, content long, hit boolean"

    def __init__(self, spark: SparkSession, path: str | None = None, parts: int = 16, bits: int = 1 << 22) -> None:
        self.spark, self.path, self.parts, self.bits = spark, path or shared_dir(spark), parts, bits
        self.steps: list[int] = []
        if path_exists(spark, f"{self.path}/log"):
            log = spark.read.schema("step int, parts int, bits int").json(f"{self.path}/log").orderBy("step").collect()  # a line a batch
            self.steps = [r["step"] for r in log]
            self.parts, self.bits = log[-1]["parts"], log[-1]["bits"]

    def _at(self, what: str, step: int) -> str:
        return f"{self.path}/{what}/step={step}"

    def _next(self) -> int:
        return self.steps[-1] + 1 if self.steps else 0

    def _log(self, step: int) -> None:
        write_text(self.spark, f"{self.path}/log/{step}.json", json.dumps({"step": step, "parts": self.parts, "bits": self.bits}))
        self.steps.append(step)

    def decided(self) -> DataFrame:
        """All batches' contents: batch, content, seq, rows and root, the (batch, seq, content) they repeat; their own if they are new."""
        return self.spark.read.schema(self.DECIDED).parquet(*[self._at("contents", s) for s in self.steps])

    def _screens(self, steps: list[int]) -> DataFrame:
        """For each part the filter, in a row without fingerprint, and the fingerprints of each step. Files hold part after part, so row groups of other parts are skipped."""
        return self.spark.read.schema(self.ROLLED).parquet(*[self._at("screens", s) for s in steps])

    def _exploded(self, contents: DataFrame) -> DataFrame:
        return contents.select("content", F.explode("fps").alias("fp")).withColumn("part", F.pmod(F.xxhash64("fp"), F.lit(self.parts)).cast("int"))

    def _screen(self, contents: DataFrame, step: int) -> tuple[DataFrame, list[int], int]:
        """Positives (part, fp, content) of a batch, the parts that have some, and their number. The filters take the batch in on the way."""
        dealt = self._exploded(contents).select("part", F.lit(None).cast("binary").alias("bits"), "fp", "content")
        if self.steps:  # a filter's numbers are zeros: with a null among them pandas would make floats of all
            none = F.lit(0).cast("long")
            dealt = dealt.unionByName(self._screens(self.steps[-1:]).filter("bits is not null").select("part", "bits", none.alias("fp"), none.alias("content")))
        seen = Observation()
        rolled = dealt.groupBy("part").applyInPandas(_rolled(self.bits), self.ROLLED)
        counts = F.count_if("hit").alias("n"), F.collect_set(F.when(F.col("hit"), F.col("part"))).alias("parts")
        rolled.observe(seen, *counts).write.mode("overwrite").parquet(self._at("screens", step))
        return self._screens([step]).filter("hit").select("part", "fp", "content"), list(seen.get["parts"] or []), int(seen.get["n"] or 0)

    def _append(self, decided: DataFrame, step: int) -> DataFrame:
        """Writes a batch's contents."""
        at = self._at("contents", step)
        decided.write.mode("overwrite").parquet(at)
        self._log(step)
        return self.spark.read.schema(self.DECIDED).parquet(at)

    @staticmethod
    def _own_root() -> Column:
        return F.struct(F.col("batch").cast("int").alias("batch"), "seq", "content").alias("root")

    def seed(self, contents: DataFrame) -> None:
        """Fill the empty store with contents that are accepted as they stand."""
        step = self._next()
        self._screen(contents, step)
        self._append(contents.select(F.col("batch").cast("int").alias("batch"), "content", "text", "seq", "rows", self._own_root(), F.lit(True).alias("fresh")), step)

    def check(self, contents: DataFrame) -> DataFrame:
        """The batch's contents, decided."""
        step = self._next()
        positives, parts, n = self._screen(contents, step)
        base = contents.select(F.col("batch").cast("int").alias("batch"), "content", "text", "seq", "rows", self._own_root())
        if not n:
            return self._append(base.withColumn("fresh", F.lit(True)), step)
        hits = F.broadcast(positives) if n <= BROADCAST_ROWS else positives
        # what a positive may meet: positives of the batch itself, and the store
        stored = positives.withColumn("inside", F.lit(True))
        if self.steps:
            prints = self._screens(self.steps).filter("fp is not null")
            prints = prints if len(parts) == self.parts else prints.filter(F.col("part").isin(parts))
            stored = stored.unionByName(prints.select("part", "fp", "content", F.lit(False).alias("inside")))
        met = stored.withColumnRenamed("content", "other").join(hits, ["part", "fp"]).select("content", "other", "inside").distinct()
        met = met.filter(~F.col("inside") | (F.col("content") != F.col("other")) & (_salt_bits("content") == _salt_bits("other")))
        pairs = Observation()
        met = materialize(met.observe(pairs, F.count(F.lit(1)).alias("n")))
        few = int(pairs.get["n"] or 0) <= BROADCAST_ROWS
        return self._append((self._decide_few if few else self._decide_many)(base, met), step)

    def _then(self) -> DataFrame:
        """Contents a batch may repeat: other, other_text, root."""
        return self.decided().filter("fresh").select(F.col("content").alias("other"), F.col("text").alias("other_text"), "root")

    def _decide_few(self, base: DataFrame, met: DataFrame) -> DataFrame:
        """The batch's contents, decided in one plan: pairs meet the batch's contents by bucket of their salt."""
        links = met.filter("inside").select("content", "other", "inside", F.lit(None).cast("string").alias("other_text"), F.lit(None).cast(ROOT).alias("root"))
        if self.steps:
            links = links.unionByName(self._then().join(F.broadcast(met.filter("not inside")), "other"))
        links = links.select("content", "other", "inside", "other_text", *[F.col(f"root.{c}").alias(f"root_{c}") for c in ("batch", "seq", "content")])
        bucket = F.pmod(_salt_bits("content"), F.lit(self.parts))
        groups = [df.withColumn("bucket", bucket).groupBy("bucket") for df in (links, base.select("batch", "content", "text", "seq", "rows"))]
        return groups[0].cogroup(groups[1]).applyInArrow(_decide, self.DECIDED)

    def _decide_many(self, base: DataFrame, met: DataFrame) -> DataFrame:
        """The same by joins."""
        others = base.select(F.col("content").alias("other"), F.col("text").alias("other_text"), "root", F.lit(True).alias("inside"))
        if self.steps:
            others = others.unionByName(self._then().withColumn("inside", F.lit(False)))
        earlier = (F.col("root.seq") < F.col("seq")) | (F.col("root.seq") == F.col("seq")) & (F.col("other") < F.col("content"))
        tried = met.join(others, ["other", "inside"]).join(base.select("batch", "content", "text", "seq"), "content").filter(~F.col("inside") | earlier)
        found = Observation()
        alike = tried.filter((F.col("content") == F.col("other")) | agree("text", "other_text")).select("batch", "content", "seq", "other", "root", "inside")
        alike = materialize(alike.observe(found, F.count(F.lit(1)).alias("n")))
        few = int(found.get["n"] or 0) <= BROADCAST_ROWS
        roots = (_settle_few if few else _settle_many)(alike)
        return base.join(F.broadcast(roots) if few else roots, "content", "left").select(
            "batch", "content", "text", "seq", "rows", F.coalesce("r", "root").alias("root"), F.coalesce("is_new", F.lit(True)).alias("fresh")
        )


def _carry(alike: pd.DataFrame) -> pd.DataFrame:
    """Roots of the linked contents of a batch, carried along the links inside it until none moves."""
    place = lambda r: (int(r["batch"]), int(r["seq"]), int(r["content"]))
    at, known = {}, {}
    for batch, content, seq, other, root, inside in zip(*(alike[c] for c in ("batch", "content", "seq", "other", "root", "inside")), strict=True):
        own = at.setdefault(content, (batch, seq, content))
        if inside:
            at.setdefault(other, place(root))
        elif content == other:  # an equal content of the store settles it
            known[content] = place(root)
        else:
            at[content] = min(own, place(root))
    at |= known
    links = [(c, o) for c, o, inside in zip(alike["content"], alike["other"], alike["inside"], strict=True) if inside and c not in known]
    moved = True
    while moved:
        moved = False
        for c, o in links:
            if at[o] < at[c]:
                at[c], moved = at[o], True
    frame = pd.DataFrame([(c, *r, c not in known) for c, r in at.items()], columns=["content", "b", "s", "c", "is_new"])
    return frame.astype({"content": "int64", "b": "int32", "s": "int64", "c": "int64", "is_new": "bool"})


def _decide(links: pa.Table, own: pa.Table) -> pa.Table:
    """Contents of a bucket with root and whether they are new; `links` are the pairs that met, those of the store with text and root."""
    batch, content, seq = (own[c].to_numpy() for c in ("batch", "content", "seq"))
    root, fresh = [batch.copy(), seq.copy(), content.copy()], np.ones(len(own), bool)
    order = np.argsort(content)
    at = lambda x: order[np.searchsorted(content, x, sorter=order)]
    inside = links["inside"].to_numpy()
    mine, theirs = links["content"].to_numpy(), links["other"].to_numpy()
    i, j = at(mine), np.zeros(len(mine), np.int64)
    j[inside] = at(theirs[inside])
    # a pair inside the batch goes from the later to the earlier
    earlier = (seq[j] < seq[i]) | (seq[j] == seq[i]) & (theirs < mine)
    tried = np.flatnonzero(~inside | earlier)
    texts = [own["text"].take(pa.array(x[tried])).to_pylist() for x in (i, j)]
    stored = links.select(["other_text", "root_batch", "root_seq", "root_content"]).take(pa.array(tried)).to_pylist()
    alike = []
    for k, text, near, far in zip(tried, *texts, stored, strict=True):
        if mine[k] == theirs[k] or same_text(text, near if inside[k] else far["other_text"]):
            place = (batch[j[k]], seq[j[k]], theirs[k]) if inside[k] else (far["root_batch"], far["root_seq"], far["root_content"])
            alike.append((batch[i[k]], mine[k], seq[i[k]], theirs[k], dict(zip(("batch", "seq", "content"), place, strict=True)), inside[k]))
    if alike:
        carried = _carry(pd.DataFrame(alike, columns=["batch", "content", "seq", "other", "root", "inside"]))
        where = at(carried["content"].to_numpy())
        for column, name in zip(root, ("b", "s", "c"), strict=True):
            column[where] = carried[name].to_numpy()
        fresh[where] = carried["is_new"].to_numpy()
    roots = pa.StructArray.from_arrays([pa.array(x) for x in root], ["batch", "seq", "content"])
    return own.select(["batch", "content", "text", "seq", "rows"]).append_column("root", roots).append_column("fresh", pa.array(fresh))


def _settle_few(alike: DataFrame) -> DataFrame:
    """(content, r, is_new) of linked contents, in one task: for as many links as may be broadcast."""
    carried = alike.withColumn("all", F.lit(1)).groupBy("all").applyInPandas(_carry, "content long, b int, s long, c long, is_new boolean")
    return carried.select("content", F.struct(F.col("b").alias("batch"), F.col("s").alias("seq"), F.col("c").alias("content")).alias("r"), "is_new")


def _settle_many(alike: DataFrame) -> DataFrame:
    """The same by joins, pass after pass."""
    own = lambda c, s: F.struct("batch", F.col(s).alias("seq"), F.col(c).alias("content"))
    inside = alike.filter("inside")
    places = alike.select("content", own("content", "seq").alias("r"), F.lit(None).cast(ROOT).alias("same"))
    places = places.unionByName(inside.select(F.col("other").alias("content"), F.col("root").alias("r"), F.lit(None).cast(ROOT).alias("same")))
    stored = alike.filter("not inside").select("content", F.col("root").alias("r"), F.when(F.col("content") == F.col("other"), F.col("root")).alias("same"))
    start = places.unionByName(stored).groupBy("content").agg(F.min("r").alias("r"), F.min("same").alias("same"))
    carried = materialize(start.select("content", F.coalesce("same", "r").alias("r"), F.col("same").isNull().alias("is_new"), F.lit(True).alias("moved")))
    edges = materialize(inside.select("content", "other").join(carried.filter("is_new").select("content"), "content", "left_semi"))
    while not carried.filter("moved").isEmpty():
        theirs = edges.join(carried.select(F.col("content").alias("other"), F.col("r").alias("theirs")), "other").groupBy("content").agg(F.min("theirs").alias("theirs"))
        carried = materialize(carried.drop("moved").join(theirs, "content", "left").select("content", F.least("r", "theirs").alias("r"), "is_new", F.coalesce(F.col("theirs") < F.col("r"), F.lit(False)).alias("moved")))
    return carried.drop("moved")


def repeated_rows(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """(row_id, original) of incoming rows that repeat something. `rows`: row_id (null for accepted ones), batch, content, seq, original (the row's own name)."""
    # contents that are new and have one row repeat nothing
    own = (F.col("root.batch") == F.col("batch")) & (F.col("root.content") == F.col("content"))
    cases = decided.filter(~own | (F.col("rows") > 1)).select("batch", "content", "root")
    places = cases.select("root").distinct().select("root", F.col("root.batch").alias("batch"), F.col("root.seq").alias("seq"), F.col("root.content").alias("content"))
    named = rows.join(places, ["batch", "seq", "content"]).groupBy("root").agg(F.min("original").alias("first"))
    known = rows.filter("row_id is not null").select("row_id", "batch", "content", F.col("original").alias("own")).join(cases, ["batch", "content"]).join(named, "root")
    return known.filter(F.col("own") != F.col("first")).select("row_id", F.col("first").alias("original"))
