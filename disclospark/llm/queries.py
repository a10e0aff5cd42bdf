"""Queries of the text operators (problems 1, 4, 7, 8, 9, 10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.normalize import calendar_date
from ..functions.text import is_blank
from ..operators.timestamps import local_day, normalize_times
from ..session import drop_finished, materialize, read_table, short_plans
from .canonical import map_fields
from .history_dedup import HistoryStore, amount_ends, asset_texts, if_small, prepare, repeated_rows, with_content
from .lookalikes import canonical_texts, form_classes, same_looking
from .mixing import mix
from .names import attribute, if_few, member_spelling
from .tokenizer import count_tokens, encode_texts


#: The batch number that stands for what was accepted before the first batch.
ACCEPTED = -1


def trades(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Accepted and incoming trades (batch, row_id: null for accepted ones, content, salt, text_id, seq, original), and the texts of their assets.

    Names, assets and forms of days are few beside the rows: each distinct one is read once.
    """
    register = read_table(spark, sf_dir, "filers")
    old = read_table(spark, sf_dir, "transactions").select("id", "politician", "transaction_date", "asset_name", "amount_min", "amount_max", "created_at")
    raw = read_table(spark, sf_dir, "raw_transactions").select("row_id", "batch_no", "politician", "transaction_date", "asset_name", "amount", "office_tz")
    spellings = (
        raw.select(F.col("politician").alias("spelling")).unionByName(old.select(F.col("politician").alias("spelling")))
        .groupBy("spelling").agg(F.count(F.lit(1)).alias("frequency"))
    )
    person = materialize(attribute(materialize(spellings), register).select(F.col("spelling").alias("politician"), "person"))
    named = lambda df: df.filter(~is_blank("politician") & ~is_blank("asset_name"))
    texts = asset_texts(named(raw).select("asset_name").unionByName(named(old).select("asset_name")))
    lo, hi = amount_ends("amount")
    timed = normalize_times(named(raw).filter(~is_blank("transaction_date")), "transaction_date", "office_tz")
    incoming = (
        timed.withColumn("day", local_day(F.col("utc"), calendar_date("transaction_date"), F.col("office_tz")))
        .filter("day is not null")
        .select(
            F.col("batch_no").alias("batch"), "row_id", "politician", "asset_name", "day", lo.alias("lo"), hi.alias("hi"),
            F.col("row_id").alias("seq"),
            F.col("row_id").cast("string").alias("original"),
        )
    )
    accepted = named(old).filter(F.col("transaction_date").isNotNull()).select(
        F.lit(ACCEPTED).alias("batch"), "politician", "asset_name", F.col("transaction_date").cast("date").alias("day"), F.col("amount_min").alias("lo"), F.col("amount_max").alias("hi"),
        F.coalesce(F.unix_micros(F.col("created_at").cast("timestamp")), F.lit(0)).alias("seq"), F.col("id").alias("original"),
    )
    both = accepted.unionByName(incoming, allowMissingColumns=True)
    owned = both.join(if_small(person), "politician", "left").withColumn("person", F.coalesce("person", F.lower("politician")))
    rows = with_content(owned, texts, "person", "day", "lo", "hi").select("batch", "row_id", "content", "salt", "text_id", "seq", "original")
    return materialize(rows), texts


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch after batch against the accepted trades and the batches before."""
    with short_plans(spark):
        return _repeats(spark, sf_dir)


def _repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, texts = trades(spark, sf_dir)
    contents = prepare(rows, texts)
    # a catalogue of deliveries: one small row a batch
    sizes = {r["batch"]: r["n"] for r in contents.groupBy("batch").agg(F.sum(F.size("fps")).alias("n")).collect()}
    store = HistoryStore(spark, parts=max(4, -(-sum(sizes.values()) * 10 // (1 << 22))))
    for no in sorted(sizes):
        batch = contents.filter(F.col("batch") == no)
        store.seed(batch) if no == ACCEPTED else store.check(batch)
        drop_finished(spark)
    if not sizes:
        return spark.createDataFrame([], "row_id long, original string")
    return repeated_rows(rows, store.decided().filter(F.col("batch") != ACCEPTED))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = read_table(spark, sf_dir, "raw_transactions").select("row_id", "type", "owner", "asset_type")
    return map_fields(raw, "row_id", ["type", "owner", "asset_type"], read_table(spark, sf_dir, "canonical_values"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    register = read_table(spark, sf_dir, "filers")
    raw = read_table(spark, sf_dir, "raw_transactions").select(
        F.lit("raw_transactions").alias("source_table"), "row_id", F.col("politician").alias("spelling")
    )
    parts = ["prefix", "first", "last", "suffix"]
    same = F.lit(True)
    for c in parts:
        same = same & F.col(f"m.{c}").eqNullSafe(F.col(f"f.{c}"))
    members = read_table(spark, sf_dir, "raw_members").select("member_row", *parts).alias("m")
    rewritten = members.join(if_few(register.select(*parts)).alias("f"), same, "left_anti").select(
        F.lit("raw_members").alias("source_table"), F.col("member_row").alias("row_id"), member_spelling().alias("spelling")
    )
    exact = register.select(F.col("full_name").alias("spelling"))
    counted = materialize(raw.unionByName(rewritten).groupBy("spelling").agg(F.count(F.lit(1)).alias("frequency")))
    people = materialize(attribute(counted, register).filter("filer_id is not null").select("spelling", "filer_id"))
    typed = raw.join(exact, "spelling", "left_anti").unionByName(rewritten)
    return typed.join(people, "spelling").select("source_table", "row_id", "filer_id")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(read_table(spark, sf_dir, "documents"), "text", ["doc_id"])


def _mixed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    counted = count_tokens(read_table(spark, sf_dir, "documents"), "text", ["doc_id", "source"])
    return mix(counted, read_table(spark, sf_dir, "source_targets"))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixed(spark, sf_dir)[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixed(spark, sf_dir)[1]


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return same_looking(read_table(spark, sf_dir, "documents"))


def p10_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text in its one form."""
    return canonical_texts(read_table(spark, sf_dir, "documents"), "text", ["doc_id"]).select("doc_id", "form")


def p10_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document whose form several texts have, with the class it belongs to."""
    return form_classes(read_table(spark, sf_dir, "documents")).select("doc_id", "representative")


QUERIES = {
    "p1_found": p1_found, "p4_found": p4_found, "p7_found": p7_found, "p8_ids": p8_ids, "p9_mix": p9_mix, "p9_shares": p9_shares,
    "p10_found": p10_found, "p10_forms": p10_forms, "p10_classes": p10_classes,
}
