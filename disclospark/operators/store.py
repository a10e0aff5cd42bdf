"""Stores: a unique parquet table (insert or ignore) and an append-only one."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.identity import stable_id
from ..functions.text import ascii_lower
from ..schemas import TRANSACTION
from ..session import materialize, path_exists


@dataclass(frozen=True)
class QueryFilters:
    """Read filters; absent or empty ones vanish, the rest must all hold. Both date ends count."""

    politician: str | None = None
    ticker: str | None = None
    date_from: str | None = None
    date_to: str | None = None
    type: str | None = None
    owner: str | None = None
    limit: int = 500
    offset: int = 0


def like_politician(value: str, column: str = "politician") -> Column:
    """Substring match that folds ASCII letters only; % and _ of the value are live wildcards."""
    pattern = value.replace("\\", "\\\\").translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)}))
    return ascii_lower(column).like(f"%{pattern}%")


def contains_politician(value: str, column: str = "politician") -> Column:
    """Literal substring match over Unicode lower case."""
    return F.contains(F.lower(F.col(column)), F.lower(F.lit(value)))


def predicate(f: QueryFilters, literal: bool = False) -> Column:
    parts = []
    if f.politician:
        parts.append(contains_politician(f.politician) if literal else like_politician(f.politician))
    if f.ticker:
        parts.append(F.col("ticker") == f.ticker.upper())
    if f.type:
        parts.append(F.col("type") == f.type)
    if f.owner:
        parts.append(F.col("owner") == f.owner)
    if f.date_from:
        parts.append(F.col("transaction_date") >= F.lit(f.date_from).cast("date"))
    if f.date_to:
        parts.append(F.col("transaction_date") <= F.lit(f.date_to).cast("date"))
    out = F.lit(True)
    for p in parts:
        out = out & p
    return out


def page(df: DataFrame, f: QueryFilters, *tie_break: str, literal: bool = False, ordered: bool = True) -> DataFrame:
    """Filtered rows, newest trade first, one page of them (planned as a top-k, not a full sort)."""
    out = df.filter(predicate(f, literal))
    if ordered:
        newest = [F.desc("transaction_date"), *([F.desc("inserted_at")] if "inserted_at" in df.columns else [])]
        out = out.orderBy(*newest, *[F.asc(c) for c in tie_break])
    return out.offset(f.offset).limit(f.limit)


def first_by_id(df: DataFrame, *order: str, key: str = "id") -> DataFrame:
    """One row an id: the first by `order`. An aggregate, so equal ids meet map-side and no group is sorted in one task."""
    best = F.min_by(F.struct(*df.columns), F.struct(*order)).alias("r")
    return df.groupBy(key).agg(best).select("r.*")


def new_rows(incoming: DataFrame, existing: DataFrame, key: str = "id") -> DataFrame:
    """Incoming rows whose key the store doesn't have; repeats inside the batch stay."""
    return incoming.join(existing.select(key), key, "left_anti")


def insert_or_ignore(incoming: DataFrame, existing: DataFrame, *order: str) -> DataFrame:
    """The rows a unique table would take: first of each id in the batch, and only ids the store doesn't have."""
    return new_rows(first_by_id(incoming, *order), existing)


def known_ids(incoming: DataFrame, existing: DataFrame, key: str = "id") -> DataFrame:
    """Distinct keys of the batch that the store has."""
    return incoming.select(key).distinct().join(existing.select(key), key, "left_semi")


def with_id(normalized: DataFrame) -> DataFrame:
    return normalized.withColumn("id", stable_id())


class ParquetStore:
    """Unique by id, partitioned by trade year. One writer at a time; each save is one append."""

    unique = True

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def _exists(self) -> bool:
        return path_exists(self.spark, self.path)

    def create_table(self, name: str) -> None:
        """An external catalogue table over the store, if there is none of that name."""
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TRANSACTION.fields)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, trade_year int) USING parquet PARTITIONED BY (trade_year) LOCATION '{self.path}'")

    @staticmethod
    def _stored() -> T.StructType:
        return T.StructType([*TRANSACTION.fields, T.StructField("trade_year", T.IntegerType())])

    def read(self) -> DataFrame:
        """Stored rows with the read-back defaults for nulls; empty before the first save."""
        if not self._exists():
            return self.spark.createDataFrame([], TRANSACTION)
        df = self.spark.read.schema(TRANSACTION).parquet(self.path).select(*TRANSACTION.names)
        return df.withColumns(
            {
                "asset_type": F.coalesce("asset_type", F.lit("")),
                "amount_min": F.coalesce("amount_min", F.lit(0)),
                "owner": F.coalesce("owner", F.lit("self")),
            }
        )

    def save(self, rows: DataFrame, *order: str) -> int:
        """Number of rows really inserted. Rows with a null in a required column are ignored, as are known ids."""
        needed = ("politician", "transaction_date", "filing_date", "asset_name", "type")
        sound = rows.dropna(subset=list(needed))
        if self.unique and self._exists():
            # an id holds its trade date: only the years of the batch are looked up; the batch is made once for both
            sound = materialize(sound)
            years = [r[0] for r in sound.select(F.year("transaction_date")).distinct().collect()]
            stored = self.spark.read.schema(self._stored()).parquet(self.path).filter(F.col("trade_year").isin(years))
            fresh = insert_or_ignore(sound, stored, *order)
        else:
            fresh = first_by_id(sound, *order) if self.unique else sound
        out = fresh.withColumn("inserted_at", F.current_timestamp()).select(*TRANSACTION.names)
        out = out.withColumn("trade_year", F.year("transaction_date"))
        seen = F.count(F.lit(1)).alias("n")
        o = Observation()
        out.observe(o, seen).write.mode("append").partitionBy("trade_year").parquet(self.path)
        return int(o.get["n"] or 0)

    def query(self, f: QueryFilters) -> DataFrame:
        return page(self.read(), f, "id")

    def count(self) -> int:
        return self.read().count()


class AppendStore(ParquetStore):
    """Takes every row; reads filter by literal substring and keep no order."""

    unique = False

    def query(self, f: QueryFilters) -> DataFrame:
        return page(self.read(), f, literal=True, ordered=False)


