"""File-source ingest: everything that has landed, once, into a unique store.

Uniqueness lives in the store, not in operator state, so no watermark is needed and state doesn't grow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.normalize import kept, normalize
from ..operators.store import ParquetStore, with_id


def ingest_available(spark: SparkSession, landing: str, schema: StructType, store: ParquetStore, checkpoint: str, order: str = "source_id", fmt: str = "parquet") -> None:
    """Process what landed since the last call and stop. A call with nothing new changes nothing."""

    def save(batch: DataFrame, _: int) -> None:
        store.save(with_id(kept(normalize(batch, (order,)))), order)

    stream = spark.readStream.schema(schema).format(fmt).load(landing)
    stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def windowed_counts(stream: DataFrame, ts: str, late: str = "10 minutes", window: str = "1 hour") -> DataFrame:
    """Counts a tumbling window of a stream, late rows within the watermark included."""
    return (
        stream.withWatermark(ts, late).groupBy(F.window(ts, window)).agg(F.count(F.lit(1)).alias("count"))
        .select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "count")
    )
