"""Session helpers shared by all operators."""

from __future__ import annotations

import contextlib
import gc
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder below spark.checkpoint.dir, which all executors share; a local one only where that is unset (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"file://{tempfile.gettempdir()}/disclospark-checkpoints"
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def _hadoop_path(spark: SparkSession, path: str):  # noqa: ANN202
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_path(spark, path)
    return fs.exists(p)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, written at once."""
    fs, p = _hadoop_path(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


@contextlib.contextmanager
def short_plans(spark: SparkSession, length: int = 20_000) -> Iterator[None]:
    """For loops of many steps: the driver keeps the plan text of every step, which would grow with their number."""
    key = "spark.sql.maxPlanStringLength"
    before = spark.conf.get(key)
    spark.conf.set(key, str(length))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def drop_finished(spark: SparkSession) -> None:
    """For loops of many steps: shuffle files and broadcasts of finished plans stay until the driver collects its garbage, which small plans seldom bring about."""
    gc.collect()  # frames hold their plans in the driver's JVM
    spark.sparkContext._jvm.System.gc()


def clear_intermediates(spark: SparkSession) -> None:
    """Delete every table this application wrote to cut lineage. To be called once no frame built before is needed any more."""
    fs, p = _hadoop_path(spark, shared_dir(spark).rpartition("/")[0])
    fs.delete(p, True)


def materialize(df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts lineage and survives the loss of executors."""
    path = shared_dir(df.sparkSession)
    df.write.partitionBy(*partition_by).parquet(path) if partition_by else df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
