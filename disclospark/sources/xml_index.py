"""Yearly filing index: an XML file in a ZIP archive."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.normalize import calendar_date, member_name
from ..functions.text import blank_to_null
from ..schemas import MEMBER_XML


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(path, name, xml) of the `<year>fd.xml` entry of every ZIP below `path`; archives are unpacked by the executors."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for where, content in zip(batch["path"], batch["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    rows += [
                        (where, n, z.read(n).decode("utf-8-sig")) for n in z.namelist() if n.lower().endswith("fd.xml")
                    ]
            yield pd.DataFrame(rows, columns=["path", "name", "xml"])

    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", "true").load(path)
    return found.select("path", "content").mapInPandas(unpack, "path string, name string, xml string")


def read_members(spark: SparkSession, path: str) -> DataFrame:
    """Member elements of landed XML files; every tag stays text, so leading zeros of ids survive."""
    return spark.read.schema(MEMBER_XML).option("rowTag", "Member").option("inferSchema", "false").xml(path)


def members_of(df: DataFrame, column: str = "xml") -> DataFrame:
    """Member elements of a column with one `<Member>` fragment a row."""
    return df.select(F.from_xml(F.col(column), MEMBER_XML.simpleString()).alias("m")).select("m.*")


def archive_members(spark: SparkSession, path: str) -> DataFrame:
    """Member elements of all yearly archives below `path`: unpacked, cut into fragments and read in one flow."""
    fragments = F.regexp_extract_all("xml", F.lit(r"(?s)<Member>.*?</Member>"), F.lit(0))
    return members_of(read_archives(spark, path).select(F.explode(fragments).alias("xml")))


def periodic_filings(members: DataFrame, first_day: Column | str, last_day: Column | str) -> DataFrame:
    """member, filingDate, filingDateRaw, docId, year of the periodic reports filed in a window (both ends count)."""
    to_date = lambda d: F.to_date(F.lit(d)) if isinstance(d, str) else d
    day = calendar_date("FilingDate")
    return (
        members.filter(F.col("FilingType") == "P")
        .select(
            member_name().alias("member"),
            day.alias("filingDate"),
            F.col("FilingDate").alias("filingDateRaw"),
            blank_to_null("DocID").alias("docId"),
            F.col("Year").try_cast("int").alias("year"),
        )
        .filter((F.col("member") != "") & F.col("docId").isNotNull())
        .filter(F.col("filingDate").between(to_date(first_day), to_date(last_day)))
    )
