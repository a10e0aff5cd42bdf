"""Fixed schemas of the data model."""

from pyspark.sql import types as T

_s = T.StringType()


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, _s) for n in names])


RAW_FIELDS = (
    "politician", "transaction_date", "filing_date", "ticker", "asset_name",
    "asset_type", "type", "amount", "owner", "source_id",
)
RAW_TRANSACTION = T.StructType([*_strings(*RAW_FIELDS).fields, T.StructField("raw_json", _s)])
TRANSACTION = T.StructType(
    [
        T.StructField("id", _s),
        T.StructField("politician", _s),
        T.StructField("transaction_date", T.DateType()),
        T.StructField("filing_date", T.DateType()),
        T.StructField("ticker", _s),
        T.StructField("asset_name", _s),
        T.StructField("asset_type", _s),
        T.StructField("type", _s),
        T.StructField("amount_min", T.LongType()),
        T.StructField("amount_max", T.LongType()),
        T.StructField("owner", _s),
        T.StructField("inserted_at", T.TimestampType()),
    ]
)
LISTING_PAGE = T.StructType(
    [
        T.StructField("draw", T.IntegerType()),
        T.StructField("recordsTotal", T.IntegerType()),
        T.StructField("recordsFiltered", T.IntegerType()),
        T.StructField("data", T.ArrayType(T.ArrayType(_s))),
    ]
)
MEMBER_XML = _strings("Prefix", "Last", "First", "Suffix", "FilingType", "StateDst", "Year", "FilingDate", "DocID")
HIT_SOURCE = _strings(
    "senator_name", "first_name", "last_name", "transaction_date", "date_filed", "filing_date", "ticker",
    "asset_name", "asset_type", "transaction_type", "amount", "owner", "report_id",
)
HITS = T.ArrayType(T.StructType([T.StructField("_id", _s), T.StructField("_source", HIT_SOURCE)]))
