"""Text of report PDFs to raw transactions.

The grammar is this engine's own. A record is anchored on its `(TICKER) [TYPE]` marker, or on `[TYPE]` alone where the asset has no ticker (bonds,
municipals, funds): the asset name stands before it, kind, two dates and amount after it, an owner code may lead the asset name, which may then run
over lines. Null characters vanish; glued fields are read apart by their shapes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import collapse_blanks, wide_trim

# Codes of the printed form.
OWNER_CODES = {"SP": "Spouse", "DC": "Dependent Child", "JT": "Joint"}
KIND_CODES = {"P": "Purchase", "S": "Sale", "S (partial)": "Sale (Partial)", "E": "Exchange"}

_AMOUNT = r"\$[\d,]+(?:\s*[-\x{2013}]\s*\$[\d,]+)?|Over\s+\$[\d,]+"
_RECORD = (
    r"(\b(?:SP|DC|JT)\s[^\[\]]+?|[^\[\]\n]+?)(?:\(([A-Za-z0-9.\-]+)\)\s*)?\[([A-Z]{2,3})\]\s*"
    r"(P|S \(partial\)|S|E)\s*(\d{1,2}/\d{1,2}/\d{4})\s*(\d{1,2}/\d{1,2}/\d{4})\s*(" + _AMOUNT + ")"
)


def parse_ptr_text(df: DataFrame, column: str = "text") -> DataFrame:
    """One raw transaction a marker; `df` has member, filingDate, docId and the text column. Null and empty texts give none."""
    clean = F.regexp_replace(F.col(column), r"\x{0}", "")
    hits = df.select("*", F.posexplode(F.regexp_extract_all(clean, F.lit(_RECORD), F.lit(0))).alias("idx", "hit"))
    g = lambda n: F.regexp_extract("hit", _RECORD, n)
    lead = collapse_blanks(g(1))
    owner = F.regexp_extract(lead, r"\A(SP|DC|JT)\s", 1)
    table = lambda t, k: F.create_map(*[F.lit(x) for kv in t.items() for x in kv])[k]
    return hits.select(
        F.col("member").alias("politician"),
        g(5).alias("transaction_date"),
        F.col("filingDate").cast("string").alias("filing_date"),
        F.nullif(g(2), F.lit("")).alias("ticker"),
        wide_trim(F.regexp_replace(lead, r"\A(SP|DC|JT)\s+", "")).alias("asset_name"),
        g(3).alias("asset_type"),
        table(KIND_CODES, g(4)).alias("type"),
        collapse_blanks(g(7)).alias("amount"),
        F.coalesce(table(OWNER_CODES, owner), F.lit("Self")).alias("owner"),
        F.concat_ws("|", F.col("docId"), F.col("idx")).alias("source_id"),
        F.to_json(F.struct(F.col("docId"), F.col("idx"))).alias("raw_json"),
    )
