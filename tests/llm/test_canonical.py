"""Mapping of freely entered values, against a plain scan of all forms."""

from disclospark.llm import canonical as C

REFERENCE = [
    ("type", "purchase", "Purchase", "P; buy; bought"), ("type", "sale", "Sale", "S; sell; sold"), ("type", "sale_full", "Sale (Full)", "S (full); sold all"),
    ("type", "sale_partial", "Sale (Partial)", "S (partial); sold part"), ("owner", "self", "Self", "filer; own"), ("owner", "spouse", "Spouse", "SP; wife; husband"),
    ("owner", "child", "Dependent Child", "DC; child; dependent"), ("asset_type", "stock", "Stock", "ST; equity; common shares"), ("asset_type", "option", "Stock Option", "OP; option contract"),
    ("asset_type", "corp_bond", "Corporate Bond", "CB; company note"), ("asset_type", "reit", "Real Estate Investment Trust", "REIT; RE"), ("asset_type", "odd", "Odd", None),
]
VALUES = {
    "type": {"purchse": "purchase", " p": "purchase", "Full, Sale": "sale_full", "SaleFull": "sale_full", "S (PARTTIAL)": "sale_partial", "Sale of shares": "sale", "SOLD ALL": "sale_full",
             "void": "unmatched", "??": "unmatched", "transfer in kind": "unmatched", "x" * 50_000: "unmatched"},
    "owner": {"Self (IRA)": "self", "Owner: Spouse": "spouse", "hubsand": "spouse", "child_dependent": "child", "estate": "unmatched", "\tSELF\xa0": "self"},
    "asset_type": {"Sotck": "stock", "Livestock": "unmatched", "Stockpile of grain": "unmatched", "[OP] Stock Option": "option", "Stock Option (OP)": "option", "Stock Option - other": "option",
                   "Corp. Bond": "corp_bond", "Bond Coporate": "corp_bond", "Real Estate Inve. Trust": "reit", "Corporate Bonds": "corp_bond", "st": "stock", "racehorse share": "unmatched"},
}


def frames(spark):
    ref = spark.createDataFrame(REFERENCE, "field_name string, code string, label string, also_known string")
    rows, i = [], 0
    for field, vs in VALUES.items():
        for v in [*vs, *vs, None, "", " \t", next(r[2] for r in REFERENCE if r[0] == field)]:
            rows.append((i, *(v if f == field else None for f in ("type", "owner", "asset_type")), "extra"))
            i += 1
    return ref, rows, spark.createDataFrame(rows, "row_id long, type string, owner string, asset_type string, code string")


def test_values(spark):
    ref, rows, df = frames(spark)
    got = {(r["row_id"], r["field_name"]): r["code"] for r in C.map_fields(df, "row_id", list(VALUES), ref).collect()}
    want = {}
    for i, *vs, _ in rows:
        for f, v in zip(VALUES, vs, strict=True):
            if v in VALUES[f]:
                want[i, f] = VALUES[f][v]
    assert got == want


def test_index_finds_what_a_scan_finds(spark):
    """The n-gram index loses no form that the check of the spelling would take."""
    ref, _, _ = frames(spark)
    forms = C.list_forms(ref)
    values = [(f, v) for f, vs in VALUES.items() for v in vs if len(v) < 100]
    got = {(r[0], r[1]): r[2] for r in C.match_values(spark.createDataFrame(values, "field_name string, value string"), forms).collect()}
    listed = [tuple(r) for r in forms.collect()]
    for f, v in values:
        scan = {c for g, c, form in listed if g == f and C.same_spelling(v, form)}
        assert (got[f, v] in scan) if scan else got[f, v] == "unmatched"


def test_empty(spark):
    ref, _, df = frames(spark)
    assert C.map_fields(df.limit(0), "row_id", ["type"], ref).collect() == []
    assert {r["code"] for r in C.map_fields(df, "row_id", ["type"], ref.limit(0)).collect()} == {"unmatched"}
