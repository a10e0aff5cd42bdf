"""Freely entered values to the entries of a reference list.

Distinct values are normalised (case, quotes, punctuation, blanks, qualifying words), their character n-grams looked up in an inverted index of the list's forms (labels, other
names, codes in use) by an equi-join, and candidates scored by cosine with inverse-frequency weights. The n-grams are those of two and three letters, the
words and the whole value with one letter skipped (two spellings one typo apart share some, a word inside a longer one doesn't), and how words begin. The entry of highest cosine is
accepted if it is above the threshold and by a margin above the next entry; only forms that pass a check of the spelling count: at most one typo in eight letters, in the words as
written, run together or in another order, qualifying words aside.

Cases: null and blank values are no values; ties between entries, within the margin,
and values below the threshold are `unmatched`; repeated rows share one distinct value; very long values are compared whole (words and values over 64 letters
without their skip-grams); empty input gives no rows.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import is_blank
from ..session import materialize
from .names import edits

# Words that qualify an entry without changing it.
QUALIFIERS = frozenset("of shares share account acct ira other owner type asset the a an".split())
THRESHOLD = 0.2
MARGIN = 0.03
_CODE = re.compile(r"^\s*[\[(]\s*\w{1,5}\s*[\])]\s*(?=\w)|(?<=\w)\s*[\[(]\s*[A-Z]{2,5}\s*[\])]\s*$")
_PUNCT = re.compile(r"[^\w]+|_+")


def words(value: str) -> list[str]:
    return _PUNCT.sub(" ", unicodedata.normalize("NFKC", value)).casefold().split()


def _plain(ws: list[str]) -> list[str]:
    kept = [w for w in ws if w not in QUALIFIERS]
    return kept or ws


def _grams(s: str) -> list[str]:
    return [s[i : i + n] for n in (2, 3) for i in range(len(s) - n + 1)]


def _skipped(s: str) -> set[str]:
    """The text, and the text with one letter left out."""
    return {s} | ({s[:i] + s[i + 1 :] for i in range(len(s))} if 2 < len(s) <= 64 else set())


def features(value: str) -> set[str]:
    """Marked n-grams: of the words, each padded, and of the words run together, so neither order nor a lost blank hides a form."""
    ws = _plain(words(value))
    run = "".join(ws)
    if not run:
        return set()
    out = set(_grams(run)) | {f"_{g}" for g in _skipped(run)} | {f"={''.join(sorted(run))}"}
    for w in ws:
        out |= set(_grams(f"#{w}#")) | {f"~{g}" for g in _skipped(w)} | {f"^{w[:k]}" for k in (3, 4) if len(w) >= k}
    return out


@F.pandas_udf(T.ArrayType(T.StringType()))
def value_grams(value: pd.Series) -> pd.Series:
    return value.map(lambda v: sorted(features(v or "")))


def allowed(n: int) -> int:
    return 0 if n <= 2 else 1 if n <= 9 else 2


def readings(value: str) -> list[list[str]]:
    """The words of a value as typed, without qualifiers, and without a code in brackets; each once, the plainest first."""
    typed = words(value)
    bare = words(_CODE.sub(" ", value))
    out: list[list[str]] = []
    for r in (typed, _plain(typed), bare, _plain(bare)):
        if r and r not in out:
            out.append(r)
    return out


def _word_by_word(t: list[str], b: list[str]) -> bool:
    """Each word a typo of another, in the order that fits best, or all of them cut short."""
    left, total = list(b), 0
    for w in t:
        d, best = min(((edits(w, z, 2), z) for z in left), key=lambda x: x[0])
        if d > allowed(len(best)) or d > 1 and len(best) < 8:
            break
        total += d
        left.remove(best)
    else:
        if total <= 2:
            return True
    return all(x == y or len(x) >= 3 and y.startswith(x) for x, y in zip(t, b, strict=True))


def spelling_gap(tries: list[list[str]], b: list[str]) -> int | None:
    """How far a value is from a form, or null if it isn't that form with a few typos."""
    form, turned = "".join(b), "".join(sorted(b))
    best, same = None, False
    for i, t in enumerate(tries):
        for s, r in ((("".join(t)), form), ("".join(sorted(t)), turned)):
            n = min(len(s), len(r))
            if abs(len(s) - len(r)) > 3:
                d = 4
            else:
                d = edits(s, r, 3)
            same = same or d == 0 or n >= 3 and d <= allowed(n) or s == r + "s"
            gap = i + 4 * d
            best = gap if best is None or gap < best else best
        same = same or len(t) == len(b) > 1 and _word_by_word(t, b)
    return best if same else None


def same_spelling(value: str, form: str) -> bool:
    """True if the value is the form, a few typos aside."""
    return spelling_gap(readings(value), words(form)) is not None


@F.pandas_udf(T.BooleanType())
def _spelled(value: pd.Series, form: pd.Series) -> pd.Series:
    tries = {v: readings(v) for v in value.unique()}
    forms = {f: words(f) for f in form.unique()}
    return pd.Series([spelling_gap(tries[v], forms[f]) is not None for v, f in zip(value, form, strict=True)], dtype="bool")


#: Not deterministic for the planner, which would else pull the check below the exchange and run it twice.
spelled_alike = _spelled.asNondeterministic()


def list_forms(reference: DataFrame, field: str = "field_name", code: str = "code", label: str = "label", others: str = "also_known") -> DataFrame:
    """(field_name, code, form) of every label and every other name."""
    both = F.concat(F.array(F.col(label)), F.split(F.coalesce(F.col(others), F.lit("")), r"\s*;\s*"))
    return (
        reference.select(F.col(field).alias("field_name"), F.col(code).alias("code"), F.explode(both).alias("form"))
        .filter(F.trim("form") != "").distinct()
    )


def match_values(values: DataFrame, forms: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(field_name, value, code) of distinct `values` (field_name, value); `unmatched` where no entry is meant."""
    forms = materialize(forms.withColumn("grams", value_grams("form")))
    index = forms.select("field_name", "code", "form", F.explode("grams").alias("gram"))
    n = forms.groupBy("field_name").agg(F.count(F.lit(1)).alias("n"))
    # the square root keeps rare n-grams from outweighing all others
    weight = (
        index.groupBy("field_name", "gram").agg(F.count(F.lit(1)).alias("df")).join(n, "field_name")
        .select("field_name", "gram", F.sqrt(F.log(F.lit(1.0) + F.col("n") / F.col("df"))).alias("w"))
    )
    weighted = index.join(weight, ["field_name", "gram"])
    norms = weighted.groupBy("field_name", "code", "form").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm_f"))
    postings = weighted.join(norms, ["field_name", "code", "form"])
    postings = materialize(postings)  # as long as the list, not as the data
    values = materialize(values.withColumn("grams", value_grams("value")))
    typed = values.select("field_name", "value", F.explode("grams").alias("gram"))
    # grams the index doesn't know weigh as the rarest
    norm_v = (
        typed.join(weight, ["field_name", "gram"], "left").join(n, "field_name")
        .groupBy("field_name", "value").agg(F.sqrt(F.sum(F.pow(F.coalesce("w", F.sqrt(F.log(F.lit(1.0) + F.col("n")))), F.lit(2)))).alias("norm_v"))
    )
    scored = (
        typed.join(postings, ["field_name", "gram"])
        .groupBy("field_name", "value", "code", "form", "norm_f").agg(F.sum(F.col("w") * F.col("w")).alias("dot"))
        .join(norm_v, ["field_name", "value"])
        .withColumn("cosine", F.col("dot") / (F.col("norm_f") * F.col("norm_v")))
        .filter(F.col("cosine") >= threshold)
        # few bytes, but each pair takes work: spread them as wide as any shuffle
        .repartition(int(values.sparkSession.conf.get("spark.sql.shuffle.partitions")), "value", "form")
        .withColumn("alike", spelled_alike("value", "form"))
        .filter("alike")
    )
    entries = materialize(scored.groupBy("field_name", "value", "code").agg(F.max("cosine").alias("cosine")))
    best = entries.groupBy("field_name", "value").agg(F.max_by("code", F.struct("cosine", "code")).alias("code"), F.max("cosine").alias("top"))
    rivals = entries.join(best.withColumnRenamed("code", "best"), ["field_name", "value"]).filter((F.col("code") != F.col("best")) & (F.col("cosine") > F.col("top") - MARGIN))
    chosen = best.join(rivals.select("field_name", "value").distinct(), ["field_name", "value"], "left_anti").select("field_name", "value", "code")
    return values.join(chosen, ["field_name", "value"], "left").select("field_name", "value", F.coalesce("code", F.lit("unmatched")).alias("code"))


def map_fields(df: DataFrame, row: str, fields: list[str], reference: DataFrame) -> DataFrame:
    """(row, field_name, code) of every value that isn't blank and not exactly a label of its field."""
    forms = list_forms(reference)
    stacked = df.select(
        F.col(row), F.inline(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).cast("string").alias("value")) for f in fields]))
    ).filter(~is_blank("value"))
    labels = reference.select("field_name", F.col("label").alias("value")).distinct()
    odd = materialize(stacked.join(labels, ["field_name", "value"], "left_anti"))
    mapped = match_values(odd.select("field_name", "value").distinct(), forms)
    return odd.join(mapped, ["field_name", "value"]).select(row, "field_name", "code")
