"""Clock times of many forms and zones to one UTC time.

A value is read in one pass of one pattern; all of it stays in codegen. The zone is, in this order, the one the text names, the one
the row names, or the one estimated for the row's group and month. Estimation aligns the local times of a group with bounds on the true time: the
time of ingestion, which comes after it, or the place in a sequence, where rows of known time before and after it bound it. Each candidate zone (its offset history,
daylight saving included) costs a month so much for each bound it violates and for its distance from the bounds; the cheapest history of
zones over the months is chosen, each change of zone at a price. Costs are aggregated to (group, month, candidate) before any shuffle, so only numbers
as many as months reach the choice.

Cases: null, empty, blank and unknown text, impossible days, hours, minutes, seconds, and dates without a clock time give null. A local
time that occurs twice means its first pass; one that daylight saving skips is read with the offset before the jump. Numeric dates are
month first. Fractions beyond microseconds are cut. A row without any bound takes the zone its group has most. Session time zone has no influence.
"""

from __future__ import annotations

import zoneinfo

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import as_col, wide_trim
from ..session import materialize

# Zone abbreviations of the United States as printed on filings; two-letter ones follow daylight saving.
ABBREVIATIONS = {
    "utc": "UTC", "gmt": "UTC", "z": "UTC",
    "est": "-05:00", "edt": "-04:00", "et": "America/New_York",
    "cst": "-06:00", "cdt": "-05:00", "ct": "America/Chicago",
    "mst": "-07:00", "mdt": "-06:00", "mt": "America/Denver",
    "pst": "-08:00", "pdt": "-07:00", "pt": "America/Los_Angeles",
    "akst": "-09:00", "akdt": "-08:00", "akt": "America/Anchorage",
    "hst": "-10:00", "hdt": "-09:00", "ht": "Pacific/Honolulu",
    "ast": "-04:00", "adt": "-03:00", "at": "America/Puerto_Rico",
    "sst": "-11:00", "chst": "+10:00",
}
#: Estimated zones are broadcast up to this many groups (a name and a zone each); more are joined by a shuffle.
BROADCAST_GROUPS = 100_000
#: What a violated bound costs, and the most that a distance does, in hours; what a change of zone costs.
VIOLATION, SWITCH = 24.0, 48.0
ROWS_PER_STEP = 1000
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

_DATE = (
    r"(?:(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})"  # 1-3
    r"|(\d{1,2})[/.](\d{1,2})[/.](\d{4}|\d{2})"  # 4-6 month first
    r"|(\d{1,2})[- ]([a-z]{3,9})\.?[-, ]+(\d{4})"  # 7-9
    r"|([a-z]{3,9})\.? (\d{1,2})(?:st|nd|rd|th)?,? (\d{4})"  # 10-12
    r"|(\d{4})(\d{2})(\d{2}))"  # 13-15
)
_TIME = r"(?:(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,12}))?)?|(\d{2})(\d{2})(\d{2}))"  # 16-19, 20-22
_PATTERN = (
    r"(?i)\A(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,? +)?" + _DATE + r"(?:t|,? +(?:at +)?)" + _TIME
    + r" *([ap])?(?:(?<=[ap])\.?m\b\.?)? *((?:utc|gmt)? ?[+-]\d{1,2}(?::?\d{2})?|[a-z]{1,4})? *(?:\[([a-z_]+(?:/[a-z_+-]+)+)\]|\([a-z ]+\))?\z"  # 23 am/pm, 24 zone, 25 zone id
)
_GROUPS = "\x1f".join(f"${i}" for i in range(1, 26))
_EPOCH = r"\A\d{9,10}(?:\.\d{1,6})?\z|\A\d{12,13}\z|\A\d{15,16}\z"
EPOCH_START = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def known_zones() -> list[str]:
    """Region ids of the zone database (names with a slash), the same ones the JVM has."""
    areas = ("Africa", "America", "Antarctica", "Arctic", "Asia", "Atlantic", "Australia", "Europe", "Indian", "Pacific", "Etc", "US")
    return sorted(z for z in zoneinfo.available_timezones() if z.split("/")[0] in areas and "/" in z)


def _checked_zone(c: Column) -> Column:
    """The zone id, or null for one that isn't known (converting would raise)."""
    t = wide_trim(c)
    return F.when(t.isin(*known_zones(), "UTC") | t.rlike(r"\A[+-](?:0\d|1[0-4]):[0-5]\d\z"), t)


def _tidy(c: Column) -> Column:
    return F.regexp_replace(wide_trim(c), r"[\s\x{A0}\x{2009}\x{202F}]+", " ")


def has_clock_time(c: Column | str) -> Column:
    """Cheap first look at what every value the grammar reads has: a colon, six digits behind something else, or nine in a row. Plain dates end here."""
    return as_col(c).rlike(r":|\D\d{6}|\d{9}")


def parse_clock(df: DataFrame, column: str) -> DataFrame:
    """Adds local (timestamp_ntz; null if the text is no clock time) and named_zone (id or offset, null if the text has none)."""
    t = F.col("clock_text")
    g = lambda *ns: F.coalesce(*[F.nullif(F.get("clock_parts", F.lit(n - 1)), F.lit("")) for n in ns])
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(F.substring(g(8, 10), 1, 3)))
    year = g(1, 6, 9, 12, 13)
    hour, half = g(16, 20).try_cast("int"), F.lower(g(23))
    hour = F.when(half.isNull(), hour).when(hour.between(1, 12), hour % 12 + F.when(half == "p", 12).otherwise(0))
    number = lambda c: F.coalesce(c.try_cast("int"), F.lit(0))
    text = F.format_string(
        "%04d-%02d-%02d %02d:%02d:%02d.%s",
        F.when(F.length(year) == 2, year.try_cast("int") + 2000).otherwise(year.try_cast("int")),
        F.coalesce(g(2, 4, 14).try_cast("int"), F.when(month > 0, month.cast("int")), F.lit(0)),
        number(g(3, 5, 7, 11, 15)),
        F.coalesce(F.when(hour <= 23, hour), F.lit(99)),
        F.coalesce(g(17, 21).try_cast("int"), F.lit(99)),
        number(g(18, 22)),
        F.rpad(F.substring(F.coalesce(g(19), F.lit("0")), 1, 6), 6, "0"),
    )
    named = F.lower(F.trim(F.coalesce(g(24), F.lit(""))))
    shift = r"([+-])(\d{1,2}?):?(\d{2})?\z"
    sign, hours, minutes = (F.regexp_extract(named, shift, n) for n in (1, 2, 3))
    zone_map = F.create_map(*[F.lit(x) for kv in ABBREVIATIONS.items() for x in kv])
    zone = (
        F.when(sign != "", F.concat(sign, F.lpad(hours, 2, "0"), F.lit(":"), F.when(minutes == "", "00").otherwise(minutes)))
        .when(named != "", F.coalesce(zone_map[named], F.lit("?")))
        .otherwise(g(25))
    )
    whole = F.regexp_extract(t, r"\A(\d+)", 1)
    unit = F.when(F.length(whole) <= 10, 1_000_000).when(F.length(whole) <= 13, 1_000).otherwise(1)
    fraction = F.rpad(F.regexp_extract(t, r"\.(\d{1,6})\z", 1), 6, "0").try_cast("bigint")
    micros = F.coalesce(whole.try_cast("bigint"), F.lit(0)) * unit + F.coalesce(fraction, F.lit(0))
    epoch = F.timestamp_add("MICROSECOND", micros, F.expr(EPOCH_START))
    is_epoch = t.rlike(_EPOCH)
    clock = F.struct(
        F.when(is_epoch, epoch).otherwise(text.try_cast("timestamp_ntz")).alias("local"),
        F.when(is_epoch, F.lit("UTC")).otherwise(zone).alias("named_zone"),
    )
    parts = F.when(t.rlike(_PATTERN), F.split(F.regexp_replace(t, _PATTERN, _GROUPS), "\x1f"))
    # the generator keeps later filters from copying the whole parse into their conditions
    return (
        df.withColumn("clock_text", _tidy(F.col(column)))
        .withColumn("clock_parts", parts)
        .select(*[F.col(c) for c in df.columns], F.inline(F.array(clock)))
    )


def month_no(c: Column) -> Column:
    return (F.year(c) * 12 + F.month(c)).cast("int")


def to_utc(local: Column, zone: Column) -> Column:
    return F.convert_timezone(zone, F.lit("UTC"), local)


def utc_text(c: Column) -> Column:
    """`2026-04-09T15:15:07.120000Z` of a timestamp_ntz."""
    t = c.cast("string")
    fraction = F.rpad(F.regexp_extract(t, r"\.(\d+)\z", 1), 6, "0")
    return F.concat(F.substring(t, 1, 10), F.lit("T"), F.substring(t, 12, 8), F.lit("."), fraction, F.lit("Z"))


def utc_bound(df: DataFrame, column: str) -> Column:
    """A point in time as timestamp_ntz in UTC, whatever the session's zone; a column without zone is UTC already."""
    if dict(df.dtypes)[column] == "timestamp":
        return F.timestamp_add("MICROSECOND", F.unix_micros(F.col(column)), F.expr(EPOCH_START))
    return F.col(column).cast("timestamp_ntz")


def sequence_bounds(df: DataFrame, sequence: str, known: str, rows_per_step: int = 1000) -> DataFrame:
    """(step, seen_from, seen_to): the latest known time in the steps of a sequence before one, and the earliest in those behind it.

    A step is `rows_per_step` places wide. Only a row a step is left for the running bounds, which are taken in blocks of a thousand steps and then over the blocks.
    """
    step = F.floor(F.col(sequence) / rows_per_step).cast("bigint")
    ends = materialize(df.groupBy(step.alias("step")).agg(F.min(known).alias("lo"), F.max(known).alias("hi")).withColumn("block", F.floor(F.col("step") / 1000)))
    blocks = ends.groupBy("block").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    w = lambda key, before: (W.partitionBy(*key).orderBy("step" if key[0] == "block" else "block")).rowsBetween(*((W.unboundedPreceding, -1) if before else (1, W.unboundedFollowing)))
    one = blocks.withColumn("all", F.lit(1))  # a row a million places
    over = one.select("block", F.max("hi").over(w(("all",), True)).alias("b_from"), F.min("lo").over(w(("all",), False)).alias("b_to"))
    inner = ends.select("step", "block", F.max("hi").over(w(("block",), True)).alias("i_from"), F.min("lo").over(w(("block",), False)).alias("i_to"))
    return inner.join(over, "block").select("step", F.greatest("i_from", "b_from").alias("seen_from"), F.least("i_to", "b_to").alias("seen_to"))


def estimate_zones(local: DataFrame, group: str, candidates: list[str]) -> DataFrame:
    """(group, zones, usual) from rows with `local` and bounds seen_from, seen_to (either may be null): the zone of each month, and the cheapest over all."""
    tried = local.filter(F.col("local").isNotNull() & (F.col("seen_from").isNotNull() | F.col("seen_to").isNotNull())).select(
        group, month_no(F.col("local")).alias("month"), "local", "seen_from", "seen_to", F.explode(F.array(*[F.lit(z) for z in candidates])).alias("zone")
    )
    utc = to_utc(F.col("local"), F.col("zone"))
    early, late = F.timestamp_diff("SECOND", F.col("seen_from"), utc), F.timestamp_diff("SECOND", utc, F.col("seen_to"))
    violated = F.coalesce(early < 0, F.lit(False)) | F.coalesce(late < 0, F.lit(False))
    away = F.least(F.least(F.coalesce(early, late), F.coalesce(late, early)) / 3600.0, F.lit(VIOLATION))
    costs = tried.groupBy(group, "month", "zone").agg(F.sum(F.when(violated, F.lit(VIOLATION)).otherwise(away)).alias("cost"))

    def choose(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        table = pdf.pivot(index="month", columns="zone", values="cost").sort_index().sort_index(axis=1)
        cost = table.to_numpy()
        best, back = cost[0].copy(), []
        for row in cost[1:]:
            move = best.min() + SWITCH < best
            back.append(np.where(move, best.argmin(), np.arange(len(best))))
            best = np.minimum(best, best.min() + SWITCH) + row
        at = [int(best.argmin())]
        for b in reversed(back):
            at.append(int(b[at[-1]]))
        names = table.columns.to_numpy()
        history = {int(m): names[i] for m, i in zip(table.index, reversed(at), strict=True)}
        return pd.DataFrame({"grp": [key[0]], "zones": [history], "usual": [names[int(cost.sum(axis=0).argmin())]]})

    kind = dict(local.dtypes)[group]
    return costs.groupBy(group).applyInPandas(choose, f"grp {kind}, zones map<int,string>, usual string").withColumnRenamed("grp", group)


def normalize_times(
    df: DataFrame, column: str, zone: str, group: str | None = None, ingested: str | None = None, candidates: list[str] | None = None, sequence: str | None = None
) -> DataFrame:
    """Adds utc (timestamp_ntz), null where the text is no clock time or no zone can be told.

    Zones are estimated only if there are rows without any, and group, candidates and an ingestion time or a sequence (a number) are given.
    """
    looked = df.withColumn("maybe_clock", F.when(has_clock_time(column), F.col(column)))
    parsed = parse_clock(looked, "maybe_clock").drop("maybe_clock")
    row_zone = _checked_zone(F.col(zone))
    stated = F.when(F.col("named_zone").isNotNull(), _checked_zone(F.col("named_zone"))).otherwise(row_zone)
    parsed = parsed.withColumn("used_zone", stated)
    if group and candidates and (ingested or sequence) and not df.filter(has_clock_time(column) & row_zone.isNull()).isEmpty():
        bare = parsed.filter(F.col("used_zone").isNull() & F.col("named_zone").isNull())
        none = F.lit(None).cast("timestamp_ntz")
        if ingested:
            bounded = bare.withColumns({"seen_from": none, "seen_to": utc_bound(df, ingested)})
        else:
            known = parsed.filter(F.col("used_zone").isNotNull() & F.col("local").isNotNull()).select(sequence, to_utc(F.col("local"), F.col("used_zone")).alias("at"))
            steps = sequence_bounds(known.unionByName(bare.select(sequence, none.alias("at"))), sequence, "at", ROWS_PER_STEP)
            bounded = bare.withColumn("step", F.floor(F.col(sequence) / ROWS_PER_STEP).cast("bigint")).join(steps, "step")
        estimates = materialize(estimate_zones(bounded, group, candidates))
        if estimates.count() <= BROADCAST_GROUPS:
            estimates = F.broadcast(estimates)
        parsed = parsed.join(estimates, group, "left")
        own = F.when(F.col("named_zone").isNull(), F.coalesce(F.col("zones")[month_no(F.col("local"))], F.col("usual")))
        parsed = parsed.withColumn("used_zone", F.coalesce("used_zone", own)).drop("zones", "usual")
    return parsed.withColumn("utc", F.when(F.col("used_zone").isNotNull(), to_utc(F.col("local"), F.col("used_zone")))).drop(
        "local", "named_zone", "used_zone"
    )


def local_day(utc: Column, plain: Column, zone: Column) -> Column:
    """Calendar day in a zone: of the UTC time if there is one, else the plain date itself."""
    return F.coalesce(F.convert_timezone(F.lit("UTC"), _checked_zone(zone), utc).cast("date"), plain)
