"""Sources mixed to target shares of tokens.

Every row has a hash-random key. Ranges of that key are the buckets of a range sort inside each source: even by construction, so no source,
however large, meets in one task. Token sums a bucket give each bucket's offset; a running sum inside the bucket completes the distributed
prefix sum, and the cut at each source's budget is exact to the row. A source smaller than its budget is used in whole epochs and a last
partial one.

The total is the largest at which every listed source that has tokens can give its share within its cap, unless the caller names one; then
sources that run out are used to their cap and the report shows it. A row is taken while the running sum stays within the budget.

Cases: null and empty texts have no tokens and are never used; sources that aren't listed are left out, listed ones without tokens get
nothing and the others' shares are scaled up to one; null or negative shares and caps below one count as zero; ties in the key are settled by
the id; repeated rows of a source list add up their shares and take the smallest cap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize

#: Offsets of buckets are broadcast up to this many; more are joined by a shuffle, which the running sums have made already.
BROADCAST_BUCKETS = 100_000


def plan_budgets(sizes: DataFrame, targets: DataFrame, total: int | None = None) -> DataFrame:
    """(source, target_share, share, max_repeats, available, budget): one row a listed source."""
    listed = (
        targets.filter(F.col("source").isNotNull())
        .groupBy("source")
        .agg(F.sum(F.greatest(F.coalesce("target_share", F.lit(0.0)), F.lit(0.0))).alias("target_share"), F.min(F.greatest(F.coalesce("max_repeats", F.lit(0)), F.lit(0))).alias("max_repeats"))
        .join(sizes, "source", "left")
        .withColumn("available", F.coalesce("available", F.lit(0)))
        .withColumn("usable", (F.col("available") > 0) & (F.col("target_share") > 0) & (F.col("max_repeats") > 0))
    )
    # sources are a short list of names given by hand
    every = W.partitionBy(F.lit(1))
    share = F.when(F.col("usable"), F.col("target_share") / F.sum(F.when(F.col("usable"), F.col("target_share"))).over(every)).otherwise(0.0)
    capped = F.col("available") * F.col("max_repeats")
    shared = listed.withColumn("share", share)
    feasible = F.min(F.when(F.col("usable"), F.floor(capped / F.col("share")))).over(every)
    whole = F.lit(total).cast("bigint") if total is not None else feasible
    budget = F.when(F.col("usable"), F.least(F.floor(F.col("share") * whole), capped)).otherwise(0)
    return shared.withColumn("budget", budget.cast("bigint")).drop("usable")


def mix(counted: DataFrame, targets: DataFrame, key: str = "doc_id", seed: int = 17, total: int | None = None, rows_per_bucket: int = 20_000) -> tuple[DataFrame, DataFrame]:
    """(mix, report). `counted`: key, source, n_tokens. mix: key, source, n_tokens, copies (at least one); report: one row a listed source."""
    rows = materialize(
        counted.filter((F.col("n_tokens") > 0) & F.col("source").isNotNull()).select(key, "source", "n_tokens")
        .withColumn("r", F.xxhash64(F.lit(seed), F.col(key).cast("string")))
    )
    sizes = rows.groupBy("source").agg(F.sum("n_tokens").alias("available"), F.count(F.lit(1)).alias("n"))
    largest = sizes.agg(F.max("n")).first()[0] or 1
    bits = max(0, (-(-largest // rows_per_bucket) - 1).bit_length())
    plan = materialize(plan_budgets(sizes.drop("n"), targets, total).coalesce(1))
    bucketed = rows.withColumn("bucket", (F.shiftrightunsigned("r", 64 - bits) if bits else F.lit(0)).cast("int")).withColumn("r", F.shiftleft("r", bits))
    # unsigned order of the rest of the key: move the sign
    bucketed = bucketed.withColumn("r", F.col("r").bitwiseXOR(F.lit(-(1 << 63))))
    # offsets grow with the rows: a row a bucket of each source
    few = (1 << bits) * (sizes.count() or 1) <= BROADCAST_BUCKETS
    sums = bucketed.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("t"))
    offsets = sums.withColumn("before", F.coalesce(F.sum("t").over(W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("t")
    inside = F.sum("n_tokens").over(W.partitionBy("source", "bucket").orderBy("r", key).rowsBetween(W.unboundedPreceding, 0))
    running = (
        bucketed.withColumn("upto", inside).join(F.broadcast(offsets) if few else offsets, ["source", "bucket"])
        .join(F.broadcast(plan.select("source", "available", "budget", "max_repeats")), "source")
        .withColumn("upto", F.col("upto") + F.col("before"))
    )
    epochs = F.floor(F.col("budget") / F.col("available"))
    rest = F.col("budget") - epochs * F.col("available")
    copies = F.least(epochs + F.when(F.col("upto") <= rest, 1).otherwise(0), F.col("max_repeats"))
    mixed = materialize(running.select(key, "source", "n_tokens", copies.cast("int").alias("copies")).filter("copies > 0"))
    used = mixed.groupBy("source").agg(F.sum(F.col("copies") * F.col("n_tokens")).alias("tokens"), F.count(F.lit(1)).alias("documents"), F.max("copies").alias("most_copies"))
    all_used = F.sum("tokens").over(W.partitionBy(F.lit(1)))
    report = plan.join(used, "source", "left").fillna(0, ["tokens", "documents", "most_copies"]).withColumn("actual_share", F.when(all_used > 0, F.col("tokens") / all_used).otherwise(0.0))
    return mixed, report
