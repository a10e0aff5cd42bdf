"""What changed between full snapshots: invertible Bloom lookup tables per hash bucket.

Every record is a pair of 64-bit hashes (key, value); only these and the line number are shuffled, by bucket, and then the cells. A snapshot adds its pairs to the table of its own
comparison and takes them from the table of the next one, so subtraction is one aggregate with map-side combine: records that two snapshots share cancel, and only cells
that differ leave the aggregate. Each bucket is peeled by itself. A bucket that doesn't peel to nothing is built again with four times
the cells, for its records only, until all are done. Recovered pairs are verified (no cell is left, and the sums of what was recovered equal
the difference of counts), classified, and named by a look at the lines that have their key hash: one side only is added or removed, both is changed.

Cases: null and blank keys are no records; of repeated keys in a snapshot the one with the highest `order` (a number) counts; the lowest snapshot has
no changes; empty input gives no rows. Keys are text here; callers normalise them first.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize

HASHES = 3
#: Recovered keys are broadcast up to this many (under 50 bytes each) to be named; more are joined by a shuffle.
BROADCAST_CHANGES = 200_000


# The primes of the 64-bit xxhash.
_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _hash_long(x: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """xxhash64 of eight bytes each, all at once."""
    h = (seed + _P5 + np.uint64(8)) ^ (_turn(x * _P2, 31) * _P1)
    h = _turn(h, 27) * _P1 + _P4
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def _check(key: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Spark's xxhash64(key, value) of two bigint columns."""
    seed = np.full(len(key), 42, np.uint64)
    return _hash_long(value.astype(np.int64).view(np.uint64), _hash_long(key.astype(np.int64).view(np.uint64), seed)).view(np.int64)


def _positions(check: np.ndarray, cells: int) -> np.ndarray:
    """The cell of each of the three sub-tables, as _cell_columns() places it."""
    bits = check.view(np.uint64)
    return np.stack([((bits >> np.uint64(21 * i)) & np.uint64(0x1FFFFF)).astype(np.int64) % cells + i * cells for i in range(HASHES)], 1)


def _cell_columns(cells: int) -> Column:
    part = lambda i: F.shiftrightunsigned("h_check", 21 * i).bitwiseAND(F.lit(0x1FFFFF)) % cells + i * cells
    return F.array(*[part(i).cast("int") for i in range(HASHES)])


def _peel(cells: int):  # noqa: ANN202
    """Pairs of one bucket: side 1 (new) or -1 (old), or one row with ok = false."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        n = np.zeros(cells * HASHES, np.int64)
        k, v, c = (np.zeros(cells * HASHES, np.int64) for _ in range(3))
        at = pdf["cell"].to_numpy()
        n[at], k[at], v[at], c[at] = (pdf[x].to_numpy() for x in ("n", "k", "v", "c"))
        balance = int(n[:cells].sum())
        sides, keys, values = [], [], []
        todo = np.unique(at)
        while len(todo):
            lone = todo[np.abs(n[todo]) == 1]
            if len(lone):
                lone = lone[_check(k[lone], v[lone]) == c[lone]]
            if not len(lone):
                break
            pure = pd.DataFrame({"c": c[lone], "k": k[lone], "v": v[lone], "s": n[lone]}).drop_duplicates("c")
            spots = _positions(pure["c"].to_numpy(), cells)
            for j in range(HASHES):
                np.subtract.at(n, spots[:, j], pure["s"].to_numpy())
                for cell_sum, x in ((k, "k"), (v, "v"), (c, "c")):
                    np.bitwise_xor.at(cell_sum, spots[:, j], pure[x].to_numpy())
            sides += pure["s"].tolist()
            keys += pure["k"].tolist()
            values += pure["v"].tolist()
            todo = np.unique(spots)
        ok = not (n.any() or k.any() or v.any() or c.any()) and sum(sides) == balance
        if not ok:
            sides, keys, values = [0], [0], [0]
        return pd.DataFrame({"pair_no": np.int32(key[0]), "bucket": np.int32(key[1]), "side": sides, "h_key": keys, "h_value": values, "ok": ok})

    return run


def snapshot_changes(
    df: DataFrame, snapshot: str, key: str, value: list[str], order: str, rows_per_bucket: int = 2048, cells: int = 256
) -> DataFrame:
    """(snapshot, key, change_kind) against the next lower snapshot present."""
    lines = df.filter(F.col(key).isNotNull() & F.col(snapshot).isNotNull()).select(
        F.col(snapshot).alias("snap"), F.col(key).alias("key"), F.xxhash64(key).alias("h_key"),
        F.xxhash64(*[F.to_json(F.struct(F.col(c))) for c in value]).alias("h_value"), F.col(order).cast("bigint").alias("line"),
    )
    # one row a snapshot: their number is that of deliveries, not of records
    sizes = lines.groupBy("snap").agg(F.count(F.lit(1)).alias("n"))
    numbered = materialize(sizes.withColumn("pair_no", F.row_number().over(W.orderBy("snap")).cast("int")).coalesce(1))
    top = numbered.agg(F.max("n").alias("n"), F.max("pair_no").alias("last")).first()
    if not top["n"]:
        return df.select(F.col(snapshot), F.col(key), F.lit("").alias("change_kind")).limit(0)
    buckets = max(1, -(-top["n"] // rows_per_bucket))
    # the one shuffle of records, numbers only
    placed = (
        lines.drop("key").join(F.broadcast(numbered.drop("n")), "snap")
        .select("pair_no", "h_key", "h_value", "line", F.pmod("h_key", F.lit(buckets)).cast("int").alias("bucket")).repartition("bucket")
    )
    keyed = placed.groupBy("pair_no", "bucket", "h_key").agg(F.count(F.lit(1)).alias("times"), F.max("line").alias("line"), F.bit_xor("h_value").alias("h_value"))
    keyed = materialize(keyed)
    # keys that stand more than once in a snapshot: the value of the last line
    several = keyed.filter("times > 1").select("pair_no", "bucket", "h_key", "line")
    last = placed.join(several, ["pair_no", "bucket", "h_key", "line"]).groupBy("pair_no", "bucket", "h_key").agg(F.max("h_value").alias("h_value"))
    records = keyed.filter("times = 1").select("pair_no", "bucket", "h_key", "h_value").unionByName(last)
    signed = records.withColumn("h_check", F.xxhash64("h_key", "h_value")).withColumn(
        "sides", F.array(F.struct("pair_no", F.lit(1).alias("side")), F.struct((F.col("pair_no") + 1).alias("pair_no"), F.lit(-1).alias("side")))
    ).select("bucket", "h_key", "h_value", "h_check", F.inline("sides"))
    signed = signed.filter(F.col("pair_no").between(2, top["last"]))
    found, todo = None, signed
    while True:
        table = (
            todo.select("pair_no", "bucket", "side", "h_key", "h_value", "h_check", F.explode(_cell_columns(cells)).alias("cell"))
            .groupBy("pair_no", "bucket", "cell")
            .agg(F.sum("side").alias("n"), F.bit_xor("h_key").alias("k"), F.bit_xor("h_value").alias("v"), F.bit_xor("h_check").alias("c"))
            .filter("n != 0 or k != 0 or v != 0 or c != 0")
        )
        peeled = materialize(
            table.groupBy("pair_no", "bucket").applyInPandas(
                _peel(cells), "pair_no int, bucket int, side long, h_key long, h_value long, ok boolean"
            )
        )
        good = peeled.filter("ok")
        found = good if found is None else found.unionByName(good)
        failed = peeled.filter("not ok").select("pair_no", "bucket")
        if failed.isEmpty():
            break
        cells *= 4
        if cells > 1 << 20:  # beyond any bucket of this size: compare what is left record by record
            rest = todo.join(failed, ["pair_no", "bucket"], "left_semi")
            sums = rest.groupBy("pair_no", "bucket", "h_key", "h_value").agg(F.sum("side").alias("side")).filter("side != 0")
            found = found.unionByName(sums.withColumn("ok", F.lit(True)))
            break
        todo = todo.join(F.broadcast(failed) if buckets * top["last"] < 100_000 else failed, ["pair_no", "bucket"], "left_semi")
    kinds = found.groupBy("pair_no", "h_key").agg(F.max("side").alias("new"), F.min("side").alias("old"))
    kinds = kinds.withColumn(
        "change_kind", F.when(F.col("old") > 0, "added").when(F.col("new") < 0, "removed").otherwise("changed")
    )
    # the name of a recovered key: from the newer snapshot, or for a removed key from the older one
    kinds = kinds.withColumn("at", F.when(F.col("change_kind") == "removed", F.col("pair_no") - 1).otherwise(F.col("pair_no")))
    catalogue = F.broadcast(numbered.select("pair_no", "snap"))
    kinds = materialize(kinds.join(catalogue.withColumnsRenamed({"pair_no": "at", "snap": "at_snap"}), "at").join(catalogue, "pair_no").select("at_snap", "h_key", "snap", "change_kind"))
    if kinds.count() <= BROADCAST_CHANGES:
        kinds = F.broadcast(kinds)
    named = lines.select(F.col("snap").alias("at_snap"), "h_key", "key").join(kinds, ["at_snap", "h_key"])
    return named.groupBy("snap", "key").agg(F.first("change_kind").alias("change_kind")).select(F.col("snap").alias(snapshot), F.col("key").alias(key), "change_kind")
