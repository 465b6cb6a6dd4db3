"""Joins that stay balanced when one key holds a large share of all rows.

The number of hot keys is bounded by construction: a key is hot when it holds more than
``1 / MAX_HOT`` of all rows, so there are fewer than ``MAX_HOT`` of them whatever the data size, and
with keys of at most ``MAX_KEY_BYTES`` the broadcast of the hot keys stays below 10 MB and some
overhead. All other keys hold at most ``1 / MAX_HOT`` of the rows each and can be shuffled.
A hot key longer than that is shuffled too; adaptive execution splits its partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_HOT = 10_000
MAX_KEY_BYTES = 1024
SLICES = 256
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 32 * 1024 * 1024


def fits_broadcast(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """Count the rows and the bytes of ``df`` (one small job) against the broadcast bound."""
    size = sum((F.octet_length(F.col(c).cast("string")) for c in df.columns), F.lit(0))
    rows, total = df.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return rows <= max_rows and total <= max_bytes


def hot_totals(totals: DataFrame, key: str, size: str, max_hot: int = MAX_HOT) -> DataFrame:
    """The rows of ``totals`` (one per key) whose ``size`` exceeds ``1 / max_hot`` of its sum. With more
    than MAX_HOT, only shorter keys, so that all of them stay within MAX_BROADCAST_BYTES."""
    share = totals.agg(F.sum(size)).scalar() / max_hot
    # One test on key and size together: a test on the key alone would move down into the scan of
    # this branch, which could then not share its shuffle with the others.
    longest = min(MAX_KEY_BYTES, MAX_BROADCAST_BYTES // max_hot)
    short = F.octet_length(F.col(key).cast("string")) <= longest
    return totals.filter(F.when(short, F.col(size)).otherwise(0) > share)


def hot_keys(rows: DataFrame, key: str, max_hot: int = MAX_HOT) -> DataFrame:
    """The keys that hold more than ``1 / max_hot`` of ``rows``."""
    counted = rows.groupBy(key).agg(F.count("*").alias("_size"))
    return hot_totals(counted, key, "_size", max_hot).select(key, F.lit(True).alias("_hot"))


def attach_totals(
    rows: DataFrame, totals: DataFrame, key: str, size: str, max_hot: int = MAX_HOT, hashed: bool = False
) -> DataFrame:
    """Inner join of ``rows`` with ``totals``, which has one row per ``key`` and in ``size`` the
    number of ``rows`` with that key.

    Rows of hot keys meet their total by broadcast and are not shuffled at all; only the rest is.
    The split is an outer join and a null test, not an anti-join: Catalyst moves an anti-join below
    the aggregate that makes ``rows``, which would then be computed once for each branch.
    ``hashed`` says that a partition of ``totals`` fits a hash table, so that ``rows`` need not be sorted.
    """
    hot = hot_totals(totals, key, size, max_hot)
    totals = totals.hint("shuffle_hash") if hashed else totals
    tagged = rows.join(F.broadcast(hot), key, "left")
    of_hot = tagged.filter(F.col(size).isNotNull())
    of_rest = tagged.filter(F.col(size).isNull()).select(rows.columns).join(totals, key)
    return of_hot.unionByName(of_rest)


def attach_sliced(
    rows: DataFrame, totals: DataFrame, key: str, size: str, spread: str, max_hot: int = MAX_HOT
) -> DataFrame:
    """The join of :func:`attach_totals` by one shuffle, so that ``rows`` is read once only.

    Rows of a hot key are spread over slices by a hash of column ``spread``, and its total is repeated for
    each slice. That fits rows which come out of an aggregate, as each read would run it again.
    """
    share = totals.agg(F.sum(size)).scalar() / max_hot
    hot = hot_totals(totals, key, size, max_hot).select(key, F.lit(True).alias("_hot"))
    slice_of = F.when(F.col("_hot"), F.pmod(F.xxhash64(spread), F.lit(SLICES))).otherwise(F.lit(0))
    left = rows.join(F.broadcast(hot), key, "left").withColumn("_slice", slice_of.cast("int")).drop("_hot")
    # Each total knows by itself whether its key is hot.
    short = F.octet_length(F.col(key).cast("string")) <= MAX_KEY_BYTES
    last = F.when(F.when(short, F.col(size)).otherwise(0) > share, F.lit(SLICES - 1)).otherwise(F.lit(0))
    right = totals.withColumn("_slice", F.explode(F.sequence(F.lit(0), last)))
    return left.join(right, [key, "_slice"]).drop("_slice")


def sliced_join(
    rows: DataFrame, other: DataFrame, key: str, spread: str, max_hot: int = MAX_HOT
) -> DataFrame:
    """Inner join by shuffle where both sides repeat ``key`` and neither fits a broadcast.

    Rows of a hot key are spread over slices by a hash of column ``spread``, and the rows of
    ``other`` with that key are repeated for each slice.
    """
    hot = F.broadcast(hot_keys(rows, key, max_hot))
    slice_of = F.when(F.col("_hot"), F.pmod(F.xxhash64(spread), F.lit(SLICES))).otherwise(F.lit(0))
    all_slices = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SLICES - 1))).otherwise(
        F.array(F.lit(0))
    )
    left = rows.join(hot, key, "left").withColumn("_slice", slice_of.cast("int")).drop("_hot")
    right = other.join(hot, key, "left").withColumn("_slice", F.explode(all_slices)).drop("_hot")
    return left.join(right, [key, "_slice"]).drop("_slice")


def drop_keys(
    rows: DataFrame, keys: DataFrame, key: str, small: bool | None = None
) -> DataFrame:
    """``rows`` whose ``key`` is not in ``keys`` (a frame with that one column).

    A list within the broadcast bound is a broadcast anti-join. A longer one is joined by shuffle, for
    which ``rows`` is made once; where a key is hot, adaptive execution splits its rows among tasks, as
    the join keeps or drops each by itself.
    """
    if small if small is not None else fits_broadcast(keys):
        return rows.join(F.broadcast(keys), key, "left_anti")
    return rows.join(keys.hint("merge"), key, "left_anti").select(rows.columns)
