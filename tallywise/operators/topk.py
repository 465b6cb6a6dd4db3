"""The best K rows with all ties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywise.session import checkpoint


def top_k(
    rows: DataFrame, k: int, score: str, item: str, by: Sequence[str] = (), buckets: int | None = None
) -> DataFrame:
    """Rows with ``rank() <= k`` by descending ``score`` (per group of ``by``): all rows that
    fewer than ``k`` rows beat. Not ordered. A null score is beaten by every other and ties with
    null scores; nulls in ``by`` are a group like any other.

    The rows may tie without bound, as copies of one document do, so no task may rank a whole
    group. First each group is cut to the best ``k`` and their ties within buckets hashed from
    ``item``, which Spark prunes before the shuffle. From what is left, at most ``k`` rows per
    task are needed to find the score of place ``k``; then a filter at that score gives the
    result, ties spread over all buckets. There are as many ``buckets`` as shuffle partitions,
    unless a number is given.

    A floating score should be rounded before. Its survivors are checkpointed, since the score of
    place ``k`` and the filter must see the very same numbers, and a sum of doubles computed twice
    may differ in the last bit.
    """
    by = list(by)
    if buckets is None:
        buckets = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Null if a null score is among the first k.
    least = F.when(F.count(score) >= k, F.min(score))
    bucket = F.pmod(F.xxhash64(item), F.lit(buckets)).cast("int")
    in_bucket = Window.partitionBy(*by, "_bucket").orderBy(F.desc(score))
    near = (
        rows.withColumn("_bucket", bucket)
        .withColumn("_place", F.rank().over(in_bucket))
        .filter(F.col("_place") <= k)
        .drop("_place")
    )
    if isinstance(rows.schema[score].dataType, (T.DoubleType, T.FloatType)):
        near = checkpoint(near)

    if not by:
        lowest = near.orderBy(F.desc(score)).limit(k).agg(least).scalar()
        return near.filter(F.coalesce(F.col(score) >= lowest, lowest.isNull())).drop("_bucket")

    in_group = Window.partitionBy(*by).orderBy(F.desc(score))
    lowest = (
        near.select(*by, score)
        .withColumn("_place", F.row_number().over(in_group))
        .filter(F.col("_place") <= k)
        .groupBy(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)])
        .agg(least.alias("_lowest"))
        .withColumn("_in", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    )
    same = F.col("_bucket") == F.col("_in")
    for i, c in enumerate(by):
        same &= F.col(c).eqNullSafe(F.col(f"_by{i}"))
    reached = F.coalesce(F.col(score) >= F.col("_lowest"), F.col("_lowest").isNull())
    return near.join(lowest, same).filter(reached).select(rows.columns)
