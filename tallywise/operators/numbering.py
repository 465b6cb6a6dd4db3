"""Row numbers in a total order, without sending all rows through one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywise.session import Scratch


def number_rows(
    rows: DataFrame, order: Sequence[str], scratch: Scratch, by: Sequence[str] = (), name: str = "place"
) -> DataFrame:
    """``rows`` with ``name``, the place from 1 that a row has by ``order`` (ascending, nulls first), in
    each group of ``by`` or in all. Rows that tie have places next to each other in no set order.

    The rows are range-partitioned and sorted once and written with their position, so that a lost
    task can't deal ties anew. The sizes of the pieces, one for each partition and group in it, are
    then summed up from partition to partition, and a row's place is the sum before its piece and its
    position within. Only the sizes, no more than partitions and groups together, meet a window.
    """
    by = list(by)
    dealt = rows.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order)
    table = scratch.write(dealt.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    table = table.withColumn("_part", F.shiftright("_at", 33))  # where Spark keeps the partition in that id
    pieces = table.groupBy(*by, "_part").agg(F.count("*").alias("_size"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy(*by, F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_size").over(earlier), F.lit(0))
    pieces = pieces.select(
        *[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)],
        F.col("_part").alias("_piece"),
        (before - F.col("_first") + 1).alias("_shift"),
    )
    same = [F.col(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate(by)]
    joined = table.join(pieces, reduce(lambda a, b: a & b, same, F.col("_part") == F.col("_piece")))
    return joined.select(*rows.columns, (F.col("_at") + F.col("_shift")).alias(name))
