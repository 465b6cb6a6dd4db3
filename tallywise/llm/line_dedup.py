"""Delete later copies of runs of lines (operator 6), with built-in SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywise.operators.skew import attach_totals
from tallywise.session import Scratch


def _ranks(lines: Column, depth: int) -> Column:
    """The rank of the first ``depth`` lines of each suffix that has as many, by prefix doubling: the
    rank of 2k lines is that of the ranks of k lines at a place and k places on; the last step
    overlaps. Ranks are hashes, so that all documents agree on them without meeting."""
    ranks, width = F.transform(lines, lambda line: F.xxhash64(line)), 1
    while width < depth:
        step = min(width, depth - width)
        count = F.greatest(F.size(lines) - width - step + 1, F.lit(0))
        near, far = F.slice(ranks, F.lit(1), count), F.slice(ranks, F.lit(1 + step), count)
        ranks = F.zip_with(near, far, lambda a, b: F.xxhash64(a, b))
        width += step
    return ranks


def dedup_lines(docs: DataFrame, scratch: Scratch, min_lines: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, text, n_lines, n_removed): each text without the lines of repeated runs, except in
    a run's first place.

    A run is ``min_lines`` consecutive lines or more that stand in two places; the first place is that of the
    smallest id, then line number. Suffixes of all documents' line sequences are ranked by prefix
    doubling up to ``min_lines``: suffixes of equal rank are those whose longest common prefix has that
    many lines or more, so each interval of equal rank is a repeated run, and the windows of a
    maximal run cover it. Deeper ranks would split the intervals but cover the same lines, so the
    doubling ends there. Every window with an earlier copy goes, also where it overlaps that copy.

    A null text stays null and has no lines; an empty text has one empty line. Rows that repeat id
    and text are one document and come out alike; rows that share only the id are ordered by a hash
    of the text. A null id comes before all others. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("key", F.xxhash64("text"))
    lines = F.split("text", "\n", -1)
    cut = rows.filter("text is not null").withColumn("lines", lines)
    windows = cut.select("id", "key", F.posexplode(_ranks(F.col("lines"), min_lines)).alias("place", "rank"))
    windows = scratch.write(windows, "windows")
    place = F.struct("id", "key", "place")
    runs = windows.groupBy("rank").agg(F.count("*").alias("copies"), F.min(place).alias("first"))
    runs = scratch.write(runs.filter("copies > 1"), "runs")
    copies = attach_totals(windows, runs, "rank", "copies").filter(~place.eqNullSafe(F.col("first")))
    covered = F.flatten(F.transform("places", lambda i: F.sequence(i, i + (min_lines - 1))))
    gone = copies.groupBy("id", "key").agg(F.collect_set("place").alias("places"))
    gone = gone.select(F.col("id").alias("gone_id"), F.col("key").alias("gone_key"), F.array_distinct(covered).alias("gone"))

    same = (F.col("key") == F.col("gone_key")) & F.col("id").eqNullSafe(F.col("gone_id"))
    joined = rows.join(gone, same, "left").withColumn("lines", lines)
    every = F.sequence(F.lit(0), F.size("lines") - 1)
    kept = F.transform(F.array_except(every, F.col("gone")), lambda i: F.get(F.col("lines"), i))
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    count = F.when(F.col("text").isNull(), 0).otherwise(F.size("lines")).cast("long")
    removed = F.coalesce(F.size("gone"), F.lit(0))
    removed = F.when(F.col("gone").isNull(), 0).otherwise(removed).cast("long")
    return joined.select(F.col("id").alias(id_col), text.alias("text"), count.alias("n_lines"), removed.alias("n_removed"))
