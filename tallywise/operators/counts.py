"""Word counts and the words two inputs share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def word_count(*tokens: DataFrame, word: str = "word") -> DataFrame:
    """(word, n) over one or more token frames together. Counts are added up per task first, so a
    word with a large share of all tokens crosses the shuffle as one row per task."""
    together = reduce(DataFrame.unionByName, [t.select(word) for t in tokens])
    return together.groupBy(word).agg(F.count("*").alias("n"))


def common_words(left: DataFrame, right: DataFrame) -> DataFrame:
    """(word, n) of the words in both count tables, with the smaller of the two counts: the bag
    intersection of the tokens. Both sides have one row per word, so no key is hot, and the join
    uses the partitioning of the two counts."""
    sides = left.withColumnRenamed("n", "c1").join(right.withColumnRenamed("n", "c2"), "word")
    return sides.select("word", F.least("c1", "c2").alias("n"))


def common_words_onepass(left: DataFrame, right: DataFrame) -> DataFrame:
    """The result of :func:`common_words` from two token frames by a single shuffle: both are
    tagged, put together and counted per side in one aggregate."""
    tagged = left.select("word", F.lit("f1").alias("src")).unionByName(
        right.select("word", F.lit("f2").alias("src"))
    )
    counted = tagged.groupBy("word").agg(
        F.count_if(F.col("src") == "f1").alias("c1"), F.count_if(F.col("src") == "f2").alias("c2")
    )
    both = counted.filter((F.col("c1") > 0) & (F.col("c2") > 0))
    return both.select("word", F.least("c1", "c2").alias("n"))


def sort_by_count(counts: DataFrame, descending: bool = False) -> DataFrame:
    """(n, word) in total order by count, ties by word; a range-partitioned sort."""
    order = F.desc("n") if descending else F.asc("n")
    return counts.select("n", "word").orderBy(order, "word")
