"""Adjacency files: ``node<TAB>link<TAB>link...``, one line per node."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywise.functions import trim_control
from tallywise.sources.text import read_lines


def _edges(lines: DataFrame, links: Column) -> DataFrame:
    linked = lines.select(F.col("id").alias("src"), F.explode(links).alias("dst"))
    return linked.withColumn("dst", trim_control("dst")).filter(F.col("dst") != "")


def read_adjacency(
    spark: SparkSession, paths: str | Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """``nodes (id)`` and ``edges (src, dst)``.

    Blank lines and empty fields are dropped, names are trimmed. A repeated link stays repeated.
    A node may have several lines: it is one node with the links of all of them. A long line that has a file
    of its own is read field by field, so that no task holds it.
    """
    parts = F.split("value", "\t")
    lines, fields = read_lines(spark, paths)
    lines = lines.filter(trim_control("value") != "")
    lines = lines.select(trim_control(parts[0]).alias("id"), parts.alias("parts"))
    edges = _edges(lines, F.slice("parts", F.lit(2), F.size("parts")))
    ids = lines.select("id")
    if fields is not None:
        trimmed = fields.select("file", "place", trim_control("value").alias("dst"))
        first = trimmed.groupBy("file").agg(
            F.min(F.struct("place", "dst")).alias("first"), F.max(F.col("dst") != "").alias("filled")
        )
        first = first.filter("filled").select("file", F.col("first.dst").alias("src"), F.col("first.place").alias("start"))
        linked = trimmed.join(F.broadcast(first), "file").filter(F.col("place") != F.col("start"))
        edges = edges.unionByName(linked.select("src", "dst").filter(F.col("dst") != ""))
        ids = ids.unionByName(first.select(F.col("src").alias("id")))
    return ids.distinct(), edges


def read_ranked_adjacency(
    spark: SparkSession, paths: str | Sequence[str], link_sep: str = " "
) -> tuple[DataFrame, DataFrame]:
    """``ranks (id, rank)`` and ``edges (src, dst)`` of lines ``node<TAB>rank link link...``, with
    what ``link_sep`` says between the links."""
    pair = F.split("value", "\t", 2)
    lines = spark.read.text(paths).filter(trim_control("value") != "")
    lines = lines.select(trim_control(pair[0]).alias("id"), F.split(pair[1], link_sep).alias("parts"))
    ranks = lines.select("id", F.col("parts")[0].cast("double").alias("rank")).distinct()
    return ranks, _edges(lines, F.slice("parts", F.lit(2), F.size("parts")))
