"""Text files: lines, documents, key-value lines, stop words and queries.

A file that does not exist raises. Going on without stop words would be a silent wrong result; to
use none, pass none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywise.operators.tokens import tokenize

LONG_LINE_BYTES = 16 * 1024 * 1024  # from which a line that has a file of its own is read field by field


def read_texts(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(text): one row per line of one or more files or directories, not recursive."""
    return spark.read.text(paths).withColumnRenamed("value", "text")


def file_name() -> Column:
    """Base name of the file a row was read from."""
    # The metadata column is percent-encoded, but url_decode also reads "+" as a space.
    return F.url_decode(F.replace("_metadata.file_name", F.lit("+"), F.lit("%2B")))


def read_documents(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(doc, text): one row per line, ``doc`` being the base name of its file."""
    lines = spark.read.text(paths)
    return lines.select(file_name().alias("doc"), F.col("value").alias("text"))


def count_files(spark: SparkSession, path: str) -> int:
    """Number of files in a directory, empty ones included, which Spark's file scans leave out.
    The files are listed and counted by Spark but not opened."""
    context = spark.sparkContext
    return context._jsc.sc().binaryFiles(path, context.defaultMinPartitions).count()


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """(value) of the lines, without files that are one line of LONG_LINE_BYTES or more, as an adjacency sink
    makes them; and, if there are such files, their fields, cut at each tab.

    The fields are (file, place, value, size): ``place`` orders those of a file, ``size`` is that of the file. No
    task holds such a line. A long line that shares its file with others stays in the lines.
    """
    lines = spark.read.text(paths)
    listed = spark.read.format("binaryFile").load(paths).select("_metadata.file_path", "_metadata.file_size")
    large = {r.file_path: r.file_size for r in listed.filter(F.col("file_size") >= LONG_LINE_BYTES).collect()}
    if not large:
        return lines, None
    # A reader with a limit leaves out longer lines, so their bytes are missing in the sum for their file.
    limited = spark.read.option("mapreduce.input.linerecordreader.line.maxlength", LONG_LINE_BYTES).text(paths)
    limited = limited.filter(F.col("_metadata.file_path").isin(list(large)))
    sums = limited.groupBy("_metadata.file_path").agg(F.sum(F.octet_length("value") + 1).alias("n"))
    whole = {r.file_path: r.n for r in sums.collect()}
    long = [file for file, size in large.items() if whole.get(file, 0) < size]
    if long:
        fields = _fields(spark, paths, long)
        broken = fields.filter(F.col("value").rlike(r"[\r\n]")).select("file").distinct().collect()
        long = sorted(set(long) - {r.file for r in broken})
    if not long:
        return lines, None
    return lines.filter(~F.col("_metadata.file_path").isin(long)), _fields(spark, paths, long)


def _fields(spark: SparkSession, paths: str | Sequence[str], files: list[str]) -> DataFrame:
    fields = spark.read.option("lineSep", "\t").text(paths).filter(F.col("_metadata.file_path").isin(files))
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    file, size = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")
    return fields.select(file, place.alias("place"), "value", size)


def read_pairs(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(key, value) of lines cut at the first tab; without a tab the value is empty. Not a CSV
    scan, whose quote handling would eat words that begin with a quote. The value of a long line that has a file
    of its own is put together only where it is asked for."""
    parts = F.split("value", "\t", 2)
    lines, fields = read_lines(spark, paths)
    pairs = lines.select(parts[0].alias("key"), F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("value"))
    if fields is None:
        return pairs
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda field: field["value"])
    # Each field of a file counts its tab, so the sum is the size if there is one at the end.
    ends = (F.count("*") > 1) & (F.sum(F.octet_length("value") + 1) == F.first("size"))
    values = fields.groupBy("file").agg(
        F.min(F.struct("place", "value")).alias("first"),
        F.concat(F.array_join(F.slice(ordered, 2, F.greatest(F.size(ordered) - 1, F.lit(0))), "\t"), F.when(ends, "\t").otherwise("")).alias("value"),
    )
    return pairs.unionByName(values.select(F.col("first.value").alias("key"), "value"))


def read_stop_words(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(word): one word per line, exactly the line, not trimmed, without repeats."""
    return spark.read.text(paths).toDF("word").distinct()


def read_query(spark: SparkSession, path: str) -> DataFrame:
    """(term): the distinct words of the first line."""
    lines = spark.read.text(path).filter(F.col("_metadata.file_block_start") == 0)
    return tokenize(lines.limit(1), "value", word="term").distinct()
