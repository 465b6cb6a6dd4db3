"""The training-text pipeline: language ID, line dedup, near-duplicate join, decontamination, BPE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywise.llm.decontaminate import find_leaks
from tallywise.llm.jaccard_join import jaccard_components
from tallywise.llm.langid import train, with_language
from tallywise.llm.line_dedup import dedup_lines
from tallywise.llm.registered import bpe_digests
from tallywise.session import Scratch

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
LEAST_SHARE = 0.5  # of a document's letters in its main language


def _rows(docs: DataFrame, null_last: bool = False) -> DataFrame:
    """The documents, each with a key ``row`` of its own: doc_id and the text's hash, in this order, a
    null doc_id first or last. Rows that repeat doc_id and text have the same key and are one document. The
    key is never null and its parts compare null-safe, so that it can be joined and grouped as it is."""
    kind = f"struct<last:boolean,doc_id:{docs.schema['doc_id'].dataType.simpleString()},key:bigint>"
    last = F.col("doc_id").isNull() if null_last else F.lit(False)
    return docs.select(F.struct(last, F.col("doc_id"), F.xxhash64("text")).cast(kind).alias("row"), *COLUMNS)


def _once(rows: DataFrame) -> DataFrame:
    """One row of each key, the first by its other columns."""
    first = rows.groupBy("row").agg(F.min(F.struct("lang", "source", "n_chars", "doc_id", "text")).alias("first"))
    return first.select("row", *(F.col(f"first.{c}").alias(c) for c in COLUMNS))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, and those of which no language has LEAST_SHARE, go. ``lang`` is
    the language found. Of rows that repeat doc_id and text one stays, here and in the next stages."""
    rows = docs.select(*COLUMNS)
    found = with_language(rows, train(docs)).filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SHARE))
    kept = Scratch(spark).write(found.drop("lang").withColumnRenamed("lang_pred", "lang").select(*COLUMNS), "language")
    return _once(_rows(kept)).select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of runs of lines go. A document of which nothing is left goes too."""
    rows = _rows(docs)
    deduped = dedup_lines(rows, Scratch(spark), id_col="row").filter("text is null or text <> '' or n_removed = 0")
    deduped = deduped.groupBy("row").agg(F.min("text").alias("left"))
    joined = _once(rows).join(deduped, "row")
    joined = joined.withColumn("text", F.col("left")).withColumn("n_chars", F.length("left").cast("long"))
    return joined.select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id, then hash of
    the text; one without doc_id only if all are. Documents without words stay."""
    rows = _rows(docs, null_last=True)
    first = jaccard_components(rows, Scratch(spark), id_col="row").filter("row = component_id").select("row").distinct()
    return _once(rows).join(first, "row", "left_semi").select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, edited or not, go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = _rows(docs)
    leaks = find_leaks(rows, items, Scratch(spark), id_col="row").select("row").distinct()
    return _once(rows).join(leaks, "row", "left_anti").select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's tokens and the round trip, as digests."""
    return bpe_digests(docs.select("doc_id", "text"))


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("encode", encode),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark)
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
