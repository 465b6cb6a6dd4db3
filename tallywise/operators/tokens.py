"""Words of texts, stop words and query terms."""

from __future__ import annotations

from collections.abc import Collection, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywise.functions import words
from tallywise.operators.skew import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS, drop_keys

MAX_LITERALS = 500


def tokenize(
    texts: DataFrame, text: str = "text", keep: Sequence[str] = (), word: str = "word"
) -> DataFrame:
    """One row for each word of ``text``, with the columns in ``keep``. Case and punctuation stay."""
    return texts.select(*keep, F.explode(words(text)).alias(word)).filter(F.col(word) != "")


def word_list(spark: SparkSession, items: Iterable[str], word: str = "word") -> DataFrame:
    """A one-column frame of the distinct ``items``. A short list is a literal in the plan."""
    distinct = sorted(set(items))
    if len(distinct) > MAX_LITERALS:
        return spark.createDataFrame([(item,) for item in distinct], f"`{word}` string")
    literal = F.array(*[F.lit(item) for item in distinct]).cast("array<string>")
    return spark.range(1).select(F.explode(literal).alias(word))


def is_short(items: Collection[str]) -> bool:
    """Whether distinct ``items`` are within the broadcast bound."""
    return len(items) <= MAX_BROADCAST_ROWS and sum(len(i.encode()) for i in items) <= MAX_BROADCAST_BYTES


def drop_stop_words(
    tokens: DataFrame, stop: DataFrame | Iterable[str], word: str = "word"
) -> DataFrame:
    """Drop the rows whose word is a stop word; exact and case-sensitive, keeps repeats.

    ``stop`` is a frame with one column or a collection of words.
    """
    if isinstance(stop, DataFrame):
        listed = stop.toDF(word)
        return drop_keys(tokens, listed.filter(F.col(word).isNotNull()).distinct(), word)
    items = set(stop)
    if not items:
        return tokens
    return drop_keys(tokens, word_list(tokens.sparkSession, items, word), word, is_short(items))


def query_terms(queries: DataFrame, query_id: str, text: str = "text") -> DataFrame:
    """Distinct (``query_id``, term): each term of a query counts once."""
    return tokenize(queries, text, keep=[query_id], word="term").distinct()
