"""Counting words and comparing two inputs, from texts to result."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from tallywise.operators import (
    common_words_onepass,
    drop_stop_words,
    sort_by_count,
    tokenize,
    top_k,
    word_count,
)

StopWords = DataFrame | Iterable[str]


def count_words(*texts: DataFrame, text: str = "text", stop: StopWords = ()) -> DataFrame:
    """(word, n) over one or more inputs together, without the stop words."""
    return word_count(*[drop_stop_words(tokenize(t, text), stop) for t in texts])


def shared_words(
    left: DataFrame, right: DataFrame, text: str = "text", stop: StopWords = ()
) -> DataFrame:
    """(word, n): the words of both inputs with the smaller of their two counts."""
    sides = [drop_stop_words(tokenize(t, text), stop) for t in (left, right)]
    return common_words_onepass(*sides)


def top_shared_words(
    left: DataFrame, right: DataFrame, text: str = "text", stop: StopWords = (), k: int = 20
) -> DataFrame:
    """(n, word): the ``k`` most frequent shared words and all ties, most frequent first."""
    best = top_k(shared_words(left, right, text, stop), k, score="n", item="word")
    return sort_by_count(best, descending=True)
