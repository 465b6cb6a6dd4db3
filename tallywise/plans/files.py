"""The programs: paths in, a directory of tab-separated text out. All fail if it exists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallywise.operators import pagerank, sort_by_count
from tallywise.plans.search import search
from tallywise.plans.words import StopWords, count_words, shared_words, top_shared_words
from tallywise.sinks import write_adjacency, write_pairs
from tallywise.sources import (
    count_files,
    read_adjacency,
    read_documents,
    read_query,
    read_stop_words,
    read_texts,
)


def _stop(spark: SparkSession, path: str | None) -> StopWords:
    return () if path is None else read_stop_words(spark, path)


def word_count_files(
    spark: SparkSession,
    inputs: list[str],
    output: str,
    stop_path: str | None = None,
    files: int | None = None,
) -> None:
    """``word<TAB>n`` over one or more inputs together, ordered by word. As in all programs, ``files``
    sets the number of output files; the order goes on from one to the next."""
    texts = [read_texts(spark, path) for path in inputs]
    counted = count_words(*texts, stop=_stop(spark, stop_path))
    write_pairs(counted, output, files, order=["word"])


def common_words_files(
    spark: SparkSession,
    left: str,
    right: str,
    output: str,
    stop_path: str | None = None,
    files: int | None = None,
) -> None:
    """``n<TAB>word`` of the shared words, by count ascending."""
    stop = _stop(spark, stop_path)
    shared = shared_words(read_texts(spark, left), read_texts(spark, right), stop=stop)
    shared = sort_by_count(shared)
    write_pairs(shared, output, files, order=shared.columns if files else ())


def top_common_words_files(
    spark: SparkSession, left: str, right: str, output: str, stop_path: str | None = None, k: int = 20
) -> None:
    """``n<TAB>word`` of the ``k`` most frequent shared words and ties, by count descending."""
    stop = _stop(spark, stop_path)
    best = top_shared_words(read_texts(spark, left), read_texts(spark, right), stop=stop, k=k)
    write_pairs(best, output)


def search_files(
    spark: SparkSession,
    documents: str,
    query: str,
    output: str,
    stop_path: str | None = None,
    k: int = 3,
    n_docs: int | None = None,
) -> None:
    """``score<TAB>doc`` of the ``k`` best files for the words in the first line of ``query``.
    Without ``n_docs`` the files are counted, empty ones too."""
    total = count_files(spark, documents) if n_docs is None else n_docs
    docs = read_documents(spark, documents)
    best = search(docs, read_query(spark, query), stop=_stop(spark, stop_path), k=k, n_docs=total)
    write_pairs(best, output)


def pagerank_files(
    spark: SparkSession,
    graph: str,
    output: str,
    iterations: int = 10,
    damping: float = 0.85,
    on_missing: str = "error",
    files: int | None = None,
    link_sep: str = " ",
) -> DataFrame:
    """``node<TAB>rank link link...`` after the rounds, ordered by node; returns the ranks. Names
    with white space need ``link_sep="\t"``."""
    nodes, edges = read_adjacency(spark, graph)
    ranks = pagerank(nodes, edges, iterations, damping, on_missing=on_missing)
    write_adjacency(ranks, edges, output, files, ordered=True, link_sep=link_sep)
    return ranks
