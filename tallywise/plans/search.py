"""Ranking documents against keyword queries, from texts to result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywise.operators import (
    count_documents,
    document_frequency,
    mark_asked,
    normalize,
    relevance,
    relevance_batch,
    term_frequency,
    term_table,
    tfidf,
    top_k,
)
from tallywise.operators.pruned import prune_scores, size_class, term_bounds
from tallywise.operators.tfidf import asked_with_norm
from tallywise.plans.words import StopWords
from tallywise.session import Scratch, written


def document_weights(
    docs: DataFrame,
    doc: str = "doc",
    text: str = "text",
    stop: StopWords = (),
    n_docs: int | Column | None = None,
) -> DataFrame:
    """(doc, term, tf, df, tfidf, weight) with weights of norm 1 per document, or all 0.

    ``n_docs`` is the number of documents, by default those in ``docs``.
    """
    tf = term_table(docs, doc, text, stop)
    total = count_documents(docs, doc) if n_docs is None else n_docs
    weights = tfidf(tf, written(document_frequency(tf), "stats"), total, doc=doc, table=True)
    return normalize(weights, tf, doc, keep=["tf", "df", "tfidf"])


def score_documents(
    docs: DataFrame,
    terms: DataFrame,
    doc: str = "doc",
    text: str = "text",
    stop: StopWords = (),
    n_docs: int | Column | None = None,
    table: bool = False,
) -> DataFrame:
    """(doc, score) of the documents with any of the terms; ``terms`` has one column. With ``table`` the
    counts of (doc, term) are written first, which large tables want; otherwise all is one plan."""
    tf = (term_table if table else term_frequency)(docs, doc, text, stop)
    total = count_documents(docs, doc) if n_docs is None else n_docs
    stats = mark_asked(document_frequency(tf), terms)
    stats = written(stats, "stats") if table else stats
    return relevance(tfidf(tf, stats, total, doc=doc, table=table), doc)


def search(
    docs: DataFrame,
    terms: DataFrame,
    doc: str = "doc",
    text: str = "text",
    stop: StopWords = (),
    k: int = 3,
    n_docs: int | Column | None = None,
) -> DataFrame:
    """(score, doc): the ``k`` documents most relevant to the terms and all ties, best first."""
    scores = score_documents(docs, terms, doc, text, stop, n_docs, table=True)
    best = top_k(scores, k, score="score", item=doc)
    return best.select("score", doc).orderBy(F.desc("score"), doc)


def search_batch(
    docs: DataFrame,
    queries: DataFrame,
    query_id: str = "query_id",
    doc: str = "doc",
    text: str = "text",
    stop: StopWords = (),
    k: int = 3,
    n_docs: int | Column | None = None,
    small: bool | None = None,
    prune: bool = False,
) -> DataFrame:
    """(query_id, score, doc): as :func:`search` for each query; ``queries`` is distinct
    (query_id, term). Not ordered. With ``prune``, documents that can't be among the best are left out before they are
    scored (:func:`tallywise.operators.pruned.prune_scores`). ``small`` says whether the queries fit a
    broadcast; unless given they are counted."""
    if not prune:
        tf = term_table(docs, doc, text, stop)
        total = count_documents(docs, doc) if n_docs is None else n_docs
        stats = written(mark_asked(document_frequency(tf), queries.select("term")), "stats")
        weights = tfidf(tf, stats, total, doc=doc, table=True)
        scores = relevance_batch(weights, queries, tf, query_id, doc, small)
        return top_k(scores, k, score="score", item=doc, by=[query_id]).select(query_id, "score", doc)
    scratch = Scratch(docs.sparkSession)
    tf = term_table(docs, doc, text, stop, scratch=scratch)
    total = count_documents(docs, doc) if n_docs is None else n_docs
    stats = scratch.write(mark_asked(document_frequency(tf), queries.select("term")), "stats")
    weights = asked_with_norm(tfidf(tf, stats, total, doc=doc, table=True), tf, doc)
    postings = scratch.write(postings_of(weights, doc), "postings")
    scratch.drop(tf, stats)
    bounds = scratch.write(term_bounds(postings), "bounds")
    found = prune_scores(postings, bounds, queries, k, scratch, query_id, doc, small)
    return top_k(found.scores, k, score="score", item=doc, by=[query_id]).select(query_id, "score", doc)


def postings_of(weights: DataFrame, doc: str, *more: Column) -> DataFrame:
    """(term, ``doc``, tfidf, norm, size, *more) of weights with the norm and number of terms of their
    document."""
    own = (F.col("_norm").alias("norm"), size_class("_terms").alias("size"))
    return weights.select("term", doc, "tfidf", *own, *more)
