from tallywise.operators.counts import (
    common_words,
    common_words_onepass,
    sort_by_count,
    word_count,
)
from tallywise.operators.graph import (
    contributions,
    gather,
    out_degrees,
    pagerank,
    pagerank_step,
    with_out_degree,
)
from tallywise.operators.numbering import number_rows
from tallywise.operators.tfidf import (
    count_documents,
    document_frequency,
    mark_asked,
    normalize,
    relevance,
    relevance_batch,
    term_frequency,
    term_table,
    tfidf,
    with_document_frequency,
)
from tallywise.operators.tokens import drop_stop_words, query_terms, tokenize, word_list
from tallywise.operators.topk import top_k

__all__ = [
    "common_words",
    "common_words_onepass",
    "contributions",
    "count_documents",
    "document_frequency",
    "drop_stop_words",
    "gather",
    "mark_asked",
    "normalize",
    "number_rows",
    "out_degrees",
    "pagerank",
    "pagerank_step",
    "query_terms",
    "relevance",
    "relevance_batch",
    "sort_by_count",
    "term_frequency",
    "term_table",
    "tfidf",
    "tokenize",
    "top_k",
    "with_document_frequency",
    "with_out_degree",
    "word_count",
    "word_list",
]
