from tallywise.plans.index import SearchIndex, open_index, write_index
from tallywise.plans.search import document_weights, search, search_batch
from tallywise.plans.words import count_words, shared_words, top_shared_words

__all__ = [
    "SearchIndex",
    "count_words",
    "document_weights",
    "open_index",
    "search",
    "search_batch",
    "shared_words",
    "top_shared_words",
    "write_index",
]
