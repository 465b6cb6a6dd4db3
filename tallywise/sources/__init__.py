from tallywise.sources.adjacency import read_adjacency, read_ranked_adjacency
from tallywise.sources.tables import read_table, spread
from tallywise.sources.text import (
    count_files,
    read_documents,
    read_pairs,
    read_query,
    read_stop_words,
    read_texts,
)

__all__ = [
    "count_files",
    "read_adjacency",
    "read_documents",
    "read_pairs",
    "read_query",
    "read_ranked_adjacency",
    "read_stop_words",
    "read_table",
    "read_texts",
    "spread",
]
