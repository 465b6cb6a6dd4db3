from tallywise.sinks.text import write_adjacency, write_pairs

__all__ = ["write_adjacency", "write_pairs"]
