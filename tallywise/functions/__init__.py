from tallywise.functions.scores import safe_ratio, stable, tfidf_weight
from tallywise.functions.text import trim_control, words

__all__ = ["safe_ratio", "stable", "tfidf_weight", "trim_control", "words"]
