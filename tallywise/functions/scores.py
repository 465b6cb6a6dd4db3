"""Column expressions on numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tfidf_weight(tf: Column, df: Column, n_docs: Column) -> Column:
    """``(1 + ln tf) * ln(n_docs / df)``."""
    return (1 + F.log(tf)) * F.log(n_docs / df)


def safe_ratio(value: Column, norm: Column) -> Column:
    """``value / norm``, and 0.0 where the norm is 0: such a document has only terms that are in
    every document, and none of them tells it apart."""
    return F.when(norm == 0, F.lit(0.0)).otherwise(value / norm)


def stable(score: str | Column, digits: int = 9) -> Column:
    """Round a floating score, so that equal scores added in another order still tie."""
    return F.round(score, digits)
