"""The best documents for many queries, of which only those are scored in full that can be among them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywise.functions import safe_ratio, stable
from tallywise.operators.skew import (
    MAX_BROADCAST_BYTES,
    MAX_BROADCAST_ROWS,
    fits_broadcast,
    sliced_join,
)
from tallywise.session import Scratch

SEEDS = 12  # rarest terms of a query that find its first documents
FOUND = 16  # times k documents that they find
LEAD = 0.7  # of the floor that a query's later terms must be able to reach, or they are looked up last
MARGIN = 1e-8  # more than rounding a score and adding in another order can change


def size_class(n_terms: str | Column) -> Column:
    """The class of a document by its number of terms, two classes for each doubling."""
    return F.floor(2 * F.log2(n_terms)).cast("int")


def term_bounds(postings: DataFrame) -> DataFrame:
    """(term, size, n, most): of the documents of each size class that hold the term, their number and the
    largest weight. A short document's terms weigh far more than a long one's, so that one bound
    for all of them would say little."""
    weight = safe_ratio(F.col("tfidf"), F.col("norm"))
    return postings.groupBy("term", "size").agg(F.count("*").alias("n"), F.max(weight).alias("most"))


@dataclass(frozen=True)
class Pruned:
    """``scores`` (query_id, doc, score) of all documents that can be among the best, and the tables that
    led to them: ``seeds``, ``pairs`` (partly scored documents of queries), ``survivors``, ``probes``; and
    ``plan``, which terms of a query are looked up first."""

    scores: DataFrame
    stages: dict[str, DataFrame]
    plan: DataFrame

    def made(self) -> dict[str, int]:
        """How many rows each stage made, and in ``matched`` how many postings were joined for the pairs."""
        made = {name: table.count() for name, table in self.stages.items()}
        joined = self.plan.filter("leads").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        return made | {"matched": joined}


def prune_scores(
    postings: DataFrame,
    bounds: DataFrame,
    queries: DataFrame,
    k: int,
    scratch: Scratch,
    query_id: str = "query_id",
    doc: str = "doc",
    small: bool | None = None,
) -> Pruned:
    """The scores that the ``k`` best documents of each query, and all that tie with them, are among.

    ``postings`` is (term, ``doc``, tfidf, norm, size), ``bounds`` what :func:`term_bounds` makes of
    it, ``queries`` distinct (``query_id``, term). All scores are exact; the pruning is by bounds.

    Seeds: the rarest terms of a query find some documents, which are scored in full. Place ``k``
    among them is a floor, as place ``k`` of all can't be lower. Pairs: a query's terms stand in order of
    rarity, and for each size class the largest weights of a term and all later ones add up to
    what a document can reach that holds none before. Where that is below the floor, the later terms
    need not be looked up to find documents; only the terms before, the rare ones, make pairs. The
    line is drawn lower, at LEAD of the floor, so that the terms left out can add little. Survivors: pairs
    that can still reach the floor with them. Probes: the terms left out are looked up for those documents
    only. A query with fewer than ``k`` documents has no floor, and
    nothing of it is pruned.
    """
    weight = safe_ratio(F.col("tfidf"), F.col("norm"))
    rarity = bounds.groupBy("term").agg(F.sum("n").alias("df"))
    by_rarity = Window.partitionBy(query_id).orderBy("df", "term")
    asked = queries.select(query_id, "term").join(rarity, "term").withColumn("place", F.row_number().over(by_rarity))
    asked = scratch.write(asked.select(query_id, "term", "place"), "asked")
    # The seeds are so many documents a query, and what is joined for them that times the queries' terms.
    times = FOUND * k
    few = fits_broadcast(asked, MAX_BROADCAST_ROWS // times, MAX_BROADCAST_BYTES // times) if small is None else small

    found = _matched(postings, asked.filter(F.col("place") <= SEEDS).select(query_id, "term"), ["term"], doc, few)
    seeds = found.groupBy(query_id, doc).agg(F.sum(weight).alias("part"))
    seeds = scratch.write(_first(seeds, "part", FOUND * k, query_id, doc), "seeds")
    probes = seeds.select(query_id, doc).join(asked.select(query_id, "term"), query_id)
    full = _probed(postings, probes, doc, few).groupBy(query_id, doc).agg(F.sum(weight).alias("score"))
    best = _first(full, "score", k, query_id, doc).groupBy(query_id).agg(F.min("score").alias("floor"), F.count("*").alias("n"))
    floors = scratch.write(best.filter(F.col("n") == k).select(query_id, (F.col("floor") - MARGIN).alias("floor")), "floors")

    later = Window.partitionBy(query_id, "size").orderBy(F.desc("place"))
    tail, left = F.sum("most").over(later), F.count("*").over(later)
    # Squares of a document's weights add up to 1, so m of its terms have sqrt(m) together at most.
    held = F.least(left, F.pow(F.lit(2.0), (F.col("size") + 1) / 2))
    plan = asked.join(bounds.select("term", "size", "n", "most"), "term").withColumn("reach", F.least(tail, F.sqrt(held)))
    plan = plan.join(floors, query_id, "left").withColumn("leads", F.coalesce(F.col("reach") >= LEAD * F.col("floor"), F.lit(True)))
    plan = scratch.write(plan.select(query_id, "size", "term", "n", "reach", "floor", "leads"), "plan")
    small = fits_broadcast(plan) if small is None else small
    rest = plan.filter("not leads").groupBy(query_id, "size").agg(F.max("reach").alias("rest"))

    leading = plan.filter("leads").select(query_id, "size", "term")
    pairs = _matched(postings, leading, ["term", "size"], doc, small)
    pairs = pairs.groupBy(query_id, doc, "norm", "size").agg(F.sum("tfidf").alias("dot"))
    pairs = scratch.write(pairs, "pairs")
    reachable = safe_ratio(F.col("dot"), F.col("norm")) + F.coalesce("rest", F.lit(0.0)) >= F.col("floor")
    kept = pairs.join(_bounded(rest, small), [query_id, "size"], "left").join(_bounded(floors, small), query_id, "left")
    kept = scratch.write(kept.filter(F.coalesce(reachable, F.lit(True))).select(query_id, doc, "norm", "size", "dot"), "survivors")

    omitted = plan.filter("not leads").select(query_id, "size", "term")
    probes = kept.select(query_id, doc, "size").join(_bounded(omitted, small), [query_id, "size"])
    probes = scratch.write(probes.select(query_id, doc, "term"), "probes")
    more = _probed(postings, probes, doc, small and fits_broadcast(probes)).groupBy(query_id, doc).agg(F.sum("tfidf").alias("more"))
    dot = F.col("dot") + F.coalesce("more", F.lit(0.0))
    scores = kept.join(more, [query_id, doc], "left").select(query_id, doc, stable(safe_ratio(dot, F.col("norm"))).alias("score"))
    return Pruned(scores, {"seeds": seeds, "pairs": pairs, "survivors": kept, "probes": probes}, plan)


def _bounded(df: DataFrame, small: bool) -> DataFrame:
    """``df`` marked for a broadcast if it was found to be within the bound of one."""
    return F.broadcast(df) if small else df


def _matched(postings: DataFrame, wanted: DataFrame, keys: list[str], doc: str, small: bool) -> DataFrame:
    """The postings of the wanted terms, repeated for each query: by broadcast, or with hot terms sliced."""
    if small:
        return postings.join(F.broadcast(wanted), keys)
    renamed = wanted.select(*[F.col(c).alias(f"_{c}" if c in keys[1:] else c) for c in wanted.columns])
    joined = sliced_join(postings, renamed, "term", spread=doc)
    for c in keys[1:]:
        joined = joined.filter(F.col(c) == F.col(f"_{c}")).drop(f"_{c}")
    return joined


def _probed(postings: DataFrame, probes: DataFrame, doc: str, small: bool) -> DataFrame:
    """The postings of (document, term), each found at most once a query."""
    return postings.join(_bounded(probes, small), [doc, "term"])


def _first(parts: DataFrame, score: str, k: int, query_id: str, doc: str) -> DataFrame:
    """``k`` documents of each query with the largest scores: of each bucket first, then of all."""
    buckets = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = parts.withColumn("_bucket", F.pmod(F.xxhash64(doc), F.lit(buckets)))
    for by in ([query_id, "_bucket"], [query_id]):
        order = Window.partitionBy(*by).orderBy(F.desc(score), doc)
        parts = parts.withColumn("_at", F.row_number().over(order)).filter(F.col("_at") <= k)
    return parts.drop("_bucket", "_at")
