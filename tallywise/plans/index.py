"""An inverted index in a folder: built once from texts, read by later searches without the texts."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywise.functions import safe_ratio, stable, tfidf_weight
from tallywise.operators import count_documents, document_frequency, term_table, tfidf, top_k
from tallywise.operators.pruned import Pruned, prune_scores, size_class, term_bounds
from tallywise.operators.skew import MAX_HOT, MAX_KEY_BYTES, attach_totals, fits_broadcast
from tallywise.plans.words import StopWords
from tallywise.session import Scratch, clean_shuffles

SHELF_ROWS = 100_000  # postings of a term that share a shelf at most, unless that made more than MAX_HOT shelves
MAX_SHELVES = 1000  # that a search names in its filter


def _shelf(shelves: Column, number: Column) -> Column:
    """The term, and the number of the shelf if the term has several. No term has a space."""
    return F.when(shelves > 1, F.concat("term", F.lit(" "), number.cast("string"))).otherwise(F.col("term"))


def _columns(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def write_index(
    docs: DataFrame,
    path: str,
    doc: str = "doc",
    text: str = "text",
    stop: StopWords = (),
    n_docs: int | None = None,
    buckets: int | None = None,
    shelf_rows: int = SHELF_ROWS,
) -> None:
    """Write the weights of all terms in ``docs`` to ``path``, which must not exist.

    ``postings`` (shelf, term, ``doc``, tfidf, norm, size) is bucketed by shelf and sorted by term. A term has one
    shelf, and one for every ``shelf_rows`` of its postings if it has more, so that no bucket holds all of
    a term that is in most documents. ``terms`` (term, df, shelves) and ``bounds`` (largest weights) have a
    row for each term and size class, ``about`` the number of documents and of buckets. There are as many
    ``buckets`` as shuffle partitions unless a number is given.

    The counts of (document, term) stay in buckets of their document, where they meet its norm, and are shuffled
    once, to their shelf; only those of rarer terms are shuffled before, for the norms.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    if buckets is None:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        tf = term_table(docs, doc, text, stop, scratch=scratch, bucketed=True)
        total = spark.range(1).select(count_documents(docs, doc)).first()[0] if n_docs is None else n_docs
        stats = scratch.write(document_frequency(tf), "stats")
        clean_shuffles(spark)
        rows = stats.agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]
        shelves = F.ceil(F.col("df") / max(shelf_rows, rows / MAX_HOT)).cast("int")
        # Several shelves are told by a broadcast, so that a term too long for one has a single shelf.
        short = F.octet_length("term") <= MAX_KEY_BYTES
        stats = stats.select("term", "df", F.when(short, shelves).otherwise(1).alias("shelves"))
        norms = scratch.write(_norms(tfidf(tf, stats, total, doc=doc, table=True), doc), "norms")
        clean_shuffles(spark)
        postings = _shelved(_with_norms(tf, norms, doc), stats, total, doc, buckets)
        table = f"tallywise_{uuid.uuid4().hex}"
        writer = postings.write.format("parquet").option("path", f"{path}/postings")
        writer.bucketBy(buckets, "shelf").sortBy("term").saveAsTable(table)
        scratch.drop(tf, norms)
        clean_shuffles(spark)
        tables = {"postings": spark.table(table), "bounds": term_bounds(spark.table(table)), "terms": stats}
        tables["bounds"].write.parquet(f"{path}/bounds")
        stats.write.parquet(f"{path}/terms")
        # An empty table may have no file that tells its columns.
        columns = [F.lit(_columns(df)).alias(name) for name, df in tables.items()]
        spark.sql(f"drop table {table}")
        about = spark.range(1).select(F.lit(total).cast("long").alias("n_docs"), F.lit(buckets).alias("buckets"), F.lit(doc).alias("doc"), *columns)
        about.write.parquet(f"{path}/about")
    finally:
        scratch.release()


def _norms(weights: DataFrame, doc: str) -> DataFrame:
    """(doc, norm, n_terms) of each document, from sums that the tasks make."""
    square = F.col("tfidf") * F.col("tfidf")
    return weights.groupBy(doc).agg(F.sqrt(F.sum(square)).alias("norm"), F.count("*").alias("n_terms"))


def _with_norms(tf: DataFrame, norms: DataFrame, doc: str) -> DataFrame:
    """(doc, term, tf, norm, size). In buckets of their document the rows stay where they are."""
    if tf._bucketed:
        joined = tf.join(norms.hint("shuffle_hash"), doc)
    else:
        joined = attach_totals(tf, norms, doc, "n_terms")
    return joined.select(doc, "term", "tf", "norm", size_class("n_terms").alias("size"))


def _shelved(rows: DataFrame, stats: DataFrame, n_docs: int, doc: str, buckets: int) -> DataFrame:
    """The postings, dealt to their shelves. What is shuffled is as short as can be: the shelf tells the term, and a
    term of a single shelf meets all its documents there, where they are counted."""
    several = stats.filter(F.col("shelves") > 1)
    tagged = rows.join(F.broadcast(several), "term", "left")
    shelf = _shelf(F.col("shelves"), F.pmod(F.xxhash64(doc), F.col("shelves")))
    dealt = tagged.select(shelf.alias("shelf"), F.col(doc).alias("_doc"), "tf", "norm", "size", "df").repartition(buckets, "shelf")
    n = F.coalesce("df", F.count("*").over(Window.partitionBy("shelf")))
    weight = tfidf_weight(F.col("tf"), n, F.lit(n_docs)).alias("tfidf")
    term = F.substring_index("shelf", " ", 1).alias("term")
    return dealt.select(term, F.col("_doc").alias(doc), weight, "norm", "size", "shelf")


@dataclass(frozen=True)
class SearchIndex:
    """What :func:`write_index` wrote. The results are those of :func:`tallywise.plans.search` and
    :func:`tallywise.plans.search_batch` on the texts."""

    postings: DataFrame
    terms: DataFrame
    bounds: DataFrame
    n_docs: int
    doc: str

    def lookup(self, terms: DataFrame) -> DataFrame:
        """The postings of ``terms`` (one column). With up to MAX_SHELVES shelves, as any query of a person has,
        the shelves are named in a filter, and the scan opens their buckets only."""
        wanted = terms.toDF("term").distinct().join(self.terms, "term")
        wanted = wanted.select("term", "shelves", F.explode(F.sequence(F.lit(0), F.col("shelves") - 1)).alias("n"))
        wanted = wanted.select("term", _shelf(F.col("shelves"), F.col("n")).alias("shelf"))
        named = wanted.limit(MAX_SHELVES + 1).collect()
        if len(named) <= MAX_SHELVES:
            shelves, words = {r.shelf for r in named}, {r.term for r in named}
            return self.postings.filter(F.col("shelf").isin(sorted(shelves)) & F.col("term").isin(sorted(words)))
        # Shelves are distinct, so the join is of one row each with its postings, in the buckets as they are.
        listed = F.broadcast(wanted) if fits_broadcast(wanted) else wanted
        return self.postings.join(listed, ["shelf", "term"], "left_semi")

    def search(self, terms: DataFrame, k: int = 3) -> DataFrame:
        """(score, doc): the ``k`` documents most relevant to the terms and all ties, best first."""
        sums = self.lookup(terms).groupBy(self.doc, "norm").agg(F.sum("tfidf").alias("dot"))
        scores = sums.select(self.doc, stable(safe_ratio(F.col("dot"), F.col("norm"))).alias("score"))
        best = top_k(scores, k, score="score", item=self.doc)
        return best.select("score", self.doc).orderBy(F.desc("score"), self.doc)

    def prune(self, queries: DataFrame, k: int, query_id: str = "query_id", small: bool | None = None) -> Pruned:
        """The scores that the best documents of each query are among, and what it took to find them."""
        spark = self.postings.sparkSession
        asked = queries.select("term").distinct()
        scratch = Scratch(spark)
        postings = scratch.write(self.lookup(asked).select("term", self.doc, "tfidf", "norm", "size"), "postings")
        bounds = scratch.write(self.bounds.join(asked, "term", "left_semi"), "bounds")
        return prune_scores(postings, bounds, queries, k, scratch, query_id, self.doc, small)

    def search_batch(self, queries: DataFrame, k: int = 3, query_id: str = "query_id", small: bool | None = None) -> DataFrame:
        """(query_id, score, doc) for each of ``queries``, distinct (query_id, term). Not ordered."""
        scores = self.prune(queries, k, query_id, small).scores
        return top_k(scores, k, score="score", item=self.doc, by=[query_id]).select(query_id, "score", self.doc)


def open_index(spark: SparkSession, path: str) -> SearchIndex:
    """The index in ``path``; its postings become a table of the session's catalogue, for the sake of the
    buckets, and stay one until the session ends."""
    about = spark.read.parquet(f"{path}/about").first()
    table = f"tallywise_{uuid.uuid4().hex}"
    spark.sql(
        f"create table {table} ({about.postings}) using parquet options (path '{path}/postings') "
        f"clustered by (shelf) sorted by (term) into {about.buckets} buckets"
    )
    terms, bounds = (spark.read.schema(about[name]).parquet(f"{path}/{name}") for name in ("terms", "bounds"))
    return SearchIndex(spark.table(table), terms, bounds, about.n_docs, about.doc)
