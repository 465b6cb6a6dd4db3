"""TF-IDF weights of (document, term) and the relevance of documents to keyword queries."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywise.functions import safe_ratio, stable, tfidf_weight
from tallywise.operators.skew import (
    MAX_BROADCAST_BYTES,
    MAX_BROADCAST_ROWS,
    MAX_HOT,
    SLICES,
    attach_sliced,
    attach_totals,
    fits_broadcast,
    hot_totals,
    sliced_join,
)
from tallywise.operators.tokens import drop_stop_words, is_short, tokenize
from tallywise.session import Scratch, written

TASK_BYTES = 8 * 1024 * 1024  # of text that a task counts the terms of
HOT_BYTES = 64 * 1024 * 1024  # of text in a document whose rows do not go to one task
HOT_TERMS = 1_000_000  # of a document whose norm is not summed by one task
LEAST_BLOCKS = 2  # that queries are cut into when they are not broadcast at once
MAX_BLOCKS = 64
MAX_HOT_TERMS = 100_000  # terms whose number of documents may be broadcast to the rows of a table


def term_frequency(
    docs: DataFrame,
    doc: str = "doc",
    text: str = "text",
    stop: DataFrame | Iterable[str] = (),
) -> DataFrame:
    """(doc, term, tf). A document may span many rows of ``docs``.

    Rows without a document name are left out, as no result could name them. Saying so here also
    gives all readers of the shuffle below the same scan, whether they join on ``doc`` or not.
    """
    named = docs.filter(F.col(doc).isNotNull())
    tokens = tokenize(named, text, keep=[doc], word="term")
    kept = drop_stop_words(tokens, stop, word="term")
    return kept.groupBy(doc, "term").agg(F.count("*").alias("tf"))


def term_table(
    docs: DataFrame,
    doc: str = "doc",
    text: str = "text",
    stop: DataFrame | Iterable[str] = (),
    hot_bytes: int = HOT_BYTES,
    scratch: Scratch | None = None,
    bucketed: bool = False,
) -> DataFrame:
    """:func:`term_frequency` as a table in the shared folder, or in ``scratch``, made by one shuffle of the texts.

    The texts of a document meet in the task that counts its terms, so the far more (document, term) rows
    are not shuffled. If some document has more than ``hot_bytes`` of text, as a small job on the lengths tells,
    the rows are shuffled as :func:`term_frequency` does, which no document makes uneven.

    ``bucketed`` keeps the rows of the table in buckets of their document, if that is where they were counted and the
    stop words are few enough to be broadcast; ``_bucketed`` of the result says so.
    """
    stop = stop if isinstance(stop, DataFrame) else set(stop)
    sizes = docs.filter(F.col(doc).isNotNull()).groupBy(doc).agg(F.sum(F.octet_length(text)).alias("n"))
    most, total = sizes.agg(F.max("n"), F.sum("n")).first()
    met = (most or 0) <= hot_bytes
    if met:
        parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        parts = max(parts, (total or 0) // TASK_BYTES + 1)
        docs = docs.select(doc, text).repartition(parts, doc)
    tf = term_frequency(docs, doc, text, stop)
    if scratch is None:
        return written(tf, "terms")
    dealt = bucketed and met and not isinstance(stop, DataFrame) and is_short(stop)
    table = scratch.bucketed(tf, "terms", parts, [doc], dealt=True) if dealt else scratch.write(tf, "terms")
    table._bucketed = dealt
    return table


def count_documents(docs: DataFrame, doc: str = "doc") -> Column:
    """Number of documents as a scalar subquery, those left without any term included, rows without a
    document name not."""
    return docs.filter(F.col(doc).isNotNull()).select(doc).distinct().agg(F.count("*")).scalar()


def document_frequency(tf: DataFrame) -> DataFrame:
    """(term, df): the number of documents that hold the term.

    Counting ``tf > 0`` and not rows keeps the column in use. The shuffle below is then the same
    as the one the weights read, and Spark tokenises the texts once for both.
    """
    return tf.groupBy("term").agg(F.count_if(F.col("tf") > 0).alias("df"))


def mark_asked(stats: DataFrame, terms: DataFrame) -> DataFrame:
    """Add ``asked`` to the term table: whether ``terms`` (a frame with one column) holds the term.

    Both sides have one row per term here, so no term is hot; a query within the bound is broadcast, as the
    term table of a large corpus is long."""
    asked = terms.toDF("term").distinct().withColumn("asked", F.lit(True))
    asked = F.broadcast(asked) if fits_broadcast(asked) else asked
    marked = stats.join(asked, "term", "left")
    return marked.withColumn("asked", F.coalesce("asked", F.lit(False)))


def with_document_frequency(
    tf: DataFrame,
    stats: DataFrame,
    max_hot: int = MAX_HOT,
    doc: str | None = None,
    table: bool = False,
) -> DataFrame:
    """Attach the term table to each (doc, term) row, balanced when a term is in most documents.

    ``doc`` is the column of ``tf`` besides ``term`` and ``tf`` unless it is named. The counts of
    (doc, term) are made for the term table and for the rows here, and not again for hot terms. If
    ``tf`` is a ``table``, it is read for hot terms apart, whose rows then are not shuffled at all, and more
    terms are held to be hot, MAX_HOT_TERMS at most.
    """
    if table:
        return attach_totals(tf, stats, "term", "df", MAX_HOT_TERMS if max_hot == MAX_HOT else max_hot)
    spread = doc or next(c for c in tf.columns if c not in ("term", "tf"))
    return attach_sliced(tf, stats, "term", "df", spread, max_hot)


def tfidf(
    tf: DataFrame,
    stats: DataFrame,
    n_docs: int | Column,
    max_hot: int = MAX_HOT,
    doc: str | None = None,
    table: bool = False,
) -> DataFrame:
    """Add ``tfidf`` to the rows of :func:`with_document_frequency`."""
    n = F.lit(n_docs) if isinstance(n_docs, int) else n_docs
    weight = tfidf_weight(F.col("tf"), F.col("df"), n)
    return with_document_frequency(tf, stats, max_hot, doc, table).withColumn("tfidf", weight)


def normalize(
    weights: DataFrame,
    tf: DataFrame,
    doc: str = "doc",
    keep: Sequence[str] = (),
    max_hot: int = MAX_HOT,
) -> DataFrame:
    """(doc, term, *keep, weight): ``weight`` is tfidf divided by the L2 norm over all terms of the
    document. ``tf`` is read at once, to find hot documents, and so had better be a table."""
    weight = safe_ratio(F.col("tfidf"), F.col("_norm"))
    normed = with_norm(weights, tf, doc, keep, max_hot)
    return normed.select(doc, "term", *keep, weight.alias("weight"))


def with_norm(
    weights: DataFrame, tf: DataFrame, doc: str, keep: Sequence[str], max_hot: int = MAX_HOT
) -> DataFrame:
    """(doc, term, tfidf, *keep, _norm, _terms): the norm and number of terms of the row's document.

    The rows are shuffled to their document and summed there by a window. If a document has a
    large share of all rows and more than HOT_TERMS, as one small job on ``tf`` tells, its rows are spread over slices by
    term, and its norm is summed from rows added up per task.
    """
    hot = _hot_documents(tf, doc, max_hot)
    carried = list(dict.fromkeys([doc, "term", "tfidf", *keep]))
    rows = weights.select(*carried)
    square = F.col("tfidf") * F.col("tfidf")
    if not hot.limit(1).count():
        same = Window.partitionBy(doc)
        return rows.select(
            *carried, F.sqrt(F.sum(square).over(same)).alias("_norm"), F.count("*").over(same).alias("_terms")
        )
    hot = F.broadcast(hot.withColumnRenamed("_terms", "_hot_terms"))
    tagged = rows.join(hot, doc, "left")
    of_hot = rows.join(hot, doc).groupBy(doc).agg(F.sqrt(F.sum(square)).alias("_hot_norm"))
    slice_of = F.when(F.col("_hot_terms").isNotNull(), F.pmod(F.xxhash64("term"), F.lit(SLICES)))
    same = Window.partitionBy(doc, "_slice")
    summed = tagged.withColumn("_slice", F.coalesce(slice_of, F.lit(-1))).select(
        *carried,
        "_hot_terms",
        F.sqrt(F.sum(square).over(same)).alias("_own"),
        F.count("*").over(same).alias("_count"),
    )
    return summed.join(F.broadcast(of_hot), doc, "left").select(
        *carried,
        F.coalesce("_hot_norm", "_own").alias("_norm"),
        F.coalesce("_hot_terms", "_count").alias("_terms"),
    )


def _hot_documents(tf: DataFrame, doc: str, max_hot: int) -> DataFrame:
    """(doc, _terms) of documents with a large share of all rows that are too many for one task."""
    sizes = tf.groupBy(doc).agg(F.count_if(F.col("tf") > 0).alias("_terms"))
    return hot_totals(sizes, doc, "_terms", max_hot).filter(F.col("_terms") > HOT_TERMS)


def asked_with_norm(
    weights: DataFrame, tf: DataFrame, doc: str, max_hot: int = MAX_HOT
) -> DataFrame:
    """The rows of :func:`with_norm` whose term is ``asked``. The squares of a document's other terms are
    added up per task, so that they are not shuffled one by one; the few hot documents go the other way."""
    if _hot_documents(tf, doc, max_hot).limit(1).count():
        return with_norm(weights, tf, doc, ["asked"], max_hot).filter("asked").drop("asked")
    square = F.sum(F.col("tfidf") * F.col("tfidf")).alias("_squares")
    kept = F.when(F.col("asked"), F.col("term")).alias("term")
    grouped = weights.groupBy(doc, kept).agg(square, F.sum("tfidf").alias("tfidf"), F.count("*").alias("_n"))
    same = Window.partitionBy(doc)
    norm, terms = F.sqrt(F.sum("_squares").over(same)), F.sum("_n").over(same)
    rows = grouped.select(doc, "term", "tfidf", norm.alias("_norm"), terms.alias("_terms"))
    return rows.filter(F.col("term").isNotNull())


def relevance(weights: DataFrame, doc: str = "doc") -> DataFrame:
    """(doc, score) for one query, from weights whose term table went through :func:`mark_asked`:
    the sum of the normalised weights of the asked terms. Documents without any have no row.

    The norm and the sum come from one aggregate, as dividing the sum equals summing the quotients,
    so the normalised weights of the other terms are never made.
    """
    sums = weights.groupBy(doc).agg(
        F.sqrt(F.sum(F.col("tfidf") * F.col("tfidf"))).alias("_norm"),
        F.sum(F.when(F.col("asked"), F.col("tfidf"))).alias("_dot"),
    )
    score = stable(safe_ratio(F.col("_dot"), F.col("_norm")))
    return sums.filter(F.col("_dot").isNotNull()).select(doc, score.alias("score"))


def relevance_batch(
    weights: DataFrame,
    queries: DataFrame,
    tf: DataFrame,
    query_id: str = "query_id",
    doc: str = "doc",
    small: bool | None = None,
) -> DataFrame:
    """(query_id, doc, score) for many queries, ``queries`` being distinct (query_id, term).

    Where the queries fit a broadcast, one aggregate keeps a row for each asked term of a document
    and adds up the squares of all its other terms in one more. A document then has at most as many
    rows as there are asked terms, so the bound on the queries bounds the window that sums the
    norm. The rows meet the queries where the window left them, all pairs of a document on one
    task, and no (query, document) pair is ever shuffled.

    More queries than that are cut into blocks of whole queries, each of which fits a broadcast. The asked rows
    are written in buckets of their document, where they meet one block after the other, so that still no
    pair is shuffled. If that took more than MAX_BLOCKS, or one query fits no broadcast, rows and queries are joined by
    shuffle on the term, hot terms spread over slices. The score is the same sum in all ways, divided by the norm once.
    """
    if small if small is not None else fits_broadcast(queries):
        asked_term = F.when(F.col("asked"), F.col("term")).alias("term")
        grouped = weights.groupBy(doc, asked_term).agg(
            F.sum(F.col("tfidf") * F.col("tfidf")).alias("_squares"), F.sum("tfidf").alias("_tfidf")
        )
        norm = F.sqrt(F.sum("_squares").over(Window.partitionBy(doc)))
        matched = grouped.withColumn("_norm", norm).join(F.broadcast(queries), "term")
    else:
        asked = asked_with_norm(weights, tf, doc).select(doc, "term", "_norm", F.col("tfidf").alias("_tfidf"))
        queries = written(queries.select(query_id, "term"), "queries")
        blocks = _blocks(queries, query_id)
        if blocks:
            buckets = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            asked = Scratch(queries.sparkSession).bucketed(asked, "asked", buckets, [doc], dealt=True)
            parts = [asked.join(F.broadcast(block), "term") for block in blocks]
        else:
            parts = [sliced_join(written(asked, "asked"), queries, "term", spread=doc)]
        return reduce(DataFrame.unionByName, [_scores(part, query_id, doc) for part in parts])
    return _scores(matched, query_id, doc)


def _scores(matched: DataFrame, query_id: str, doc: str) -> DataFrame:
    sums = matched.groupBy(query_id, doc, "_norm").agg(F.sum("_tfidf").alias("_dot"))
    score = safe_ratio(F.col("_dot"), F.col("_norm"))
    return sums.select(query_id, doc, stable(score).alias("score"))


def _blocks(queries: DataFrame, query_id: str) -> list[DataFrame]:
    """``queries`` in blocks that each fit a broadcast; none if one does not, or if there were more than MAX_BLOCKS."""
    size = F.octet_length(F.col(query_id).cast("string")) + F.octet_length("term")
    rows, total = queries.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    # About half full, as a hash deals the queries.
    n = max(LEAST_BLOCKS, 2 * rows // MAX_BROADCAST_ROWS + 1, 2 * total // MAX_BROADCAST_BYTES + 1)
    if n > MAX_BLOCKS:
        return []
    block = F.pmod(F.xxhash64(query_id), F.lit(n))
    dealt = queries.groupBy(block).agg(F.count("*").alias("rows"), F.sum(size).alias("bytes"))
    most, longest = dealt.agg(F.max("rows"), F.max("bytes")).first()
    if (most or 0) > MAX_BROADCAST_ROWS or (longest or 0) > MAX_BROADCAST_BYTES:
        return []
    return [queries.filter(block == i) for i in range(n)]
