"""One query per operator, bound to the driver's tables. All read whole tables."""

from __future__ import annotations

from collections.abc import Callable
from math import ceil, sqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywise import operators as op
from tallywise import plans, sinks, sources
from tallywise.functions import stable, words
from tallywise.operators.tokens import word_list
from tallywise.plans import files as programs
from tallywise.plans.search import score_documents
from tallywise.session import Scratch, scratch_path, written

# Parameters of the queries, the same in the oracle SQL.
STOP_WORDS = ["the", "of", "and", "to", "in", "a", "is", "that"]
KEYWORDS = ["thon", "erin", "und", "dans", "heing", "rely", "the"]
FEW = ["erin", "dans"]
BUCKETS = 50
TOLERANCE = 1.0
MOST_ROUNDS = 40


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return sources.spread(sources.read_table(spark, sf, "documents", "doc_id", "text"))


def _texts(spark: SparkSession, sf: str, name: str, where: str | None = None) -> DataFrame:
    return sources.spread(sources.read_table(spark, sf, name, "text", where=where))


def tokenize(spark: SparkSession, sf: str) -> DataFrame:
    return op.tokenize(_documents(spark, sf), keep=["doc_id"])


def word_count(spark: SparkSession, sf: str) -> DataFrame:
    return plans.count_words(_texts(spark, sf, "documents"))


def text_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Documents written as text files, a directory per language, and read back by file."""
    path = scratch_path(spark, "text_scan")
    docs = sources.read_table(spark, sf, "documents", "lang", "text")
    docs.write.partitionBy("lang").text(path)
    lines = spark.read.text(path).select(
        "lang", "value", F.col("_metadata.file_path"), sources.text.file_name().alias("doc")
    )
    named = F.url_decode("file_path").endswith(F.concat(F.lit("/"), "doc"))
    in_line = F.array_remove(words("value"), "")
    return lines.groupBy("lang").agg(
        F.count("*").alias("n_lines"),
        F.count_if(named & ~F.contains("doc", F.lit("/"))).alias("n_named"),
        F.sum(F.size(in_line)).alias("n_words"),
    )


def tsv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "tsv_roundtrip")
    sinks.write_pairs(word_count(spark, sf), path, files=3)
    pairs = sources.read_pairs(spark, path)
    return pairs.select(F.col("key").alias("word"), F.col("value").cast("bigint").alias("n"))


def word_count_union(spark: SparkSession, sf: str) -> DataFrame:
    return plans.count_words(_texts(spark, sf, "documents"), _texts(spark, sf, "conversations"))


def stopword_filter(spark: SparkSession, sf: str) -> DataFrame:
    return op.drop_stop_words(tokenize(spark, sf), STOP_WORDS)


def word_count_nostop(spark: SparkSession, sf: str) -> DataFrame:
    return plans.count_words(_texts(spark, sf, "documents"), stop=STOP_WORDS)


def _two_languages(spark: SparkSession, sf: str) -> list[DataFrame]:
    return [_texts(spark, sf, "documents", where=f"lang = '{lang}'") for lang in ("en", "fr")]


def common_words(spark: SparkSession, sf: str) -> DataFrame:
    counts = [plans.count_words(t, stop=STOP_WORDS) for t in _two_languages(spark, sf)]
    return op.common_words(*counts)


def common_words_onepass(spark: SparkSession, sf: str) -> DataFrame:
    return plans.shared_words(*_two_languages(spark, sf), stop=STOP_WORDS)


def common_words_sorted(spark: SparkSession, sf: str) -> DataFrame:
    return op.sort_by_count(common_words_onepass(spark, sf))


def topk_common_words(spark: SparkSession, sf: str) -> DataFrame:
    return plans.top_shared_words(*_two_languages(spark, sf), stop=STOP_WORDS, k=20)


def _term_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return op.term_frequency(_documents(spark, sf), doc="doc_id", stop=STOP_WORDS)


def _plain_documents(spark: SparkSession, sf: str) -> DataFrame:
    """For what shuffles the texts itself."""
    return sources.read_table(spark, sf, "documents", "doc_id", "text")


def _term_table(spark: SparkSession, sf: str) -> DataFrame:
    return op.term_table(_plain_documents(spark, sf), doc="doc_id", stop=STOP_WORDS)


def _n_docs(spark: SparkSession, sf: str) -> Column:
    return op.count_documents(sources.read_table(spark, sf, "documents", "doc_id"), "doc_id")


def term_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return _term_frequency(spark, sf)


def doc_frequency(spark: SparkSession, sf: str) -> DataFrame:
    tf = _term_table(spark, sf)
    joined = op.with_document_frequency(tf, _document_frequency(tf), doc="doc_id", table=True)
    return joined.select("doc_id", "term", "tf", "df")


def _document_frequency(tf: DataFrame) -> DataFrame:
    """Written, as it is read for hot terms, for their bound and for the others."""
    return written(op.document_frequency(tf), "stats")


def _weights(spark: SparkSession, sf: str, tf: DataFrame) -> DataFrame:
    return op.tfidf(tf, _document_frequency(tf), _n_docs(spark, sf), doc="doc_id", table=True)


def tfidf(spark: SparkSession, sf: str) -> DataFrame:
    weights = _weights(spark, sf, _term_table(spark, sf))
    return weights.select("doc_id", "term", stable("tfidf").alias("tfidf"))


def tfidf_normalized(spark: SparkSession, sf: str) -> DataFrame:
    tf = _term_table(spark, sf)
    weights = op.normalize(_weights(spark, sf, tf), tf, doc="doc_id")
    return weights.select("doc_id", "term", stable("weight").alias("weight"))


def query_terms(spark: SparkSession, sf: str) -> DataFrame:
    items = sources.read_table(spark, sf, "benchmark", "item_id", "text")
    return op.query_terms(items, "item_id")


def doc_relevance(spark: SparkSession, sf: str) -> DataFrame:
    return score_documents(
        _plain_documents(spark, sf),
        word_list(spark, KEYWORDS, "term"),
        doc="doc_id",
        stop=STOP_WORDS,
        n_docs=_n_docs(spark, sf),
        table=True,
    )


def topk_documents(spark: SparkSession, sf: str) -> DataFrame:
    return plans.search(
        _plain_documents(spark, sf),
        word_list(spark, KEYWORDS, "term"),
        doc="doc_id",
        stop=STOP_WORDS,
        k=3,
        n_docs=_n_docs(spark, sf),
    )


def search_batch(spark: SparkSession, sf: str, small: bool | None = None) -> DataFrame:
    return plans.search_batch(
        _plain_documents(spark, sf),
        query_terms(spark, sf),
        query_id="item_id",
        doc="doc_id",
        stop=STOP_WORDS,
        k=3,
        n_docs=_n_docs(spark, sf),
        small=small,
    )


def search_batch_shuffled(spark: SparkSession, sf: str) -> DataFrame:
    """The same by the way that is taken for more queries than fit a broadcast."""
    return search_batch(spark, sf, small=False)


def search_index(spark: SparkSession, sf: str) -> DataFrame:
    """An index of all documents, written once and asked twice, for KEYWORDS and for FEW."""
    path = scratch_path(spark, "search_index")
    plans.write_index(_plain_documents(spark, sf), path, doc="doc_id", stop=STOP_WORDS)
    index = plans.open_index(spark, path)
    found = [index.search(word_list(spark, asked, "term"), k=3) for asked in (KEYWORDS, FEW)]
    numbered = [f.select(F.lit(i).alias("query"), "score", "doc_id") for i, f in enumerate(found)]
    return numbered[0].unionByName(numbered[1])


def search_index_batch(spark: SparkSession, sf: str) -> DataFrame:
    """The items of ``benchmark`` asked of an index of all documents."""
    path = scratch_path(spark, "search_index")
    plans.write_index(_plain_documents(spark, sf), path, doc="doc_id", stop=STOP_WORDS)
    return plans.open_index(spark, path).search_batch(query_terms(spark, sf), k=3, query_id="item_id")


def _search_files(spark: SparkSession, docs: DataFrame, files: int, query: DataFrame, name: str) -> DataFrame:
    """The search program on ``docs`` dealt by id to ``files`` files, each of which is a document."""
    folder = scratch_path(spark, name)
    bucket = F.pmod(F.col("doc_id"), F.lit(files)).cast("int")
    docs.repartitionById(files, bucket).select("text").write.text(f"{folder}/docs")
    word_list(spark, STOP_WORDS, "word").write.text(f"{folder}/stop")
    query.coalesce(1).write.text(f"{folder}/query")
    inputs = (f"{folder}/docs", f"{folder}/query")
    programs.search_files(spark, *inputs, f"{folder}/found", stop_path=f"{folder}/stop")
    found = sources.read_pairs(spark, f"{folder}/found")
    number = F.regexp_extract("value", r"part-(\d+)", 1).cast("bigint").alias("bucket")
    return found.select(F.col("key").cast("double").alias("score"), number)


def search_files(spark: SparkSession, sf: str) -> DataFrame:
    """The search program on all texts, written to BUCKETS files."""
    docs = sources.read_table(spark, sf, "documents", "doc_id", "text").dropna()
    query = word_list(spark, [" ".join(KEYWORDS)], "line")
    return _search_files(spark, docs, BUCKETS, query, "search_files")


def search_growing_files(spark: SparkSession, sf: str) -> DataFrame:
    """The same for the words of a benchmark item, with as many files as the root of the number of texts, so
    that rare words still tell files apart when the table grows."""
    docs = sources.read_table(spark, sf, "documents", "doc_id", "text").dropna()
    items = sources.read_table(spark, sf, "benchmark", "item_id", "text")
    query = items.orderBy("item_id").limit(1).select("text")
    return _search_files(spark, docs, max(ceil(sqrt(docs.count())), 1), query, "search_growing_files")


def _part_supplier(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Parts and suppliers, linked both ways once for each line item."""
    items = sources.spread(sources.read_table(spark, sf, "lineitem", "l_partkey", "l_suppkey"))
    part = F.concat(F.lit("P"), "l_partkey")
    supplier = F.concat(F.lit("S"), "l_suppkey")
    both = F.array(
        F.struct(part.alias("src"), supplier.alias("dst")),
        F.struct(supplier.alias("src"), part.alias("dst")),
    )
    edges = items.select(F.inline(both))
    return edges.select(F.col("src").alias("id")).distinct(), edges


def _customer_nation_region(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Customers point to their nation and nations to their region, which points nowhere."""
    customer = sources.read_table(spark, sf, "customer", "c_custkey", "c_nationkey")
    nation = sources.read_table(spark, sf, "nation", "n_nationkey", "n_regionkey")
    region = sources.read_table(spark, sf, "region", "r_regionkey")

    def named(letter: str, key: str) -> Column:
        return F.concat(F.lit(letter), key)

    nodes = customer.select(named("C", "c_custkey").alias("id"))
    nodes = nodes.unionByName(nation.select(named("N", "n_nationkey").alias("id")))
    nodes = nodes.unionByName(region.select(named("R", "r_regionkey").alias("id")))
    edges = customer.select(
        named("C", "c_custkey").alias("src"), named("N", "c_nationkey").alias("dst")
    ).unionByName(
        nation.select(named("N", "n_nationkey").alias("src"), named("R", "n_regionkey").alias("dst"))
    )
    return nodes, edges


def graph_edges(spark: SparkSession, sf: str) -> DataFrame:
    _, edges = _part_supplier(spark, sf)
    return op.with_out_degree(edges)


def adjacency_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "adjacency")
    sinks.write_adjacency(*_part_supplier(spark, sf), path)
    _, edges = sources.read_adjacency(spark, path)
    return op.with_out_degree(edges)


def adjacency_hub(spark: SparkSession, sf: str) -> DataFrame:
    """Written and read back with a node that links to the part of every line item: each link with
    its copies, and the lines that its node has in the files."""
    nodes, edges = _part_supplier(spark, sf)
    hub = F.lit("H")
    items = sources.spread(sources.read_table(spark, sf, "lineitem", "l_partkey"))
    links = items.select(hub.alias("src"), F.concat(F.lit("P"), "l_partkey").alias("dst"))
    path = scratch_path(spark, "hub")
    all_nodes = nodes.unionByName(nodes.select(hub.alias("id")).limit(1))
    sinks.write_adjacency(all_nodes, edges.unionByName(links), path, ordered=True)
    _, linked = sources.read_adjacency(spark, path)
    lines = sources.read_pairs(spark, path).groupBy("key").agg(F.count("*").alias("n_lines"))
    copies = linked.groupBy("src", "dst").agg(F.count("*").alias("copies"))
    joined = copies.join(lines, F.col("src") == F.col("key"))
    return joined.select("src", "dst", "copies", "n_lines")


def _first_ranks(nodes: DataFrame) -> DataFrame:
    return nodes.select("id", F.lit(1.0).alias("rank"))


def pagerank_contribs(spark: SparkSession, sf: str) -> DataFrame:
    nodes, edges = _part_supplier(spark, sf)
    credits = op.contributions(edges, _first_ranks(nodes))
    return credits.select("src", "dst", stable("credit").alias("credit"))


def pagerank_step(spark: SparkSession, sf: str) -> DataFrame:
    nodes, edges = _part_supplier(spark, sf)
    ranks = op.pagerank_step(nodes, edges, _first_ranks(nodes))
    return ranks.select("id", stable("rank").alias("rank"))


def pagerank(spark: SparkSession, sf: str) -> DataFrame:
    ranks = op.pagerank(*_part_supplier(spark, sf))
    return ranks.select("id", stable("rank").alias("rank"))


def pagerank_tol(spark: SparkSession, sf: str) -> DataFrame:
    """Rounds until no rank changes by more than TOLERANCE."""
    ranks = op.pagerank(*_part_supplier(spark, sf), iterations=MOST_ROUNDS, tol=TOLERANCE)
    return ranks.select("id", stable("rank").alias("rank"))


def word_count_ordered(spark: SparkSession, sf: str) -> DataFrame:
    """The word counts in the order of the words, each with its place in it."""
    return op.number_rows(word_count(spark, sf), ["word"], Scratch(spark))


def pagerank_dangling(spark: SparkSession, sf: str) -> DataFrame:
    ranks = op.pagerank(*_customer_nation_region(spark, sf))
    return ranks.select("id", stable("rank").alias("rank"))


def ranked_adjacency_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Ranks after one round written with the out-links of each node, and read back."""
    nodes, edges = _customer_nation_region(spark, sf)
    path = scratch_path(spark, "ranked_adjacency")
    sinks.write_adjacency(op.pagerank_step(nodes, edges, _first_ranks(nodes)), edges, path)
    ranks, linked = sources.read_ranked_adjacency(spark, path)
    degrees = op.out_degrees(linked).withColumnRenamed("src", "id")
    joined = ranks.join(degrees, "id", "left")
    return joined.select(
        "id",
        stable("rank").alias("rank"),
        F.coalesce("out_degree", F.lit(0)).alias("out_degree"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    functions = [
        text_scan,
        tokenize,
        word_count,
        word_count_ordered,
        tsv_roundtrip,
        word_count_union,
        stopword_filter,
        word_count_nostop,
        common_words,
        common_words_onepass,
        common_words_sorted,
        topk_common_words,
        term_frequency,
        doc_frequency,
        tfidf,
        tfidf_normalized,
        query_terms,
        doc_relevance,
        topk_documents,
        search_batch,
        search_batch_shuffled,
        search_index,
        search_index_batch,
        search_files,
        search_growing_files,
        graph_edges,
        adjacency_roundtrip,
        adjacency_hub,
        pagerank_contribs,
        pagerank_step,
        pagerank,
        pagerank_tol,
        pagerank_dangling,
        ranked_adjacency_roundtrip,
    ]
    return {function.__name__: function for function in functions}
