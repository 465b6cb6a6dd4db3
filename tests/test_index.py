"""Pruned batch search and the inverted index, against scoring everything; plans of the weights."""

from __future__ import annotations

import random
import re

import pytest
from conftest import TESTDATA, nodes_of, rows
from pyspark.sql import functions as F
from test_search import close, model

from tallywise import operators as op
from tallywise import plans
from tallywise.operators import pruned, skew
from tallywise.operators.pruned import prune_scores, term_bounds
from tallywise.operators.tfidf import asked_with_norm, with_norm
from tallywise.plans import index as indexes
from tallywise.plans.search import postings_of
from tallywise.registry.registered import STOP_WORDS
from tallywise.session import Scratch


def corpus(seed, size=120):
    """Documents of very different lengths, copies, and queries that repeat parts of them."""
    chance = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(80)]
    weights = [1 / (i + 1) for i in range(80)]
    lines = []
    for i in range(size):
        lines.append((f"d{i}", " ".join(chance.choices(vocabulary, weights, k=chance.choice([1, 2, 5, 20, 60])))))
    lines += [(f"copy{i}", "w3 w4 w70 w9") for i in range(4)] + [("none", ""), ("null", None), ("all", " ".join(vocabulary))]
    queries = {q: set(chance.choices(vocabulary, k=chance.choice([1, 3, 12, 40]))) for q in range(12)}
    queries |= {q: set((lines[q][1] or "").split()) | {"w1", "w2"} for q in range(20, 30)}
    queries[99] = {"nothing"}
    queries[98] = {"w3", "w4", "w70", "w9"}
    return lines, queries


def frames(spark, lines, queries):
    docs = spark.createDataFrame([(*line, "clash") for line in lines], "doc string, text string, term string")
    asked = spark.createDataFrame([(q, t) for q, ts in queries.items() for t in ts], "query_id int, term string")
    return docs, asked


@pytest.mark.parametrize(("small", "k", "seeds"), [(True, 2, 8), (False, 3, 1), (None, 1, 2)])
def test_batch_and_index_against_brute_force(spark, tmp_path, monkeypatch, small, k, seeds):
    monkeypatch.setattr(pruned, "SEEDS", seeds)
    monkeypatch.setattr(skew, "SLICES", 3)
    lines, queries = corpus(k)
    docs, asked = frames(spark, lines, queries)
    want = model([(d, t or "") for d, t in lines], queries, {"w0"}, k)
    close(set(rows(plans.search_batch(docs, asked, stop=["w0"], k=k, small=small))), want)
    plans.write_index(docs, str(tmp_path / "index"), stop=["w0"], buckets=3, shelf_rows=20)
    index = plans.open_index(spark, str(tmp_path / "index"))
    close(set(rows(index.search_batch(asked, k=k, small=small))), want)
    for q in (20, 98, 99):
        one = index.search(asked.filter(F.col("query_id") == q).select("term"), k=k)
        close({(q, s, d) for s, d in rows(one)}, {x for x in want if x[0] == q})


def test_pruning_makes_few_pairs(spark):
    """Of the benchmark's items far fewer rows are joined than share a term, few pairs are scored in full,
    and the best are the same."""
    folder = TESTDATA / "sf0.01"
    docs = spark.read.parquet(str(folder / "documents.parquet"))
    items = spark.read.parquet(str(folder / "benchmark.parquet"))
    scratch = Scratch(spark)
    tf = scratch.write(op.term_frequency(docs, "doc_id", stop=STOP_WORDS), "tf")
    asked = scratch.write(op.query_terms(items, "item_id"), "asked")
    stats = op.mark_asked(op.document_frequency(tf), asked.select("term"))
    weights = with_norm(op.tfidf(tf, stats, docs.count(), doc="doc_id"), tf, "doc_id", ["asked"])
    postings = scratch.write(postings_of(weights.filter("asked"), "doc_id"), "postings")
    shared = postings.join(asked, "term").select("item_id", "doc_id")
    every, pairs = shared.count(), shared.distinct().count()
    found = prune_scores(postings, term_bounds(postings), asked, 3, scratch, "item_id", "doc_id")
    made = found.made()
    assert made["matched"] + made["probes"] < every * 0.6 and made["survivors"] < pairs / 4
    full = op.relevance_batch(op.tfidf(tf, stats, docs.count(), doc="doc_id"), asked, tf, "item_id", "doc_id")
    best = [op.top_k(s, 3, "score", "doc_id", by=["item_id"]).select("item_id", "score", "doc_id") for s in (full, found.scores)]
    close(*(set(rows(b)) for b in best))


def test_a_search_opens_its_buckets_only(spark, tmp_path):
    lines, _ = corpus(7)
    docs, _ = frames(spark, lines, {1: {"x"}})
    plans.write_index(docs, str(tmp_path / "index"), buckets=8, shelf_rows=1_000)
    index = plans.open_index(spark, str(tmp_path / "index"))
    # Files of other buckets are left out in any scan; the plan only says so where it keeps buckets apart.
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        plan = index.lookup(op.word_list(spark, ["w70"], "term"))._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 8" in plan
    assert index.lookup(op.word_list(spark, ["not there"], "term")).count() == 0
    again = plans.open_index(spark, str(tmp_path / "index"))
    assert rows(again.search(op.word_list(spark, ["w70"], "term"))) == rows(index.search(op.word_list(spark, ["w70"], "term")))
    with pytest.raises(Exception, match="non-empty|exist"):
        plans.write_index(docs, str(tmp_path / "index"))


def test_a_term_of_all_documents_has_several_shelves(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(indexes, "MAX_SHELVES", 5)
    docs = spark.createDataFrame([(i, f"all x{i % 7} y{i}") for i in range(100)] + [(200, "z")], "id long, text string")
    plans.write_index(docs, str(tmp_path / "index"), doc="id", buckets=4, shelf_rows=10)
    index = plans.open_index(spark, str(tmp_path / "index"))
    assert {r.term: r.shelves for r in index.terms.collect() if r.term in ("all", "x1", "y1")} == {"all": 10, "x1": 2, "y1": 1}
    assert index.postings.filter("term = 'all'").select("shelf").distinct().count() > 5
    for words in (["all"], ["all", "x1"], ["y1"], ["all", *[f"y{i}" for i in range(20)]]):
        asked = op.word_list(spark, words, "term")
        assert rows(index.search(asked, k=4)) == rows(plans.search(docs, asked, doc="id", k=4))


def test_postings_are_shuffled_once(spark, tmp_path, monkeypatch):
    """What is written to the shelves comes from buckets of documents, by one shuffle; and no document name, stop word
    list or repeated document makes other weights."""
    lines, queries = corpus(3)
    docs, asked = frames(spark, lines, queries)
    made = []
    shelved = indexes._shelved
    monkeypatch.setattr(indexes, "_shelved", lambda *args: made.append(shelved(*args)) or made[-1])
    dealt = indexes._with_norms
    monkeypatch.setattr(indexes, "_with_norms", lambda *args: made.append(dealt(*args)) or made[-1])
    plans.write_index(docs, str(tmp_path / "index"), stop=["w0"], buckets=3, shelf_rows=20)
    texts = [df._jdf.queryExecution().optimizedPlan().toString() for df in made]
    assert [t.count("RepartitionByExpression") for t in texts] == [0, 1] and all("Window" not in t for t in texts[:1])
    # A list of stop words in a frame, a document in many rows, and rows without a name.
    words = spark.createDataFrame([("w0",)], "word string")
    parted = docs.unionByName(docs.filter("doc in ('all', 'd7')")).unionByName(docs.limit(3).withColumn("doc", F.lit(None).cast("string")))
    plans.write_index(parted, str(tmp_path / "parted"), stop=words, shelf_rows=20)
    twice = [(d, f"{t or ''} {t or ''}" if d in ("all", "d7") else t or "") for d, t in lines]
    want = model(twice, queries, {"w0"}, 3)
    close(set(rows(plans.open_index(spark, str(tmp_path / "parted")).search_batch(asked, k=3))), want)


def test_rows_by_document_meet_their_norm_without_a_shuffle(spark):
    lines, _ = corpus(2)
    docs, _ = frames(spark, lines, {1: {"x"}})
    scratch = Scratch(spark)
    tf = op.term_table(docs, scratch=scratch, bucketed=True)
    norms = scratch.write(indexes._norms(op.tfidf(tf, op.document_frequency(tf), 100, table=True), "doc"), "norms")
    rows_ = indexes._shelved(indexes._with_norms(tf, norms, "doc"), spark.sql("select 'w1' as term, 9L as df, 2 as shelves"), 100, "doc", 3)
    execution = rows_._jdf.queryExecution()
    execution.toRdd().count()
    shuffles = [n.toString() for n in nodes_of(execution.executedPlan()) if n.nodeName() == "Exchange"]
    assert all("shelf" in s or "doc" in s for s in shuffles)
    assert sum("shelf" in s.split("\n")[0] for s in shuffles) == 1
    # Besides, the norms may be shuffled, a row for each document.
    assert not any("term" in s.split("\n")[0] or "tf#" in s.split("\n")[0] for s in shuffles if "shelf" not in s.split("\n")[0])
    scratch.release()


def test_empty_index(spark, tmp_path):
    docs = spark.createDataFrame([], "doc string, text string")
    plans.write_index(docs, str(tmp_path / "index"))
    index = plans.open_index(spark, str(tmp_path / "index"))
    assert rows(index.search(op.word_list(spark, ["a"], "term"))) == []
    assert rows(index.search_batch(spark.createDataFrame([(1, "a")], "query_id int, term string"))) == []


def test_counts_are_made_twice_at_most(spark, tmp_path):
    """In the executed plans: the (document, term) counts, however often they are read."""
    lines, _ = corpus(1)
    frames(spark, lines, {1: {"x"}})[0].write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    tf = op.term_frequency(docs)
    asked = op.word_list(spark, ["w3"], "term")
    stats = op.document_frequency(tf)
    for df in (
        op.with_document_frequency(tf, stats),
        op.tfidf(tf, stats, op.count_documents(docs)),
        op.relevance(op.tfidf(tf, op.mark_asked(stats, asked), 10)),
        plans.document_weights(docs),
        plans.search(docs, asked),
    ):
        execution = df._jdf.queryExecution()
        execution.toRdd().count()
        plan = [n.verboseString(99) for n in nodes_of(execution.executedPlan()) if "Aggregate" in n.nodeName()]
        counts = [p for p in plan if re.search(r"keys=\[doc#\d+, term#\d+\], functions=\[count\(1\)\]", p.replace("Keys [2]: ", "keys=").replace("\n", ""))
                  or re.search(r"doc#\d+, term#\d+.*Functions \[1\]: \[count\(1\)\]", p.replace("\n", " "))]
        assert len(counts) <= 2
        assert not any("collect_set" in p for p in plan)


@pytest.mark.parametrize("max_hot", [1, 3, 10_000])
def test_norms_with_and_without_hot_documents(spark, max_hot):
    lines, _ = corpus(4)
    docs, _ = frames(spark, lines, {1: {"x"}})
    tf = Scratch(spark).write(op.term_frequency(docs), "tf")
    weights = op.tfidf(tf, op.document_frequency(tf), 100)
    got = with_norm(weights, tf, "doc", ["tf"], max_hot)
    assert got.columns == ["doc", "term", "tfidf", "tf", "_norm", "_terms"]
    norms = weights.groupBy("doc").agg(F.sqrt(F.sum(F.col("tfidf") ** 2)).alias("norm"), F.count("*").alias("n"))
    joined = got.join(norms, "doc").collect()
    assert len(joined) == tf.count()
    marked = weights.withColumn("asked", F.col("term").isin("w1", "w5", "w70"))
    want = sorted((r.doc, r.term, round(r.tfidf, 9), round(r._norm, 9), r._terms) for r in joined if r.term in ("w1", "w5", "w70"))
    few = asked_with_norm(marked, tf, "doc", max_hot)
    assert sorted((r.doc, r.term, round(r.tfidf, 9), round(r._norm, 9), r._terms) for r in few.collect()) == want
    assert all(r._terms == r.n and r._norm == pytest.approx(r.norm) for r in joined)
