from __future__ import annotations

import math
import sys
from collections import Counter, defaultdict

import pytest
from conftest import nodes_of, rows
from pyspark.sql import functions as F

from tallywise import operators as op
from tallywise import plans
from tallywise.operators import skew
from tallywise.plans.search import score_documents

LINES = [
    ("f1.txt", "the cat sat"), ("f1.txt", "the cat ran"), ("f2.txt", "the dog sat of a dog dog"),
    ("f3.txt", "a bird sang the song"), ("f4.txt", "cat bird"),
]
STOP = ["the", "of", "a"]
N4 = {
    ("f1.txt", "cat"): (2, 2, 1.173600194, 0.603666547),
    ("f1.txt", "ran"): (1, 1, 1.386294361, 0.713070375),
    ("f1.txt", "sat"): (1, 2, 0.693147181, 0.356535187),
    ("f2.txt", "dog"): (3, 1, 2.909294382, 0.972771695),
    ("f2.txt", "sat"): (1, 2, 0.693147181, 0.231765462),
    ("f3.txt", "bird"): (1, 2, 0.693147181, 0.333333333),
    ("f3.txt", "sang"): (1, 1, 1.386294361, 0.666666667),
    ("f3.txt", "song"): (1, 1, 1.386294361, 0.666666667),
    ("f4.txt", "bird"): (1, 2, 0.693147181, 0.707106781),
    ("f4.txt", "cat"): (1, 2, 0.693147181, 0.707106781),
}
N10 = {
    ("f1.txt", "cat"): 0.696256674, ("f1.txt", "ran"): 0.588323398,
    ("f1.txt", "sat"): 0.411220408, ("f2.txt", "dog"): 0.948760228,
    ("f2.txt", "sat"): 0.315996882, ("f3.txt", "bird"): 0.443082464,
    ("f3.txt", "sang"): 0.633907694, ("f3.txt", "song"): 0.633907694,
    ("f4.txt", "bird"): 0.707106781, ("f4.txt", "cat"): 0.707106781,
}


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(LINES, "doc string, text string")


def terms(spark, words):
    return op.word_list(spark, words, "term")


def test_weights(spark, docs):
    got = plans.document_weights(docs, stop=STOP)
    assert got.columns == ["doc", "term", "tf", "df", "tfidf", "weight"]
    table = {r[:2]: (r[2], r[3], round(r[4], 9), round(r[5], 9)) for r in rows(got)}
    assert table == N4


def test_weights_with_given_number_of_documents(spark, docs):
    got = plans.document_weights(docs, stop=STOP, n_docs=10)
    assert {r[:2]: round(r[5], 9) for r in rows(got)} == N10


@pytest.mark.parametrize(
    ("n_docs", "want"),
    [
        (None, [(0.972771695, "f2.txt"), (0.707106781, "f4.txt"), (0.603666547, "f1.txt")]),
        (10, [(0.948760228, "f2.txt"), (0.707106781, "f4.txt"), (0.696256674, "f1.txt")]),
    ],
)
def test_search(spark, docs, n_docs, want):
    query = op.tokenize(
        spark.createDataFrame([("cat dog the cat",)], "text string"), word="term"
    )
    got = plans.search(docs, query, stop=STOP, n_docs=n_docs)
    assert got.columns == ["score", "doc"]
    assert [tuple(r) for r in got.collect()] == want


def test_no_known_term_gives_no_row(spark, docs):
    assert rows(plans.search(docs, terms(spark, ["fish", "the"]), stop=STOP)) == []
    assert rows(plans.search(docs, terms(spark, []), stop=STOP)) == []


def test_term_in_every_document_weighs_nothing(spark):
    docs = spark.createDataFrame([("p", "x y"), ("q", "x y")], "doc string, text string")
    assert {r[5] for r in rows(plans.document_weights(docs))} == {0.0}
    assert rows(plans.search(docs, terms(spark, ["x"]))) == [(0.0, "p"), (0.0, "q")]


def test_documents_without_terms_count(spark):
    data = [("p", "x"), ("q", "y"), ("r", "the"), ("s", "")]
    docs = spark.createDataFrame(data, "doc string, text string")
    got = {r[0]: r[4] for r in rows(plans.document_weights(docs, stop=["the"]))}
    assert got == {"p": pytest.approx(math.log(4)), "q": pytest.approx(math.log(4))}


def test_words_with_marks_stay_whole(spark):
    docs = spark.createDataFrame([("a:b", "a@b k=v http://x"), ("c", "z")], "doc string, text string")
    got = [r[:2] for r in rows(plans.document_weights(docs))]
    assert got == [("a:b", "a@b"), ("a:b", "http://x"), ("a:b", "k=v"), ("c", "z")]


def model(lines, queries, stop, k):
    """Brute force over all documents and queries."""
    words = defaultdict(Counter)
    for doc, text in lines:
        words[doc].update(w for w in text.split() if w not in stop)
    df = Counter(w for counts in words.values() for w in counts)
    result = set()
    weights = {}
    for doc, counts in words.items():
        raw = {w: (1 + math.log(n)) * math.log(len(words) / df[w]) for w, n in counts.items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        weights[doc] = {w: v / norm if norm else 0.0 for w, v in raw.items()}
    for query, asked in queries.items():
        scores = {
            doc: round(sum(w[t] for t in asked if t in w), 9)
            for doc, w in weights.items()
            if any(t in w for t in asked)
        }
        for doc, score in scores.items():
            if sum(other > score for other in scores.values()) < k:
                result.add((query, score, doc))
    return result


def close(got, want):
    rounded = [{(q, round(s, 8), d) for q, s, d in side} for side in (got, want)]
    assert rounded[0] == rounded[1]


@pytest.mark.parametrize("small", [True, False, None])
def test_batch_against_brute_force(spark, small, monkeypatch):
    import random

    monkeypatch.setattr(skew, "SLICES", 3)
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(30)]
    spread = [1 / (i + 1) for i in range(30)]
    lines = [
        (f"d{i % 25}", " ".join(rng.choices(vocabulary, spread, k=rng.randint(0, 15))))
        for i in range(80)
    ]
    lines += [("copy1", "w3 w4 w9"), ("copy2", "w3 w4 w9"), ("copy3", "w3 w4 w9")]
    queries = {q: set(rng.choices(vocabulary, k=4)) for q in range(6)}
    queries[99] = {"nothing"}
    docs = spark.createDataFrame(lines, "doc string, text string")
    asked = spark.createDataFrame(
        [(q, t) for q, ts in queries.items() for t in ts], "query_id int, term string"
    )
    got = plans.search_batch(docs, asked, stop=["w0"], k=2, small=small)
    assert got.columns == ["query_id", "score", "doc"]
    close(set(rows(got)), model(lines, queries, {"w0"}, 2))


def test_pairs_are_scored_without_a_shuffle(spark, docs):
    tf = op.term_frequency(docs)
    asked = op.query_terms(spark.createDataFrame([(1, "cat dog")], "q int, text string"), "q")
    weights = op.tfidf(tf, op.mark_asked(op.document_frequency(tf), asked.select("term")), 4)
    scores = op.relevance_batch(weights, asked, tf, "q", small=True)
    names = [n.nodeName() for n in nodes_of(scores._jdf.queryExecution().executedPlan())]
    above = names[: names.index("Window")]
    assert "BroadcastHashJoin" in above and "Exchange" not in above
    assert above.count("HashAggregate") == 2


def test_query_terms_are_distinct(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, "b"), (3, " ")], "q int, text string")
    assert rows(op.query_terms(df, "q")) == [(1, "a"), (1, "b"), (2, "b")]


def test_hot_terms_and_documents(spark):
    """One term in all documents and one document with a third of all rows, hot at any bound."""
    lines = [(f"d{i}", f"all w{i}") for i in range(40)] + [
        ("big", " ".join(f"w{i}" for i in range(40)))
    ]
    docs = spark.createDataFrame(lines, "doc string, text string")
    tf = op.term_frequency(docs)
    stats = op.document_frequency(tf)
    for max_hot in (1, 5, 10_000):
        weights = op.tfidf(tf, stats, 41, max_hot)
        table = rows(op.normalize(weights, tf, max_hot=max_hot))
        assert len(table) == 120
        norms = defaultdict(float)
        for doc, _, weight in table:
            norms[doc] += weight * weight
        assert all(v == pytest.approx(1.0) for v in norms.values())
    assert rows(skew.hot_totals(stats, "term", "df", max_hot=5)) == [("all", 40)]


def test_hot_keys_are_bounded(spark):
    many = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(3).alias("n"))
    assert skew.hot_totals(many, "k", "n", max_hot=100).count() == 0
    long = spark.createDataFrame([("x" * 2000, 900), ("y", 100)], "k string, n int")
    assert [r[0] for r in rows(skew.hot_totals(long, "k", "n", max_hot=100))] == ["y"]


def test_texts_are_tokenised_once(spark, tmp_path, docs):
    path = str(tmp_path / "docs")
    docs.write.parquet(path)
    stored = spark.read.parquet(path)
    for df in (
        score_documents(stored, terms(spark, ["cat"]), stop=STOP),
        op.normalize(
            op.tfidf(tf := op.term_frequency(stored), op.document_frequency(tf), 4), tf
        ).select("doc", "term", "weight"),
    ):
        execution = df._jdf.queryExecution()
        execution.toRdd().count()
        plan = list(nodes_of(execution.executedPlan()))
        names = [node.nodeName() for node in plan]
        assert not {"BatchEvalPython", "ArrowEvalPython"} & set(names)
        # The branches in the tree other than the first read the shuffle of the first.
        splits = [n for n in plan if n.nodeName() == "Generate" and "split(text" in n.verboseString(99)]
        assert len(splits) == 1 and "ReusedExchange" in names


def test_weights_have_norm_one_or_zero(spark, docs):
    sums = plans.document_weights(docs).groupBy("doc").agg(F.sum(F.col("weight") ** 2))
    assert all(v == pytest.approx(1.0) or v == 0.0 for _, v in rows(sums))


@pytest.mark.parametrize("hot_bytes", [7, 1 << 30])
def test_term_table_shuffles_texts_and_not_terms(spark, tmp_path, monkeypatch, hot_bytes):
    """A document over many rows, one without a name and one without a text; hot or not."""
    lines = [("a", "x y x"), ("b", "y the"), ("a", "x z"), (None, "x"), ("c", None), ("d", "")]
    docs = spark.createDataFrame(lines, "doc string, text string").repartition(3)
    plan = []

    def kept(df, name):
        plan.extend(n.nodeName() for n in nodes_of(df._jdf.queryExecution().executedPlan()))
        return df

    monkeypatch.setattr(sys.modules["tallywise.operators.tfidf"], "written", kept)
    got = op.term_table(docs, stop=["the"], hot_bytes=hot_bytes)
    assert rows(got) == [("a", "x", 3), ("a", "y", 1), ("a", "z", 1), ("b", "y", 1)]
    below = plan[: plan.index("Generate")]
    assert ("Exchange" in below) == (hot_bytes == 7)


def test_hot_documents_are_few(spark, monkeypatch):
    """A document with a large share of a small corpus does not make the weights twice, unless it is large."""
    module = sys.modules["tallywise.operators.tfidf"]
    lines = [(f"d{i}", f"all w{i}") for i in range(40)] + [("big", " ".join(f"w{i}" for i in range(40)))]
    tf = op.term_frequency(spark.createDataFrame(lines, "doc string, text string"))
    assert module._hot_documents(tf, "doc", 5).count() == 0
    weights = op.tfidf(tf, op.document_frequency(tf), 41)
    plain = rows(op.normalize(weights, tf, max_hot=5).select("doc", "term", F.round("weight", 9)))
    monkeypatch.setattr(module, "HOT_TERMS", 0)
    assert [r.doc for r in module._hot_documents(tf, "doc", 5).collect()] == ["big"]
    assert rows(op.normalize(weights, tf, max_hot=5).select("doc", "term", F.round("weight", 9))) == plain


@pytest.mark.parametrize("most", [0, 64])
def test_many_queries_meet_documents_in_blocks(spark, docs, monkeypatch, most):
    """More queries than a broadcast: in blocks of whole queries, pairs not shuffled; or, beyond MAX_BLOCKS, sliced."""
    module = sys.modules["tallywise.operators.tfidf"]
    monkeypatch.setattr(module, "MAX_BLOCKS", most)
    asked = spark.createDataFrame([(q, t) for q in range(9) for t in ("cat", "dog", "sang", f"w{q}")], "query_id int, term string")
    tf = op.term_frequency(docs)
    weights = op.tfidf(tf, op.mark_asked(op.document_frequency(tf), asked.select("term")), 4)
    got, want = (op.relevance_batch(weights, asked, tf, small=small) for small in (False, True))
    assert rows(got) == rows(want) and got.count() > 9
    names = [n.nodeName() for n in nodes_of(got._jdf.queryExecution().executedPlan())]
    assert ("Exchange" in names) == (most == 0)
