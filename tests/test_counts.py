from __future__ import annotations

import random
from collections import Counter

import pytest
from conftest import nodes_of, plan_of, rows

from tallywise import operators as op
from tallywise import plans

A = ["the cat and the hat", "cat cat dog dog"]
B = ["a cat cat dog dog. dog", "hat hat"]
STOP = ["the", "of", "a"]


def texts(spark, lines):
    return spark.createDataFrame([(line,) for line in lines], "text string")


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("  a\tb\r\nc\fd  ", ["a", "b", "c", "d"]),
        ("x\u000by", ["x\u000by"]),
        ("x y", ["x y"]),
        ("x y", ["x y"]),
        ("Dog dog dog.", ["Dog", "dog", "dog."]),
        ("a@b k=v http://x :x", [":x", "a@b", "http://x", "k=v"]),
        ("", []),
        (" \n", []),
        (None, []),
    ],
)
def test_tokenize(spark, text, expected):
    assert rows(op.tokenize(texts(spark, [text]))) == sorted((w,) for w in expected)


def test_tokenize_keeps_columns(spark):
    df = spark.createDataFrame([(7, "x y")], "doc int, text string")
    assert rows(op.tokenize(df, keep=["doc"])) == [(7, "x"), (7, "y")]


def test_word_count(spark):
    assert rows(plans.count_words(texts(spark, A))) == [
        ("and", 1), ("cat", 3), ("dog", 2), ("hat", 1), ("the", 2)
    ]


def test_word_count_of_two_inputs(spark):
    assert rows(plans.count_words(texts(spark, A), texts(spark, B))) == [
        ("a", 1), ("and", 1), ("cat", 5), ("dog", 4), ("dog.", 1), ("hat", 3), ("the", 2)
    ]


def test_word_count_without_stop_words(spark):
    assert rows(plans.count_words(texts(spark, A), stop=STOP)) == [
        ("and", 1), ("cat", 3), ("dog", 2), ("hat", 1)
    ]
    frame = spark.createDataFrame([("the",), ("of",), ("a",), ("a",), (None,)], "word string")
    assert rows(plans.count_words(texts(spark, B), stop=frame)) == [
        ("cat", 2), ("dog", 2), ("dog.", 1), ("hat", 2)
    ]


def test_stop_words_are_exact_and_keep_repeats(spark):
    tokens = op.tokenize(texts(spark, ["The the the. cat cat"]))
    assert rows(op.drop_stop_words(tokens, ["the"])) == [
        ("The",), ("cat",), ("cat",), ("the.",)
    ]
    assert op.drop_stop_words(tokens, []) is tokens


def test_long_stop_list_is_not_broadcast_whole(spark):
    from tallywise.operators.skew import drop_keys

    words = [("hot",)] * 400 + [("warm",)] * 300 + [(f"w{i}",) for i in range(300)]
    tokens = spark.createDataFrame(words, "word string")
    stop = spark.createDataFrame([("warm",), ("w5",), ("w7",), ("absent",)], "word string")
    kept = drop_keys(tokens, stop, "word", small=False)
    want = Counter(w for (w,) in words if w not in {"warm", "w5", "w7"})
    assert Counter(w for (w,) in rows(kept)) == want


def test_long_stop_list_reads_the_texts_once(spark, monkeypatch):
    from tallywise.operators import skew, tokens

    monkeypatch.setattr(tokens, "drop_keys", lambda *a: skew.drop_keys(*a[:3], small=False))
    listed = [f"w{i}" for i in range(1000)]
    found = op.drop_stop_words(op.tokenize(texts(spark, ["w1 w2 x", "x w999 y w1000"])), listed)
    found._jdf.queryExecution().toRdd().count()
    plan = list(nodes_of(found._jdf.queryExecution().executedPlan()))
    assert [n.nodeName() for n in plan].count("Generate") == 1
    assert any(n.nodeName() == "SortMergeJoin" and "LeftAnti" in n.verboseString(99) for n in plan)
    assert rows(found) == [("w1000",), ("x",), ("x",), ("y",)]


def test_stop_word_plan(spark):
    plan = plan_of(plans.count_words(texts(spark, A), stop=STOP))
    assert "BroadcastHashJoin [word" in plan and "LeftAnti" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_common_words(spark):
    a, b = texts(spark, A), texts(spark, B)
    want = [("cat", 2), ("dog", 2), ("hat", 1)]
    counts = [plans.count_words(t, stop=STOP) for t in (a, b)]
    assert rows(op.common_words(*counts)) == want
    assert rows(op.common_words(*reversed(counts))) == want
    assert rows(plans.shared_words(a, b, stop=STOP)) == want
    assert rows(plans.shared_words(b, a, stop=STOP)) == want
    ordered = op.sort_by_count(plans.shared_words(a, b, stop=STOP)).collect()
    assert [tuple(r) for r in ordered] == [(1, "hat"), (2, "cat"), (2, "dog")]


def test_common_words_is_intersect_all(spark):
    rng = random.Random(3)
    sides = [[" ".join(rng.choices("abcdefgh", k=40))] for _ in range(2)]
    tokens = [op.tokenize(texts(spark, side)) for side in sides]
    bag = tokens[0].intersectAll(tokens[1]).groupBy("word").count()
    assert rows(op.common_words_onepass(*tokens)) == rows(bag)
    assert rows(op.common_words(*[op.word_count(t) for t in tokens])) == rows(bag)


@pytest.mark.parametrize(
    ("k", "want"),
    [(1, [(2, "cat"), (2, "dog")]), (2, [(2, "cat"), (2, "dog")]),
     (3, [(2, "cat"), (2, "dog"), (1, "hat")])],
)
def test_top_common_words(spark, k, want):
    got = plans.top_shared_words(texts(spark, A), texts(spark, B), stop=STOP, k=k)
    assert got.columns == ["n", "word"]
    assert [tuple(r) for r in got.collect()] == want


def test_common_words_onepass_shuffles_once(spark):
    plan = plan_of(plans.shared_words(texts(spark, A), texts(spark, B), stop=STOP))
    assert plan.split("Initial Plan")[0].count("Exchange hashpartitioning") == 1


def test_results_do_not_depend_on_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    for parts in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got.append(rows(plans.count_words(texts(spark, A), texts(spark, B))))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got[0] == got[1]
