from __future__ import annotations

import random

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from tallywise.operators import top_k

SCORES = [("a", 5), ("b", 5), ("c", 4), ("d", 3), ("e", 3), ("f", 2)]


@pytest.mark.parametrize(
    ("k", "want"), [(1, "ab"), (2, "ab"), (3, "abc"), (4, "abcde"), (5, "abcde"), (20, "abcdef")]
)
@pytest.mark.parametrize("kind", ["bigint", "double"])
def test_ties(spark, k, want, kind):
    df = spark.createDataFrame(SCORES, "item string, n bigint")
    df = df.select("item", F.col("n").cast(kind).alias("n"))
    assert [r[0] for r in rows(top_k(df, k, "n", "item"))] == list(want)


@pytest.mark.parametrize("buckets", [1, 3, 64])
def test_against_brute_force(spark, buckets):
    rng = random.Random(buckets)
    data = [(g, i, rng.randint(0, 12)) for g in "xyz" for i in range(rng.randint(1, 60))]
    df = spark.createDataFrame(data, "g string, item int, n int").repartition(5)
    for k in (1, 4, 30):
        want = sorted(
            r for r in data if sum(o[0] == r[0] and o[2] > r[2] for o in data) < k
        )
        assert rows(top_k(df, k, "n", "item", by=["g"], buckets=buckets)) == want
        alone = sorted(r for r in data if sum(o[2] > r[2] for o in data) < k)
        assert rows(top_k(df, k, "n", "item", buckets=buckets)) == alone


def test_empty(spark):
    df = spark.createDataFrame([], "item string, n double")
    assert rows(top_k(df, 3, "n", "item")) == []


def test_rows_are_pruned_before_the_shuffle(spark):
    df = spark.range(1000).select(F.col("id").alias("item"), (F.col("id") % 50).alias("n"))
    plan = plan_of(top_k(df, 3, "n", "item"))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_ties_are_not_ranked_in_one_task(spark):
    """20,000 equal scores: the result comes from many tasks, none with more than a small part."""
    df = spark.range(20_000).select(F.col("id").alias("item"), F.lit(1).alias("n"))
    df = df.withColumn("g", F.lit("q"))
    for got in (top_k(df, 3, "n", "item", buckets=16), top_k(df, 3, "n", "item", ["g"], buckets=16)):
        bucket = F.pmod(F.xxhash64("item"), F.lit(16))
        sizes = [r["count"] for r in got.groupBy(bucket).count().collect()]
        assert sum(sizes) == 20_000 and len(sizes) == 16 and max(sizes) < 2_000
        plan = plan_of(got).split("Initial Plan")[0]
        ranked = [line for line in plan.splitlines() if " Window [" in line or ") Window [" in line]
        assert ranked and all("_bucket" in line or "row_number" in line for line in ranked)


def test_nulls(spark):
    data = [("x", "a", 3), ("x", "b", None), ("x", "c", None), (None, "d", 1), (None, "e", None), (None, "f", 2), (None, "g", 2)]
    df = spark.createDataFrame(data, "g string, item string, n int")
    for buckets in (1, 5):
        items = lambda *args: "".join(sorted(r.item for r in top_k(df, *args, buckets=buckets).collect()))  # noqa: E731, B023
        assert items(1, "n", "item") == "a"
        assert items(4, "n", "item") == "adfg"
        assert items(5, "n", "item") == "abcdefg"
        assert items(1, "n", "item", ["g"]) == "afg"
        assert items(2, "n", "item", ["g"]) == "abcfg"
        assert items(4, "n", "item", ["g"]) == "abcdefg"
