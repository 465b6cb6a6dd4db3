from __future__ import annotations

import pytest
from conftest import TESTDATA, nodes_of
from pyspark.sql import functions as F

from tallywise.operators import number_rows
from tallywise.session import Scratch


def test_places_go_on_over_partitions(spark):
    items = spark.read.parquet(str(TESTDATA / "sf0.001/lineitem.parquet")).select("l_orderkey", "l_shipdate")
    got = number_rows(items.repartition(7), ["l_orderkey", "l_shipdate"], Scratch(spark)).collect()
    ordered = sorted(got, key=lambda r: r.place)
    assert [r.place for r in ordered] == list(range(1, len(got) + 1))
    assert [(r.l_orderkey, r.l_shipdate) for r in ordered] == sorted((r.l_orderkey, r.l_shipdate) for r in got)


@pytest.mark.parametrize("copies", [1, 300])
def test_groups_nulls_and_ties(spark, copies):
    rows = [("a", 2), ("a", None), (None, 5), (None, 5), ("b", 1), ("a", 2)] * copies
    df = spark.createDataFrame(rows, "k string, v int")
    got = number_rows(df, ["v"], Scratch(spark), by=["k"], name="n").collect()
    for key in ("a", "b", None):
        mine = sorted((r.n, r.v) for r in got if r.k == key and r.v is not None)
        nulls = sorted(r.n for r in got if r.k == key and r.v is None)
        assert nulls == list(range(1, len(nulls) + 1))
        assert [n for n, _ in mine] == list(range(len(nulls) + 1, len(nulls) + len(mine) + 1))
        assert [v for _, v in mine] == sorted(v for _, v in mine)
    assert number_rows(df.limit(0), ["v"], Scratch(spark)).collect() == []


def test_windows_see_sizes_only(spark):
    rows = spark.range(50_000).withColumn("v", F.xxhash64("id"))
    df = number_rows(rows, ["v"], Scratch(spark))
    df._jdf.queryExecution().toRdd().count()
    windows = [n for n in nodes_of(df._jdf.queryExecution().executedPlan()) if n.nodeName() == "Window"]
    assert windows
    for window in windows:
        assert any(n.nodeName() == "HashAggregate" for n in nodes_of(window))
