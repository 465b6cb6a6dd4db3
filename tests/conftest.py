from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tallywise.session import SETTINGS  # noqa: E402

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
    )
    for setting, value in SETTINGS.items():
        builder = builder.config(setting, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df):
    """All rows as a sorted list of tuples."""
    return sorted(tuple(r) for r in df.collect())


def plan_of(df):
    """The executed plan after a run, in its final form."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString()


def nodes_of(plan):
    """The nodes of a physical plan, without what is inside a cached table."""
    yield plan
    if plan.nodeName() == "AdaptiveSparkPlan":
        yield from nodes_of(plan.executedPlan())
    if plan.nodeName().endswith("QueryStage"):
        yield from nodes_of(plan.plan())
    children = plan.children()
    for i in range(children.size()):
        yield from nodes_of(children.apply(i))
