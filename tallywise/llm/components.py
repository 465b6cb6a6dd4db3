"""Connected components of links, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywise.session import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, label) for each node of ``links`` (a, b), the label being the smallest node that can be
    reached.

    Each round gives a node and its label the smallest label among its neighbours and then follows
    labels of labels, so that the number of rounds grows with the logarithm of a chain's length.
    Neighbours are reduced by a minimum, which is taken per task before the shuffle, so that a node
    with very many links meets no single task. Each round is a written table.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = scratch.write(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels"
    )
    while True:
        of_a = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
        of_b = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        seen = links.join(of_a, "a").join(of_b, "b").filter("la <> lb")
        low, high = F.least("la", "lb"), F.greatest("la", "lb")
        # The label of the larger side takes the smaller label, and so do the two nodes.
        found = seen.select(F.explode(F.array(high, "a", "b")).alias("node"), low.alias("new"))
        found = found.groupBy("node").agg(F.min("new").alias("new"))
        hooked = labels.join(found, "node", "left").select(
            "node", F.least("label", F.coalesce("new", "label")).alias("label"), F.col("label").alias("old")
        )
        hooked = scratch.write(hooked, "hooked")
        above = hooked.select(F.col("node").alias("label"), F.col("label").alias("up"))
        jumped = hooked.join(above, "label").select("node", F.col("up").alias("label"), "old")
        jumped = scratch.write(jumped, "labels")
        changed = jumped.filter("label <> old").limit(1).count()
        scratch.drop(hooked, labels)
        labels = jumped
        if not changed:
            return jumped.select("node", "label")
