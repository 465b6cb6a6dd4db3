"""PageRank over an edge table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywise.operators.skew import MAX_HOT, attach_totals
from tallywise.session import Scratch

SLICE_ROWS = 10_000
HASH_BYTES = 64 * 1024 * 1024  # of the ranks of a bucket that a task holds to look up those of its links
ROW_BYTES = 64  # of a row that is held, besides the name of its node


def out_degrees(edges: DataFrame) -> DataFrame:
    """(src, out_degree); a repeated edge counts each time."""
    return edges.groupBy("src").agg(F.count("*").alias("out_degree"))


def with_out_degree(edges: DataFrame, max_hot: int = MAX_HOT) -> DataFrame:
    """(src, dst, out_degree), one row per edge, balanced when one node has most of the edges."""
    return attach_totals(edges, out_degrees(edges), "src", "out_degree", max_hot)


def _check_on_missing(on_missing: str) -> None:
    if on_missing not in ("error", "add"):
        raise ValueError(f"on_missing must be 'error' or 'add', not {on_missing!r}")


def _unknown(what: str, name: str) -> Column:
    shown = F.coalesce(F.col(name).cast("string"), F.lit("null"))
    return F.raise_error(F.concat(F.lit(f"{what}: "), shown))


def contributions(
    edges: DataFrame, ranks: DataFrame, max_hot: int = MAX_HOT, on_missing: str = "error"
) -> DataFrame:
    """(src, dst, credit): each node hands its rank to its out-links in equal parts. An edge from
    a node without a rank raises, or counts as from rank 1.0 with ``on_missing="add"``."""
    _check_on_missing(on_missing)
    # No join finds a null, so it would go without a word.
    edges = edges.withColumn("src", F.coalesce("src", F.raise_error(F.lit("edge of a node without a name"))))
    state = out_degrees(edges).join(ranks.withColumnRenamed("id", "src"), "src", "left")
    missing = F.lit(1.0) if on_missing == "add" else _unknown("edge of a node without a rank", "src")
    credit = F.coalesce("rank", missing) / F.col("out_degree")
    joined = attach_totals(edges, state, "src", "out_degree", max_hot)
    return joined.select("src", "dst", credit.alias("credit"))


def gather(
    nodes: DataFrame,
    credits: DataFrame,
    n_nodes: int | Column,
    damping: float = 0.85,
    how: str = "left",
    hashed: bool = False,
) -> DataFrame:
    """The columns of ``nodes`` and the new ``rank``, from (dst, credit) rows. A node that gets no
    credit keeps the part all nodes have, ``(1 - damping) / n_nodes``. ``hashed`` says that the nodes of a
    partition fit a hash table."""
    arrived = credits.groupBy(F.col("dst").alias("id")).agg(F.sum("credit").alias("_credit"))
    arrived = arrived.hint("shuffle_hash") if hashed else arrived
    # Rounded, since 1 - 0.85 is not the double nearest to 0.15.
    base = F.lit(round(1 - damping, 15)) / (F.lit(n_nodes) if isinstance(n_nodes, int) else n_nodes)
    rank = base + damping * F.coalesce("_credit", F.lit(0.0))
    return nodes.join(arrived, "id", how).select(*nodes.columns, rank.alias("rank"))


def pagerank_step(
    nodes: DataFrame,
    edges: DataFrame,
    ranks: DataFrame,
    damping: float = 0.85,
    max_hot: int = MAX_HOT,
    on_missing: str = "error",
) -> DataFrame:
    """One round: (id, rank) before to (id, rank) after. A node that is listed twice counts once.
    An edge from or to an id that is not in ``nodes``, or from one without a rank, raises; with
    ``on_missing="add"`` such ids become nodes that start at rank 1.0."""
    nodes = nodes.select("id")
    if on_missing == "add":
        for end in ("src", "dst"):
            nodes = nodes.unionByName(edges.select(F.col(end).alias("id")))
    nodes = nodes.distinct()
    n_nodes = nodes.agg(F.count("*")).scalar()
    listed = nodes.withColumn("_listed", F.lit(True))
    # A row for each source too, so that one which is no node is found, be it ever so well ranked.
    sent = contributions(edges, ranks, max_hot, on_missing).select("dst", "credit")
    sent = sent.unionByName(edges.select(F.col("src").alias("dst"), F.lit(0.0).alias("credit")))
    after = gather(listed, sent, n_nodes, damping, how="full")
    missing = _unknown("edge of a node without a row in nodes", "id")
    known = F.when(F.col("_listed") & F.col("id").isNotNull(), F.col("id")).otherwise(missing)
    return after.select(known.alias("id"), "rank")


@dataclass(frozen=True)
class Graph:
    """A graph prepared for many rounds.

    ``links`` (src, slice, dst, share): repeated edges are one row, and ``share`` is the part of
    the rank of ``src`` that goes to ``dst``. The links of a node are cut into slices of about
    ``1 / MAX_HOT`` of all links, so that no join key has more.
    ``nodes`` (id, slices): all slices of all nodes are fewer than the nodes plus ``MAX_HOT``.
    ``sliced`` tells whether any node has more than one slice. Both are tables in the shared folder with
    ``buckets`` buckets by their key, the session's number of shuffle partitions, so that what a round
    shuffles meets them where they are, and a lost executor costs a read.
    ``hashed`` tells whether the ranks of a bucket are few enough for a hash table, about HASH_BYTES. No round then
    sorts the links, and they lie in the order of their targets, at which their credits are added up.
    If the nodes were ``numbered``, ``id``, ``src`` and ``dst`` are numbers, and ``names`` (number, id) has the names.
    """

    nodes: DataFrame
    links: DataFrame
    n_nodes: int
    sliced: bool
    buckets: int
    hashed: bool
    names: DataFrame | None
    scratch: Scratch

    def keep(self, ranks: DataFrame) -> DataFrame:
        """``ranks`` as a table with the buckets of ``nodes``, whose partitioning a round leaves as it is."""
        return self.scratch.bucketed(ranks, "ranks", self.buckets, ["id"], dealt=True)

    def release(self) -> None:
        """Delete the tables that were written."""
        self.scratch.release()


def prepare(
    nodes: DataFrame,
    edges: DataFrame,
    on_missing: str = "error",
    slice_rows: int = SLICE_ROWS,
    max_hot: int = MAX_HOT,
    numbered: bool = False,
) -> Graph:
    """Count and slice the out-links once, for all rounds, and lay them and the nodes out in buckets.
    All tables are written to the shared folder, so that a lost executor never sends a task back to the
    source of the edges.

    ``on_missing`` says what to do with an edge from or to an id that is not in ``nodes``:
    ``"error"`` raises, ``"add"`` makes it a node. A null id raises in any case. ``numbered`` puts numbers in place
    of the nodes' names, which takes one more join and makes each round cheaper; repeated edges then count
    each time also where a node's links are cut into slices.
    """
    _check_on_missing(on_missing)
    scratch = Scratch(nodes.sparkSession)
    copies, one = F.count("*").alias("copies"), F.lit(1).cast("bigint")
    if numbered:  # as they are, since pairs of numbers are merged with less effort
        table, degree = scratch.write(edges.select("src", "dst"), "edges"), one
    else:
        table, degree = scratch.write(edges.groupBy("src", "dst").agg(copies), "edges"), F.col("copies")

    # One row per node from three kinds of rows: listed nodes, edges at their source and edges at
    # their target. Partial sums keep a hot node to one row per task.
    def counts(id_: str, listed: int, *sizes: Column) -> list[Column]:
        named = [size.alias(name) for size, name in zip(sizes, ("out_degree", "n_links", "n_in"), strict=True)]
        return [F.col(id_).alias("id"), F.lit(listed).alias("listed"), *named]

    none = F.lit(0).cast("bigint")
    rows = nodes.select(*counts("id", 1, none, none, none))
    rows = rows.unionByName(table.select(*counts("src", 0, degree, one, none)))
    rows = rows.unionByName(table.select(*counts("dst", 0, none, none, one)))
    counted = rows.groupBy("id").agg(
        F.max("listed").alias("listed"),
        F.sum("out_degree").alias("out_degree"),
        F.sum("n_links").alias("n_links"),
        F.sum("n_in").alias("n_in"),
    )
    # The numbers hold once they are written.
    counted = scratch.write(counted.withColumn("number", F.monotonically_increasing_id()), "nodes")
    totals = counted.agg(
        F.count("*"),
        F.sum("n_links"),
        F.max("n_links"),
        F.min(F.when(F.col("listed") == 0, F.col("id"))),
        F.count_if(F.col("id").isNull()),
        F.sum(F.octet_length(F.col("id").cast("string")) + ROW_BYTES),
    )
    n_nodes, n_links, most, missing, nulls, size = totals.first()
    if nulls:
        scratch.release()
        raise ValueError("a node or an end of an edge is null")
    if on_missing == "error" and missing is not None:
        scratch.release()
        raise ValueError(f"edge of a node without a row in nodes: {missing!r}")

    per_slice = max((n_links or 0) / max_hot, slice_rows)
    slices = F.greatest(F.ceil(F.col("n_links") / per_slice), F.lit(1)).cast("int")
    counted = counted.withColumn("slices", slices)
    buckets = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = (most or 0) > per_slice
    # A node's row is repeated for each slice, of which there are max_hot more than nodes.
    hashed = (size or 0) + (max_hot * (size // n_nodes) if sliced else 0) <= HASH_BYTES * buckets
    if numbered:
        targets = counted.filter(F.col("n_in") > 0).select(F.col("id").alias("dst"), "n_in", "number")
        ends = attach_totals(table, targets, "dst", "n_in", max_hot, hashed)
        raw = table
        table = scratch.write(ends.select("src", F.col("number").alias("dst")), "ends")
        scratch.drop(raw)
    sources = counted.filter(F.col("n_links") > 0).drop("n_in").withColumnRenamed("id", "src")
    links = attach_totals(table, sources, "src", "n_links", max_hot, hashed)
    slice_of = F.pmod(F.xxhash64("dst"), F.col("slices")).cast("int").alias("slice")
    if numbered:
        links = links.select(F.col("number").alias("src"), slice_of, "dst", "out_degree")
        links = links.groupBy("src", "slice", "dst", "out_degree").agg(copies)
    else:
        links = links.select("src", slice_of, "dst", "out_degree", "copies")
    links = links.select("src", "slice", "dst", (F.col("copies") / F.col("out_degree")).alias("share"))
    keys = ["src", "slice"] if sliced else ["src"]
    own = counted.select((F.col("number") if numbered else F.col("id")).alias("id"), "slices")
    links = links if sliced else links.drop("slice")
    return Graph(
        nodes=scratch.bucketed(own, "nodes", buckets, ["id"]),
        links=scratch.bucketed(links, "links", buckets, keys, order=["dst"] if hashed else keys),
        n_nodes=n_nodes,
        sliced=sliced,
        buckets=buckets,
        hashed=hashed,
        names=counted.select("number", "id") if numbered else None,
        scratch=scratch,
    )


def pagerank(
    nodes: DataFrame,
    edges: DataFrame,
    iterations: int = 10,
    damping: float = 0.85,
    init: float | str = 1.0,
    on_missing: str = "error",
    checkpoint_every: int = 3,
    slice_rows: int = SLICE_ROWS,
    max_hot: int = MAX_HOT,
    tol: float | None = None,
) -> DataFrame:
    """(id, rank) after ``iterations`` rounds from ``init`` (a number, or ``"uniform"`` for ``1 / N``).
    The rank that reaches a node without out-links is lost.

    With ``tol``, the loop stops after the first round in which no rank changed by more than ``tol``,
    and after ``iterations`` rounds in any case. The largest change is observed while the round writes
    its ranks, so that it takes no job of its own.

    The links stay where they are, and the ranks are made on the buckets of their node. A round
    thus shuffles the credits to their target, added up per task first, and nothing else; if some
    node is hot, also the ranks, one row for each slice of a node. The ranks are written every
    ``checkpoint_every`` rounds, with ``tol`` in each. Nodes with names are numbered for the rounds.
    """
    ends = (nodes.schema["id"], edges.schema["src"], edges.schema["dst"])
    named = all(isinstance(end.dataType, T.StringType) for end in ends)
    graph = prepare(nodes, edges, on_missing, slice_rows, max_hot, numbered=named)
    start = 1.0 / max(graph.n_nodes, 1) if init == "uniform" else float(init)
    ranks = graph.nodes.select("id", "slices", F.lit(start).alias("rank"))
    result = Scratch(nodes.sparkSession)
    kept = None
    try:
        for done in range(1, iterations + 1):
            if tol is not None:
                ranks, change = _observed_round(graph, ranks, damping)
            else:
                ranks = gather(graph.nodes, _credits(graph, ranks), graph.n_nodes, damping, hashed=graph.hashed)
            if tol is not None or (done % checkpoint_every == 0 and done < iterations):
                before, kept = kept, graph.keep(ranks)
                ranks = kept
                if before is not None:
                    graph.scratch.drop(before)
            if tol is not None and (change.get["change"] or 0.0) <= tol:
                break
        if named:
            ranks = ranks.withColumnRenamed("id", "number").join(graph.names, "number")
        return result.write(ranks.select("id", "rank"), "pagerank")
    finally:
        graph.release()


def _observed_round(graph: Graph, ranks: DataFrame, damping: float) -> tuple[DataFrame, Observation]:
    """The ranks after a round, and what will hold the largest change once they have been written."""
    change = Observation()
    before = ranks.withColumnRenamed("rank", "before")
    after = gather(before, _credits(graph, ranks), graph.n_nodes, damping, hashed=graph.hashed)
    after = after.observe(change, F.max(F.abs(F.col("rank") - F.col("before"))).alias("change"))
    return after.drop("before"), change


def _credits(graph: Graph, ranks: DataFrame) -> DataFrame:
    sent = ranks.withColumnRenamed("id", "src")
    keys = ["src"]
    if graph.sliced:
        every_slice = F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice")
        sent = sent.select("src", "rank", every_slice)
        keys = ["src", "slice"]
    credit = (F.col("rank") * F.col("share")).alias("credit")
    sent = sent.hint("shuffle_hash") if graph.hashed else sent
    return graph.links.join(sent, keys).select("dst", credit)
