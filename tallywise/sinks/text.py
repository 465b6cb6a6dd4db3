"""Tab-separated text and adjacency files. Every sink fails if the path exists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywise.operators.skew import attach_totals
from tallywise.session import delete

COPIES = 1000  # of a repeated link that are made at a time
LONG_LINE_BYTES = 16 * 1024 * 1024  # of links in a line from which no task holds it
MAX_LINE_BYTES = 1 << 36  # that the task which writes such a line puts in order
MAX_RANKED_BYTES = 1 << 30  # half of what one string can hold, as the reader of ranked lines holds each


def _dealt(df: DataFrame, files: int | None, order: Sequence[str]) -> DataFrame:
    if order and files is None:
        return df.orderBy(*order)
    if order:
        return df.repartitionByRange(files, *order).sortWithinPartitions(*order)
    # A shuffle here and not coalesce, which would run the stage before in as few tasks.
    return df if files is None else df.repartition(files)


def _write(lines: DataFrame, path: str) -> None:
    lines.write.mode("errorifexists").text(path)


def _unbroken(cell: Column, within: str = r"[\t\r\n]") -> Column:
    """``cell``, or an error if it holds what ends a field or a line."""
    bad = F.raise_error(F.concat(F.lit("field with a tab, line break or separator: "), cell))
    return F.when(cell.rlike(within), bad).otherwise(cell)


def write_pairs(
    df: DataFrame, path: str, files: int | None = None, order: Sequence[str] = ()
) -> None:
    """One line per row, columns separated by tabs, nothing quoted. A tab or line break in a value
    raises, a null is empty. ``files`` sets the number of output files; rows then come in no order,
    or, by the columns of ``order``, sorted in each file and from file to file. Without ``files``
    and ``order`` the order of ``df`` stays."""
    cells = [F.coalesce(_unbroken(F.col(c).cast("string")), F.lit("")) for c in df.columns]
    lines = _dealt(df, files, order)
    _write(lines.select(F.concat_ws("\t", *cells).alias("value")), path)


def write_adjacency(
    nodes: DataFrame,
    edges: DataFrame,
    path: str,
    files: int | None = None,
    line_links: int | None = None,
    ordered: bool = False,
    link_sep: str | None = None,
) -> None:
    """One line per node, ``id<TAB>link<TAB>link...``. With a ``rank`` column in ``nodes`` lines
    are ``id<TAB>rank link link...``; ``link_sep="\t"`` puts tabs there too, for names with spaces.
    A name that is null, holds a tab or line break, or white space where spaces separate, raises. A node that is listed twice has one line, with the larger rank.

    A line holds all links of its node. One with more than LONG_LINE_BYTES of links gets a file of its own, which
    a task writes link by link without holding the line; that file has ``sep`` at its end and no line break,
    and comes on top of ``files``. A node whose links take more than MAX_LINE_BYTES (with ranks
    MAX_RANKED_BYTES) raises before anything is written; keep such a graph as an edge table.
    Only a caller that asks for ``line_links`` gets another format: several lines of about that
    many links for a node, which the readers of this library put together again.

    ``ordered`` sorts the lines by node, within each of the files and from file to file.
    """
    ranked = "rank" in nodes.columns
    if ranked:
        nodes = nodes.groupBy("id").agg(F.max("rank").alias("rank"))
    else:
        nodes = nodes.select("id").distinct()
    sep = link_sep or (" " if ranked else "\t")
    if sep not in ("\t", " "):
        raise ValueError(f"link_sep must be a tab or a space, not {sep!r}")
    long = None
    if line_links is None:
        found = _long_nodes(edges, min(MAX_LINE_BYTES, MAX_RANKED_BYTES) if ranked else MAX_LINE_BYTES)
        if found:
            long = F.broadcast(_numbered(edges, found))
            of_long = _named(edges, sep).join(long, "src")
            long_nodes = long.withColumnRenamed("src", "id").join(nodes, "id", "left")
            nodes = nodes.join(long.select(F.col("src").alias("id")), "id", "left_anti")
            edges = edges.join(long, "src", "left_anti")
        links = F.sort_array(F.collect_list("dst")).alias("links")
        numbered = nodes.withColumn("line", F.lit(0))
        grouped = _named(edges, sep).groupBy(F.col("src").alias("id")).agg(links)
        grouped = grouped.withColumn("line", F.lit(0))
    else:
        numbered, grouped = _cut(nodes, _named(edges, sep), line_links)
    joined = numbered.join(grouped, ["id", "line"], "full")
    links = F.coalesce("links", F.array().cast("array<string>"))
    # A further line that the hash left empty says nothing; the first one names the node.
    joined = joined.filter((F.col("line") == 0) | (F.size(links) > 0))
    if ranked:
        links = F.concat(F.array(_rank_of()), links)
    rest = F.array_join(links, sep)
    value = F.when(F.size(links) > 0, F.concat_ws("\t", _node_of(), rest)).otherwise(_node_of())
    if long is None:
        lines = _dealt(joined, files, ["id", "line"] if ordered else ())
        _write(lines.select(value.alias("value")), path)
        return
    step = (files or int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))) + 1 if ordered else 1
    total = step * (len(found) + 1)
    heads = long_nodes.select("number", F.concat_ws("\t", _node_of(), _rank_of()) if ranked else _node_of())
    lines = joined.select("id", "line", value.alias("value"))
    if ordered:
        # Lines with as many long ones before them come before the next of these, in ranges of all lines.
        before = F.size(F.filter(F.array(*[F.lit(v) for v in sorted(found)]), lambda node: node < F.col("id")))
        part = F.spark_partition_id()
        lines = lines.repartitionByRange(step - 1, "id", "line").withColumn("_file", before * step + part)
        lines = lines.repartitionById(total, F.col("_file")).sortWithinPartitions("id", "line")
    else:
        lines = _dealt(lines, files, ())
    _write_long(heads, of_long, path, sep, total, step)
    try:
        lines.select("value").write.mode("append").text(path)
    except BaseException:
        delete(nodes.sparkSession, path)
        raise


def _node_of() -> Column:
    return _unbroken(F.coalesce("id", F.raise_error(F.lit("node without a name"))).cast("string"))


def _rank_of() -> Column:
    missing = F.raise_error(F.concat(F.lit("node without rank: "), "id"))
    return F.coalesce("rank", missing).cast("string")


def _named(edges: DataFrame, sep: str) -> DataFrame:
    name = F.coalesce("dst", F.raise_error(F.lit("link without a name"))).cast("string")
    name = _unbroken(name, r"\s" if sep == " " else r"[\t\r\n]")
    return edges.select("src", name.alias("dst"))


def _long_nodes(edges: DataFrame, most: int) -> list:
    """The nodes with more than LONG_LINE_BYTES of links; there is one for as many bytes of all links at most."""
    size = F.sum(F.octet_length(F.col("dst").cast("string")) + 1).alias("size")
    found = edges.groupBy("src").agg(size).filter(F.col("size") > min(LONG_LINE_BYTES, most)).collect()
    for row in found:
        if row["size"] > most:
            raise ValueError(f"the links of node {row['src']!r} don't fit one line")
    return [row["src"] for row in found if row["src"] is not None]


def _numbered(edges: DataFrame, found: list) -> DataFrame:
    """(src, number) of the long lines, in the order of their nodes."""
    schema = T.StructType([T.StructField("src", edges.schema["src"].dataType), T.StructField("number", T.IntegerType())])
    return edges.sparkSession.createDataFrame([(v, i) for i, v in enumerate(sorted(found))], schema)


def _write_long(heads: DataFrame, edges: DataFrame, path: str, sep: str, files: int, step: int) -> None:
    """Each long line as a file: its head, then the links in order, all followed by ``sep``.

    The writer takes a row for up to COPIES of a link, so that it sorts few rows and holds none for long."""
    merged = edges.groupBy("number", "dst").agg(F.count("*").alias("copies"))
    block = F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / COPIES)))
    copies = F.least(F.lit(COPIES), F.col("copies") - F.col("block") * COPIES).cast("int")
    links = merged.withColumn("block", block).select("number", "dst", F.array_join(F.array_repeat("dst", copies), sep))
    first = heads.toDF("number", "value").select("number", F.lit(None).cast("string").alias("dst"), "value")
    rows = first.union(links)
    dealt = rows.repartitionById(files, F.col("number") * step + step - 1).sortWithinPartitions("dst")
    # Not marked as complete, as the other lines follow.
    writer = dealt.select("value").write.mode("errorifexists").option("lineSep", sep)
    writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").text(path)


def _cut(nodes: DataFrame, edges: DataFrame, line_links: int) -> tuple[DataFrame, DataFrame]:
    """The nodes with a row for each line, and the links of each line."""
    degrees = edges.groupBy("src").agg(F.count("*").alias("n_links"))
    degrees = degrees.withColumn("n_lines", F.ceil(F.col("n_links") / line_links).cast("int"))
    known = nodes.join(degrees.withColumnRenamed("src", "id"), "id", "full")
    line = F.explode(F.sequence(F.lit(0), F.coalesce("n_lines", F.lit(1)) - 1))
    grouped = (
        _numbered_links(edges, degrees)
        .groupBy(F.col("src").alias("id"), "line")
        .agg(F.sort_array(F.collect_list("dst")).alias("links"))
    )
    return known.withColumn("line", line), grouped


def _numbered_links(edges: DataFrame, degrees: DataFrame) -> DataFrame:
    """(src, line, dst): each copy of a link with the number of its line.

    The line is a hash of the link and the number of the copy, not of a row position, so that a
    task run again after a lost executor puts each link on the same line. Copies are made in two
    steps to keep the arrays short.
    """
    merged = edges.groupBy("src", "dst").agg(F.count("*").alias("copies"))
    block = F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / COPIES)))
    copies = F.least(F.lit(COPIES), F.col("copies") - F.col("block") * COPIES)
    linked = (
        attach_totals(merged, degrees, "src", "n_links")
        .withColumn("block", block)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), copies.cast("int"))))
    )
    line = F.pmod(F.xxhash64("dst", "block", "copy"), F.col("n_lines")).cast("int")
    return linked.select("src", line.alias("line"), "dst")
