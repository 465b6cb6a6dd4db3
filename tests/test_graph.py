from __future__ import annotations

from pathlib import Path

import pytest
from conftest import nodes_of, rows

from tallywise import operators as op
from tallywise.operators import graph
from tallywise.sinks import text, write_adjacency
from tallywise.sources import read_adjacency, read_pairs, read_ranked_adjacency
from tallywise.sources import text as readers

OPEN = ["A\tB\tC", "B\tC", "C\tA", "D\tC", "E\tA\tA\tD", "F"]
CLOSED = ["A\tB\tC", "B\tC", "C\tA"]
AFTER = {
    0: [1, 1, 1, 1, 1, 1],
    1: [1.441666667, 0.45, 2.15, 0.308333333, 0.025, 0.025],
    2: [1.866666667, 0.637708333, 1.282291667, 0.032083333, 0.025, 0.025],
    10: [0.640678494, 0.317283417, 0.638598108, 0.032083333, 0.025, 0.025],
}


def load(spark, tmp_path, lines):
    path = tmp_path / "graph.txt"
    path.write_text("\n".join(lines) + "\n")
    return read_adjacency(spark, str(path))


def ranks(df):
    return [round(r, 9) for _, r in rows(df.select("id", "rank"))]


@pytest.mark.parametrize("rounds", list(AFTER))
@pytest.mark.parametrize("slice_rows", [10_000, 1])
def test_rounds(spark, tmp_path, rounds, slice_rows):
    nodes, edges = load(spark, tmp_path, OPEN)
    got = op.pagerank(nodes, edges, rounds, slice_rows=slice_rows, max_hot=4)
    assert ranks(got) == AFTER[rounds]
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


@pytest.mark.parametrize("written", [False, True])
def test_links_stay_where_they_are(spark, tmp_path, written):
    """A round shuffles the credits only: one exchange, and no shuffle of links, nodes or ranks."""
    prepared = graph.prepare(*load(spark, tmp_path, OPEN))
    start = prepared.nodes.selectExpr("id", "slices", "1D as rank")
    if written:
        start = prepared.keep(start)
    after = graph.gather(prepared.nodes, graph._credits(prepared, start), 6)
    plan = list(nodes_of(after._jdf.queryExecution().executedPlan()))
    moved = [node.toString() for node in plan if node.nodeName() == "Exchange"]
    assert len(moved) == 1 and "hashpartitioning(dst" in moved[0]
    prepared.release()


def test_the_session_stays_as_it_is(spark, tmp_path):
    """No setting changes, also not while a round runs, and no table stays in the catalogue."""
    nodes, edges = load(spark, tmp_path, OPEN)
    settings, tables, seen = dict(spark.sql("set").collect()), spark.catalog.listTables(), []
    gather = graph.gather

    def watched(*args, **kwargs):
        seen.append(dict(spark.sql("set").collect()) == settings)
        return gather(*args, **kwargs)

    graph.gather = watched
    try:
        op.pagerank(nodes, edges, 3, tol=0.0)
    finally:
        graph.gather = gather
    assert seen == [True] * 3 and spark.catalog.listTables() == tables


@pytest.mark.parametrize("tol", [0.3, 0.01])
def test_tolerance(spark, tmp_path, tol):
    """Stops where the rounds, taken one by one, first change no rank by more than the tolerance."""
    nodes, edges = load(spark, tmp_path, OPEN)
    state = {n: 1.0 for (n,) in rows(nodes)}
    for done in range(1, 31):
        after = dict(rows(op.pagerank(nodes, edges, done))) if done == 2 else None
        degree = {n: sum(1 for s, _ in rows(edges) if s == n) for n in state}
        new = {n: 0.15 / 6 + 0.85 * sum(state[s] / degree[s] for s, d in rows(edges) if d == n) for n in state}
        assert after is None or after == pytest.approx(new)
        change, state = max(abs(new[n] - state[n]) for n in state), new
        if change <= tol:
            break
    assert dict(rows(op.pagerank(nodes, edges, 30, tol=tol))) == pytest.approx(state, abs=1e-12)


def test_hot_node_is_sliced(spark):
    edges = spark.createDataFrame(
        [("hub", f"n{i}") for i in range(300)] + [(f"n{i}", "hub") for i in range(300)],
        "src string, dst string",
    )
    nodes = edges.select(edges.src.alias("id")).distinct()
    prepared = graph.prepare(nodes, edges, slice_rows=10)
    assert prepared.sliced and prepared.n_nodes == 301
    slices = {r.id: r.slices for r in prepared.nodes.collect()}
    assert slices["hub"] == 30 and slices["n0"] == 1
    largest = prepared.links.groupBy("src", "slice").count().agg({"count": "max"}).first()[0]
    assert largest < 40 and prepared.links.count() == 600
    prepared.release()
    plain = graph.prepare(nodes, edges)
    assert not plain.sliced
    plain.release()
    assert ranks(op.pagerank(nodes, edges, 3, slice_rows=10)) == ranks(op.pagerank(nodes, edges, 3))


@pytest.mark.parametrize("slice_rows", [10_000, 4])
@pytest.mark.parametrize("hashed", [True, False])
def test_names_are_numbered_for_the_rounds(spark, monkeypatch, slice_rows, hashed):
    """Ranks are those of numbers as names, with repeated edges and hot nodes; the links of a round are not sorted."""
    monkeypatch.setattr(graph, "HASH_BYTES", graph.HASH_BYTES if hashed else 1)
    pairs = [("hub", f"n{i % 40}") for i in range(90)] + [(f"n{i}", "hub") for i in range(40)] + [("n1", "n2")] * 30 + [("n3", "sink")]
    number = {n: i for i, n in enumerate(sorted({n for p in pairs for n in p}))}
    edges = spark.createDataFrame(pairs, "src string, dst string")
    nodes = spark.createDataFrame([(n,) for n in number] + [("alone",), ("hub",)], "id string")
    numbers = spark.createDataFrame([(number[s], number[d]) for s, d in pairs], "src int, dst int")
    listed = spark.createDataFrame([(i,) for i in number.values()] + [(-1,)], "id int")
    got = dict(rows(op.pagerank(nodes, edges, 4, slice_rows=slice_rows, max_hot=8)))
    want = dict(rows(op.pagerank(listed, numbers, 4)))
    assert got == pytest.approx({n: want[i] for n, i in number.items()} | {"alone": want[-1]})
    assert dict(rows(op.pagerank(nodes.limit(0), edges, 4, on_missing="add"))).keys() == set(number)
    with pytest.raises(ValueError, match="'sink'"):
        op.pagerank(nodes.filter("id != 'sink'"), edges, 4)
    prepared = graph.prepare(nodes, edges, slice_rows=slice_rows, max_hot=8, numbered=True)
    assert prepared.hashed == hashed and prepared.sliced == (slice_rows == 4)
    assert dict(prepared.links.dtypes)["src"] == "bigint" and prepared.links.count() == len(set(pairs))
    credits = graph._credits(prepared, prepared.nodes.selectExpr("id", "slices", "1D as rank"))
    joins = [n.nodeName() for n in nodes_of(credits._jdf.queryExecution().executedPlan()) if "Join" in n.nodeName()]
    assert joins == ["ShuffledHashJoin" if hashed else "SortMergeJoin"]
    prepared.release()


@pytest.mark.parametrize("rounds", [1, 3])
def test_steps_agree_with_the_loop(spark, tmp_path, rounds):
    nodes, edges = load(spark, tmp_path, OPEN)
    state = nodes.selectExpr("id", "1D as rank")
    for _ in range(rounds):
        state = spark.createDataFrame(rows(op.pagerank_step(nodes, edges, state)), "id string, rank double")
    assert ranks(state) == ranks(op.pagerank(nodes, edges, rounds, checkpoint_every=2))


def test_mass_of_closed_graph(spark, tmp_path):
    nodes, edges = load(spark, tmp_path, CLOSED)
    for rounds, want in ((1, [0.9, 0.475, 1.325]), (10, [0.548873512, 0.292345922, 0.552529374])):
        got = ranks(op.pagerank(nodes, edges, rounds))
        assert got == want
        assert sum(got) == pytest.approx(1 + 0.85**rounds * 2)
    uniform = ranks(op.pagerank(nodes, edges, 4, init="uniform"))
    assert sum(uniform) == pytest.approx(1.0)


def test_contributions_keep_repeated_edges(spark, tmp_path):
    nodes, edges = load(spark, tmp_path, ["E\tA\tA\tD", "A\tA", "D"])
    assert rows(op.with_out_degree(edges)) == [
        ("A", "A", 1), ("E", "A", 3), ("E", "A", 3), ("E", "D", 3)
    ]
    credit = op.contributions(edges, nodes.selectExpr("id", "3D as rank"))
    assert rows(credit) == [("A", "A", 3.0), ("E", "A", 1.0), ("E", "A", 1.0), ("E", "D", 1.0)]


def test_self_loop(spark, tmp_path):
    nodes, edges = load(spark, tmp_path, ["A\tA"])
    assert ranks(op.pagerank(nodes, edges, 1)) == [1.0]


def test_missing_node(spark, tmp_path):
    nodes, edges = load(spark, tmp_path, ["A\tB", "B\tX"])
    with pytest.raises(ValueError, match="'X'"):
        op.pagerank(nodes, edges, 1)
    got = op.pagerank(nodes, edges, 1, on_missing="add")
    assert dict(rows(got)) == pytest.approx({"A": 0.05, "B": 0.9, "X": 0.9})
    with pytest.raises(ValueError, match="on_missing"):
        op.pagerank(nodes, edges, 1, on_missing="drop")


def test_nodes_without_edges(spark):
    nodes = spark.createDataFrame([("A",), ("B",), ("B",)], "id string")
    edges = spark.createDataFrame([], "src string, dst string")
    assert rows(op.pagerank(nodes, edges, 2)) == [("A", pytest.approx(0.075)), ("B", pytest.approx(0.075))]


def test_adjacency_parsing(spark, tmp_path):
    lines = ["A \tB\t", "", " \t ", "A\tC\t\tB", "B\t two words \x01", "C"]
    nodes, edges = load(spark, tmp_path, lines)
    assert rows(nodes) == [("A",), ("B",), ("C",)]
    assert rows(edges) == [("A", "B"), ("A", "B"), ("A", "C"), ("B", "two words")]


@pytest.mark.parametrize("line_links", [1, 2, 1000])
def test_adjacency_sink(spark, tmp_path, line_links):
    nodes, edges = load(spark, tmp_path, OPEN)
    out = str(tmp_path / "out")
    write_adjacency(nodes, edges, out, line_links=line_links)
    again = read_adjacency(spark, out)
    assert rows(again[0]) == rows(nodes)
    assert rows(again[1]) == rows(edges)
    if line_links == 1000:
        assert rows(spark.read.text(out)) == sorted((line,) for line in OPEN)
    with pytest.raises(Exception, match="already exists"):
        write_adjacency(nodes, edges, out)


def test_repeated_link_beyond_one_line(spark, tmp_path):
    edges = spark.range(2500).selectExpr("'A' as src", "'B' as dst")
    nodes = spark.createDataFrame([("A",), ("B",)], "id string")
    out = str(tmp_path / "out")
    write_adjacency(nodes, edges, out, line_links=500)
    assert rows(read_adjacency(spark, out)[1].groupBy("src", "dst").count()) == [("A", "B", 2500)]
    longest = spark.read.text(out).selectExpr("max(size(split(value, '\t')))").first()[0]
    assert longest < 700


def test_ranked_adjacency(spark, tmp_path):
    nodes, edges = load(spark, tmp_path, OPEN)
    after = op.pagerank(nodes, edges, 1)
    out = str(tmp_path / "out")
    write_adjacency(after, edges, out, files=2)
    again, linked = read_ranked_adjacency(spark, out)
    assert ranks(again) == AFTER[1]
    assert rows(linked) == rows(edges)
    line = spark.read.text(out).filter("value like 'E%'").first().value
    node, rest = line.split("\t")
    rank, *links = rest.split(" ")
    assert (node, links) == ("E", ["A", "A", "D"]) and float(rank) == pytest.approx(0.025)


def test_hub_has_one_line(spark, tmp_path):
    edges = spark.range(3000).selectExpr("'H' as src", "concat('n', id % 2900) as dst")
    nodes = spark.sql("select 'H' as id union all select 'n1' union all select 'n1'")
    out = str(tmp_path / "out")
    write_adjacency(nodes, edges, out, files=2, ordered=True)
    lines = [r.value.split("\t") for r in spark.read.text(out).collect()]
    assert sorted((line[0], len(line)) for line in lines) == [("H", 3001), ("n1", 1)]
    assert rows(read_adjacency(spark, out)[1]) == rows(edges)


@pytest.fixture
def short(monkeypatch):
    """Lines count as long from 1,000 bytes on."""
    monkeypatch.setattr(text, "LONG_LINE_BYTES", 1000)
    monkeypatch.setattr(readers, "LONG_LINE_BYTES", 1000)


@pytest.mark.parametrize("ordered", [True, False])
def test_long_lines_are_held_by_no_task(spark, tmp_path, short, ordered):
    """Hubs have a line and a file each, in their place, that is written and read link by link."""
    hubs = spark.range(5000).selectExpr("if(id % 2 = 0, 'H', 'U') as src", "concat('n', if(id < 2600, 1, id % 900)) as dst")
    few = spark.range(300).selectExpr("concat(substr('AHIZ', cast(id % 4 + 1 as int), 1), id) as src", "concat('n', id % 7) as dst")
    edges = hubs.unionByName(few)
    nodes = edges.selectExpr("src as id").filter("id != 'U'").unionByName(spark.sql("select 'alone' as id union all select 'alone'"))
    out = str(tmp_path / "out")
    write_adjacency(nodes, edges, out, files=3, ordered=ordered)
    lines, fields = readers.read_lines(spark, out)
    assert lines.selectExpr("max(length(value))").first()[0] < 1000
    assert fields.selectExpr("count(distinct file)", "max(length(value))").first() == (2, 4)
    again, linked = read_adjacency(spark, out)
    assert rows(linked) == rows(edges)
    assert rows(again) == sorted({(r.src,) for r in edges.collect()} | {("alone",)})
    files = [f.read_text() for f in sorted(Path(out).glob("part-*"))]
    assert [f.count("\n") for f in files if len(f) > 5000] == [0, 0] and (Path(out) / "_SUCCESS").exists()
    texts = [line for f in files if f for line in f.removesuffix("\n").split("\n")]
    assert len(texts) == 303
    names = [line.split("\t")[0] for line in texts]
    assert names == sorted(names) or not ordered
    for line in texts:
        links = line.rstrip("\t").split("\t")[1:]
        assert links == sorted(links)
    assert rows(read_pairs(spark, out)) == sorted(tuple([*t.split("\t", 1), ""][:2]) for t in texts)
    with pytest.raises(Exception, match="already exists"):
        write_adjacency(nodes, edges, out)


def test_long_lines_of_other_programs(spark, tmp_path, short):
    """Files with a long line among others, with other line ends, and without any line end, some blank."""
    links = [f"n{i}" for i in range(700)]
    line = "\t".join(["H", *links])
    files = {
        "mixed": f"A\tB\n{line}\nC\tA\n", "ends": "\r\n".join(f"D{i}\tA" for i in range(400)),
        "alone": f" {line}\t\t x ", "blank": "\t" * 1200, "empty_id": "\t" * 1200 + "A", "no_link": "N" * 2000, "small": "S\tA\n",
    }
    for name, content in files.items():
        (tmp_path / f"{name}.txt").write_text(content)
    nodes, edges = read_adjacency(spark, str(tmp_path))
    want = [("H", n) for n in links] * 2 + [("A", "B"), ("C", "A"), ("H", "x"), ("", "A"), ("S", "A")] + [(f"D{i}", "A") for i in range(400)]
    assert rows(edges) == sorted(want)
    assert rows(nodes) == sorted({(s,) for s, _ in want} | {("N" * 2000,)})
    for name in files:
        file = str(tmp_path / f"{name}.txt")
        pairs = spark.read.text(file).selectExpr("split(value, '\t', 2) as p").selectExpr("p[0]", "coalesce(get(p, 1), '')")
        assert rows(read_pairs(spark, file)) == rows(pairs)
    _, fields = readers.read_lines(spark, str(tmp_path))
    assert {r.file.split("/")[-1] for r in fields.select("file").distinct().collect()} == {f"{n}.txt" for n in ("alone", "blank", "empty_id", "no_link")}


def test_long_lines_with_ranks(spark, tmp_path, short):
    edges = spark.range(2000).selectExpr("'H' as src", "concat('n', id % 900) as dst")
    nodes = spark.createDataFrame([("H", 1.5), ("H", 1.25), ("n1", 2.0)], "id string, rank double")
    write_adjacency(nodes, edges, str(tmp_path / "out"), ordered=True)
    again, linked = read_ranked_adjacency(spark, str(tmp_path / "out"))
    assert rows(again) == [("H", 1.5), ("n1", 2.0)] and rows(linked) == rows(edges)
    with pytest.raises(Exception, match="node without rank"):
        write_adjacency(nodes.filter("id != 'H'"), edges, str(tmp_path / "none"))
    broken = nodes.unionByName(spark.createDataFrame([("a\nb", 1.0)], nodes.schema))
    with pytest.raises(Exception, match="separator"):
        write_adjacency(broken, edges, str(tmp_path / "broken"))
    assert not (tmp_path / "broken").exists()


def test_line_too_long_raises(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(text, "MAX_LINE_BYTES", 10)
    nodes, edges = load(spark, tmp_path, ["A\tlonger\tlongest", "B\tA"])
    with pytest.raises(ValueError, match="'A'"):
        write_adjacency(nodes, edges, str(tmp_path / "out"))


def test_names_with_spaces(spark, tmp_path):
    edges = spark.createDataFrame([("Old York", "New York"), ("B", "Old York")], "src string, dst string")
    nodes = spark.createDataFrame([("Old York", 1.5), ("New York", 2.0), ("B", 1.0)], "id string, rank double")
    write_adjacency(nodes.select("id"), edges, str(tmp_path / "plain"))
    assert rows(read_adjacency(spark, str(tmp_path / "plain"))[1]) == rows(edges)
    write_adjacency(nodes, edges, str(tmp_path / "ranked"), link_sep="\t", ordered=True)
    again, linked = read_ranked_adjacency(spark, str(tmp_path / "ranked"), link_sep="\t")
    assert rows(again) == rows(nodes) and rows(linked) == rows(edges)
    first = spark.read.text(str(tmp_path / "ranked")).first().value
    assert first == "B\t1.0\tOld York"
    with pytest.raises(Exception, match="separator"):
        write_adjacency(nodes, edges, str(tmp_path / "spaces"))


@pytest.mark.parametrize("name", ["a\tb", "a\nb", "a\rb", None])
def test_names_that_no_line_can_hold(spark, tmp_path, name):
    good = spark.createDataFrame([("A", "B")], "src string, dst string")
    nodes = spark.createDataFrame([("A",), ("B",)], "id string")
    for i, (n, e) in enumerate([
        (spark.createDataFrame([(name,)], "id string"), good),
        (nodes, spark.createDataFrame([("A", name)], "src string, dst string")),
    ]):
        with pytest.raises(Exception, match="separator|without a name"):
            write_adjacency(n, e, str(tmp_path / f"out{i}"))


def test_missing_node_in_a_step(spark, tmp_path):
    nodes, edges = load(spark, tmp_path, ["A\tB", "B\tX"])
    state = nodes.selectExpr("id", "1D as rank")
    with pytest.raises(Exception, match="'?X"):
        op.pagerank_step(nodes, edges, state).collect()
    got = op.pagerank_step(nodes, edges, state, on_missing="add")
    assert rows(got) == rows(op.pagerank(nodes, edges, 1, on_missing="add"))
    with pytest.raises(Exception, match="without a rank: B"):
        op.contributions(edges, state.filter("id = 'A'")).collect()
    assert rows(op.contributions(edges, state.limit(0), on_missing="add")) == [("A", "B", 1.0), ("B", "X", 1.0)]
    with pytest.raises(ValueError, match="on_missing"):
        op.contributions(edges, state, on_missing="drop")
    strangers = edges.selectExpr("'Z' as src", "dst").filter("dst = 'B'")
    with pytest.raises(Exception, match="Z"):
        op.pagerank_step(nodes, strangers, state.selectExpr("'Z' as id", "rank")).collect()


@pytest.mark.parametrize("edge", [("A", None), (None, "A")])
def test_null_ends(spark, edge):
    nodes = spark.createDataFrame([("A",), ("B",)], "id string")
    edges = spark.createDataFrame([edge, ("A", "B")], "src string, dst string")
    for on_missing in ("error", "add"):
        with pytest.raises(ValueError, match="null"):
            op.pagerank(nodes, edges, 1, on_missing=on_missing)
        with pytest.raises(Exception, match="null|without a name"):
            op.pagerank_step(nodes, edges, nodes.selectExpr("id", "1D as rank"), on_missing=on_missing).collect()


def test_written_tables_go(spark, tmp_path):
    nodes, edges = load(spark, tmp_path, OPEN)
    prepared = graph.prepare(nodes, edges)
    folder = Path(prepared.scratch.folder)
    assert folder.exists()
    prepared.release()
    assert not folder.exists()
