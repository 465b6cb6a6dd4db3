"""The Merkle manifest: blocks of any depth, versions that share nodes, nulls, ties and repeats."""

from __future__ import annotations

import zlib
from hashlib import sha256

import pytest

from tallywise.llm.merkle import Version, digest, fold, manifest, record, verify_documents
from tallywise.session import Scratch

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, place int, digest string"


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf(row, more=0):
    doc_id, source, lang, n_chars, text = row[:5]
    n_chars = None if n_chars is None else n_chars + more
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def levels(foot, fanout):
    out = [foot]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i : i + fanout])) for i in range(0, len(out[-1]), fanout)])
    return out


def around(tree, i, fanout):
    path = []
    for level in tree[:-1]:
        first = i - i % fanout
        path.append(("".join(level[first:i]), "".join(level[i + 1 : first + fanout])))
        i //= fanout
    return path


def brute(rows, fanout):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        mine = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = (mine, levels([leaf(r) for r in mine], fanout))
    top = levels([trees[lang][1][-1][0] for lang in langs], fanout)
    out = []
    for n, lang in enumerate(langs):
        mine, tree = trees[lang]
        for i, row in enumerate(mine):
            path = around(tree, i, fanout) + around(top, n, fanout)
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            value = leaf(row, 1 if hit else 0)
            for a, b in path:
                value = h(a + value + b)
            proof = h("".join(a + b for a, b in path))
            out.append((row[0], leaf(row), tree[-1][0], top[-1][0], proof, value, value == top[-1][0]))
    return out


ODD = [
    (None, "s", "en", 1, "x"), (None, None, None, None, None), (3, "", "", 0, ""), (3, "", "", 0, ""), (4, "s", "", None, None),
    (7, "é漢🙂", "zz", 3, "é漢🙂"), (8, "s", "é", 100_000, "word " * 20_000), (-5, "s", "en", 2, "a\nb"), (26, "s", None, None, "x"),
]


@pytest.mark.parametrize(("fanout", "depth"), [(2, 12), (2, 2), (3, 1), (2, 3)])
def test_documents_brute_force(spark, fanout, depth):
    many = [(i * 3, f"s{i % 4}", f"l{i % 5 if i % 3 else 0}", i, "t" * (i % 7)) for i in range(150)]
    rows = [(*r, "clash", 1, "clash") for r in many + many[:3] + ODD]
    got = verify_documents(spark.createDataFrame(rows, SCHEMA), Scratch(spark), fanout, depth).collect()
    want = brute(rows, fanout)
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert 0 < sum(not r.verified for r in got) < len(got)


@pytest.mark.parametrize("n", [0, 1])
def test_hardly_any_rows(spark, n):
    rows = [(*r, "clash", 1, "clash") for r in ODD[:n]]
    got = verify_documents(spark.createDataFrame(rows, SCHEMA), Scratch(spark)).collect()
    assert list(map(tuple, got)) == brute(rows, 2)


def test_version_copies_ancestors_only():
    foot = [h(str(i)) for i in range(11)]
    first = Version.first(foot, 9, whole=True)
    second = first.changed(5, h("new"))
    third = second.changed(0, h("other"))
    assert sorted(second.nodes) == [(0, 5), (1, 2), (2, 1), (3, 0), (4, 0)]
    assert first.top == levels(foot, 2)[-1][0]
    assert second.top == levels([*foot[:5], h("new"), *foot[6:]], 2)[-1][0]
    assert third.top == levels([h("other"), *foot[1:5], h("new"), *foot[6:]], 2)[-1][0]
    assert third.node(0, 7) is first.node(0, 7) and third.node(1, 2) is second.node(1, 2)
    assert fold(foot[10], first.path(10)) == first.top


def test_nodes_and_paths_of_versions(spark):
    """Every version lists one node a level up to the root, and the first version all nodes of its blocks."""
    rows = spark.createDataFrame([(f"k{i % 2}", i, i % 4 == 0) for i in range(40)], "tree string, i long, hit boolean")
    rows = rows.select("tree", "i", record("i").alias("digest"), "hit")
    rows = rows.selectExpr("tree", "i", "digest", "case when hit then sha2(digest, 256) end as tampered")
    found = manifest(rows, ["i"], Scratch(spark), depth=2)
    nodes = found.nodes().collect()
    trees = {k: levels([h(f"{len(str(i))}:{i}") for i in range(40) if f"k{i % 2}" == k], 2) for k in ("k0", "k1")}
    base = {(n.tree, n.level, n.place): n.digest for n in nodes if n.version is None}
    assert all(trees[t][level][place] == d for (t, level, place), d in base.items())
    assert len(base) == sum(len(level) for k in trees for level in trees[k][:3])
    versions = {(n.tree, n.version) for n in nodes if n.version is not None}
    assert versions == {("k0", i) for i in range(0, 20, 2)}
    for tree, version in versions:
        mine = {n.level: n for n in nodes if (n.tree, n.version) == (tree, version)}
        assert sorted(mine) == list(range(7))  # five levels above 20 leaves and the one above both trees
        assert [mine[level].place for level in range(6)] == [version >> level for level in range(6)] and mine[6].place is None
        foot = list(trees[tree][0])
        foot[version] = mine[0].digest
        assert mine[5].digest == levels(foot, 2)[-1][0] and mine[6].digest == digest(mine[5].digest, trees["k1"][-1][0])
    for row in found.paths().collect():
        assert fold(trees[row.tree][0][row.place], [(s.left, s.right) for s in row.path]) == found.root
