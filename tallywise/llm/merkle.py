"""A Merkle manifest of a dataset: one tree for each key, a tree over their roots, proofs and versions (operator 11)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywise.operators.numbering import number_rows
from tallywise.session import Scratch

FANOUT = 2
DEPTH = 12  # levels of a block, which so has FANOUT ** DEPTH nodes at its foot


def digest(*parts: str) -> str:
    """H: the lowercase hex SHA-256 of the parts put together, digests as hex text."""
    return sha256("".join(parts).encode()).hexdigest()


def record(*fields: str | Column) -> Column:
    """H of a row: ``-`` for each null field, else its number of UTF-8 bytes, ``:`` and the value."""
    texts = [(F.col(f) if isinstance(f, str) else f).cast("string") for f in fields]
    sized = [F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.sha2(F.concat(*sized).cast("binary"), 256)


class Version:
    """A version of a block's nodes: those it copied, and all others shared with the version before.

    The first one holds all nodes, level by level from the block's foot. :meth:`changed` copies the path
    from one foot node to the top and nothing else; versions made before stay as they are.
    """

    def __init__(self, nodes: dict[tuple[int, int], str], sizes: list[int], before: Version | None = None, fanout: int = FANOUT) -> None:
        self.nodes, self.sizes, self.before, self.fanout = nodes, sizes, before, fanout

    @classmethod
    def first(cls, foot: Sequence[str], depth: int, whole: bool, fanout: int = FANOUT) -> Version:
        """The nodes above ``foot``: ``depth`` levels, or fewer if the block is a ``whole`` tree."""
        nodes, sizes, level = {}, [], list(foot)
        while True:
            nodes.update(((len(sizes), i), h) for i, h in enumerate(level))
            sizes.append(len(level))
            if len(sizes) > depth or (whole and len(level) == 1):
                return cls(nodes, sizes, fanout=fanout)
            level = [digest(*level[i : i + fanout]) for i in range(0, len(level), fanout)]

    def node(self, level: int, place: int) -> str:
        found, version = None, self
        while found is None:
            found, version = version.nodes.get((level, place)), version.before
        return found

    @property
    def top(self) -> str:
        return self.node(len(self.sizes) - 1, 0)

    def beside(self, level: int, place: int) -> tuple[str, str]:
        """The digests left and right of a node in its run, each side put together."""
        first = place - place % self.fanout
        run = range(first, min(first + self.fanout, self.sizes[level]))
        return "".join(self.node(level, i) for i in run if i < place), "".join(self.node(level, i) for i in run if i > place)

    def path(self, place: int) -> list[tuple[str, str]]:
        """What stands beside a foot node and its ancestors, up to the block's top."""
        out = []
        for level in range(len(self.sizes) - 1):
            out.append(self.beside(level, place))
            place //= self.fanout
        return out

    def changed(self, place: int, value: str) -> Version:
        """A version with another foot node: its copies of that node and the ancestors, in the block."""
        copied = {(0, place): value}
        for level, (left, right) in enumerate(self.path(place)):
            place //= self.fanout
            value = copied[level + 1, place] = digest(left, value, right)
        return Version(copied, self.sizes, self, self.fanout)


def fold(value: str, path: Sequence[tuple[str, str]]) -> str:
    """The root that a node and what stands beside its path give."""
    for left, right in path:
        value = digest(left, value, right)
    return value


PATH = "array<struct<left:string,right:string>>"
TOP = f"tree string, place long, path {PATH}, subroot string"
SIDES = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[dict], pa.Schema]]:
    """The rows of each block in turn, of rows sorted by (tree, block, place)."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and (held[0]["tree"], held[0]["block"]) != (row["tree"], row["block"]):
                yield held, batch.schema
                held = []
            held.append(row)
    if held:
        yield held, batch.schema


def _above(rows: list[dict]) -> tuple[list[tuple[str, str]], str | None]:
    """The path of the block's top and its tree's root, whose row comes before the block's own rows."""
    if rows[0]["place"] >= 0:
        return [], None
    row = rows.pop(0)
    return [(s["left"], s["right"]) for s in row["path"]], row["subroot"]


def _version(rows: list[dict], depth: int, fanout: int) -> Version:
    # Places have no gaps, so the first block is the whole tree if it isn't full; a full one ends in one node anyway.
    whole = rows[0]["block"] == 0 and len(rows) < fanout**depth
    return Version.first([r["digest"] for r in rows], depth, whole, fanout)


def _tops(depth: int, fanout: int):
    schema = pa.schema([("tree", pa.string()), ("place", pa.int64()), ("digest", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _ in _blocks(batches):
            top = {"tree": rows[0]["tree"], "place": rows[0]["block"], "digest": _version(rows, depth, fanout).top}
            yield pa.RecordBatch.from_pylist([top], schema)

    return run


def _paths(depth: int, fanout: int):
    """Rows of a level, and of each block the path of its top (place -1) → the path of each node."""
    schema = pa.schema([("tree", pa.string()), ("place", pa.int64()), ("path", SIDES), ("subroot", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _ in _blocks(batches):
            above, subroot = _above(rows)
            block = _version(rows, depth, fanout)
            out = []
            for i, row in enumerate(rows):
                path = [{"left": a, "right": b} for a, b in block.path(i) + above]
                out.append({"tree": row["tree"], "place": row["place"], "path": path, "subroot": subroot})
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _proofs(depth: int, fanout: int, keep: list[str]):
    """Rows of leaves, and of each block the path of its top (place -1) → each leaf's proof, and the root
    that it gives: an untouched leaf by its path, a tampered one by the version that it makes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, names in _blocks(batches):
            above, subroot = _above(rows)
            block = _version(rows, depth, fanout)
            out = []
            for i, row in enumerate(rows):
                path = block.path(i) + above
                if row["tampered"] is None:
                    root = fold(row["digest"], path)
                else:
                    # The version's copies end at the block's top; those of the levels above follow the path.
                    root = fold(block.changed(i, row["tampered"]).top, above)
                proof = digest(*(side for pair in path for side in pair))
                out.append({k: row[k] for k in keep} | {"subroot": subroot, "proof_sha256": proof, "folded_root": root})
            found = [(k, pa.string()) for k in ("subroot", "proof_sha256", "folded_root")]
            yield pa.RecordBatch.from_pylist(out, pa.schema([*(names.field(k) for k in keep), *found]))

    return run


def _nodes(depth: int, fanout: int):
    """Rows of leaves, and of each block the path of its top → all nodes of the blocks, and the copies of
    each version up to the root."""
    names = ("tree", "level", "place", "version", "digest")
    schema = pa.schema([(n, pa.string() if n in ("tree", "digest") else pa.int64()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _ in _blocks(batches):
            above, subroot = _above(rows)
            block = _version(rows, depth, fanout)
            tree, number = rows[0]["tree"], rows[0]["block"]

            def listed(version: Version, name: int | None, number: int = number, tree: str | None = tree) -> Iterator[tuple]:
                for (level, place), h in version.nodes.items():
                    yield tree, level, number * fanout ** (depth - level) + place, name, h

            out = list(listed(block, None))
            for i, row in enumerate(rows):
                if row["tampered"] is None:
                    continue
                version = block.changed(i, row["tampered"])
                out += listed(version, row["place"])
                base, value, level, place = block.top, version.top, len(block.sizes) - 1, number
                for left, right in above:
                    place = None if place is None or base == subroot else place // fanout
                    base, value, level = digest(left, base, right), digest(left, value, right), level + 1
                    out.append((tree, level, place, row["place"], value))
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema)

    return run


@dataclass(frozen=True)
class Manifest:
    """``leaves`` (tree, place, digest, tampered and the caller's columns; places from 0 in each tree),
    ``roots`` (tree, subroot), ``root``, and ``tops``, for each block of leaves the path of its top node up to
    the root and the root of its tree."""

    leaves: DataFrame
    roots: DataFrame
    tops: DataFrame
    root: str
    depth: int
    fanout: int

    def _dealt(self) -> DataFrame:
        return _dealt(self.leaves, self.tops, self.fanout**self.depth)

    def proofs(self, *keep: str) -> DataFrame:
        """(``keep``, subroot, proof_sha256, folded_root) of each leaf, ``keep`` being columns of the leaves."""
        kinds = "".join(f"{k} {self.leaves.schema[k].dataType.simpleString()}, " for k in keep)
        found = _proofs(self.depth, self.fanout, list(keep))
        return self._dealt().mapInArrow(found, f"{kinds}subroot string, proof_sha256 string, folded_root string")

    def paths(self) -> DataFrame:
        """(tree, place, path, subroot) of each leaf: the digests left and right of it and of each ancestor."""
        return self._dealt().mapInArrow(_paths(self.depth, self.fanout), TOP)

    def nodes(self) -> DataFrame:
        """(tree, level, place, version, digest): the nodes of the blocks of leaves. ``version`` is null for
        the first version; a tampered leaf's place names its own, which lists only the nodes it copied, up
        to the root. Above its tree's root a copy has no ``place``."""
        return self._dealt().mapInArrow(_nodes(self.depth, self.fanout), "tree string, level long, place long, version long, digest string")


def _dealt(nodes: DataFrame, tops: DataFrame | None, width: int) -> DataFrame:
    """The nodes of a level by block, each block in one task with its top's path before its rows."""
    rows = nodes.withColumn("block", F.floor(F.col("place") / width))
    if tops is not None:
        above = tops.select("tree", F.col("place").alias("block"), F.lit(-1).cast("long").alias("place"), "path", "subroot")
        rows = rows.unionByName(above, allowMissingColumns=True)
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "place")


def _climb(nodes: DataFrame, scratch: Scratch, depth: int, fanout: int) -> list[DataFrame]:
    """``nodes`` and the tables (tree, place, digest) of the tops of blocks above, until each tree is one."""
    levels = [nodes]
    while True:
        tops = _dealt(levels[-1], None, fanout**depth).mapInArrow(_tops(depth, fanout), "tree string, place long, digest string")
        levels.append(scratch.write(tops, "tops"))
        if not levels[-1].filter("place > 0").limit(1).count():
            return levels


def _descend(levels: list[DataFrame], tops: DataFrame, scratch: Scratch, depth: int, fanout: int) -> DataFrame:
    """The paths of the nodes of the first of ``levels``, from those of the blocks above the last."""
    for level in reversed(levels):
        tops = scratch.write(_dealt(level, tops, fanout**depth).mapInArrow(_paths(depth, fanout), TOP), "paths")
    return tops


def manifest(leaves: DataFrame, order: Sequence[str], scratch: Scratch, fanout: int = FANOUT, depth: int = DEPTH) -> Manifest:
    """The Merkle trees of ``leaves`` (tree, digest, tampered and others), one for each ``tree``, in the
    order of the columns ``order``, and the tree over their roots in the order of ``tree``, null first.

    While a level has several nodes, each ``fanout`` consecutive ones become their H, the last run fewer.
    Leaves are numbered by a range partitioning and cut into aligned blocks of ``fanout ** depth``; a
    task builds the nodes of a block, and the tops of all blocks are the leaves of the next, far smaller
    table, until a tree is one block. On the way down, each block's top gets the path above it. A tampered
    leaf makes a version of its block that copies the leaf's ancestors there and shares all else; above
    the block its copies follow from the top's path, in the task of the leaf's own block, so that the
    versions never meet in one task at the root.

    A null tree is a tree like any other. Leaves that tie in ``order`` and are equal give the same root
    whichever comes first. Without leaves the root is H of nothing.
    """
    names = [c for c in leaves.columns if c != "tree"]
    numbered = number_rows(leaves, order, scratch, by=["tree"], name="place")
    numbered = scratch.write(numbered.select("tree", *names, (F.col("place") - 1).alias("place")), "leaves")
    levels = _climb(numbered.select("tree", "place", "digest"), scratch, depth, fanout)
    roots = levels[-1].select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest")
    roots = number_rows(roots, ["of"], scratch, by=["tree"], name="place")
    roots = scratch.write(roots.withColumn("place", F.col("place") - 1), "subroots")
    upper = _climb(roots.select("tree", "place", "digest"), scratch, depth, fanout)
    top = upper[-1].first()
    ends = upper[-1].select("tree", "place", F.array().cast(PATH).alias("path"), F.lit(None).cast("string").alias("subroot"))
    found = _descend(upper[:-1], ends, scratch, depth, fanout).select("tree", "place", "path")
    named = roots.join(found, ["tree", "place"])
    ends = named.select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("place"), "path", F.col("digest").alias("subroot"))
    tops = _descend(levels[1:-1], ends, scratch, depth, fanout)
    roots = roots.select(F.col("of").alias("tree"), F.col("digest").alias("subroot"))
    return Manifest(numbered, roots, tops, digest() if top is None else top["digest"], depth, fanout)


def verify_documents(docs: DataFrame, scratch: Scratch, fanout: int = FANOUT, depth: int = DEPTH) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of each row of ``documents``, a
    tree for each ``lang``. Rows whose ``crc32`` of the decimal doc_id 7 divides are tampered with: 1 is added to
    n_chars. ``folded_root`` comes from the tampered leaf, where there is one, and the siblings as they were.

    A null doc_id comes first in its tree and is never tampered with; a null n_chars stays null, so that row
    verifies. Rows that repeat a doc_id are leaves of their own, ordered by digest. Empty and null texts
    differ. Columns besides doc_id, source, lang, n_chars and text are ignored; no row gives no row.
    """
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    changed = [F.col("n_chars") + 1 if f == "n_chars" else F.col(f) for f in fields]
    hit = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    tampered = F.when(hit, record(*changed)).alias("tampered")
    leaves = docs.select(F.col("lang").cast("string").alias("tree"), "doc_id", record(*fields).alias("digest"), tampered)
    found = manifest(leaves, ["doc_id", "digest"], scratch, fanout, depth)
    root = F.lit(found.root)
    rows = found.proofs("doc_id", "digest").withColumnRenamed("digest", "leaf")
    verified = (F.col("folded_root") == root).alias("verified")
    return rows.select("doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root", verified)
