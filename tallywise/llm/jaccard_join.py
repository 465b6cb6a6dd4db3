"""Similarity join of documents on the Jaccard measure of their word n-grams (operator 5)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywise.llm import tables, words
from tallywise.llm.components import components
from tallywise.operators.skew import attach_totals
from tallywise.session import Scratch

SLICE = 1 << 19  # bytes of text whose words and sets a task holds at once
BITS = 56  # of a shingle's hash; the upper byte of a key holds its rarity class
SKETCH = 1 << 18
FLAGS = 1 << 21
HOT = 2000  # a shingle is hot if its sketch cell holds more than 1 / HOT of all shingles
SALTS = 64
BLOCK = 1024  # classes of a component whose pairs a task verifies together, with those of another block
CLASS = 512  # shingles of a set that count for one more class
WIDE = 1 << 12  # shingles of two blocks that are counted at once


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    fresh = np.ones(len(values), bool)
    fresh[1:] = values[1:] != values[:-1]
    return values[fresh]


def _sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], list[int]]]:
    """For each slice of the batches its rows, their sets of shingle hashes and the sets' digests."""
    for batch in batches:
        for part, data, offsets in words.slices(batch, "text", SLICE):
            starts, ends, at = words.word_bounds(data, offsets)
            hashes = words.word_hashes(data, starts, ends)
            sets = [_distinct(s) for s in words.shingle_sets(hashes, at, n, BITS)]
            digests = [int(words.mix(np.add.reduce(words.mix(s), keepdims=True) + np.uint64(len(s))).view(np.int64)[0]) for s in sets]
            yield part, sets, digests


def _parity(s: np.ndarray) -> bytes:
    """A bit for each of so many cells as the set has shingles (64 or the next power of two): whether the
    number of its shingles there is odd. Two sets differ by one shingle at least for each bit that differs."""
    cells = 1 << max(6, (len(s) - 1).bit_length())
    counts = np.bincount((s & np.uint64(cells - 1)).astype(np.int64), minlength=cells)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def _describe(n: int):
    names = ["id", "copy", "size", "cls", "parity", "seg", "part"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SKETCH, np.int64)
        ids = None
        for part, sets, digests in _sets(batches, n):
            ids, sizes = part.column("id"), [len(s) for s in sets]
            cells = np.concatenate(sets) & np.uint64(SKETCH - 1)
            counts += np.bincount(cells.astype(np.int64), minlength=SKETCH)
            cls = [d if k else None for d, k in zip(digests, sizes, strict=True)]
            parity = [_parity(s) if len(s) else None for s in sets]
            columns = [pa.array(sizes, pa.int64()), pa.array(cls, pa.int64()), pa.array(parity, pa.binary())]
            yield pa.record_batch([ids, part.column("copy"), *columns, pa.nulls(len(ids), pa.int32()), pa.nulls(len(ids), pa.binary())], names)
        if ids is not None:
            rows = tables.segments(counts)
            none = len(rows)
            columns = [pa.nulls(none, ids.type), *(pa.nulls(none, pa.int64()) for _ in range(3)), pa.nulls(none, pa.binary())]
            yield pa.record_batch([*columns, rows["seg"], rows["part"]], names)

    return run


def _firsts(batches: Iterator[pa.RecordBatch], flags: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """The rows whose text no row of the task before had, of those that ``flags`` marks."""
    seen: set[int] = set()
    for batch in batches:
        keep = np.zeros(len(batch), bool)
        copies = batch["copy"].to_numpy()
        marked = np.arange(len(batch)) if flags is None else np.flatnonzero(flags[copies.view(np.uint64) % np.uint64(FLAGS)])
        for i in marked.tolist():
            keep[i] = copies[i] not in seen
            seen.add(copies[i])
        yield batch.filter(pa.array(keep))


def _prefixes(n: int, percent: int, rarity: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies within a task give one set of rows
        for _, sets, digests in _sets(_firsts(batches), n):
            out: list[tuple[np.ndarray, ...]] = []
            for s, cls in zip(sets, digests, strict=True):
                size = len(s)
                if not size or cls in seen:
                    continue
                seen.add(cls)
                keys = np.sort((rarity[(s & np.uint64(SKETCH - 1)).astype(np.int64)] << np.uint64(BITS)) | s)
                take = size - -(-percent * size // 100) + 1
                out.append((keys[:take], np.full(take, cls), np.full(take, size, np.int32), np.arange(take, dtype=np.int32)))
            if out:
                keys, cls, size, pos = map(np.concatenate, zip(*out, strict=True))
                yield pa.record_batch(list(map(pa.array, (keys.view(np.int64), cls, size, pos))), ["key", "cls", "size", "pos"])

    return run


POSTING = "key long, cls long, size int, pos int, pivot long, pivot_size int, pivot_pos int"


def _groups(hot: int):
    """Rows sorted by key and salt, those of a class together → the rows of groups with two classes at least, each with the
    first row of its group (the pivot). Only the last row and the pivot of a group are held. Of a hot
    key, whose rows are spread over salts, a class that is alone under its salt comes out too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: tuple | None = None  # key, salt, pivot row, last cls, whether the pivot's own row is out
        for batch in batches:
            key, salt, cls, size, pos = (batch[k].to_numpy() for k in ("key", "salt", "cls", "size", "pos"))
            if not len(key):
                continue
            head = np.ones(len(key), bool)
            head[1:] = (key[1:] != key[:-1]) | (salt[1:] != salt[:-1])
            fresh = head.copy()
            fresh[1:] |= cls[1:] != cls[:-1]
            goes_on = state is not None and state[0] == key[0] and state[1] == salt[0]
            if goes_on:
                head[0], fresh[0] = False, cls[0] != state[3]
            group = np.cumsum(head) - (not goes_on)
            heads = np.flatnonzero(head)
            rows = np.stack([cls, size, pos], 1).astype(np.int64)
            pivots = np.concatenate([np.array([state[2]] if goes_on else [], np.int64).reshape(-1, 3), rows[heads]])
            keys = np.concatenate([key[:1] if goes_on else key[:0], key[heads]])
            others = np.flatnonzero(fresh & ~head)
            out = np.zeros(len(pivots), bool)
            out[0] = goes_on and state[4]
            lead = ((np.bincount(group[others], minlength=len(pivots)) > 0) | (keys >> BITS >= hot)) & ~out
            own = np.concatenate([pivots[lead], rows[others]])
            piv = np.concatenate([pivots[lead], pivots[group[others]]])
            columns = [np.concatenate([keys[lead], key[others]]), own[:, 0], *own[:, 1:].astype(np.int32).T, piv[:, 0], *piv[:, 1:].astype(np.int32).T]
            yield pa.record_batch(list(map(pa.array, columns)), ["key", "cls", "size", "pos", "pivot", "pivot_size", "pivot_pos"])
            state = (key[-1], salt[-1], pivots[-1], cls[-1], bool(out[-1] or lead[-1]))

    return run


def _flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    flags = np.zeros(FLAGS, np.uint8)
    for batch in batches:
        flags[batch["copy"].to_numpy().view(np.uint64) % np.uint64(FLAGS)] = 1
    yield tables.segments(flags)


def _wanted(n: int, flags: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for _, sets, digests in _sets(_firsts(batches, flags), n):
            cls, data = [], []
            for s, c in zip(sets, digests, strict=True):
                if len(s) and c not in seen:
                    seen.add(c)
                    cls.append(c)
                    data.append(s.tobytes())
            if cls:
                yield pa.record_batch([pa.array(cls, pa.int64()), pa.array(data, pa.binary())], ["cls", "shingles"])

    return run


def _near(percent: int):
    """The pairs whose parities (:func:`_parity`) leave it open that they link."""

    def differ(x: bytes, y: bytes) -> int:
        if len(x) < len(y):
            x, y = y, x
        bits = int.from_bytes(x)
        for cells in (4 * len(x) >> i for i in range((len(x) // len(y)).bit_length() - 1)):
            bits = (bits >> cells) ^ (bits & ((1 << cells) - 1))
        return (bits ^ int.from_bytes(y)).bit_count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch["size_a"].to_numpy() + batch["size_b"].to_numpy()
            apart = np.array([differ(x, y) for x, y in zip(batch["pa"].to_pylist(), batch["pb"].to_pylist(), strict=True)], np.int64)
            keep = (100 + percent) * ((sizes - apart) // 2) >= percent * sizes
            yield pa.record_batch([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _possible(size: str, pos: str, size2: str, pos2: str, percent: int):
    """Length and positional filter for two classes that share the key at these positions. Two sets
    of sizes x, y link only if they share ``percent / (100 + percent) * (x + y)`` shingles, and when
    the key is their first common one they share at most one more than the shorter rest."""
    x, y = F.col(size), F.col(size2)
    length = (x * 100 >= y * percent) & (y * 100 >= x * percent)
    rest = F.least(x - F.col(pos), y - F.col(pos2))
    return length & (rest * (100 + percent) >= (x + y) * percent)


def _alike(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Which of the sets at ``left`` link with which of those at ``right``."""
    values, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = values[1:] != values[:-1]
    column = np.cumsum(fresh) - 1
    several = np.bincount(column)[column] > 1
    column, owner = (np.cumsum(fresh & several) - 1)[several], owner[several]
    same = np.zeros((len(left), len(right)), np.int64)
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, WIDE):
        a, b = np.searchsorted(column, [first, first + WIDE])
        holds = np.zeros((len(sets), int(column[b - 1]) - first + 1), np.float32)
        holds[owner[a:b], column[a:b] - first] = 1
        same += (holds[left] @ holds[right].T).astype(np.int64)
    sizes = np.array([len(x) for x in sets])
    return 100 * same >= percent * (sizes[left][:, None] + sizes[right] - same)


def _forest(linked: np.ndarray) -> tuple[list[int], list[int]]:
    """Links that connect what all links of a symmetric table connect, fewer than it has rows."""
    left, a, b = np.ones(len(linked), bool), [], []
    for start in range(len(linked)):
        todo = [start] if left[start] else []
        left[start] = False
        while todo:
            at = todo.pop()
            new = np.flatnonzero(linked[at] & left)
            left[new] = False
            a += [at] * len(new)
            b += new.tolist()
            todo += new.tolist()
    return a, b


def _block_links(percent: int, pairs: bool):
    """Rows sorted by block pair → its links: all pairs of classes, or pairs that connect the same classes
    and, with ``b`` null, the number of documents that each class links to. Only the rows of one block pair
    are held."""

    def links(rows: list[tuple]) -> pa.RecordBatch:
        cls, weight, side = (np.array(x) for x in list(zip(*rows, strict=True))[1:4])
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        sets = [np.frombuffer(r[4], np.uint64) for r in rows]
        linked = np.zeros((len(rows), len(rows)), bool)
        if rows[0][0][2] == rows[0][0][4] and rows[0][0][1] == rows[0][0][3]:  # a block with itself
            linked[:] = _alike(sets, left, left, percent)
            np.fill_diagonal(linked, False)
        elif len(left) and len(right):
            across = _alike(sets, left, right, percent)
            linked[np.ix_(left, right)], linked[np.ix_(right, left)] = across, across.T
        a, b = np.nonzero(linked & (cls[:, None] < cls)) if pairs else map(np.array, _forest(linked))
        a, b = cls[a.astype(np.int64)], cls[b.astype(np.int64)]
        if pairs:
            return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
        n = (linked * weight).sum(1)
        some = np.flatnonzero(n)
        columns = [np.concatenate([a, cls[some]]), np.concatenate([b, np.zeros(len(some), np.int64)]), np.concatenate([np.zeros(len(a), np.int64), n[some]])]
        made = pa.record_batch([pa.array(x, pa.int64()) for x in columns], ["a", "b", "n"])
        none = np.arange(len(made)) >= len(a)
        return made.set_column(1, "b", pa.array(columns[1], pa.int64(), mask=none))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            keys = zip(*(batch[k].to_pylist() for k in ("label", "band", "low", "band2", "high")), strict=True)
            for row in zip(keys, *(batch[k].to_pylist() for k in ("cls", "weight", "side", "s")), strict=True):
                if held and held[0][0] != row[0]:
                    yield links(held)
                    held = []
                held.append(row)
        if held:
            yield links(held)

    return run


def _placed(members: DataFrame, percent: int, scratch: Scratch | None = None) -> DataFrame:
    """For each of ``members`` (label, cls, weight, size, copy), the classes of components, the pairs of blocks
    (array ``m``) in which its set is verified.

    A component whose sets fit one block is one. Of others: linked sizes differ by the factor 100 / ``percent``
    at most, so links lie in one band of sizes or in two neighbouring ones. The classes of a component
    and band are dealt by hash into blocks of about BLOCK classes, fewer of large sets, and each two blocks meet in one task, so that a
    component of any size is spread. Each step is a written table: :func:`attach_totals` reads its inputs several
    times, and steps within one plan would repeat all steps before them, in the plan and on the driver that keeps it.
    """
    scratch = scratch or Scratch(members.sparkSession)
    members = scratch.write(members.withColumn("load", 1 + F.col("size") / CLASS), "members")
    whole = scratch.write(members.groupBy("label").agg(F.count("*").alias("rows"), F.sum("load").alias("whole")), "whole")
    step = F.log(F.lit(100 / percent))
    band = F.col("size").cast("long") if percent == 100 else F.floor(F.log("size") / step + 1e-9)
    banded = attach_totals(members, whole, "label", "rows").withColumn("band", F.when(F.col("whole") <= BLOCK, F.lit(0)).otherwise(band))
    banded = scratch.write(banded.drop("rows", "whole").withColumn("group", F.xxhash64("label", "band")), "banded")
    counts = banded.groupBy("label", "band").agg(F.count("*").alias("n"), F.ceil(F.sum("load") / BLOCK).alias("blocks"))
    # Each band tells its blocks to the bands beside it.
    names = ("band", "n", "blocks", "above", "below")
    none, at, blocks = F.lit(0).cast("long"), F.col("band"), F.col("blocks")
    told = ((at, F.col("n"), blocks, none, none), (at - 1, none, none, blocks, none), (at + 1, none, none, none, blocks))
    told = F.array(*(F.struct(*(x.alias(k) for k, x in zip(names, each, strict=True))) for each in told))
    beside = counts.select("label", F.explode(told).alias("t")).groupBy("label", "t.band").agg(*(F.max(f"t.{k}").alias(k) for k in names[1:]))
    groups = scratch.write(beside.filter("n > 0").select(F.xxhash64("label", "band").alias("group"), *names[1:]), "groups")
    rows = attach_totals(banded, groups, "group", "n")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("cls", F.lit(1)), F.col("blocks")))

    def meets(count: str, key: Callable[[Column], tuple]) -> Column:
        names = ("band", "low", "band2", "high", "side")
        each = F.sequence(F.lit(0).cast("long"), F.col(count) - 1)
        made = F.transform(each, lambda j: F.struct(*(x.cast("long").alias(k) for k, x in zip(names, key(j), strict=True))))
        return F.when(F.col(count) > 0, made).otherwise(F.array().cast(f"array<struct<{','.join(f'{k}:bigint' for k in names)}>>"))

    at, block = F.col("band"), F.col("block")
    own = meets("blocks", lambda j: (at, F.least(block, j), at, F.greatest(block, j), (block > j).cast("int")))
    up = meets("above", lambda j: (at, block, at + 1, j, F.lit(0)))
    down = meets("below", lambda j: (at - 1, j, at, block, F.lit(1)))
    placed = scratch.write(rows.select("label", "cls", "weight", "copy", F.concat(own, up, down).alias("m")), "placed")
    scratch.drop(members, whole, banded, groups)
    return placed


def _all_links(placed: DataFrame, texts: DataFrame, n: int, percent: int, pairs: bool) -> DataFrame:
    """Of the classes ``placed``, all links, each verified once: (a, b), or links that connect the same and
    with ``b`` null the number of documents that a class links to, by block pair. The sets are made anew, each from
    one text of the class (``copy``): a bit table of fixed size lets a task pass over nearly all
    other texts before it cuts them into words, and the join leaves the rest."""
    flags = tables.total(placed.select("copy").mapInArrow(_flags, tables.SCHEMA), FLAGS, "uint8", np.bitwise_or)
    sets = texts.mapInArrow(_wanted(n, flags), "cls long, shingles binary").groupBy("cls").agg(F.first("shingles").alias("s"))
    met = sets.join(placed, "cls").select("label", "cls", "weight", "s", F.explode("m").alias("m"))
    met = met.select("label", "cls", "weight", "s", "m.*")
    key = ["label", "band", "low", "band2", "high"]
    dealt = met.repartition(*key).sortWithinPartitions(*key)
    return dealt.mapInArrow(_block_links(percent, pairs), "a long, b long" if pairs else "a long, b long, n long")


def _open(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that may link by the parities of their sets."""
    for end in "ab":
        pairs = pairs.join(classes.select(F.col("cls").alias(end), F.col("size").alias(f"size_{end}"), F.col("parity").alias(f"p{end}")), end)
    return pairs.select("a", "b", "size_a", "size_b", "pa", "pb").mapInArrow(_near(percent), "a long, b long")


def _across(postings: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """The pairs of classes that share a key, lie in different components and may link. Of each pair
    one class at least lies outside the component that has most classes of the key, so that the rows
    of one large component are not paired with each other."""
    label = F.coalesce("label", "cls").alias("label")
    rows = postings.join(labels.withColumnRenamed("node", "cls"), "cls", "left").select("key", "cls", "size", "pos", label)
    counted = rows.groupBy("key", "label").agg(F.count("*").alias("n"))
    mains = counted.groupBy("key").agg(F.max(F.struct("n", "label")).alias("top"), F.count("*").alias("labels"))
    mains = mains.filter("labels > 1").select("key", F.col("top.label").alias("main"))
    rows = rows.join(mains, "key")
    left = rows.filter("label <> main")
    right = rows.select("key", "main", *(F.col(c).alias(f"{c}2") for c in ("cls", "size", "pos", "label"))).drop("main")
    once = (F.col("label2") == F.col("main")) | (F.col("cls") < F.col("cls2"))
    pairs = left.join(right, "key").filter((F.col("label") != F.col("label2")) & once)
    pairs = pairs.filter(_possible("size", "pos", "size2", "pos2", percent))
    return pairs.select(F.least("cls", "cls2").alias("a"), F.greatest("cls", "cls2").alias("b")).distinct()


def jaccard_components(
    docs: DataFrame, scratch: Scratch, n: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(``id_col``, n_shingles, component_id, cls): for each row of ``docs`` the size of its set of ``n``-word
    shingles, its class (rows of equal sets) and the smallest id that links lead to. Two documents
    link when their sets' Jaccard measure is ``percent`` / 100 or more.

    Shingles are ordered rare first, by a sketch that counts all shingles of all documents in a fixed
    number of cells, then by hash. The first ``size - ceil(t * size) + 1`` shingles of a set are its
    prefix; linked sets share one. Equal sets are one class. Each class of a shingle's group is first
    held against one pivot of the group; pairs that pass the length and the positional filter and
    a filter on parities of small cells of the sets give wide components. After that, all pairs of the group that lie
    in different ones and pass the filters join them. So all links lie within wide components, and a
    group of near copies does not give all its pairs. The sets of a wide component then meet in blocks, where
    their links are counted exactly; the components are those of these links.

    A null or empty text has the empty set, no class, and is its own component. Rows with a null id
    take part, but no component is named by null unless all its ids are null. Rows that repeat an id
    count as documents of their own. Other columns are ignored. Hashes have 56 bits, digests of
    sets and texts 64.
    """
    digests, labels, _, _, _ = _labelled(docs, scratch, n, percent, id_col, text_col)
    return _named(digests, labels, id_col)


def jaccard_join(
    docs: DataFrame, scratch: Scratch, n: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """The rows of :func:`jaccard_components` with ``n_links``, the number of other documents that each
    links to, and all links between classes: (a, b), a below b, each pair once. Documents of one
    class link too and are not listed; the first frame's ``cls`` tells the members.

    All pairs of a wide component's classes whose sizes allow it are verified. The second frame is as long as there are links, in the square of a group of near copies; the
    first frame needs only sums, which the tasks make before a link leaves them. The same rules as there
    hold for nulls, empty texts and repeats; a document without a set has no links.
    """
    digests, labels, counts, placed, texts = _labelled(docs, scratch, n, percent, id_col, text_col)
    return _named(digests, labels, id_col, counts), _all_links(placed, texts, n, percent, True)


def _labelled(docs: DataFrame, scratch: Scratch, n: int, percent: int, id_col: str, text_col: str) -> tuple[DataFrame, ...]:
    """The documents (id, size, cls), the classes of components (node, label), the number of documents that
    each class links to (cls, n), the classes of wide components with their blocks, and the texts."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("copy"))
    id_type = rows.schema["id"].dataType.simpleString()
    described = scratch.write(
        rows.mapInArrow(_describe(n), f"id {id_type}, copy long, size long, cls long, parity binary, seg int, part binary"), "described"
    )
    digests = described.filter("seg is null").select("id", "size", "cls")
    one = (F.min("copy").alias("copy"), F.first("size").alias("size"), F.count("*").alias("weight"), F.first("parity").alias("parity"))
    classes = scratch.write(described.filter("cls is not null").groupBy("cls").agg(*one), "classes")
    counts = tables.total(described.filter("seg is not null").select("seg", "part"), SKETCH, "int64")
    rarity = np.minimum(np.rint(3 * np.log2(1 + counts)), 127).astype(np.uint64)
    # Up to here a statistic over all shingles; a hot cell's class of rarity marks its shingles.
    hot = int(min(np.rint(3 * np.log2(1 + counts.sum() / HOT)), 127))

    texts = rows.select("text", "copy")
    prefixes = texts.mapInArrow(_prefixes(n, percent, rarity), "key long, cls long, size int, pos int")
    salt = F.when(F.shiftright("key", BITS) >= hot, F.pmod("cls", F.lit(SALTS))).otherwise(F.lit(0))
    salted = prefixes.withColumn("salt", salt.cast("int"))
    # In an order of the key's own, so that a class meets different pivots by the keys it shares with a group.
    ordered = salted.repartition("key", "salt").sortWithinPartitions("key", "salt", F.xxhash64("cls", "key"), "cls")
    grouped = ordered.mapInArrow(_groups(hot), POSTING)
    postings = scratch.write(grouped, "postings")

    possible = _possible("size", "pos", "pivot_size", "pivot_pos", percent)
    star = postings.filter("cls <> pivot").filter(possible).select(F.col("pivot").alias("a"), F.col("cls").alias("b"))
    # The pivots under the salts of a hot key, at most SALTS, get the first of them as their own pivot.
    tops = postings.filter(F.shiftright("key", BITS) >= hot).groupBy("key", "pivot").agg(F.first("pivot_size").alias("ps"), F.first("pivot_pos").alias("pp"))
    top = tops.groupBy("key").agg(F.min(F.struct("pivot", "ps", "pp")).alias("t"))
    across = tops.join(top, "key").filter("pivot <> t.pivot").filter(_possible("ps", "pp", "t.ps", "t.pp", percent))
    star = scratch.write(star.union(across.select("t.pivot", "pivot")).distinct(), "star")
    links = scratch.write(_open(star, classes, percent), "near")
    wide = components(links, scratch)
    more = scratch.write(_across(postings, wide, percent).join(star, ["a", "b"], "left_anti"), "across")
    wide = components(scratch.write(_open(more, classes, percent).union(links), "near"), scratch)
    scratch.drop(postings, star, more)  # what is returned reads some of the other tables
    members = wide.toDF("cls", "label").join(classes.drop("parity"), "cls")
    placed = _placed(members, percent, scratch)
    found = scratch.write(_all_links(placed, texts, n, percent, False), "links")
    labels = components(found.filter("b is not null").select("a", "b"), scratch)
    counts = found.filter("b is null").groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("n"))
    return digests, labels, counts, placed, texts


def _named(digests: DataFrame, labels: DataFrame, id_col: str, counts: DataFrame | None = None) -> DataFrame:
    """Each document with the smallest id of its component, and with ``counts`` the number of others it
    links to. The smallest id of a class is found before the shuffle to its rows, so that copies in any
    number meet no single task as documents."""
    firsts = digests.filter("cls is not null").groupBy("cls").agg(F.min("id").alias("first"), F.count("*").alias("weight"))
    firsts = firsts.join(labels.withColumnRenamed("node", "cls"), "cls", "left")
    firsts = firsts.withColumn("label", F.coalesce("label", "cls"))
    smallest = firsts.groupBy("label").agg(F.min("first").alias("component"))
    if counts is not None:
        firsts = firsts.join(counts, "cls", "left")
        firsts = firsts.withColumn("links", F.col("weight") - 1 + F.coalesce("n", F.lit(0)))
    named = firsts.join(smallest, "label").select("cls", "component", *([] if counts is None else ["links"]))
    out = digests.join(named, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("component"))
    links = [] if counts is None else [F.coalesce("links", F.lit(0)).alias("n_links")]
    return out.select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"), component.alias("component_id"), "cls", *links)
