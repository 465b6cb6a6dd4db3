"""Remove the bytes of long strings that stand in several places (operator 12)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywise.llm import words
from tallywise.session import Scratch

PIECE = 1 << 19  # starts that are ranked at a time
LOW = np.uint64((1 << 20) - 1)  # of a gram's rank, give way to its place
HOT = 500  # a rank is hot if more than 1 / HOT of a round's rows have it
LEAST_HOT = 100  # rows that a hot rank has at least
SALTS = 64
SHARE = 1 / 32  # of the texts tells the hot ranks of the first round, which only deals rows out
ROUND_BYTES = 1 << 20
M1, M2 = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


class Names:
    """64-bit names of substrings of a buffer: equal strings have equal names wherever they stand."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray, seed: int) -> None:
        base = 0x9E3779B97F4A7C15 if seed == 0 else 0xC2B2AE3D27D4EB4F
        held = self._powers.get(seed)
        if held is None or len(held[0]) <= len(data):
            size = max(len(data) + 1, 2 * PIECE)
            held = tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, b, np.uint64)])) for b in (base, pow(base, -1, 1 << 64)))
            self._powers[seed] = held
        powers, self.back = held
        values = words.mix((np.arange(256, dtype=np.uint64) + np.uint64(1 + 256 * seed)) * M1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * powers[: len(data)], out=self.sums[1:])

    def of(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The names of the strings from ``first`` up to before ``last``."""
        return words.mix((self.sums[last] - self.sums[first]) * self.back[first])

    def runs(self, size: int) -> np.ndarray:
        """The names of all strings of ``size`` bytes."""
        n = len(self.sums) - size
        return words.mix((self.sums[size:] - self.sums[:n]) * self.back[:n])


def _core(names: np.ndarray, cell: np.ndarray | int, size: int) -> np.ndarray:
    cell = np.atleast_1d(cell).astype(np.uint64)
    return words.mix(names + ((cell << np.uint64(20)) + np.uint64(size)) * M2).view(np.int64)


def _hull(names: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    return words.mix(names + (lo.astype(np.uint64) << np.uint64(32) | hi.astype(np.uint64)) * M2).view(np.int64)


def width(length: int) -> int:
    """The number of places in a string that its sample may have: a power of two."""
    return 1 << max((length - 1).bit_length() - 1, 0)


def samples(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Of the texts between ``offsets`` the samples (doc, at, lo, hi, core, hull).

    Each string of ``length`` bytes has one sample: of its grams, with ``width`` places for them, the one of
    the least name, the rightmost of ties. Strings that follow each other mostly have the same one and
    make a row: the sample stands at ``at``, and ``lo`` to ``hi`` places after the beginning of those strings.
    """
    wide = width(length)
    gram, n = length - wide + 1, len(data)
    for x in range(0, n - length + 1, PIECE):
        y = min(x + PIECE, n - length + 1)
        piece = data[x : y + length - 1]
        first = int(np.searchsorted(offsets, x, "right")) - 1
        until = int(np.searchsorted(offsets, y, "left"))
        cut = np.clip(offsets[first : until + 1], x, y)
        doc = np.repeat(np.arange(first, until), np.diff(cut))
        ends = offsets[doc + 1] - x
        names = Names(piece, 0)
        grams = names.runs(gram)
        least = (grams & ~LOW) | (LOW - np.arange(len(grams), dtype=np.uint64))
        step = 1
        while step < wide:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        at = (LOW - (least & LOW)).astype(np.int64)
        begin = np.arange(y - x)
        whole = begin + length <= ends
        head = whole.copy()
        head[1:] &= ~whole[:-1] | (at[1:] != at[:-1])
        tail = whole.copy()
        tail[:-1] &= ~whole[1:] | (at[1:] != at[:-1])
        s, e = np.flatnonzero(head), np.flatnonzero(tail)
        if not len(s):
            continue
        a = at[s]
        lo, hi = a - e, a - s
        hull = _hull(Names(piece, 1).of(s, e + length), lo, hi)
        yield doc[s], a + x - offsets[doc[s]], lo, hi, _core(grams[a], 0, wide), hull


CELL = "core long, hull long, d1 long, d2 long, at int, lo int, hi int, multi boolean, bytes binary"
NAMES = ["core", "hull", "d1", "d2", "at", "lo", "hi", "multi", "bytes"]


def _twice(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The rows of a batch without those whose digest two rows before had: two copies repeat each other in
    full, and more of them say nothing new."""
    d1, d2 = batch["d1"].to_numpy(), batch["d2"].to_numpy()
    order = np.lexsort((d2, d1))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (d1[order][1:] != d1[order][:-1]) | (d2[order][1:] != d2[order][:-1])
    heads = np.flatnonzero(fresh)
    keep = np.zeros(len(order), bool)
    keep[order] = np.arange(len(order)) - np.repeat(heads, np.diff(np.append(heads, len(order)))) < 2
    return batch.filter(pa.array(keep))


def _over(core: np.ndarray, hull: np.ndarray) -> np.ndarray:
    """Which rows are the third of their class or later."""
    order = np.lexsort((hull, core))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (core[order][1:] != core[order][:-1]) | (hull[order][1:] != hull[order][:-1])
    heads = np.flatnonzero(fresh)
    over = np.zeros(len(order), bool)
    over[order] = np.arange(len(order)) - np.repeat(heads, np.diff(np.append(heads, len(order)))) >= 2
    return over


def _sampled(length: int):
    """The samples of texts as rows. A class of which a piece of text has more than two rows is repeated, as
    in a text that goes round in circles. Two of them come out, and instead of the others the ranges
    of their starts, each as one row twice with a core of its own, so that no rank has them all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in words.slices(_twice(batch), "text"):
                d1, d2 = part["d1"].to_numpy(), part["d2"].to_numpy()
                for doc, at, lo, hi, core, hull in samples(data, offsets, length):
                    over = _over(core, hull)
                    of, begin, until = doc[over], (at - hi)[over], (at - lo + 1)[over]
                    head = np.ones(len(of), bool)
                    head[1:] = (of[1:] != of[:-1]) | (begin[1:] != until[:-1])
                    heads = np.flatnonzero(head)
                    of, begin, until = of[heads], begin[heads], until[np.append(heads[1:], len(until))[: len(heads)] - 1]
                    own = words.mix((d1[of] ^ d2[of]).view(np.uint64) + begin.astype(np.uint64) * M1).view(np.int64)
                    of, begin, until, own = (np.repeat(x, 2) for x in (of, begin, until, own))
                    rest = ~over
                    doc, at, lo, hi = (np.concatenate([x[rest], y]) for x, y in ((doc, of), (at, begin), (lo, begin - until + 1), (hi, 0 * begin)))
                    core, hull = np.concatenate([core[rest], own]), np.concatenate([hull[rest], until])
                    small = (x.astype(np.int32) for x in (at, lo, hi))
                    columns = [core, hull, d1[doc], d2[doc], *small, np.zeros(len(doc), bool)]
                    yield pa.record_batch([*map(pa.array, columns), pa.nulls(len(doc), pa.binary())], NAMES)

    return run


def _cells(batch: pa.RecordBatch, length: int, size: int) -> Iterator[pa.RecordBatch]:
    """The rows of both halves of each cell, the halves having ``size`` offsets. ``bytes`` of a row are all
    that its strings cover, from ``hi`` before the sample on."""
    sizes = np.diff(np.frombuffer(batch["bytes"].buffers()[1], np.int32, len(batch) + 1, 4 * batch["bytes"].offset))
    first, total = 0, np.cumsum(sizes)
    while first < len(batch):
        last = int(np.searchsorted(total, (total[first - 1] if first else 0) + ROUND_BYTES, "right"))
        last = min(max(last, first + 1), len(batch))
        part = batch.slice(first, last - first)
        at, lo, hi = (part[k].to_numpy().astype(np.int64) for k in ("at", "lo", "hi"))
        column = part["bytes"]
        data = np.frombuffer(column.buffers()[2], np.uint8)
        starts = np.frombuffer(column.buffers()[1], np.int32, len(part) + 1, 4 * column.offset).astype(np.int64)
        data, starts = data[starts[0] : starts[-1]], starts[:-1] - starts[0]
        one, two = Names(data, 0), Names(data, 1)
        for half in (0, 1):
            cell = lo // (2 * size) * (2 * size) + half * size
            low, high = np.maximum(lo, cell), np.minimum(hi, cell + size - 1)
            rows = np.flatnonzero(low <= high)
            if not len(rows):
                continue
            cell, low, high = cell[rows], low[rows], high[rows]
            zero = starts[rows] + hi[rows]  # where the sample stands in the buffer
            core = _core(one.of(zero - cell, zero - cell - size + 1 + length), cell, size)
            s, e = zero - high, zero - low + length
            hull = _hull(two.of(s, e), low, high)
            held = memoryview(data)
            kept = pa.array([held[i:j].tobytes() for i, j in zip(s.tolist(), e.tolist(), strict=True)], pa.binary())
            taken = part.take(pa.array(rows))
            columns = [core, hull, taken["d1"], taken["d2"], taken["at"], low.astype(np.int32), high.astype(np.int32), taken["multi"], kept]
            yield pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], NAMES)
        first = last


def _opened(length: int, size: int):
    """Texts, each with its live rows → the first cells, with their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                text = batch["text"][i].as_py().encode()
                live = pa.RecordBatch.from_struct_array(batch["live"].slice(i, 1).flatten())
                begin = (live["at"].to_numpy() - live["hi"].to_numpy()).tolist()
                end = (live["at"].to_numpy() - live["lo"].to_numpy() + length).tolist()
                for first in range(0, len(begin), 2000):
                    part = live.slice(first, 2000)
                    cut = [text[a:b] for a, b in zip(begin[first : first + 2000], end[first : first + 2000], strict=True)]
                    whose = [pa.array(np.full(len(part), batch[d][i].as_py(), np.int64)) for d in ("d1", "d2")]
                    columns = [*whose, part["at"], part["lo"], part["hi"], part["multi"], pa.array(cut, pa.binary())]
                    yield from _cells(pa.record_batch(columns, NAMES[2:]), length, size)

    return run


RANKED = f"{CELL}, begin int, until int"


def _reranked(length: int, size: int, hot: np.ndarray):
    """Rows sorted by (core, hull) → the ranges of starts that are decided (begin, until), and what must go on,
    as the cells of half the size where the bytes are at hand.

    A class (core, hull) of two rows or more is repeated as a whole: its rows are decided, and one of them
    goes on as a partner (``multi``) for other classes of that core. A class of one row goes on if other
    classes have its core, and is unique otherwise. Of the rows before, a row is held at most.
    """

    def decided(rows: pa.RecordBatch) -> pa.RecordBatch:
        begin = pa.array(rows["at"].to_numpy() - rows["hi"].to_numpy())
        until = pa.array(rows["at"].to_numpy() - rows["lo"].to_numpy() + 1)
        none = [pa.nulls(len(rows), rows.schema.field(k).type) for k in NAMES]
        none[2], none[3] = rows["d1"], rows["d2"]
        return pa.record_batch([*none, begin, until], [*NAMES, "begin", "until"])

    def onward(rows: pa.RecordBatch, multi: np.ndarray) -> Iterator[pa.RecordBatch]:
        if size == 1 or not len(rows):
            return
        rows = rows.set_column(rows.schema.get_field_index("multi"), "multi", pa.array(multi))
        parts = _cells(rows, length, size // 2) if rows["bytes"].null_count == 0 else [rows]
        for part in parts:
            none = pa.nulls(len(part), pa.int32())
            yield pa.record_batch([*(part[k] for k in NAMES), none, none], [*NAMES, "begin", "until"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None  # the first row of the last class; multi if the class is decided
        several = False  # whether a class of the same core came before it
        for batch in batches:
            if not len(batch):
                continue
            batch = batch.select(NAMES)
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            core, hull = batch["core"].to_numpy(), batch["hull"].to_numpy()
            multi = batch["multi"].to_numpy(zero_copy_only=False)
            group = np.ones(len(batch), bool)
            group[1:] = core[1:] != core[:-1]
            fresh = group.copy()
            fresh[1:] |= hull[1:] != hull[:-1]
            heads, of = np.flatnonzero(fresh), np.cumsum(fresh) - 1
            weight = np.bincount(of, np.where(multi, 2, 1))
            repeated = weight >= 2
            yield decided(batch.filter(pa.array(repeated[of] & ~multi)))
            # How many classes each core has here, and before.
            whose = (np.cumsum(group) - 1)[heads]
            classes = np.bincount(whose)
            classes[0] += several
            shared = (classes[whose] > 1) | np.isin(core[heads], hot)
            done = np.arange(len(heads)) < len(heads) - 1
            go = np.flatnonzero(shared & done)
            yield from onward(batch.take(pa.array(heads[go])), repeated[go])
            several = bool(classes[-1] > 1)
            held = batch.slice(int(heads[-1]), 1)
            held = held.set_column(held.schema.get_field_index("multi"), "multi", pa.array([bool(repeated[-1])]))
        if held is not None and (several or np.isin(held["core"].to_numpy(), hot)[0]):
            yield from onward(held, held["multi"].to_numpy(zero_copy_only=False))

    return run


def _hot(rows: DataFrame) -> tuple[np.ndarray, int]:
    """The ranks that more than 1 / HOT of the rows have, HOT at most, and the number of rows."""
    counted = rows.groupBy("core").agg(F.count("*").alias("n"))
    total = rows.count()
    found = counted.filter(F.col("n") > max(total / HOT, LEAST_HOT)).select("core").collect()
    return np.array([r.core for r in found], np.int64), total


def _ranked(rows: DataFrame, length: int, size: int, hot: np.ndarray) -> DataFrame:
    salt = F.lit(0)
    if len(hot):
        salt = F.when(F.col("core").isin([int(x) for x in hot]), F.pmod("hull", F.lit(SALTS))).otherwise(F.lit(0))
    dealt = rows.withColumn("salt", salt.cast("int")).repartition("core", "salt").sortWithinPartitions("core", "hull")
    return dealt.drop("salt").mapInArrow(_reranked(length, size, hot), RANKED)


def repeated_strings(texts: DataFrame, scratch: Scratch, length: int = 200) -> DataFrame:
    """(d1, d2, ranges): for each digest (d1, d2) of ``texts`` (d1, d2, text) the ranges (begin, until) of bytes at
    which strings of ``length`` bytes start that stand in two places or more. Copies of a text are places of their own.

    Suffixes are ranked by prefix doubling, but a rank holds a run of neighbouring starts as long as they
    need not be told apart. Each string has a sample, one of its grams (:func:`samples`), and strings that
    are equal have equal samples at an equal offset. Spark sorts the samples by the rank of the gram, the
    ``core`` that all strings of the row share. A rank that only one row has is unique, and so are all its
    strings. Rows whose whole stretch (``hull``) is equal too are repeated as a whole. All others are cut at
    the middle of their cell of offsets. The strings of a half share a longer core, so that a row's new rank
    stands for a pair, the rank it had and that of as many bytes more on one side as the cell had
    offsets less. Spark sorts them again, until every rank is unique, decided, or as long as the string.
    The rows that go on are those at the ends of repeats, not the repeats themselves.

    Cores and hulls are 64-bit names of their own, so that what counts as equal agrees in both. A core that
    many rows share is spread by the hull, and its rows go on even if they are alone in their part. Of
    copies of a text that a task reads together, two are sampled (:func:`_twice`), so that a rank has no
    more than two rows with one hull from each piece of a batch (:func:`_sampled`).
    """
    wide = width(length)
    hot, _ = _hot(texts.sample(SHARE, seed=1).mapInArrow(_sampled(length), CELL))
    rounds = [scratch.write(_ranked(texts.mapInArrow(_sampled(length), CELL), length, wide, hot), "samples")]
    live = rounds[0].filter("core is not null")
    if wide > 1:
        # One text of each digest, with all its rows that go on.
        grouped = live.groupBy("d1", "d2").agg(F.collect_list(F.struct("at", "lo", "hi", "multi")).alias("live"))
        single = texts.groupBy("d1", "d2").agg(F.first("text").alias("text"))
        opened = grouped.join(single, ["d1", "d2"]).mapInArrow(_opened(length, wide // 2), CELL)
        cells = opened = scratch.write(opened, "cells")
        size = wide // 2
        while size:
            hot, total = _hot(cells)
            if not total:
                break
            rounds.append(scratch.write(_ranked(cells, length, size, hot), "ranks"))
            cells = rounds[-1].filter("core is not null").select(NAMES)
            size //= 2
        scratch.drop(opened)
    ranges = [r.filter("begin is not null").select("d1", "d2", "begin", "until") for r in rounds]
    every = ranges[0]
    for more in ranges[1:]:
        every = every.unionByName(more)
    # Copies give the same ranges, which meet as equal rows before they are collected for one text.
    return every.distinct().groupBy("d1", "d2").agg(F.collect_list(F.struct("begin", "until")).alias("ranges"))


def _cut(length: int):
    spans_of = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, spans = [], []
            for i in range(len(batch)):
                text, ranges = batch["text"][i].as_py().encode(), batch["ranges"][i]
                if not ranges.is_valid:
                    kept.append(text)
                    spans.append([])
                    continue
                held = ranges.values
                begin, until = held.field("begin").to_numpy().astype(np.int64), held.field("until").to_numpy() + length - 1
                order = np.argsort(begin, kind="stable")
                begin, reach = begin[order], np.maximum.accumulate(until[order])
                head = np.ones(len(begin), bool)
                head[1:] = begin[1:] > reach[:-1]
                first = begin[head].tolist()
                last = reach[np.append(np.flatnonzero(head)[1:] - 1, len(begin) - 1)].tolist()
                kept.append(b"".join(text[a:b] for a, b in zip([0, *last], [*first, len(text)], strict=True)))
                spans.append([{"first": a, "last": b} for a, b in zip(first, last, strict=True)])
            yield pa.record_batch([batch["id"], batch["n_bytes"], pa.array(kept, pa.binary()), pa.array(spans, spans_of)], ["id", "n_bytes", "kept", "spans"])

    return run


def dedup_substrings(docs: DataFrame, scratch: Scratch, length: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, n_bytes, kept, spans): of each text the bytes that are left and the maximal runs of those
    removed, from ``first`` up to before ``last``.

    Every byte goes that is covered by a string of ``length`` bytes of its text that also starts anywhere else, in
    this text or another, be it that the two overlap. What repeats is judged on the texts as they came;
    no copy stays as the first. ``kept`` is binary, as a cut may fall within a character.

    A null text counts as empty. Rows that repeat an id or a text are documents of their own, so that equal
    texts of ``length`` bytes or more go as a whole. A null id stays null. Other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    rows = rows.withColumns({"d1": F.xxhash64("text"), "d2": F.xxhash64(F.lit(1), "text"), "n_bytes": F.octet_length("text").cast("long")})
    ranges = repeated_strings(rows.filter(F.col("n_bytes") >= length).select("d1", "d2", "text"), scratch, length)
    kind = rows.schema["id"].dataType.simpleString()
    joined = rows.join(ranges, ["d1", "d2"], "left").select("id", "n_bytes", "text", "ranges")
    cut = joined.mapInArrow(_cut(length), f"id {kind}, n_bytes long, kept binary, spans array<struct<first:int,last:int>>")
    return cut.withColumnRenamed("id", id_col)
