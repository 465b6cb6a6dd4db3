"""Find benchmark items in documents, edited ones too (operator 1)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywise.llm import tables, words
from tallywise.session import Scratch

FLAGS = 1 << 22
MATCH, MISS, GAP = 2, 1, 1


def _grams(batch: pa.RecordBatch, n: int) -> Iterator[tuple]:
    """For each slice its rows, the hash of each word, the n-gram at each word and whether there is one."""
    for part, data, offsets in words.slices(batch, "text"):
        starts, ends, at = words.word_bounds(data, offsets, words.PUNCTUATION)
        hashes = words.word_hashes(data, starts, ends)
        yield part, data, offsets, hashes, at, *words.ngrams(hashes, at, n)


def _seeds(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, _, hashes, at, grams, inside in _grams(batch, n):
                row = np.repeat(np.arange(len(part)), np.diff(at))
                pos, size = np.arange(len(hashes)) - at[row], np.diff(at)[row]
                keep = np.flatnonzero(inside)
                items = part.column("item").take(pa.array(row[keep]))
                whole = pa.array([hashes[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())
                yield pa.record_batch(
                    [pa.array(grams[keep].view(np.int64)), items, pa.array(pos[keep].astype(np.int32)), pa.array(size[keep].astype(np.int32)), whole.take(pa.array(row[keep]))],
                    ["seed", "item", "item_pos", "item_size", "item_words"],
                )

    return run


def _flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    flags = np.zeros(FLAGS, np.uint8)
    for batch in batches:
        flags[batch[0].to_numpy().view(np.uint64) % np.uint64(FLAGS)] = 1
    yield tables.segments(flags)


def _key(data: np.ndarray, offsets: np.ndarray, i: int) -> int:
    text = data[offsets[i] : offsets[i + 1]].tobytes()
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)


def _hits(n: int, flags: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part, data, offsets, hashes, at, grams, inside in _grams(batch, n):
                found = np.flatnonzero(inside & (flags[grams % np.uint64(FLAGS)] > 0))
                if not len(found):
                    continue
                row = np.searchsorted(at, found, "right") - 1
                rows, back = np.unique(row, return_inverse=True)
                keys = np.array([_key(data, offsets, i) for i in rows], np.int64)
                new = np.zeros(len(rows), bool)
                for i, k in enumerate(keys.tolist()):
                    new[i] = k not in seen
                    seen.add(k)
                of_new = new[back]
                none = pa.nulls(len(rows), pa.int64())
                yield pa.record_batch([part.column("id").take(pa.array(rows)), pa.array(keys), none, pa.nulls(len(rows), pa.int32())], ["id", "key", "seed", "pos"])
                hit = found[of_new]
                yield pa.record_batch(
                    [pa.nulls(len(hit), part.column("id").type), pa.array(keys[back][of_new]), pa.array(grams[hit].view(np.int64)), pa.array((hit - at[row[of_new]]).astype(np.int32))],
                    ["id", "key", "seed", "pos"],
                )

    return run


def _bodies(n: int, flags: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part, data, offsets, hashes, at, *_ in _grams(batch, n):
                keys, bodies = [], []
                for i in range(len(part)):
                    if at[i + 1] - at[i] >= n and (key := _key(data, offsets, i)) not in seen and flags[key % FLAGS]:
                        seen.add(key)
                        keys.append(key)
                        bodies.append(hashes[at[i] : at[i + 1]].tobytes())
                yield pa.record_batch([pa.array(keys, pa.int64()), pa.array(bodies, pa.binary())], ["key", "body"])

    return run


def smith_waterman(items: list[np.ndarray], windows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The best local alignment score of each item with its window, and where it ends in the window.
    All pairs go on together, an item's word at a time; gaps along the window are a running maximum."""
    wide = max(map(len, windows))
    text = np.zeros((len(windows), wide), np.uint64)
    valid = np.zeros((len(windows), wide), bool)
    for i, w in enumerate(windows):
        text[i, : len(w)], valid[i, : len(w)] = w, True
    ramp = GAP * np.arange(wide + 1, dtype=np.int32)
    row = np.zeros((len(windows), wide + 1), np.int32)
    best, end = np.zeros(len(windows), np.int32), np.zeros(len(windows), np.int64)
    every = np.arange(len(windows))
    for k in range(max(map(len, items))):
        word = np.array([x[k] if k < len(x) else 0 for x in items], np.uint64)[:, None]
        real = np.array([k < len(x) for x in items])[:, None]
        same = np.where((text == word) & valid, MATCH, -MISS).astype(np.int32)
        new = np.maximum(row - GAP, 0)
        new[:, 1:] = np.maximum(new[:, 1:], row[:, :-1] + same)
        new = np.maximum.accumulate(new + ramp, axis=1) - ramp
        row = np.where(real, new, row)
        at = row.argmax(1)
        top = row[every, at]
        better = top > best
        best, end = np.where(better, top, best), np.where(better, at, end)
    return best, end


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, len(batch), 64):
            part = batch.slice(a, 64)
            items, windows, firsts = [], [], []
            for low, high, item, body in zip(part["low"].to_pylist(), part["high"].to_pylist(), part["item_words"], part["body"], strict=True):
                body = np.frombuffer(body.as_buffer(), np.uint64)
                items.append(np.frombuffer(item.as_buffer(), np.uint64))
                firsts.append(max(low, 0))
                windows.append(body[max(low, 0) : high])
            best, end = smith_waterman(items, windows)
            _, back = smith_waterman([x[::-1] for x in items], [w[:e][::-1] for w, e in zip(windows, end, strict=True)])
            firsts = np.array(firsts)
            score = best / (MATCH * np.array([len(x) for x in items]))
            yield pa.record_batch([part["key"], part["item"], pa.array(score), pa.array(firsts + end - back), pa.array(firsts + end)], ["key", "item", "score", "first", "last"])


def find_leaks(
    docs: DataFrame, items: DataFrame, scratch: Scratch, n: int = 3, threshold: float = 0.5,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(``id_col``, ``item_col``, score, first_word, last_word): the items that stand in a document,
    each with its best passage (words ``first_word`` up to and without ``last_word``).

    Words are runs of letters and digits, case folded in A-Z. Seeds are the ``n``-grams of an item,
    joined with those of the documents; the rarer half of an item's seeds in the corpus (8 at least,
    and ties with the last) are rare. Where one rare seed or two others meet on neighbouring diagonals, the item is aligned with the words around by Smith-Waterman (match 2, other word or
    gap -1); ``score`` is the alignment's share of the best one possible, and passages below
    ``threshold`` are left out.

    Null or empty texts hold nothing. Items of fewer than ``n`` words are not looked for. Equal texts
    are aligned once and all their rows come out; so do rows with a null or repeated id, and items
    with a null or repeated id count on their own text. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    tests = items.select(F.col(item_col).alias("item"), F.col(item_text).alias("text")).dropDuplicates()
    id_type, item_type = (x.dataType.simpleString() for x in (rows.schema["id"], tests.schema["item"]))
    seeds = tests.mapInArrow(_seeds(n), f"seed long, item {item_type}, item_pos int, item_size int, item_words binary")
    seeds = scratch.write(seeds, "seeds")
    flags = tables.total(seeds.select("seed").mapInArrow(_flags, tables.SCHEMA), FLAGS, "uint8", np.bitwise_or)
    hits = scratch.write(rows.mapInArrow(_hits(n, flags), f"id {id_type}, key long, seed long, pos int"), "hits")

    counted = hits.filter("seed is not null").groupBy("seed").agg(F.count("*").alias("n"))
    by_item = Window.partitionBy("item_words", "item").orderBy(F.coalesce("n", F.lit(0)))
    ranked = seeds.join(counted, "seed", "left").withColumn("rank", F.rank().over(by_item))
    rare = (F.col("rank") <= 8) | (F.col("rank") * 2 <= F.col("item_size"))
    slack = F.greatest(F.lit(8), F.floor(F.col("item_size") / 4)).alias("slack")
    band = F.floor((F.col("pos") - F.col("item_pos")) / F.col("slack")).alias("band")
    ranked = ranked.select("seed", "item", "item_pos", "item_size", "item_words", slack, rare.alias("rare"))
    pairs = hits.filter("seed is not null").join(ranked, "seed")
    pairs = pairs.groupBy("key", "item", "item_size", "item_words", "slack", band)
    # One rare seed is enough, or two of any kind: where many copies are edited alike, the seeds that
    # they keep are more frequent than those that they lack.
    pairs = pairs.agg(F.max("rare").alias("rare"), F.min("seed").alias("s1"), F.max("seed").alias("s2")).filter("rare or s1 <> s2")
    low = F.col("band") * F.col("slack") - F.col("slack")
    pairs = pairs.select("key", "item", "item_words", low.alias("low"), (low + F.col("item_size") + 3 * F.col("slack")).alias("high"))
    pairs = scratch.write(pairs, "pairs")

    flags = tables.total(pairs.select("key").mapInArrow(_flags, tables.SCHEMA), FLAGS, "uint8", np.bitwise_or)
    bodies = rows.select("text").mapInArrow(_bodies(n, flags), "key long, body binary").groupBy("key").agg(F.first("body").alias("body"))
    aligned = pairs.join(bodies, "key").select("key", "item", "item_words", "low", "high", "body")
    aligned = aligned.mapInArrow(_align, f"key long, item {item_type}, score double, first long, last long")
    best = F.max(F.struct("score", F.negative("first").alias("first"), "last")).alias("best")
    leaks = aligned.filter(F.col("score") >= threshold).groupBy("key", "item").agg(best)
    found = hits.filter("seed is null").select("id", "key").join(leaks, "key")
    passage = (F.negative("best.first").alias("first_word"), F.col("best.last").alias("last_word"))
    return found.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "best.score", *passage)
