"""Remove sentences of repeated spans of sentences (operator 7)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywise.llm import words
from tallywise.operators.skew import attach_totals
from tallywise.session import Scratch

_STOP = np.zeros(256, bool)
_STOP[[33, 46, 63]] = True


def _sentences(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """The first word of each sentence, the hash of its words, its number of words, the byte at which
    it starts, and for each text the number of sentences before it. A sentence ends after a word that
    ends in a full stop, question or exclamation mark, at a line's end and at the text's."""
    starts, ends, at = words.word_bounds(data, offsets)
    n = len(starts)
    if not n:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, np.zeros(len(offsets), np.int64)
    lines = np.concatenate([[0], np.cumsum(data == 10)])
    stop = _STOP[data[ends - 1]]
    stop[:-1] |= lines[starts[1:]] > lines[ends[:-1]]
    stop[at[1:][at[1:] > 0] - 1] = True
    last = np.flatnonzero(stop)
    first = np.concatenate([[0], last[:-1] + 1])
    size = last - first + 1
    place = np.arange(n) - np.repeat(first, size)
    powers = np.full(int(size.max()), words.BASE)
    powers[0] = 1
    powers = np.cumprod(powers)
    hashes = np.add.reduceat(words.word_hashes(data, starts, ends) * powers[place], first)
    return words.mix(hashes + size.astype(np.uint64)), size, starts[first], np.searchsorted(first, at)


def _spans(sizes: np.ndarray, at: np.ndarray, least: int, least_words: int) -> tuple[np.ndarray, np.ndarray]:
    """First sentences and ends, within a text and in order, of the runs of ``least`` sentences and
    ``least_words`` words at least that are shortest for where they begin or for where they end."""
    n = len(sizes)
    before = np.concatenate([[0], np.cumsum(sizes)])
    begin = np.arange(n)
    end = np.maximum(np.searchsorted(before, before[:-1] + least_words), begin + least)
    ahead = end <= np.repeat(at[1:], np.diff(at))
    last = begin + 1
    start = np.minimum(np.searchsorted(before, before[1:] - least_words, "right") - 1, last - least)
    back = start >= np.repeat(at[:-1], np.diff(at))
    runs = np.concatenate([np.stack([begin, end], 1)[ahead], np.stack([start, last], 1)[back]])
    runs = np.unique(runs, axis=0) if len(runs) else np.zeros((0, 2), np.int64)
    return runs[:, 0], runs[:, 1]


def _hash(least: int, least_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in words.slices(batch, "text"):
                hashes, sizes, _, at = _sentences(data, offsets)
                start, end = _spans(sizes, at, least, least_words)
                total = np.zeros(len(start), np.uint64)
                length = end - start
                for k in range(int(length.max()) if len(start) else 0):
                    go = length > k
                    total[go] = total[go] * words.BASE + hashes[start[go] + k]
                span = pa.array(words.mix(total + length.astype(np.uint64)).view(np.int64))
                text = np.searchsorted(at, start, "right") - 1
                rows = part.select(["id", "key"]).take(pa.array(text))
                place, length = (pa.array(x.astype(np.int32)) for x in (start - at[text], length))
                yield pa.record_batch([*rows.columns, place, length, span], ["id", "key", "place", "length", "span"])

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, offsets in words.slices(batch, "text"):
            _, _, first, at = _sentences(data, offsets)
            texts, counts = part.column("text").to_pylist(), []
            for i, runs in enumerate(part.column("gone").to_pylist()):
                n, removed = int(at[i + 1] - at[i]), 0
                if runs:
                    gone = np.zeros(n + 1, np.int64)
                    starts = np.array([r["place"] for r in runs])
                    np.add.at(gone, starts, 1)
                    np.add.at(gone, starts + np.array([r["length"] for r in runs]), -1)
                    gone = np.cumsum(gone[:-1]) > 0
                    cuts = np.append(first[at[i] : at[i + 1]], offsets[i + 1])
                    cuts[0] = offsets[i]
                    texts[i] = b"".join(data[a:b].tobytes() for a, b, g in zip(cuts[:-1], cuts[1:], gone, strict=True) if not g).decode()
                    removed = int(gone.sum())
                counts.append((n, removed))
            n, removed = zip(*counts, strict=True) if counts else ((), ())
            yield pa.record_batch([part.column("id"), pa.array(texts, pa.string()), pa.array(n, pa.int64()), pa.array(removed, pa.int64())], ["id", "text", "n_sentences", "n_removed"])


def dedup_spans(
    docs: DataFrame, scratch: Scratch, least: int = 2, least_words: int = 10, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(``id_col``, text, n_sentences, n_removed): each text without the sentences that a repeated span
    covers, except in the span's first place (smallest id, then place in the text).

    A span is a run of at least ``least`` consecutive sentences with at least ``least_words`` words together.
    The shortest from each sentence on and the shortest up to each sentence are compared: a longer
    one has the one from its first sentence on and the one up to its last in it. Spans are compared by the words, folded in A-Z, whatever the white space. A
    sentence goes with the white space behind it.

    A null text stays null, an empty one empty. Rows that repeat id and text are one document and
    come out alike; rows that share only the id are ordered by a hash of the text; a null id comes
    first. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("key", F.xxhash64("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    spans = rows.mapInArrow(_hash(least, least_words), f"id {id_type}, key long, place int, length int, span long")
    spans = scratch.write(spans, "spans")
    place = F.struct("id", "key", "place")
    runs = spans.groupBy("span").agg(F.count("*").alias("copies"), F.min(place).alias("first"))
    runs = scratch.write(runs.filter("copies > 1"), "runs")
    copies = attach_totals(spans, runs, "span", "copies").filter(~place.eqNullSafe(F.col("first")))
    gone = copies.groupBy(F.col("id").alias("gid"), F.col("key").alias("gkey")).agg(F.collect_set(F.struct("place", "length")).alias("gone"))
    joined = rows.join(gone, (F.col("key") == F.col("gkey")) & F.col("id").eqNullSafe(F.col("gid")), "left")
    schema = f"id {id_type}, text string, n_sentences long, n_removed long"
    return joined.select("id", "text", "gone").mapInArrow(_cut, schema).withColumnRenamed("id", id_col)
