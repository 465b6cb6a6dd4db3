"""Repeated byte strings against brute force: overlaps, copies, edits, ties, nulls, any length."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallywise.llm import suffix_dedup
from tallywise.llm.suffix_dedup import dedup_substrings, samples, width
from tallywise.session import Scratch

SCHEMA = "doc_id long, text string, id string, core int, ranges string"  # the last three clash with inner names


def brute(rows, length):
    texts = [(r[1] or "").encode() for r in rows]
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for row, t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = True
        edge = np.flatnonzero(np.diff(np.concatenate([[False], gone]).astype(int)))
        spans = [tuple(x) for x in edge.reshape(-1, 2).tolist()]
        out.append((row[0], len(t), bytes(b for b, g in zip(t, gone, strict=False) if not g), spans))
    return out


def rows_of(df):
    return sorted(((r.doc_id, r.n_bytes, bytes(r.kept), [tuple(s) for s in r.spans]) for r in df.collect()), key=repr)


def texts(seed, letters, sizes):
    chance = random.Random(seed)
    base = ["".join(chance.choice(letters) for _ in range(chance.choice(sizes))) for _ in range(25)]
    out = list(base)
    for _ in range(25):  # edited copies, passages in other texts, overlaps with itself
        t = chance.choice(base)
        cut = sorted(chance.randrange(len(t) + 1) for _ in range(2))
        kind = chance.randrange(4)
        out.append([t[: cut[0]] + "é" + t[cut[0] :], t[cut[0] : cut[1]], t[cut[0] :] + chance.choice(base), t[cut[0] : cut[1]] * 3][kind])
    out += [base[0], base[0], "", None, "a" * max(sizes), "ab" * max(sizes), "🙂漢é" * (max(sizes) // 4)]
    return [(i if i % 9 else None, t, "clash", 1, "clash") for i, t in enumerate(out)]


@pytest.mark.parametrize(
    ("length", "letters", "sizes"),
    [(1, "abcdefghijklmnop", [3, 9]), (2, "abcdef", [2, 12]), (5, "ab", [8, 20]), (20, "abc", [30, 60, 90]), (200, "abcdefgh \n", [150, 400, 900])],
)
def test_brute_force(spark, length, letters, sizes):
    rows = texts(length, letters, sizes)
    got = dedup_substrings(spark.createDataFrame(rows, SCHEMA), Scratch(spark), length)
    assert rows_of(got) == sorted(brute(rows, length), key=repr)


def test_hot_ranks_and_small_pieces(spark, monkeypatch):
    """Ranks spread over salts, batches of a few rows, texts over several pieces: the same result."""
    monkeypatch.setattr(suffix_dedup, "PIECE", 700)
    monkeypatch.setattr(suffix_dedup, "ROUND_BYTES", 500)
    chance = random.Random(3)
    shared = "".join(chance.choice("abcdefgh") for _ in range(120))
    rows = [(i, chance.choice("xyz") * chance.randrange(40) + str(i) + shared[chance.randrange(30) :] + str(i * i), "", 0, "") for i in range(300)]
    rows.append((1000, "".join(chance.choice("ab") for _ in range(3000)) + shared, "", 0, ""))
    df = spark.createDataFrame(rows, SCHEMA)
    # All ranks of more than a few rows count as hot here.
    monkeypatch.setattr(suffix_dedup, "SHARE", 1.0)
    monkeypatch.setattr(suffix_dedup, "LEAST_HOT", 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = rows_of(dedup_substrings(df, Scratch(spark), 40))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == sorted(brute(rows, 40), key=repr)


def test_of_many_copies_two_are_sampled():
    digests = [5, 3, 5, 5, 7, 3, 3, 5]
    batch = pa.record_batch([pa.array(digests), pa.array([0] * 8), pa.array(list("abcdefgh"))], ["d1", "d2", "text"])
    assert suffix_dedup._twice(batch)["text"].to_pylist() == ["a", "b", "c", "e", "f"]
    assert len(suffix_dedup._twice(batch.slice(0, 0))) == 0


def test_texts_that_go_round_in_circles(spark, monkeypatch):
    """Thousands of equal ranks in a text, cut off in the middle and between pieces."""
    monkeypatch.setattr(suffix_dedup, "PIECE", 1500)
    rows = [
        (1, "x" + "a" * 4000 + "y", "", 0, ""), (2, "abc" * 1700 + "Q" + "abc" * 30, "", 0, ""), (3, "the same line\n" * 250, "", 0, ""),
        (4, "tail " + "the same line\n" * 20 + "end", "", 0, ""), (5, "a" * 39 + "b" + "a" * 41, "", 0, ""),
    ]
    got = dedup_substrings(spark.createDataFrame(rows, SCHEMA), Scratch(spark), 40)
    assert rows_of(got) == sorted(brute(rows, 40), key=repr)
    batch = pa.record_batch([pa.array([1]), pa.array([1]), pa.array(["a" * 100_000])], ["d1", "d2", "text"])
    assert sum(len(b) for b in suffix_dedup._sampled(40)([batch])) < 1000


def test_empty_table_and_long_text(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert dedup_substrings(empty, Scratch(spark)).collect() == []
    long = " ".join(f"w{i}" for i in range(200_000))
    rows = [(1, long, "", 0, ""), (2, long[5000:905_000], "", 0, ""), (3, None, "", 0, "")]
    got = {r[0]: r for r in rows_of(dedup_substrings(spark.createDataFrame(rows, SCHEMA), Scratch(spark)))}
    assert got[1][3] == [(5000, 905_000)] and got[2][3] == [(0, 900_000)] and got[3][1:] == (0, b"", [])


@pytest.mark.parametrize("length", [1, 2, 3, 64, 200])
def test_samples_cover_every_start_once(length):
    chance = np.random.default_rng(length)
    sizes = [0, length - 1, length, 3 * length, 0, 500, 1]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    data = chance.integers(97, 100, offsets[-1]).astype(np.uint8)
    starts = []
    for doc, at, lo, hi, _, _ in samples(data, offsets, length):
        assert (lo >= 0).all() and (hi < width(length)).all()
        starts += [(d, a - o) for d, a, x, y in zip(doc.tolist(), at.tolist(), lo.tolist(), hi.tolist(), strict=True) for o in range(x, y + 1)]
    assert sorted(starts) == [(d, i) for d, n in enumerate(sizes) for i in range(n - length + 1)]
