"""Language of documents and of spans in them (operator 4)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywise.llm import tables, words

#: First code points of script ranges, each up to the next one; 0 stands for all other characters.
SCRIPTS = (
    (0x41, 1), (0x370, 2), (0x400, 3), (0x530, 4), (0x590, 5), (0x600, 6), (0x700, 0), (0x900, 7), (0x980, 8),
    (0xE00, 9), (0xE80, 0), (0x10A0, 10), (0x1100, 11), (0x1200, 0), (0x1E00, 1), (0x1F00, 2), (0x2000, 0),
    (0x3040, 12), (0x3100, 0), (0x3400, 13), (0xA000, 0), (0xAC00, 11), (0xD7B0, 0), (0xF900, 13), (0xFB00, 0),
)
N_SCRIPTS = 14
CELLS = 1 << 17
BLOCK = 256
TEXTS = 1024  # of a slice
SLICE = 1 << 19  # bytes of a slice, each of which takes some hundred while it is looked at
MAX_LANGUAGES = 256


def _letters() -> np.ndarray:
    """Which code points are letters, for the planes that have living scripts."""
    return np.fromiter((chr(c).isalpha() for c in range(0x32000)), bool, 0x32000)


def _features(data: np.ndarray, offsets: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each run of letters its first byte, its size and its script; the cell of each of its bytes
    with the two beside it; and for each text the number of runs before it."""
    d = data.astype(np.int32)
    nxt = np.concatenate([d[1:], np.zeros(3, np.int32)])
    lead = (data & 0xC0) != 0x80
    at = np.flatnonzero(lead)
    b, b1, b2, b3 = d[at], nxt[at] & 63, nxt[at + 1] & 63, nxt[at + 2] & 63
    point = np.select(
        [b < 0x80, b < 0xE0, b < 0xF0],
        [b, (b & 31) << 6 | b1, (b & 15) << 12 | b1 << 6 | b2],
        (b & 7) << 18 | b1 << 12 | b2 << 6 | b3,
    )
    good = (point < len(letter)) & letter[np.minimum(point, len(letter) - 1)]
    inner = np.repeat(good, np.diff(np.append(at, len(data))))
    new = np.zeros(len(data) + 1, bool)
    new[offsets] = True
    begin, end = inner.copy(), inner.copy()
    begin[1:] &= ~inner[:-1] | new[1:-1]
    end[:-1] &= ~inner[1:] | new[1:-1]
    starts, sizes = np.flatnonzero(begin), np.flatnonzero(end) + 1 - np.flatnonzero(begin)
    low = words._LOWER[data].astype(np.int32)
    low[1:] += 32 * ((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E))
    before, behind = np.zeros_like(low), np.zeros_like(low)
    before[1:], behind[:-1] = low[:-1], low[1:]
    before[begin], behind[end] = 0, 0
    gram = (before << 16 | low << 8 | behind)[inner].astype(np.uint32)
    cells = (gram * np.uint32(0x9E3779B1)) >> np.uint32(15)
    firsts, codes = np.array([a for a, _ in SCRIPTS]), np.array([0, *(s for _, s in SCRIPTS)])
    script = codes[np.searchsorted(firsts, point[np.searchsorted(at, starts)], "right")]
    return starts, sizes, script, cells.astype(np.int64), np.searchsorted(starts, offsets)


def _count(languages: list[str]):
    size = CELLS + N_SCRIPTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letter, counts = _letters(), np.zeros((len(languages), size), np.int64)
        number = {name: i for i, name in enumerate(languages)}
        for batch in batches:
            for part, data, offsets in words.slices(batch, "text", SLICE):
                lang = np.array([number[x] for x in part.column("lang").to_pylist()], np.int64)
                _, sizes, script, cells, at = _features(data, offsets, letter)
                of_word = np.repeat(lang, np.diff(at))
                of_byte = np.repeat(of_word, sizes)
                for i in range(len(languages)):
                    counts[i, :CELLS] += np.bincount(cells[of_byte == i], minlength=CELLS)
                    counts[i, CELLS:] += np.bincount(script[of_word == i], minlength=N_SCRIPTS)
        yield tables.segments(counts.ravel())

    return run


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray, np.ndarray]:
    """The languages, the log-probability of each cell in each, and which scripts each is written in,
    from all rows with a language and a text. At most MAX_LANGUAGES languages; more raise."""
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).dropna()
    found = rows.groupBy("lang").count().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    languages = [row["lang"] for row in found]
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    size = CELLS + N_SCRIPTS
    counts = tables.total(rows.mapInArrow(_count(languages), tables.SCHEMA), size * len(languages), "int64") if languages else np.zeros(0)
    counts = counts.reshape(len(languages), size)
    grams, scripts = counts[:, :CELLS] + 0.5, counts[:, CELLS:]
    logs = np.log(grams / grams.sum(1, keepdims=True)).astype(np.float32)
    written = scripts >= 0.001 * scripts.sum(1, keepdims=True)
    written[:, ~written.any(0)] = True  # a script that no language has leaves all as candidates
    return languages, np.ascontiguousarray(logs.T), written


def viterbi(scores: np.ndarray, at: np.ndarray, penalty: float) -> np.ndarray:
    """The best language of each word where each change of language within a text costs ``penalty``.

    Texts are cut into blocks of BLOCK words, which go on together. A first pass finds what each
    block gains from each language before it to each at its end, a second the languages at the
    blocks' ends, a third the words of each block.
    """
    n, k = scores.shape
    if not n:
        return np.zeros(0, np.int64)
    counts = -(-np.diff(at) // BLOCK)
    first_block = np.concatenate([[0], np.cumsum(counts)])
    text = np.repeat(np.arange(len(counts)), counts)
    nth = np.arange(len(text)) - first_block[text]
    begin = at[text] + nth * BLOCK
    size = np.minimum(at[text + 1] - begin, BLOCK)
    index = begin[:, None] + np.arange(BLOCK)
    s = np.where((np.arange(BLOCK) < size[:, None])[:, :, None], scores[np.minimum(index, n - 1)], 0)
    switch = np.where(np.eye(k, dtype=bool), 0, -penalty)
    gain = switch + s[:, 0, None, :]
    for t in range(1, int(size.max())):
        gain = s[:, t, None, :] + np.maximum(gain, gain.max(2, keepdims=True) - penalty)
    start, final = np.zeros(len(text), np.int64), np.zeros(len(text), np.int64)
    total = np.zeros((len(counts), k))
    came = np.zeros((len(text), k), np.int64)
    for j in range(int(counts.max())):
        has = np.flatnonzero(counts > j)
        paths = total[has][:, :, None] + gain[first_block[has] + j]
        came[first_block[has] + j] = paths.argmax(1)
        total[has] = paths.max(1)
    state = total.argmax(1)
    for j in range(int(counts.max()) - 1, -1, -1):
        has = np.flatnonzero(counts > j)
        block = first_block[has] + j
        final[block] = state[has]
        start[block] = state[has] = came[block, state[has]]
    value = switch[start] + s[:, 0]
    stayed = np.ones((len(text), BLOCK, k), bool)
    best = np.zeros((len(text), BLOCK), np.int64)
    for t in range(1, int(size.max())):
        best[:, t] = value.argmax(1)
        other = value.max(1, keepdims=True) - penalty
        stayed[:, t] = value >= other
        value = s[:, t] + np.maximum(value, other)
    labels = np.zeros((len(text), BLOCK), np.int64)
    every, now = np.arange(len(text)), final
    for t in range(BLOCK - 1, -1, -1):
        inside = t < size
        labels[:, t] = now
        now = np.where(inside & ~stayed[every, t, now], best[:, t], now)
    return labels[np.arange(BLOCK) < size[:, None]]


def _few(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of TEXTS texts at most, as each takes a block of words however short it is."""
    for batch in batches:
        for first in range(0, len(batch), TEXTS):
            yield from words.slices(batch.slice(first, TEXTS), "text", SLICE)


def _predict(languages: list[str], logs: np.ndarray, written: np.ndarray, penalty: float, keep: list[str] | None):
    """With ``keep``, the rows of those columns and the language; else the id and the spans too."""
    names = np.array([*languages, "und"], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letter = _letters()
        for part, data, offsets in _few(batches):
            k = len(languages)
            _, sizes, script, cells, at = _features(data, offsets, letter)
            heads = np.cumsum(sizes) - sizes
            scores = np.zeros((len(sizes), k), np.float32)
            if len(sizes):
                for i in range(k):
                    scores[:, i] = np.add.reduceat(logs[cells, i], heads)
                scores[~written[:, script].T] = -1e4
            labels = viterbi(scores, at, penalty) if k else np.zeros(0, np.int64)
            share = np.zeros((len(part), max(k, 1)))
            text = np.repeat(np.arange(len(part)), np.diff(at))[: len(labels)]
            if k:
                np.add.at(share, (text, labels), sizes)
            all_bytes = share.sum(1)
            main = np.where(all_bytes > 0, share.argmax(1), k)
            score = share.max(1) / np.maximum(all_bytes, 1)
            if keep is not None:
                yield pa.record_batch([*(part[k] for k in keep), pa.array(names[main], pa.string()), pa.array(score)], [*keep, "lang_pred", "score"])
                continue
            change = np.ones(len(labels), bool)
            change[1:] = (labels[1:] != labels[:-1]) | (text[1:] != text[:-1])
            begin = np.flatnonzero(change)
            last = np.append(begin[1:], len(labels))
            of = text[begin]
            spans = pa.StructArray.from_arrays(
                [pa.array(names[labels[begin]], pa.string()), pa.array(begin - at[of]), pa.array(last - at[of])],
                ["lang", "first_word", "last_word"],
            )
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(len(part) + 1)).astype(np.int32)), spans)
            yield pa.record_batch([part.column("id"), pa.array(names[main], pa.string()), pa.array(score), lists], ["id", "lang_pred", "score", "spans"])

    return run


def identify(
    docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], penalty: float = 6.0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(``id_col``, lang_pred, score, spans): the language that has most letters of the text, its
    share of them, and the spans of words (runs of letters; without the last) in one language.

    The script of a word's first letter leaves the languages that are written in it; of these the
    word's letters, each with its two neighbours, give a score for each language, and Viterbi finds
    the best path with ``penalty`` for each change. ``und`` with score 0 if the text is null or has no letter,
    or nothing was learned; ties go to the first language by name. A row comes out for each row,
    whatever its id; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    spans = "array<struct<lang:string,first_word:long,last_word:long>>"
    schema = f"id {rows.schema['id'].dataType.simpleString()}, lang_pred string, score double, spans {spans}"
    return rows.mapInArrow(_predict(*model, penalty, None), schema).withColumnRenamed("id", id_col)


def with_language(
    docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], penalty: float = 6.0, text_col: str = "text"
) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` as :func:`identify` finds them, each row by itself, so that
    nothing is joined. Columns of these two names must not be there."""
    rows = docs.withColumnRenamed(text_col, "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    found = rows.mapInArrow(_predict(*model, penalty, rows.columns), f"{schema}, lang_pred string, score double")
    return found.withColumnRenamed("text", text_col)


def held_out(id_col: str = "doc_id") -> Column:
    """The fold that no model learns from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
