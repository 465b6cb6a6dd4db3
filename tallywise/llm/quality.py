"""Quality of documents: a kernel ridge score over text statistics, calibrated (operator 2)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywise.llm import tables, words
from tallywise.llm.langid import held_out
from tallywise.session import Scratch

WAVES = 256  # random Fourier features
MAX_LABELLED = 200_000  # labelled rows to learn from; of more, a share by a hash of the id
RIDGE = 1e-3
BINS = 4096  # of raw scores between -1 and 2, for the calibration

_CLASSES = [
    np.isin(np.arange(256), list(chars))
    for chars in (b".!?", b",;:", b"|", b"$%&*#@^~<>{}[]\\/=+_", b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"\n", b" \t")
] + [np.arange(256) >= 128]
N_STATISTICS = len(_CLASSES) + 12


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of numbers for each text, from its characters, words and lines alone."""
    starts, ends, at = words.word_bounds(data, offsets)
    hashes = words.word_hashes(data, starts, ends)
    n_bytes, n_words = np.diff(offsets), np.diff(at)
    out = np.zeros((len(n_bytes), N_STATISTICS))
    per_byte, per_word = np.maximum(n_bytes, 1), np.maximum(n_words, 1)

    def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values)])
        return total[bounds[1:]] - total[bounds[:-1]]

    for i, chars in enumerate(_CLASSES):
        out[:, i] = np.sqrt(sums(chars[data], offsets) / per_byte)
    k = len(_CLASSES)
    sizes = ends - starts
    mean = sums(sizes, at) / per_word
    out[:, k] = np.log1p(n_bytes)
    out[:, k + 1] = np.log1p(n_words)
    out[:, k + 2] = mean
    out[:, k + 3] = np.sqrt(np.maximum(sums(sizes * sizes, at) / per_word - mean**2, 0))
    same = np.zeros(len(hashes), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    out[:, k + 4] = sums(same, at) / per_word
    last = data[ends - 1] if len(ends) else data[:0]
    out[:, k + 5] = sums(np.isin(last, list(b".!?")), at) / per_word
    symbols = (last < 128) & ~np.isin(last, list(b".!?,;:|0123456789")) & words.PUNCTUATION[last]
    out[:, k + 6] = sums(symbols, at) / per_word
    out[:, k + 7] = sums(sizes == 1, at) / per_word
    first = data[starts] if len(starts) else data[:0]
    out[:, k + 8] = sums((first >= 65) & (first <= 90), at) / per_word
    for i, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)):
        if b > a:
            _, counts = np.unique(hashes[a:b], return_counts=True)
            out[i, k + 9] = len(counts) / (b - a)
            out[i, k + 10] = counts.max() / (b - a)
            out[i, k + 11] = float(np.square(counts / (b - a)).sum())
    return out


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, offsets in words.slices(batch, "text"):
            rows = statistics(data, offsets)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), N_STATISTICS).cast(pa.list_(pa.float64()))
            yield pa.record_batch([part.column("id"), lists], ["id", "x"])


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    knots: np.ndarray  # raw scores and what they are calibrated to
    values: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        """Random Fourier features, whose products approach a Gaussian kernel, and a constant."""
        z = np.clip((x - self.mean) / self.spread, -6, 6)
        chance = np.random.default_rng(7)
        waves = chance.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], WAVES))
        phase = chance.uniform(0, 2 * np.pi, WAVES)
        return np.hstack([np.sqrt(2 / WAVES) * np.cos(z @ waves + phase), np.ones((len(z), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.knots, self.values), 0, 1)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch["x"].flatten().to_numpy().reshape(-1, N_STATISTICS)


def isotonic(weights: np.ndarray, positives: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: of bins with counts and positives the blocks' ends and means."""
    blocks: list[list[float]] = []  # weight, positives, last bin
    for i in np.flatnonzero(weights):
        blocks.append([weights[i], positives[i], i])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            w, p, last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + w, blocks[-1][1] + p, last]
    return np.array([b[2] for b in blocks], int), np.array([b[1] / b[0] for b in blocks])


def fit(described: DataFrame, labels: DataFrame) -> Model:
    """Learn from the rows of ``labels`` (id, label 0 or 1) that have statistics. Three quarters give the ridge
    weights by normal equations, which tasks sum up and whose size is fixed; the rest, by a hash of
    the id, gives the isotonic calibration. Without rows of both labels the score is constant."""
    share = MAX_LABELLED / max(labels.count(), 1)
    kept = labels if share >= 1 else labels.filter(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1_000_000)) < int(share * 1_000_000))
    rows = described.join(kept, "id").withColumn("aside", F.pmod(F.xxhash64("id"), F.lit(4)) == 0)
    width = WAVES + 1

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + 2 * N_STATISTICS)
        for batch in batches:
            x = _matrix(batch)
            total += np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)])
        yield tables.segments(total)

    sums = tables.total(rows.select("x").mapInArrow(moments, tables.SCHEMA), 1 + 2 * N_STATISTICS, "float64")
    n = max(sums[0], 1)
    mean = sums[1 : 1 + N_STATISTICS] / n
    spread = np.sqrt(np.maximum(sums[1 + N_STATISTICS :] / n - mean**2, 1e-9))
    model = Model(mean, spread, np.zeros(width), np.array([0.0]), np.array([0.5]))

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width + 1))
        for batch in batches:
            z, y = model.features(_matrix(batch)), batch["label"].to_numpy()
            total[:, :width] += z.T @ z
            total[:, width] += z.T @ y
        yield tables.segments(total.ravel())

    equations = rows.filter("not aside").select("x", "label").mapInArrow(normal, tables.SCHEMA)
    sums = tables.total(equations, width * (width + 1), "float64").reshape(width, width + 1)
    scale = max(sums[-1, -2], 1)
    model.weights = np.linalg.solve(sums[:, :width] / scale + RIDGE * np.eye(width) / 10, sums[:, width] / scale)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BINS))
        for batch in batches:
            cell = np.clip((model.raw(_matrix(batch)) + 1) / 3 * BINS, 0, BINS - 1).astype(int)
            total[0] += np.bincount(cell, minlength=BINS)
            total[1] += np.bincount(cell, batch["label"].to_numpy(), BINS)
        yield tables.segments(total.ravel())

    bins = tables.total(rows.filter("aside").select("x", "label").mapInArrow(binned, tables.SCHEMA), 2 * BINS, "float64").reshape(2, BINS)
    ends, values = isotonic(*bins)
    if len(ends):
        begins = np.append(0, ends[:-1] + 1)
        # The middle of each block's bins that hold rows.
        first = np.array([a + np.flatnonzero(bins[0, a : b + 1])[0] for a, b in zip(begins, ends, strict=True)])
        model.knots, model.values = ((first + ends + 1) / 2) / BINS * 3 - 1, values
    return model


def assess(
    docs: DataFrame, labels: DataFrame, scratch: Scratch, cut: float = 0.7, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> DataFrame:
    """(``id_col``, held_out, score, predicted): the calibrated chance of label 1 for each whole text,
    learned from the labels of rows outside the held-out fold; only the text is an input.

    A null text counts as empty; empty texts have a score too. Rows that repeat an id learn and are
    scored each by its own text; an id with several labels counts as 1 if their mean is a half or
    more; null ids and labels teach nothing. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    described = scratch.write(rows.mapInArrow(_describe, f"id {id_type}, x array<double>"), "statistics")
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).dropna().filter(~held_out("id"))
    known = known.groupBy("id").agg((F.avg("label") >= 0.5).cast("double").alias("label"))
    model = fit(described, known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch["id"], pa.array(model.score(_matrix(batch)))], ["id", "score"])

    scored = described.mapInArrow(run, f"id {id_type}, score double")
    predicted = (F.col("score") >= cut).cast("int").alias("predicted")
    return scored.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "score", predicted)
