"""Fixed-size count tables over a whole frame: made in parts by the tasks, summed by Spark, one copy
to the driver. The size is a parameter and does not grow with the data."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEGMENT = 1 << 15
SCHEMA = "seg int, part binary"


def segments(table: np.ndarray) -> pa.RecordBatch:
    """A one-dimensional table as rows (seg, part); segments of zeros are left out."""
    parts = [(i, table[a : a + SEGMENT]) for i, a in enumerate(range(0, len(table), SEGMENT))]
    parts = [(i, p.tobytes()) for i, p in parts if p.any()]
    segs, data = [i for i, _ in parts], [p for _, p in parts]
    return pa.record_batch([pa.array(segs, pa.int32()), pa.array(data, pa.binary())], ["seg", "part"])


def total(parts: DataFrame, size: int, dtype: str, merge: np.ufunc = np.add) -> np.ndarray:
    """The sum of all parts (rows seg, part), or what ``merge`` makes of them. Each task adds up as it
    reads, so that memory does not depend on the number of parts."""
    kind = np.dtype(dtype)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for seg, part in zip(batch["seg"].to_pylist(), batch["part"], strict=True):
                values = np.frombuffer(part.as_buffer(), kind)
                sums[seg] = merge(sums[seg], values) if seg in sums else values.copy()
        keys = pa.array(list(sums), pa.int32())
        yield pa.record_batch([keys, pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["seg", "part"])

    # In two steps, the first by a hash of the part, so that a segment's parts don't meet in one task.
    spread = parts.withColumn("_r", F.pmod(F.xxhash64("part"), F.lit(16))).repartition("seg", "_r").drop("_r")
    summed = spread.mapInArrow(add, SCHEMA).repartition("seg").mapInArrow(add, SCHEMA)
    out = np.zeros(size, kind)
    for row in summed.collect():
        a = row["seg"] * SEGMENT
        out[a : a + SEGMENT] = np.frombuffer(row["part"], kind)
    return out
