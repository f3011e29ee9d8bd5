"""Frequency levels of hashes, counted over a whole column of texts in fixed memory."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SKETCH_BITS, PART = 20, 1 << 14
MOST_LEVEL = 31


def slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def slot_counts(texts: DataFrame, hashes_of: Callable[[pa.Scalar], np.ndarray]) -> np.ndarray:
    """How many hashes of all texts fall into each slot (upper bits of a hash).

    `texts` has one column; `hashes_of` gives the hashes of one text. There are 2**20 slots,
    whatever the size of the input.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                np.add.at(total, slot(hashes_of(text)), 1)
        for at, part in enumerate(total.reshape(-1, PART)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([at], pa.int32()), pa.array([part.tobytes()])], names=["part", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = np.frombuffer(counts.as_buffer(), np.int64)
                totals[part] = totals[part] + own if part in totals else own
        if totals:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(totals), pa.int32()),
                 pa.array([t.tobytes() for t in totals.values()])], names=["part", "counts"])

    schema = "part int, counts binary"
    parts = texts.mapInArrow(count, schema).repartition("part").mapInArrow(add, schema)
    sketch = np.zeros(((1 << SKETCH_BITS) // PART, PART), np.int64)
    for row in parts.collect():  # the sketch has a fixed size
        sketch[row["part"]] = np.frombuffer(bytes(row["counts"]), np.int64)
    return sketch.ravel()


def usual_count(counts: np.ndarray) -> float:
    """Counts near this one may as well be collisions."""
    return max(1.0, float(np.median(counts)))


def levels_of(counts: np.ndarray, by_excess: bool = False) -> np.ndarray:
    """Level of each slot: 0 for usual counts, one more per doubling.

    What doubles is the count, or `by_excess` what it is above the usual one, from three standard
    deviations on.
    """
    usual = usual_count(counts)
    if by_excess:
        beyond = (counts - usual) / (3 * np.sqrt(usual))
        levels = np.where(beyond < 1, 0, 1 + np.log2(np.maximum(beyond, 1)))
    else:
        levels = np.log2(np.maximum(counts, 1) / usual) - 1
    return np.clip(levels, 0, MOST_LEVEL).astype(np.int8)


def frequency_levels(texts: DataFrame, hashes_of: Callable[[pa.Scalar], np.ndarray]) -> np.ndarray:
    return levels_of(slot_counts(texts, hashes_of))
