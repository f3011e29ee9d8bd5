"""Packing documents into sequences of fixed capacity by exact-complement hashing.

1. Tokenise (one pass, Arrow batches): a document's ids end with id 0. Only documents longer than
   the capacity are cut, into full pieces; the first piece takes what is left over.
2. Plan on the histogram of piece lengths, which has at most `capacity` entries whatever the
   input's size. Opened with the longest length that is left, a bin's gap is looked up among the
   sums of one, two and three available lengths; a combination that fills it exactly is used as
   often as the counts allow. Where there is none, the longest length that fits goes in and the
   rest of the gap is looked up again.
3. Place: pieces of a length are numbered (per slice of a hash, with cumulated counts, so that no
   length meets in one task) and the n-th one takes the n-th slot that the plan has for its length.

A null text is empty: one piece with id 0 alone. Rows that repeat an id are packed as documents of
their own. No documents give no rows. Extra columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillstream.llm.common import table, written
from tillstream.llm.tokens import as_array, encoder, vocabulary_path

CAPACITY = 2048
END_ID = 0


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, id_col: str = "doc_id",
           text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every piece of every document."""
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
              ("length", pa.int64()), ("ids_crc32", pa.int64())]
    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long"
    if with_ids:
        fields.append(("ids", pa.list_(pa.int32())))
        kinds += ", ids array<int>"
    schema = pa.schema(fields)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).ids
        for batch in batches:
            out: list[list] = [[] for _ in fields]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "")
                ids.append(END_ID)
                ids = as_array(ids)
                first = len(ids) % capacity or capacity
                edges = [0, *range(first, len(ids) + 1, capacity)]
                for piece, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    part = ids[a:b]
                    row = (doc_id, piece, a, b - a, zlib.crc32(part.tobytes()))
                    for column, value in zip(out, row, strict=False):
                        column.append(value)
                    if with_ids:
                        out[-1].append(part.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, (_, kind) in zip(out, fields, strict=True)],
                schema=schema)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(cut, kinds)


def _fill(gap: int, left: np.ndarray) -> list[int] | None:
    """One, two or three available lengths whose sum is the gap, long ones first."""
    if left[gap]:
        return [gap]

    def pair(total: int, top: int) -> tuple[int, int] | None:
        long = np.arange(min(total - 1, top), (total + 1) // 2 - 1, -1)
        fits = (left[long] > 0) & (left[total - long] > 0)
        fits &= (long * 2 != total) | (left[long] > 1)
        at = int(fits.argmax()) if fits.any() else -1
        return None if at < 0 else (int(long[at]), int(total - long[at]))

    if found := pair(gap, gap):
        return list(found)
    for first in np.flatnonzero(left[:max(gap - 1, 0)])[::-1].tolist():
        if 3 * first < gap:
            break
        left[first] -= 1
        found = pair(gap - first, first)
        left[first] += 1
        if found:
            return [first, *found]
    return None


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """(how many bins, {length: pieces of it in each such bin}) for all pieces."""
    left = np.zeros(capacity + 1, np.int64)
    for length, count in histogram.items():
        left[length] = count
    bins = []
    while left.any():
        filling: dict[int, int] = {}
        gap = capacity

        def put(length: int, times: int = 1, filling=filling) -> None:
            filling[length] = filling.get(length, 0) + times
            left[length] -= times

        longest = int(np.flatnonzero(left)[-1])
        put(longest)
        gap -= longest
        while gap:
            if exact := _fill(gap, left):
                for length in exact:
                    put(length)
                break
            fitting = np.flatnonzero(left[:gap + 1])
            if not len(fitting):
                break
            best = int(fitting[-1])
            # Short pieces go in together, but for the last few, which may yet fit exactly.
            times = max(1, min(int(left[best]), gap // best - 3))
            put(best, times)
            gap -= best * times
        again = min(int(left[length]) // times for length, times in filling.items())
        for length, times in filling.items():
            left[length] -= again * times
        bins.append((again + 1, filling))
    return bins


def _slots(bins: list[tuple[int, dict[int, int]]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length, in order of slots: first slot, first sequence, pieces in each, offset."""
    rows: dict[int, list[tuple[int, ...]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for count, filling in bins:
        offset = 0
        for length, times in filling.items():
            rows.setdefault(length, []).append((used.get(length, 0), sequence, times, offset))
            used[length] = used.get(length, 0) + count * times
            offset += length * times
        sequence += count
    return {length: tuple(np.array(column, np.int64) for column in zip(*own, strict=True))
            for length, own in rows.items()}


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces; reads them twice, so they should be stored rows."""
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    slots = _slots(plan(histogram, capacity))
    slices = math.ceil(math.sqrt(sum(histogram.values()) or 1) / 4)
    sliced = cut.withColumn("slice", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(slices)))
    counts = sliced.groupBy("length", "slice").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(
        Window.unboundedPreceding, -1)
    bases = counts.select("length", "slice",
                          F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    order = Window.partitionBy("length", "slice").orderBy("doc_id", "piece", "ids_crc32")
    numbered = sliced.withColumn("number", F.row_number().over(order) - 1).join(
        bases, ["length", "slice"]).withColumn("slot", F.col("base") + F.col("number"))
    numbered = numbered.select(*cut.columns, "slot")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            slot = batch.column("slot").to_numpy()
            sequence, offset = np.zeros_like(slot), np.zeros_like(slot)
            for length in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == length)
                first, base, times, begin = slots[length]
                at = np.searchsorted(first, slot[rows], side="right") - 1
                nth = slot[rows] - first[at]
                sequence[rows] = base[at] + nth // times[at]
                offset[rows] = begin[at] + nth % times[at] * length
            columns = [batch.column(name) for name in batch.schema.names if name != "slot"]
            names = [name for name in batch.schema.names if name != "slot"]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"])

    return numbered.mapInArrow(fill, f"{kinds}, sequence_id long, offset long")


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece with its place; `sequences` puts the ids together."""
    return place(written(pieces(docs, vocabulary, capacity, id_col, text_col, with_ids),
                         "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of pieces packed with their ids; a sequence has at most `capacity`."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.flatten(F.col("parts.ids")).alias("ids"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), vocabulary_path())
