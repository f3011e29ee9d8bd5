"""Substring dedup: repeated runs of words are removed wherever they come up again.

A window is `WINDOW` consecutive words of one document. Words covered by a window whose words also
start earlier (smaller doc_id, or the same document, earlier start) go; windows are judged on the
input. All documents are the reference of all documents, so the reference grows with the input and
cannot be broadcast. It is cut into shards that can be matched on their own instead:

1. Every window selects one of its 6-word grams, the least in the order (frequency level, hash);
   equal windows select the same one. Consecutive windows with the same gram form a segment. The
   levels are sketched over all documents and keep grams of common lines out, so that a segment
   hangs on what is particular to it.
2. A segment whose gram is there only once in the corpus cannot repeat and is left out. Equal
   segments fold into one passage with its first place, before anything is shuffled by gram, so
   that thousands of copies are one row.
3. A shard holds the passages of some grams. Its suffix automaton keeps the earliest place of
   every run of words; the passages stream through it for their matching statistics, and where
   the match is as long as a window, the earliest place of that window is known.
4. Each segment in a document takes over its passage's places; windows that are not at their
   earliest place are marked, and the union of the marked windows (the maximal spans) is cut out.

A null text has no words. Documents shorter than a window lose nothing. Rows that repeat an id are
one document as far as earlier and later go: alike rows have the same windows at the same places and
do not remove each other. Null ids come first. No documents give no rows. Extra columns are not
read.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm.common import table, written
from tillstream.llm.sketch import frequency_levels, slot
from tillstream.llm.suffix import SuffixAutomaton
from tillstream.llm.words import hashed, mixed, runs, words_of

WINDOW, GRAM = 20, 6
SHARD_WORDS = 60_000
LEVEL_BITS = 5


def grams(text: pa.Scalar, gram: int = GRAM) -> np.ndarray:
    return runs(hashed(words_of(text)), gram)


def segments(found: np.ndarray, levels: np.ndarray, window: int = WINDOW,
             gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(selected gram, first window, number of windows, whether the document has that gram more
    than once) of a document's segments."""
    width = window - gram + 1
    if len(found) < width:
        nothing = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), nothing, nothing, np.zeros(0, bool)
    rank = levels[slot(found)].astype(np.uint64) << np.uint64(64 - LEVEL_BITS)
    rank |= mixed(found) >> np.uint64(LEVEL_BITS)
    least, reach = rank, 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[:len(found) - width + 1], least[width - reach:])
    first = np.flatnonzero(np.diff(least, prepend=~least[:1]))
    selected = least[first]
    doubled = np.unique(rank[pd.Series(rank).duplicated().to_numpy()])
    return selected, first, np.diff(first, append=len(least)), np.isin(selected, doubled)


def _segments(docs: DataFrame, levels, window: int) -> DataFrame:
    """(doc_id, text_hash, gram, start, windows, doubled) of all segments of all documents."""
    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [segments(grams(text), levels.value, window) for text in batch.column(2)]
            sizes = [len(p[0]) for p in parts]
            row = np.repeat(np.arange(len(parts)), sizes)
            if not parts:
                continue
            gram, start, count, doubled = (np.concatenate(c) for c in zip(*parts, strict=True))
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at),
                 pa.array(gram.view(np.int64)), pa.array(start.astype(np.int32)),
                 pa.array(count.astype(np.int32)), pa.array(doubled)],
                names=["doc_id", "text_hash", "gram", "start", "windows", "doubled"])

    return docs.mapInArrow(
        select, "doc_id long, text_hash long, gram long, start int, windows int, doubled boolean")


def _passages(found: DataFrame, window: int) -> DataFrame:
    """The repeated segments of each document with their words.

    `found` has doc_id, text_hash, text and spans; gives one row per segment: gram, passage (a
    digest of its words), doc_id, text_hash, start, words.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(6)]
            for doc_id, text_hash, text, spans in zip(
                    batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2),
                    batch.column(3), strict=True):
                words = words_of(text)
                for span in spans.as_py():
                    start = span["start"]
                    own = b" ".join(words[start:start + span["windows"] + window - 1])
                    passage = hashlib.blake2b(own, digest_size=16).digest()
                    for column, value in zip(out, (span["gram"], passage, doc_id, text_hash, start,
                                                   own), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()),
                 pa.array(out[2], pa.int64()), pa.array(out[3], pa.int64()),
                 pa.array(out[4], pa.int32()), pa.array(out[5], pa.binary())],
                names=["gram", "passage", "doc_id", "text_hash", "start", "words"])

    return found.select("doc_id", "text_hash", "text", "spans").mapInArrow(
        cut, "gram long, passage binary, doc_id long, text_hash long, start int, words binary")


FIRSTS = "passage binary, firsts array<struct<at:int,windows:int,doc_id:long,start:int>>"
FIRST_KIND = pa.list_(pa.struct([("at", pa.int32()), ("windows", pa.int32()),
                                 ("doc_id", pa.int64()), ("start", pa.int32())]))


def first_places(passages: list[tuple[bytes, int | None, int]],
                 window: int = WINDOW) -> list[list[dict]]:
    """For each (words, doc_id, start) of a shard, where its windows start for the first time.

    Windows whose first places follow each other are one entry: at (window in the passage),
    windows, doc_id, start.
    """
    order = sorted(range(len(passages)),
                   key=lambda i: (passages[i][1] is not None, passages[i][1] or 0, passages[i][2]))
    numbers: dict[bytes, int] = {}
    words = [[numbers.setdefault(w, len(numbers)) for w in p[0].split(b" ")] for p in passages]
    doc_ids = sorted({p[1] for p in passages}, key=lambda d: (d is not None, d or 0))
    ranks = {doc_id: rank for rank, doc_id in enumerate(doc_ids)}
    automaton = SuffixAutomaton()
    for i in order:
        automaton.add(words[i], (ranks[passages[i][1]] << 40) + passages[i][2])
    automaton.settle()
    found = []
    for own in words:
        entries: list[dict] = []
        expected = None
        for at, (matched, end) in enumerate(automaton.matches(own, window)):
            if matched < window:
                continue
            if end == expected:
                entries[-1]["windows"] += 1
            else:
                entries.append({"at": at - window + 1, "windows": 1, "doc_id": doc_ids[end >> 40],
                                "start": (end & ((1 << 40) - 1)) - window + 1})
            expected = end + 1
        found.append(entries)
    return found


def _first_places(passages: DataFrame, shards: int, window: int) -> DataFrame:
    def match(shard: pa.Table) -> pa.Table:
        rows = list(zip(*(shard.column(c).to_pylist() for c in ("words", "doc_id", "start")),
                        strict=True))
        # The automaton's many small objects hold no cycles; looking for some takes time.
        gc.disable()
        try:
            firsts = first_places(rows, window)
        finally:
            gc.enable()
        return pa.table([shard.column("passage"), pa.array(firsts, FIRST_KIND)],
                        names=["passage", "firsts"])

    dealt = passages.withColumn("shard", F.pmod(F.xxhash64("gram"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(match, FIRSTS)


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, text_hash, spans (start, end in words) that are covered by repeated windows.

    `docs` has doc_id, text_hash and text.
    """
    levels = docs.sparkSession.sparkContext.broadcast(
        frequency_levels(docs.select("text"), grams))
    selected = written(_segments(docs, levels, window), "segments")
    again = selected.groupBy("gram").agg(
        F.count(F.lit(1)).alias("times"), F.max("doubled").alias("doubled")).filter(
        "times > 1 OR doubled").select("gram")
    spans = selected.join(again, "gram").groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.struct("gram", "start", "windows")).alias("spans"))
    spans = written(spans, "candidate-segments")
    same = docs["doc_id"].eqNullSafe(spans["doc_id"]) & (docs["text_hash"] == spans["text_hash"])
    found = docs.join(spans, same).select(
        docs["doc_id"], docs["text_hash"], "text", "spans")
    occurrences = written(_passages(found, window), "occurrences")
    passages = written(occurrences.groupBy("gram", "passage").agg(
        F.min(F.struct("doc_id", "start")).alias("first"), F.first("words").alias("words")
    ).select("gram", "passage", "words", "first.doc_id", "first.start"), "passages")
    size = passages.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    firsts = written(_first_places(passages, max(1, size // 6 // SHARD_WORDS), window), "firsts")

    placed = occurrences.select("passage", "doc_id", "text_hash", "start").join(firsts, "passage")

    def later(first):
        other = ~first["doc_id"].eqNullSafe(F.col("doc_id"))
        return other | (first["start"] < F.col("start") + first["at"])

    marked = placed.select("doc_id", "text_hash", F.transform(
        F.filter("firsts", later), lambda first: F.struct(
            (F.col("start") + first["at"]).alias("start"),
            (F.col("start") + first["at"] + first["windows"] + (window - 1)).alias("end")))
        .alias("spans")).filter(F.size("spans") > 0)
    return marked.groupBy("doc_id", "text_hash").agg(
        F.flatten(F.collect_set("spans")).alias("spans"))


def _cut(with_spans: DataFrame) -> DataFrame:
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, removed, kept = [], [], []
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                words = words_of(text)
                totals.append(len(words))
                if not spans.is_valid:
                    removed.append(0)
                    kept.append(b" ".join(words))
                    continue
                edges = np.zeros(len(words) + 1, np.int64)
                own = spans.values.flatten()
                np.add.at(edges, own[0].to_numpy(), 1)
                np.add.at(edges, own[1].to_numpy(), -1)
                gone = np.cumsum(edges[:-1]) > 0
                removed.append(int(gone.sum()))
                kept.append(b" ".join(w for w, g in zip(words, gone.tolist(), strict=True)
                                      if not g))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.binary())], names=["doc_id", "n_words", "n_removed", "kept"])

    return with_spans.select("doc_id", "text", "spans").mapInArrow(
        remove, "doc_id long, n_words long, n_removed long, kept binary").withColumn(
        "kept", F.col("kept").cast("string"))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words, joined by one space, of every row."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    docs = docs.withColumn("text_hash", F.coalesce(F.xxhash64("text"), F.lit(0))).select(
        "doc_id", "text_hash", "text")
    spans = written(repeated_spans(docs, window), "repeated-spans")
    same = docs["doc_id"].eqNullSafe(spans["doc_id"]) & (docs["text_hash"] == spans["text_hash"])
    return _cut(docs.join(spans, same, "left").select(docs["doc_id"], "text", "spans"))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
