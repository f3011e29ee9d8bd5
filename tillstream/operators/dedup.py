"""Duplicate handling: first write wins, rows not stored yet, and the recent-id window.

A single id may own a large share of all rows, so nothing here gathers an id's rows in one place:
copies are folded map-side before any shuffle, and long histories are followed by joins on
(id, time).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstream.session import enable_checkpoints

# Ids with more distinct sighting times than this are followed by joins, not folded as an array.
FOLD_LIMIT = 1024
# How many time-to-live spans of an id are ordered together.
SLICE_SPANS = 4096


def first_wins(
    events: DataFrame, keys: tuple[str, ...] = ("event_id",),
    order: tuple[str, ...] = ("kafka_partition", "kafka_offset"),
) -> DataFrame:
    """One row per key, the one that comes first in `order`; of equals always the same one.

    The limit of one row per key is applied within each task before the shuffle as well, so an id
    with very many copies sends one row per task.
    """
    tie = F.xxhash64(*[c for c in events.columns if c != "ingested_at"])
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, tie))
    return events.withColumn("nth_copy", nth).where(F.col("nth_copy") == 1).drop("nth_copy")


def surplus_copies(events: DataFrame, key: str = "event_id") -> DataFrame:
    """How many rows, ids, repeated ids and surplus copies there are."""
    copies = events.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return copies.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count("*").alias("distinct_ids"),
        F.count_if(F.col("n") > 1).alias("repeated_ids"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus_copies"),
    )


def new_rows(events: DataFrame, stored: DataFrame, key: str = "event_id") -> DataFrame:
    """Events whose id is not stored yet; only the id column of `stored` is read."""
    return events.join(stored.select(key), key, "left_anti")


def stored_hits(stored: DataFrame, ids: DataFrame, key: str = "event_id") -> DataFrame:
    """The part of a big id table that a small set of ids touches.

    A semi join may broadcast the small side (when its measured size allows it) or filter the big
    one by a Bloom filter; an anti join against the big table could do neither.
    """
    return stored.select(key).join(ids.select(key), key, "left_semi")


def _sighting_times(sightings: DataFrame, key: str, ts: str) -> DataFrame:
    return sightings.where(F.col(key).isNotNull()).select(
        F.col(key), F.unix_micros(ts).alias("at")).distinct()


def _fold_anchors(times: DataFrame, key: str, ttl: int) -> DataFrame:
    """Anchors of ids with a bounded number of sighting times."""
    seen = times.groupBy(key).agg(F.array_sort(F.collect_list("at")).alias("seen"))
    kept = F.expr(f"""aggregate(seen, cast(array() AS array<bigint>), (kept, t) ->
        if(size(kept) = 0 OR t > try_element_at(kept, -1) + {ttl}, concat(kept, array(t)), kept))""")
    return seen.select(key, F.explode(kept).alias("at"))


def _next_anchor(times: DataFrame, key: str, ttl: int) -> DataFrame:
    """For each sighting the first one of the same id that is more than `ttl` later.

    Time is cut into spans of `ttl`. A limit `at + ttl` falls into the span after `at`'s own, so
    each span of an id is searched on its own; failing that, the next span that holds anything
    starts with the answer.
    """
    span = (F.col("at") - F.pmod("at", F.lit(ttl))) / ttl
    points = times.select(
        key, span.cast("long").alias("span"), "at", F.col("at").alias("point"),
        F.lit(None).cast("long").alias("origin"))
    limits = times.select(
        key, (span.cast("long") + 1).alias("span"), (F.col("at") + ttl).alias("at"),
        F.lit(None).cast("long").alias("point"), F.col("at").alias("origin"))
    both = points.unionByName(limits)
    later_in_span = Window.partitionBy(key, "span").orderBy(F.desc("at")).rangeBetween(
        Window.unboundedPreceding, -1)
    spans = _with_later(both.groupBy(key, "span").agg(F.min("point").alias("first")), key)
    found = both.withColumn("inside", F.min("point").over(later_in_span)).where(
        F.col("origin").isNotNull())
    return found.join(spans, [key, "span"]).select(
        key, F.col("origin").alias("at"), F.coalesce("inside", "after").alias("next"),
    ).where(F.col("next").isNotNull())


def _with_later(spans: DataFrame, key: str) -> DataFrame:
    """Adds `after`, the least `first` of an id's later spans.

    Spans are looked at in slices of `SLICE_SPANS`; what lies beyond a slice comes from one row
    per id and slice, so that an id seen for years at a short ttl is not ordered in one task.
    """
    sliced = spans.withColumn("slice", F.floor(F.col("span") / SLICE_SPANS))
    backward = [Window.unboundedPreceding, -1]
    in_slice = Window.partitionBy(key, "slice").orderBy(F.desc("span")).rowsBetween(*backward)
    over_slices = Window.partitionBy(key).orderBy(F.desc("slice")).rowsBetween(*backward)
    beyond = sliced.groupBy(key, "slice").agg(F.min("first").alias("first")).select(
        key, "slice", F.min("first").over(over_slices).alias("beyond"))
    inside = sliced.withColumn("inside", F.min("first").over(in_slice))
    return inside.join(beyond, [key, "slice"]).select(
        key, "span", F.coalesce("inside", "beyond").alias("after"))


def _follow_anchors(times: DataFrame, key: str, ttl: int) -> DataFrame:
    """Anchors of ids with long histories: follow the next-anchor links, doubling the stride.

    Every join is on (id, time), which is unique, so an id that owns most rows is spread evenly.
    The number of rounds is the logarithm of the longest chain. Links soon lead to the same few
    times, and all anchors not reached yet are among those: the rest is dropped, so each round
    handles about half the rows of the one before.
    """
    links = _next_anchor(times, key, ttl).checkpoint()
    reached = times.groupBy(key).agg(F.min("at").alias("at")).checkpoint()
    while True:
        step = reached.join(links, [key, "at"]).select(key, F.col("next").alias("at")).checkpoint()
        if step.isEmpty():
            return reached
        # Each part is a written result, so the union repeats no work.
        reached = reached.unionByName(step)
        onward = links.select(key, F.col("at").alias("next"), F.col("next").alias("far"))
        links = links.join(onward, [key, "next"]).select(
            key, "at", F.col("far").alias("next")).checkpoint()
        ahead = links.select(key, F.col("next").alias("at")).distinct()
        links = links.join(ahead.unionByName(reached), [key, "at"], "left_semi").checkpoint()


def ttl_anchors(
    sightings: DataFrame, ttl_seconds: float = 300.0, key: str = "event_id", ts: str = "timestamp",
    fold_limit: int = FOLD_LIMIT,
) -> DataFrame:
    """The sighting times (`key`, `at` in microseconds) that enter a recent-id cache.

    A sighting is a duplicate while it is at most the time-to-live older than its anchor, the
    sighting that last entered the cache. Hits do not refresh the anchor.
    """
    ttl = int(ttl_seconds * 1_000_000)
    enable_checkpoints(sightings.sparkSession)
    # Written once: what led to the sightings (parsing, as a rule) is not run again below.
    times = _sighting_times(sightings, key, ts).checkpoint()
    hot = times.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > fold_limit)
    hot = hot.select(key).checkpoint()
    if hot.isEmpty():
        return _fold_anchors(times, key, ttl)
    folded = _fold_anchors(times.join(hot, key, "left_anti"), key, ttl)
    return folded.unionByName(_follow_anchors(times.join(hot, key, "left_semi"), key, ttl))


def drop_recent(
    sightings: DataFrame, ttl_seconds: float = 300.0, key: str = "event_id",
    ts: str = "timestamp", order: tuple[str, ...] = ("partition", "offset"),
    fold_limit: int = FOLD_LIMIT,
) -> DataFrame:
    """Batch form of the recent-id filter: the rows that pass, in event order per id."""
    anchors = ttl_anchors(sightings, ttl_seconds, key, ts, fold_limit)
    rows = first_wins(sightings.where(F.col(key).isNotNull()), (key, ts), order)
    return rows.withColumn("at", F.unix_micros(ts)).join(
        anchors, [key, "at"], "left_semi").drop("at")


def drop_recent_stream(
    stream: DataFrame, ttl_seconds: float = 300.0, key: str = "event_id",
) -> DataFrame:
    """Streaming form: an id is remembered for one time-to-live after it was first seen.

    What counts is the time at which the stream sees a row, so no row is ever too late, whatever
    time it carries; a first sighting always passes.
    """
    return stream.withColumn("seen_at", F.current_timestamp()).withWatermark(
        "seen_at", f"{ttl_seconds} seconds").dropDuplicatesWithinWatermark([key]).drop("seen_at")
