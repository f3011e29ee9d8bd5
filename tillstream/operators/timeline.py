"""Ordered functions over long series, in slices of time.

A window function puts a whole window partition into one task, and one busy series can be most of
the data. Here a series is cut into time slices that are processed apart; what must cross a slice
border is carried over from one summary row per series and slice. Series keys must not be null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE_SECONDS = 86_400


def slice_of(ts: Column, seconds: int = SLICE_SECONDS) -> Column:
    return F.floor(F.unix_micros(ts) / F.lit(seconds * 1_000_000)).cast("long")


def with_previous(
    rows: DataFrame, keys: list[str], ts: str, values: list[str], seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Adds `previous`, a struct of `ts` and `values` of the sample before, null at the start."""
    sliced = rows.withColumn("slice", slice_of(F.col(ts), seconds))
    sample = F.struct(ts, *values)
    in_slice = Window.partitionBy(*keys, "slice").orderBy(ts)
    over_slices = Window.partitionBy(*keys).orderBy("slice")
    carried = sliced.groupBy(*keys, "slice").agg(F.max_by(sample, ts).alias("last")).select(
        *keys, "slice", F.lag("last").over(over_slices).alias("carried"))
    inside = sliced.withColumn("inside", F.lag(sample).over(in_slice))
    return inside.join(carried, [*keys, "slice"], "left").withColumn(
        "previous", F.coalesce("inside", "carried")).drop("inside", "carried", "slice")


def with_next(rows: DataFrame, keys: list[str], at: str, seconds: int = SLICE_SECONDS) -> DataFrame:
    """Adds `next`: the time `at`, in microseconds, of the row after; null at the end."""
    sliced = rows.withColumn("slice", F.floor(F.col(at) / F.lit(seconds * 1_000_000)))
    in_slice = Window.partitionBy(*keys, "slice").orderBy(at)
    over_slices = Window.partitionBy(*keys).orderBy("slice")
    carried = sliced.groupBy(*keys, "slice").agg(F.min(at).alias("first_at")).select(
        *keys, "slice", F.lead("first_at").over(over_slices).alias("carried"))
    inside = sliced.withColumn("inside", F.lead(at).over(in_slice))
    return inside.join(carried, [*keys, "slice"], "left").withColumn(
        "next", F.coalesce("inside", "carried")).drop("inside", "carried", "slice")


def with_run_start(
    rows: DataFrame, keys: list[str], ts: str, flag: str, max_gap_seconds: float,
    seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Adds `run_start`: when the current run of flagged samples began.

    A run ends at a sample without the flag or a pause longer than `max_gap_seconds`. Only
    meaningful on flagged rows.
    """
    limit = int(max_gap_seconds * 1_000_000)
    sliced = rows.withColumn("slice", slice_of(F.col(ts), seconds))
    in_slice = Window.partitionBy(*keys, "slice").orderBy(ts)
    before = F.lag(F.struct(F.col(ts).alias("ts"), F.col(flag).alias("flag"))).over(in_slice)
    inside = sliced.withColumn("before", before)

    def begins(flagged: str, at: str, last_flagged: str, last_at: str) -> Column:
        pause = F.unix_micros(at) - F.unix_micros(last_at) > limit
        return F.col(flagged) & (~F.col(last_flagged) | pause)

    # The first sample of a slice is left open here and settled from the slice before.
    began = F.when(begins(flag, ts, "before.flag", "before.ts"), F.col(ts))
    inside = inside.withColumn("began", began)
    inside = inside.withColumn("latest", F.max("began").over(
        in_slice.rowsBetween(Window.unboundedPreceding, Window.currentRow)))

    ends = inside.groupBy(*keys, "slice").agg(
        F.min(ts).alias("first_at"), F.min_by(flag, ts).alias("first_flag"),
        F.max(ts).alias("last_at"), F.max_by(flag, ts).alias("last_flag"),
        F.max("began").alias("began_inside"))
    over_slices = Window.partitionBy(*keys).orderBy("slice")
    ends = ends.withColumns({
        "last_at": F.lag("last_at").over(over_slices),
        "last_flag": F.lag("last_flag").over(over_slices),
    })
    opens = F.col("first_flag") & F.col("last_at").isNull() | begins(
        "first_flag", "first_at", "last_flag", "last_at")
    ends = ends.withColumn("opened", F.when(opens, F.col("first_at")))
    earlier = F.max(F.coalesce("began_inside", "opened")).over(
        over_slices.rowsBetween(Window.unboundedPreceding, -1))
    carried = ends.select(*keys, "slice", F.coalesce("opened", earlier).alias("carried"))
    return inside.join(carried, [*keys, "slice"], "left").withColumn(
        "run_start", F.coalesce("latest", "carried")).drop(
        "before", "began", "latest", "carried", "slice")


def with_lookback(rows: DataFrame, ts: str, lookback: float, seconds: int = SLICE_SECONDS
                  ) -> DataFrame:
    """Rows with a `slice`; those within `lookback` seconds of the next slice appear there too,
    marked `borrowed`, so that trailing ranges can be taken inside a slice."""
    seconds = max(seconds, int(lookback) + 1)
    own = slice_of(F.col(ts), seconds)
    reaches = slice_of(F.timestamp_micros(F.unix_micros(ts) + int(lookback * 1_000_000)), seconds)
    slices = F.when(reaches > own, F.array(own, reaches)).otherwise(F.array(own))
    return rows.withColumn("slice", F.explode(slices)).withColumn(
        "borrowed", F.col("slice") > own)
