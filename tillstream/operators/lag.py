"""Consumer lag from high watermarks and committed offsets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.operators import timeline


def consumer_lag(
    high: DataFrame, committed: DataFrame, keys: tuple[str, ...] = ("topic", "partition"),
) -> DataFrame:
    """Lag per partition: `high` minus `committed`, never negative; never committed counts as 0.

    `high` has `keys` and `high`; `committed` has `keys` and `committed`.
    """
    start = F.when(F.col("committed") >= 0, F.col("committed")).otherwise(F.lit(0))
    return high.join(committed.select(*keys, "committed"), list(keys), "left").withColumns({
        "committed": start,
        "lag": F.greatest(F.col("high") - start, F.lit(0)),
    })


def total_lag(lags: DataFrame, by: tuple[str, ...] = ("topic",)) -> DataFrame:
    return lags.groupBy(*by).agg(F.sum("lag").alias("lag"))


def with_trend(lags: DataFrame, keys: list[str], ts: str = "ts") -> DataFrame:
    """Adds `trend`: ^ grew, v shrank, = unchanged since the sample before, blank for the first."""
    rows = timeline.with_previous(lags, keys, ts, ["lag"])
    before = F.col("previous.lag")
    trend = (
        F.when(before.isNull(), " ").when(F.col("lag") > before, "^")
        .when(F.col("lag") < before, "v").otherwise("=")
    )
    return rows.withColumn("trend", trend).drop("previous")
