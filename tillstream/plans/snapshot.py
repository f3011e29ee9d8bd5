"""Snapshots of a table, and the check that a restored one is the same.

Large tables are told apart by digests: every row is hashed, and per partition the hashes are added
up, so neither order nor layout matter and no row is shuffled. Only partitions whose digests differ
are compared row by row. Two sums of 64-bit hashes (under different seeds) and the number of rows
have to agree; different rows agree by chance once in some 2**64 comparisons or less.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.session import enable_checkpoints


def write_snapshot(table: DataFrame, root: str, name: str) -> str:
    path = f"{root}/snapshot={name}"
    table.write.mode("errorifexists").parquet(path)
    return path


def read_snapshot(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/snapshot={name}")


def digests(table: DataFrame, by: str) -> DataFrame:
    """One row per value of `by`: rows, and two sums of row hashes. Column order does not matter."""
    columns = sorted(table.columns)
    # Nulls are hashed as a column of their own, so that they do not equal a value left out.
    marks = F.concat(*[F.when(F.col(c).isNull(), "0").otherwise("1") for c in columns])

    def total(*seed: int) -> Column:
        return F.sum(F.xxhash64(*[F.lit(s) for s in seed], marks, *columns).cast("decimal(20,0)"))

    return table.groupBy(by).agg(
        F.count(F.lit(1)).alias("rows"), total(1).alias("first_sum"), total(2).alias("second_sum"))


def differing_partitions(left: DataFrame, right: DataFrame, by: str) -> DataFrame:
    """Values of `by` that do not hold the same rows on both sides."""
    both = digests(left, by).withColumn("n", F.lit(1)).unionByName(
        digests(right, by).withColumn("n", F.lit(-1)))
    return both.groupBy(by, "rows", "first_sum", "second_sum").agg(
        F.sum("n").alias("n")).where("n <> 0").select(by).distinct()


def difference_by_partition(left: DataFrame, right: DataFrame, by: str) -> DataFrame:
    """As `difference`, but only rows of partitions that differ are read whole and shuffled.

    The differing values are few words a partition; they are written and joined as a filter.
    """
    enable_checkpoints(left.sparkSession)
    columns = left.columns
    changed = differing_partitions(left, right.select(*columns), by).checkpoint()

    def touched(side: DataFrame) -> DataFrame:
        keys = changed.withColumnRenamed(by, "__changed")
        return side.join(keys, F.col(by).eqNullSafe(F.col("__changed")), "left_semi")

    return difference(touched(left), touched(right.select(*columns)))


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows, with their multiplicity, that only one side has; empty when both hold the same.

    Each side is reduced to counts per distinct row before the shuffle, so many equal rows cost
    one row per task.
    """
    columns = left.columns
    both = left.select(*columns, F.lit(1).alias("n")).unionByName(
        right.select(*columns, F.lit(-1).alias("n")))
    surplus = both.groupBy(*columns).agg(F.sum("n").alias("n")).where(F.col("n") != 0)
    return surplus.select(
        *columns, F.when(F.col("n") > 0, "left").otherwise("right").alias("only_in"),
        F.abs("n").alias("copies"))
