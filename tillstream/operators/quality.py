"""Data tests on tables: each one counts failures, zero means passed."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.session import enable_checkpoints


@dataclass(frozen=True)
class NotNull:
    column: str

    @property
    def name(self) -> str:
        return f"not_null_{self.column}"

    def failures(self) -> Column:
        return F.count_if(F.col(self.column).isNull())


@dataclass(frozen=True)
class AcceptedValues:
    """Failures are the distinct values outside the list; nulls are not looked at."""

    column: str
    values: tuple

    @property
    def name(self) -> str:
        return f"accepted_values_{self.column}"

    def failures(self) -> Column:
        return F.count_distinct(
            F.when(~F.col(self.column).isin(*self.values), F.col(self.column)))


@dataclass(frozen=True)
class NoRowWhere:
    """A singular test: no row may meet the condition."""

    name: str
    condition: str

    def failures(self) -> Column:
        """Over a table in which the condition is a column of this name."""
        return F.count_if(F.col(self.name))


@dataclass(frozen=True)
class Unique:
    column: str

    @property
    def name(self) -> str:
        return f"unique_{self.column}"


class DataTestFailure(RuntimeError):
    pass


def null_counts(table: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a null, per column, in one pass."""
    counts = table.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in columns])
    return counts.select(F.inline(pairs))


def duplicate_values(table: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their counts; nulls are not looked at."""
    return table.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
        F.count("*").alias("n_records")).where(F.col("n_records") > 1)


def unaccepted_values(table: DataFrame, column: str, accepted: list) -> DataFrame:
    return table.where(~F.col(column).isin(*accepted)).groupBy(
        F.col(column).alias("value")).agg(F.count("*").alias("n_records"))


def report(table: DataFrame, checks: list) -> DataFrame:
    """`check, failures, passed` - one pass for all row tests, one aggregation per unique column.

    What the tests look at is written once, so that a table that parses its input parses it once.
    """
    enable_checkpoints(table.sparkSession)
    columns = sorted({c.column for c in checks if not isinstance(c, NoRowWhere)})
    table = table.select(*columns, *[
        F.expr(c.condition).alias(c.name) for c in checks if isinstance(c, NoRowWhere)]).checkpoint()
    row_checks = [c for c in checks if not isinstance(c, Unique)]
    parts = []
    if row_checks:
        counts = table.agg(*[c.failures().alias(c.name) for c in row_checks])
        parts.append(counts.select(F.inline(F.array(*[
            F.struct(F.lit(c.name).alias("check"), F.col(c.name).alias("failures"))
            for c in row_checks]))))
    for check in checks:
        if isinstance(check, Unique):
            parts.append(duplicate_values(table, check.column).agg(
                F.count("*").alias("failures")).select(F.lit(check.name).alias("check"), "failures"))
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("failures") == 0)


def enforce(checked: DataFrame) -> None:
    """Raises when any test of a report failed."""
    failed = [f"{r['check']}: {r['failures']}" for r in checked.where("NOT passed").collect()]
    if failed:
        raise DataTestFailure("; ".join(sorted(failed)))


def missing_ids(expected: DataFrame, stored: DataFrame, key: str = "event_id") -> DataFrame:
    """Ids that should be stored and are not."""
    return expected.select(key).distinct().join(stored.select(key), key, "left_anti")


def uniqueness(table: DataFrame, key: str = "event_id") -> DataFrame:
    """Rows, distinct ids, and whether they differ."""
    return table.agg(
        F.count("*").alias("total"), F.count_distinct(key).alias("distinct_ids"),
    ).withColumn("mismatch", F.col("total") != F.col("distinct_ids"))
