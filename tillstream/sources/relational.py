"""Relational tables through JDBC, split over tasks by a numeric column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillstream.settings import Settings


def jdbc_options(settings: Settings, table: str) -> dict[str, str]:
    return {
        "url": f"jdbc:postgresql://{settings.db_host}:{settings.db_port}/{settings.db_name}",
        "driver": "org.postgresql.Driver",
        "user": settings.db_user,
        "password": settings.db_password,
        "dbtable": table,
    }


def read_table(
    spark: SparkSession, settings: Settings, table: str = "raw.events",
    split_column: str | None = None, lower: int = 0, upper: int = 0, splits: int = 1,
) -> DataFrame:
    reader = spark.read.format("jdbc").options(**jdbc_options(settings, table))
    if split_column:
        reader = reader.options(
            partitionColumn=split_column, lowerBound=lower, upperBound=upper, numPartitions=splits)
    return reader.load()


def write_table(rows: DataFrame, settings: Settings, table: str, mode: str = "append",
                batch_size: int = 10_000) -> None:
    rows.write.format("jdbc").options(
        **jdbc_options(settings, table), batchsize=batch_size).mode(mode).save()
