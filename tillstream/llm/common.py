"""Helpers that the operators of this folder share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.session import scratch_folder, ship  # noqa: F401

# A word is a run of anything but ASCII white space (as Java regular expression).
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# With this the shuffle files of a write go when it is done, not when the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(rows: DataFrame, name: str) -> DataFrame:
    """Writes rows below the shared folder and reads them again: cuts lineage, computes once."""
    spark = rows.sparkSession
    ship(spark)
    folder = scratch_folder(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        rows.write.option("compression", "zstd").parquet(folder)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(rows.schema).parquet(folder)


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only. Pure ASCII takes the byte-wise path of lower()."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _nibble(value: int) -> int:
    for _ in range(4):
        value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
    return value


def crc32_sql(text: str) -> str:
    """The unsigned CRC-32 of a text's UTF-8 as DuckDB SQL, four bits at a time, low ones first."""
    steps = ", ".join(str(_nibble(value)) for value in range(16))
    digits = (f"list_transform(range(2 * octet_length(encode({text}))), lambda k: "
              f"instr('0123456789ABCDEF', hex(encode({text}))[xor(k, 1) + 1]) - 1)")
    return (f"xor(4294967295, list_reduce(list_prepend(4294967295, {digits}), "
            f"lambda c, d: xor(c >> 4, [{steps}][(xor(c, d) & 15) + 1])))")
