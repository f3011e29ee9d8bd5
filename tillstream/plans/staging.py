"""The staging view: raw events without the columns that trace their ingestion."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillstream.schemas import STAGING_COLUMNS


def stg_events(raw: DataFrame) -> DataFrame:
    return raw.select(*STAGING_COLUMNS)
