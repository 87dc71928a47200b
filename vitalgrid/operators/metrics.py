"""Load reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def load_metrics(rows: DataFrame, entity: str = "iso3") -> DataFrame:
    """Rows delivered (before key dedupe) and distinct entities."""
    return rows.agg(
        F.count("*").alias("rows"), F.count_distinct(entity).alias("entities")
    )


def rows_per(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("rows"))
