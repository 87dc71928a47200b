"""Model runs and their time series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.operators.pick import latest_per_key


def with_params(runs: DataFrame, text: str = "params") -> DataFrame:
    """Run parameters as VARIANT; unreadable JSON is NULL."""
    return runs.withColumn(text, F.try_parse_json(text))


def newest_runs(runs: DataFrame) -> DataFrame:
    """The run created last per (iso3, year); the id decides a tie."""
    return latest_per_key(runs, ["iso3", "year"], ["created_at", "id"])


def run_points(runs: DataFrame, points: DataFrame) -> DataFrame:
    """Points of the given runs."""
    return points.join(runs.select(F.col("id").alias("run_id"), "iso3", "year"), "run_id")
