"""Datasets whose files, read one after the other, are in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_ordered(df: DataFrame, path: str, order: list[str], files: int | None = None) -> None:
    """Rows dealt by range of ``order`` and sorted, so that file names follow it too.

    A value of the order that very many rows share is one range unless further
    columns of the order tell them apart. ``files`` is about how many there will be;
    without it their size decides.
    """
    df.repartitionByRange(*([files] if files else []), *order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """The rows with ``_place``, which sorts as they were written: file, then row of the file."""
    stored = spark.read.parquet(path)
    return stored.select("*", place().alias("_place"))


def place() -> Column:
    return F.struct(F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
