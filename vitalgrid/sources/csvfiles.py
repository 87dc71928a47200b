"""CSV scans. Every field arrives as text; casts are explicit and tolerant."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.refdata import COVID_METRICS

AIRPORT_FIELDS = ["type", "ident", "iso_country", "iata_code", "name", "latitude_deg", "longitude_deg"]
COVID_FIELDS = ["iso_code", "date", *COVID_METRICS]


def text_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def subset(df: DataFrame, fields: list[str]) -> DataFrame:
    """The named columns; a header that is absent gives a column of NULLs."""
    have = set(df.columns)
    return df.select(
        *[(F.col(f"`{c}`") if c in have else F.lit(None).cast("string")).alias(c) for c in fields]
    )


def with_file_order(df: DataFrame) -> DataFrame:
    """Add ``_file`` and ``_line``, the delivery order of the rows of a file scan.

    Rows of one split keep file order and splits are ordered by their offset,
    so (file, block start, id within the partition) is the order of the file.
    """
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.struct(
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("_line"),
    )


def airports(spark: SparkSession, path: str) -> DataFrame:
    return subset_ordered(text_csv(spark, path, multi_line=True), AIRPORT_FIELDS)


def covid(spark: SparkSession, path: str) -> DataFrame:
    return subset_ordered(text_csv(spark, path), COVID_FIELDS)


def subset_ordered(df: DataFrame, fields: list[str]) -> DataFrame:
    ordered = with_file_order(df)
    have = set(df.columns)
    return ordered.select(
        *[(F.col(f"`{c}`") if c in have else F.lit(None).cast("string")).alias(c) for c in fields],
        "_file",
        "_line",
    )
