"""Rewriting a dataset with another codec, verified before it is replaced."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from vitalgrid.operators.digest import table_digest
from vitalgrid.sinks import fs


def in_codec(spark: SparkSession, path: str, codec: str) -> bool:
    """Whether every data file already names the codec."""
    names = fs.data_files(spark, path)
    return bool(names) and all(f".{codec}." in n for n in names)


def _digest(df: DataFrame) -> tuple:
    return tuple(table_digest(df).first())


def recompress(spark: SparkSession, path: str, codec: str = "zstd", dry_run: bool = False) -> tuple[str, int, int]:
    """(status, size before, size after); the original goes only after verification.

    ``skip``: already in the codec. ``CORRUPT``: contents differ, original
    kept. ``FAILED``: the rewrite broke off, original kept. ``would-shrink``:
    verified, but only tried. ``ok``: replaced.
    """
    before = fs.size(spark, path)
    if in_codec(spark, path, codec):
        return "skip", before, before
    staged = fs.staging_path(path)
    try:
        original = spark.read.parquet(path)
        try:
            parts = fs.partition_columns(spark, path)
            writer = (original.hint("rebalance", *parts) if parts else original).write.option("compression", codec)
            writer.partitionBy(*parts).parquet(staged)
        except Exception:
            return "FAILED", before, before
        after = fs.size(spark, staged)
        if _digest(original) != _digest(spark.read.schema(original.schema).parquet(staged)):
            return "CORRUPT", before, before
        if dry_run:
            return "would-shrink", before, after
        fs.swap_in(spark, staged, path)
        return "ok", before, after
    finally:
        if fs.exists(spark, staged):
            fs.remove(spark, staged)


AT_ONCE = 8  # datasets that are rewritten side by side


def recompress_all(spark: SparkSession, paths: list[str], codec: str = "zstd", dry_run: bool = False) -> DataFrame:
    """Results per dataset, as input to the rewrite report.

    The jobs of several datasets run side by side, so that small ones fill what a
    large one leaves free.
    """
    with ThreadPoolExecutor(AT_ONCE) as pool:
        rows = list(pool.map(inheritable_thread_target(spark)(lambda p: (p, *recompress(spark, p, codec, dry_run))), sorted(paths)))
    return spark.createDataFrame(rows, "path string, status string, before bigint, after bigint")
