"""Writing keyed tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vitalgrid.operators import merge
from vitalgrid.schemas import Table
from vitalgrid.session import materialise
from vitalgrid.sinks import fs
from vitalgrid.sources import tables


def replace(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Write to a sibling, then swap: readers see the old or the new table whole."""
    spark = df.sparkSession
    staged = fs.staging_path(path)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = df.hint("rebalance", *partition_by).write.mode("errorifexists").partitionBy(*partition_by)
    writer.parquet(staged)
    fs.swap_in(spark, staged, path)


def replace_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace only the partitions ``df`` has rows for.

    ``rebalance`` lets AQE split a partition that holds much of the data, so a
    hot date or year is not one task and one file.
    """
    (
        df.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def touched(stored: DataFrame, incoming: DataFrame, columns: list[str]) -> DataFrame:
    """Stored rows in partitions the incoming rows fall into.

    The scan is pruned at run time by the incoming partition values.
    """
    return stored.join(incoming.select(*columns).distinct(), columns, "left_semi")


def _stored(spark: SparkSession, table: Table, path: str) -> DataFrame:
    fs.recover(spark, path)
    return tables.read(spark, table, path) if fs.exists(spark, path) else tables.empty(spark, table)


@contextmanager
def _fixed(df: DataFrame) -> Iterator[DataFrame]:
    """The incoming rows, fixed for the time of a load: they are used more than
    once, and a load must not see two versions of them."""
    rows, path = materialise(df)
    try:
        yield rows
    finally:
        fs.remove(df.sparkSession, path)


@dataclass(frozen=True)
class LoadMetrics:
    """What a load brought: rows delivered, keys among them, and different entities where asked for."""

    rows: int
    keys: int
    entities: int | None


def upsert(
    table: Table, path: str, incoming: DataFrame, now: Column, order: list[str] | None = None, entity: str | None = None
) -> LoadMetrics:
    """Upsert incoming rows into the stored table by its key.

    A partitioned table (its partition columns are part of the key) is read and
    rewritten only where rows arrive. The metrics are observed while the rows are
    written and cost no scan; ``entity`` names a column of few values, such as
    the country. A stage that runs again after a loss may count rows twice.
    """
    spark = incoming.sparkSession
    parts = table.partition_by
    delivered, unique = Observation(), Observation()
    entities = [F.size(F.collect_set(entity)).alias("entities")] if entity else []
    seen = incoming.observe(delivered, F.count(F.lit(1)).alias("rows"), *entities)
    kept = (merge.last_write_wins(seen, table.keys, order) if order else seen).observe(unique, F.count(F.lit(1)).alias("keys"))
    with fs.only_writer(spark, path), _fixed(kept) as rows:
        stored = _stored(spark, table, path)
        if parts:
            stored = touched(stored, rows, parts)
        merged = merge.upsert(
            stored, rows, table.keys,
            [c for c in table.update_cols if c in rows.columns],
            table.default_columns(now),
        )
        if parts:
            replace_partitions(merged, path, parts)
        else:
            replace(merged, path)
    return LoadMetrics(delivered.get["rows"], unique.get["keys"], delivered.get.get("entities"))


def replace_slices(table: Table, path: str, rows: DataFrame, slice_keys: list[str], now: Column) -> None:
    """Replace the slices the rows fall into; other slices keep what they hold.

    Where the table is partitioned by columns of the slice, partitions without
    new rows are neither read nor written.
    """
    spark = rows.sparkSession
    for name, default in table.default_columns(now).items():
        if name not in rows.columns:
            rows = rows.withColumn(name, default)
    parts = table.partition_by
    with fs.only_writer(spark, path), _fixed(merge.evolve(rows, table.schema)) as new:
        stored = _stored(spark, table, path)
        if parts and set(parts) <= set(slice_keys):
            replace_partitions(merge.replace_slices(touched(stored, new, parts), new, slice_keys), path, parts)
        else:
            replace(merge.replace_slices(stored, new, slice_keys), path, parts)


def insert_if_absent(table: Table, path: str, rows: DataFrame, order: list[str] | None = None, now: Column | None = None) -> None:
    """Append the rows whose key is not stored yet, in the table's layout, defaults filled."""
    stored = _stored(rows.sparkSession, table, path)
    fresh = merge.absent(stored, rows, table.keys, order)
    for name, default in table.default_columns(F.current_timestamp() if now is None else now).items():
        fresh = fresh.withColumn(name, F.coalesce(F.col(name), default) if name in fresh.columns else default)
    fresh = merge.evolve(fresh, table.schema)
    if table.partition_by:
        fresh.hint("rebalance", *table.partition_by).write.mode("append").partitionBy(*table.partition_by).parquet(path)
    else:
        fresh.write.mode("append").parquet(path)


def migrate(spark: SparkSession, table: Table, path: str, fill: dict[str, object]) -> None:
    """Bring a stored table into its declared shape; a no-op if it already is."""
    fs.recover(spark, path)
    if not fs.exists(spark, path):
        return
    stored = spark.read.parquet(path)
    if set(table.columns) <= set(stored.columns):
        return
    replace(merge.evolve(stored, table.schema, fill), path, table.partition_by)
