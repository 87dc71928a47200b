"""Keyed tables fed from a stream of landed rows.

Each micro-batch is upserted. An upsert is idempotent, so a batch that is
delivered again after a failure leaves the table as it was.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from vitalgrid.schemas import Table
from vitalgrid.sinks import tables


def landed(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    """New parquet files of a landing folder, as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def upsert_stream(
    stream: DataFrame,
    table: Table,
    path: str,
    to_rows: Callable[[DataFrame], DataFrame],
    now: Column,
    order: list[str],
    checkpoint: str,
) -> StreamingQuery:
    """Start upserting ``to_rows(batch)``; stops when the folder is drained."""

    def load(batch: DataFrame, _: int) -> None:
        tables.upsert(table, path, to_rows(batch), now, order)

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
