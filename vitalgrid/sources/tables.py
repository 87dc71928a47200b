"""Reading keyed tables: filters and projections that reach the file scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.schemas import Table


def empty(spark: SparkSession, table: Table) -> DataFrame:
    return spark.createDataFrame([], table.schema)


def read(spark: SparkSession, table: Table, path: str) -> DataFrame:
    """The stored table with its declared schema; no inference, no footer merge."""
    return spark.read.schema(table.schema).parquet(path).select(*table.columns)


def where_equal(df: DataFrame, **values: object) -> DataFrame:
    """Equality filter; pushed to the scan when ``df`` is a stored table."""
    for name, value in values.items():
        df = df.where(F.col(name) == F.lit(value))
    return df


def lookup(df: DataFrame, key: str, value: str) -> DataFrame:
    """The two columns of a lookup. Whether it is broadcast is left to its size."""
    return df.select(key, value)


def typed(df: DataFrame, table: Table, **columns: Column) -> DataFrame:
    """Select table columns by name with the declared types, in declared order."""
    types = {f.name: f.dataType for f in table.schema.fields}
    return df.select(*[c.cast(types[n]).alias(n) for n, c in columns.items()])
