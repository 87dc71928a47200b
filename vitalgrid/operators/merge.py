"""Keyed merges: upsert, insert-if-absent, slice replacement, column update.

Parquet has no primary key, so the key is enforced here: the incoming side is
reduced to one row per key and the stored side is unique because every writer
goes through these functions. Both sides of the joins are therefore free of
hot keys. Stored columns a load does not name keep their value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalgrid.operators.pick import first_write_wins, last_write_wins


def _unique(df: DataFrame, keys: list[str], order: list[str] | None, first: bool = False) -> DataFrame:
    if not order:
        return df
    return (first_write_wins if first else last_write_wins)(df, keys, order)


def upsert(
    stored: DataFrame,
    incoming: DataFrame,
    keys: list[str],
    update_cols: list[str] | None = None,
    defaults: dict[str, Column] | None = None,
    order: list[str] | None = None,
) -> DataFrame:
    """Stored rows updated by and extended with incoming rows.

    For a key on both sides the ``update_cols`` take the incoming value, NULL
    included; every other stored column is kept. New keys get all incoming
    columns and the defaults for columns the load does not bring. ``order``
    names the delivery order when incoming keys may repeat; without it they
    must be unique.
    """
    defaults = defaults or {}
    new = _unique(incoming, keys, order)
    brought = set(new.columns)
    if update_cols is None:
        update_cols = [c for c in new.columns if c not in keys]
    o = stored.withColumn("_stored", F.lit(True)).alias("o")
    n = new.withColumn("_new", F.lit(True)).alias("n")
    joined = o.join(n, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys], "full_outer")
    is_new, is_stored = F.col("n._new").isNotNull(), F.col("o._stored").isNotNull()

    def merged(f: T.StructField) -> Column:
        name = f.name
        old = F.col(f"o.{name}")
        if name in keys:
            return F.coalesce(F.col(f"n.{name}"), old)
        if name in brought and name in update_cols:
            return F.when(is_new, F.col(f"n.{name}")).otherwise(old)
        if name in brought:
            return F.when(is_stored, old).otherwise(F.col(f"n.{name}"))
        return F.when(is_stored, old).otherwise(defaults.get(name, F.lit(None)))

    return joined.select(
        *[merged(f).cast(f.dataType).alias(f.name) for f in stored.schema.fields]
    )


def insert_if_absent(
    stored: DataFrame, incoming: DataFrame, keys: list[str], order: list[str] | None = None
) -> DataFrame:
    """Append only rows whose key is not stored; the first of a key wins."""
    return stored.unionByName(absent(stored, incoming, keys, order).select(*stored.columns))


def absent(stored: DataFrame, incoming: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """The incoming rows whose key is not stored, the first of each key."""
    return _unique(incoming, keys, order, first=True).join(stored.select(*keys), keys, "left_anti")


def replace_slices(stored: DataFrame, new: DataFrame, slice_keys: list[str]) -> DataFrame:
    """Drop every stored row of a slice the new rows touch, then add the new rows.

    Slices without new rows keep what they hold.
    """
    touched = new.select(*slice_keys).distinct()
    kept = stored.join(touched, slice_keys, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True).select(*stored.columns)


def set_column(stored: DataFrame, values: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Set one column on *every* stored row with a matching key.

    ``values`` holds one row per key: keys and the new value.
    """
    new = values.select(*keys, F.col(column).alias("_value"), F.lit(True).alias("_hit"))
    joined = stored.join(new, keys, "left")
    set_to = F.when(F.col("_hit"), F.col("_value")).otherwise(F.col(column))
    return joined.withColumn(column, set_to).select(*stored.columns)


def evolve(df: DataFrame, schema: T.StructType, fill: dict[str, object] | None = None) -> DataFrame:
    """The rows in the declared shape: missing columns added, NULLs filled, retyped.

    Running it on rows already in that shape changes nothing.
    """
    fill = fill or {}
    have = set(df.columns)

    def column(f: T.StructField) -> Column:
        base = F.col(f.name) if f.name in have else F.lit(None)
        base = base.cast(f.dataType)
        if f.name in fill:
            base = F.coalesce(base, F.lit(fill[f.name]).cast(f.dataType))
        return base.alias(f.name)

    return df.select(*[column(f) for f in schema.fields])


def cascade_delete(parents: DataFrame, children: DataFrame, parent_key: str, child_key: str) -> DataFrame:
    """Children whose parent is still there."""
    return children.join(
        parents.select(F.col(parent_key).alias(child_key)).distinct(), child_key, "left_semi"
    )
