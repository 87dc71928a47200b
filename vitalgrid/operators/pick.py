"""Choosing rows: latest, last written, first candidate, preferred value, top n.

All of these are aggregates with a map-side part, not windows: a key that holds
a third of the rows is reduced to one row per task before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(columns: list[str]) -> Column:
    return F.col(columns[0]) if len(columns) == 1 else F.struct(*columns)


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The whole row with the greatest ``order`` per key; its NULLs stay NULL."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), _order(order)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def last_write_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the one delivered last; the order columns are dropped."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    value = F.struct(*rest) if rest else F.lit(1)
    picked = df.groupBy(*keys).agg(F.max_by(value, _order(order)).alias("_row"))
    return picked.select(*keys, *([F.col("_row")[c].alias(c) for c in rest]))


def first_write_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order]
    value = F.struct(*rest) if rest else F.lit(1)
    picked = df.groupBy(*keys).agg(F.min_by(value, _order(order)).alias("_row"))
    return picked.select(*keys, *([F.col("_row")[c].alias(c) for c in rest]))


def rank_in(c: Column, candidates: list[str]) -> Column:
    """Position of the value in the list, from 0; NULL where it is not in it."""
    rank = F.array_position(F.array(*[F.lit(x) for x in candidates]), c) - 1
    return F.when(rank >= 0, rank.cast("int"))


def first_candidates(
    df: DataFrame, slice_keys: list[str], variant: str, buckets: dict[str, list[str]]
) -> DataFrame:
    """Per slice and bucket, the best candidate that occurs; NULL where none does.

    One struct column ``choice`` with a field per bucket.
    """
    best = [F.min(rank_in(F.col(variant), cands)).alias(name) for name, cands in buckets.items()]
    named = [
        F.get(F.array(*[F.lit(x) for x in cands]), F.col(name)).alias(name)
        for name, cands in buckets.items()
    ]
    return df.groupBy(*slice_keys).agg(*best).select(*slice_keys, F.struct(*named).alias("choice"))


def preferred(df: DataFrame, slice_keys: list[str], column: str, wanted: list[int]) -> DataFrame:
    """Keep, per slice, the rows of the first wanted value that occurs at all.

    ``df`` holds at most one row per slice and value.
    """
    rank = F.array_position(F.array(*[F.lit(x) for x in wanted]), F.col(column))
    ranked = df.where(F.col(column).isin(wanted))
    return latest_per_key(
        ranked.withColumn("_rank", -rank), slice_keys, ["_rank"]
    ).drop("_rank")


def bucket_rows(df: DataFrame, slice_keys: list[str], buckets: dict[str, list[str]]) -> DataFrame:
    """(slice, bucket, variant) for slices in which every bucket has a candidate."""
    choice = F.col("choice")
    complete = df.where(
        " and ".join(f"choice.`{name}` is not null" for name in buckets)
    )
    row = F.array(
        *[F.struct(F.lit(n).alias("bucket"), choice[n].alias("variant")) for n in buckets]
    )
    return complete.select(*slice_keys, F.inline(row))


def first_n_text(df: DataFrame, keys: list[str], column: str, n: int = 10) -> DataFrame:
    """The first n values per key in order, comma-joined, ' ...' if there are more.

    The rank limit is applied before the shuffle, so a list never holds more
    than n + 1 values whatever the size of its group.
    """
    ranked = (
        df.select(*keys, column)
        .withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(column)))
        .where(F.col("_n") <= n + 1)
    )
    shown = F.array_sort(F.collect_list(F.when(F.col("_n") <= n, F.col(column))))
    more = F.when(F.max("_n") > n, " ...").otherwise("")
    return ranked.groupBy(*keys).agg(F.concat(F.array_join(shown, ", "), more).alias("listed"))
