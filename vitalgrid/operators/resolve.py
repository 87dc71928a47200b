"""Resolving codes to ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.operators.pick import first_write_wins


def resolve(
    wanted: DataFrame, offered: DataFrame, code: str, ignore_case: bool = False, strict: bool = True
) -> DataFrame:
    """The id of the first offered row with the code.

    ``wanted`` holds the code, ``offered`` ``code, id, _ord``. A code without a
    match fails the query when strict, else gives a NULL id.
    """
    key = F.upper(F.col(code)) if ignore_case else F.col(code)
    rows = offered.select(key.alias("_code"), "id", "_ord")
    first = first_write_wins(rows, ["_code"], ["_ord"])
    joined = wanted.withColumn("_code", key).join(first, "_code", "left")
    if strict:
        missing = F.raise_error(F.concat(F.lit(f"no id for {code} "), F.coalesce(F.col("_code"), F.lit("NULL"))))
        joined = joined.withColumn("id", F.coalesce("id", missing))
    return joined.select(*wanted.columns, "id")
