"""Age-code totals to five-year bins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid import refdata


def rebin(totals: DataFrame, keys: list[str], code: str = "age_code", total: str = "total") -> DataFrame:
    """All 17 bins per key from the totals of the 20 age codes.

    A missing code counts 0.0. The bins are 17 conditional sums, so one
    aggregation gives the complete list without joining a bin table.
    """
    bins = refdata.AGE_BINS
    sums = [
        F.coalesce(F.sum(F.when(F.col(code).isin(codes), F.col(total))), F.lit(0.0)).alias(f"b{i}")
        for i, codes in enumerate(bins.values())
    ]
    row = F.array(
        *[
            F.struct(F.lit(i).alias("bin_ord"), F.lit(name).alias("age_bin"), F.col(f"b{i}").alias("pop"))
            for i, name in enumerate(bins)
        ]
    )
    return totals.groupBy(*keys).agg(*sums).select(*keys, F.inline(row))
