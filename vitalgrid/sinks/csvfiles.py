"""CSV output of age pyramids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.functions import ages


def write_pyramids(pyramid: DataFrame, path: str) -> None:
    """One ``age_group,pop`` file per (iso3, year), bins in order.

    A file holds the 17 bins of one slice, so slices are spread freely.
    """
    (
        pyramid.select(
            F.lower("iso3").alias("iso3"), "year", F.col("age_bin").alias("age_group"), "pop",
            ages.bin_order(F.col("age_bin")).alias("_ord"),
        )
        .repartition("iso3", "year")
        .sortWithinPartitions("iso3", "year", "_ord")
        .drop("_ord")
        .write.mode("overwrite")
        .partitionBy("iso3", "year")
        .csv(path, header=True)
    )
