"""Fertility bins and age pyramids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.operators import agebands, fertility, raster
from vitalgrid.refdata import FERTILITY_RELEASE, FERTILITY_SOURCE, NODATA
from vitalgrid.sinks import ordered
from vitalgrid.sources import payloads


def fertility_rows(
    pages: DataFrame, source: str = FERTILITY_SOURCE, release: str = FERTILITY_RELEASE
) -> DataFrame:
    """Bins of every (iso3, year) whose payload is complete, ready to replace slices.

    ``pages``: ``iso3, year, page, status, body``.
    """
    records = payloads.envelope_records(pages, ["iso3", "year"])
    return fertility.bins(records).select(
        "*", F.lit(source).alias("source"), F.lit(release).alias("release")
    )


def write_bins(rows: DataFrame, path: str) -> None:
    """Bins as files that hold them by slice, variant and age, in this order from one file to the next."""
    ordered.write_ordered(rows, path, ["iso3", "year", "variant_short_name", "age_min"])


def pyramid_rows(tiles: DataFrame, nodata: float = NODATA) -> DataFrame:
    """17 bins per (iso3, year) from the tiles of the 20 age rasters.

    ``tiles`` carries ``iso3, year, age_code``.
    """
    keys = ["iso3", "year", "age_code"]
    totals = raster.masked_sum(tiles, keys, nodata)
    return agebands.rebin(totals, ["iso3", "year"])
