"""Work manifests: one row per country and year, or per country, year and age code."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid import refdata
from vitalgrid.functions import files
from vitalgrid.refdata import RASTER_YEARS


def country_years(countries: DataFrame, years: tuple[int, int] = RASTER_YEARS) -> DataFrame:
    """Every year of the range for every country, expanded row by row."""
    first, last = years
    return countries.select("*", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("year"))


def raster_requests(countries: DataFrame, years: tuple[int, int] = RASTER_YEARS) -> DataFrame:
    iso3, year = F.col("iso3"), F.col("year")
    return country_years(countries, years).select(
        "iso3", "year",
        files.raster_url(iso3, year).alias("url"),
        files.raw_name(iso3, year).alias("raw_name"),
        files.warped_name(iso3, year).alias("warped_name"),
        files.cog_name(iso3, year).alias("cog_name"),
    )


def age_requests(countries: DataFrame, years: tuple[int, int] = RASTER_YEARS, together: bool = False) -> DataFrame:
    """One row per country, year and age code.

    With ``together`` one per country and age code, with the columns of ``countries``
    and ``requests`` (year, url, filename) of all years: to ask something of them
    needs no exchange and no sort, whatever the number of countries.
    """
    codes = F.array(*[F.lit(c) for c in refdata.RASTER_AGE_CODES])
    if together:
        first, last = years
        urls = F.transform(
            F.sequence(F.lit(first), F.lit(last)),
            lambda y: F.struct(y.alias("year"), files.age_url(F.col("iso3"), y, F.col("age_code")).alias("url")),
        )
        named = F.transform(urls, lambda r: F.struct(r["year"], r["url"], files.base_name(r["url"]).alias("filename")))
        # Behind a generator, so that the array is built once however often it is looked at.
        return countries.select("*", F.explode(codes).alias("age_code")).select("*", F.explode(F.array(named)).alias("requests"))
    expanded = country_years(countries, years).select("iso3", "year", F.explode(codes).alias("age_code"))
    url = files.age_url(F.col("iso3"), F.col("year"), F.col("age_code"))
    return expanded.withColumn("url", url).withColumn("filename", files.base_name(F.col("url")))
