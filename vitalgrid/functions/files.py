"""File names, sizes, content types, digests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: name patterns of the published rasters
RAW_NAME = "%s_pop_%d_CN_100m_R2025A_v1.tif"
WARPED_NAME = "%s_pop_%d_CN_100m_R2025A_v1_3857.tif"
COG_NAME = "%s_pop_%d_CN_100m_R2025A_v1_cog.tif"
RASTER_URL = (
    "https://data.worldpop.org/GIS/Population/Global_2015_2030/R2025A/%d/%s/v1/100m/constrained/"
    + RAW_NAME
)
AGE_URL = (
    "https://data.worldpop.org/GIS/AgeSex_structures/Global_2015_2030/R2025A/"
    "%d/%s/v1/100m/constrained/%s_%s_%s_%d_CN_100m_R2025A_v1.tif"
)


def raw_name(iso3: Column, year: Column) -> Column:
    return F.format_string(RAW_NAME, F.lower(iso3), year)


def warped_name(iso3: Column, year: Column) -> Column:
    return F.format_string(WARPED_NAME, F.lower(iso3), year)


def cog_name(iso3: Column, year: Column) -> Column:
    return F.format_string(COG_NAME, F.lower(iso3), year)


def raster_url(iso3: Column, year: Column) -> Column:
    return F.format_string(RASTER_URL, year, F.upper(iso3), F.lower(iso3), year)


def age_url(iso3: Column, year: Column, age_code: Column, sex: str = "t") -> Column:
    return F.format_string(AGE_URL, year, F.upper(iso3), F.lower(iso3), F.lit(sex), age_code, year)


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def folder(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def name_country(name: Column) -> Column:
    return F.upper(F.regexp_extract(F.lower(name), r"^([a-z0-9]+)_pop_[0-9]{4}_", 1))


def name_year(name: Column) -> Column:
    return F.regexp_extract(F.lower(name), r"_pop_([0-9]{4})_", 1).try_cast("int")


def is_year_cog(name: Column, year: int) -> Column:
    """A finished country raster of the year, whatever the case of its name."""
    low = F.lower(name)
    return (low.endswith("_cog.tif") | low.endswith("_cog.tiff")) & low.contains(f"_pop_{year}_")


def usable(length: Column) -> Column:
    """There and not empty: a writer killed half-way leaves zero bytes."""
    return F.coalesce(length, F.lit(0)) > 0


def content_type(name: Column) -> Column:
    low = F.lower(name)
    return (
        F.when(low.endswith(".tif") | low.endswith(".tiff"), "image/tiff")
        .when(low.endswith(".csv"), "text/csv")
        .when(low.endswith(".json"), "application/json")
        .otherwise("application/octet-stream")
    )


def human_bytes(n: Column) -> Column:
    """'512 B', '1.5 KiB', up to GiB."""

    def scaled(power: int) -> Column:
        return F.format_string("%.1f", F.bround(n.cast("double") / F.lit(float(1024**power)), 1))

    size = F.abs(n)
    return (
        F.when(size < 1024, F.concat(n.cast("string"), F.lit(" B")))
        .when(size < 1024**2, F.concat(scaled(1), F.lit(" KiB")))
        .when(size < 1024**3, F.concat(scaled(2), F.lit(" MiB")))
        .otherwise(F.concat(scaled(3), F.lit(" GiB")))
    )


def percent_saved(before: Column, after: Column) -> Column:
    """Share saved in percent; nothing before means nothing saved."""
    ratio = after.cast("double") / F.nullif(before, F.lit(0)).cast("double")
    return F.coalesce((F.lit(1.0) - ratio) * 100, F.lit(0.0))


def is_fresh(modified: Column, now: Column, hours: int = 12) -> Column:
    """Younger than so many hours at ``now``."""
    return F.unix_micros(now.cast("timestamp")) - F.unix_micros(modified.cast("timestamp")) < F.lit(
        hours * 3600 * 1_000_000
    )
