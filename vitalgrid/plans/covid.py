"""Daily COVID panel and its latest row per country."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.functions import clean
from vitalgrid.functions.fields import once
from vitalgrid.operators.pick import latest_per_key
from vitalgrid.refdata import COVID_AGGREGATE_PREFIX, COVID_METRICS


def daily_rows(
    raw: DataFrame, countries: list[str] = (), order: tuple[str, ...] = ("_file", "_line"),
    metrics: list[str] = COVID_METRICS,
) -> DataFrame:
    """Typed rows in delivery order; keys may repeat.

    Codes of country groups, bad dates and rows without any metric drop out.
    """
    text = raw.select(
        F.col("iso_code").alias("_code"), F.col("date").alias("_date"),
        *[F.col(m).alias(f"_{m}") for m in metrics],
        *order,
    )
    coded = once(text, clean.code("_code").alias("iso3"), clean.date_or_null("_date").alias("date")).where(
        ~clean.is_aggregate_code("iso3", COVID_AGGREGATE_PREFIX)
        & clean.allowed("iso3", list(countries))
        & F.col("date").isNotNull()
    )
    typed = once(coded, *[clean.double_or_null(f"_{m}").alias(m) for m in metrics])
    return typed.where(clean.any_present(metrics)).select("iso3", "date", *metrics, *order)


def country_latest(daily: DataFrame, now: Column) -> DataFrame:
    """The row of the last date per country, NULLs as they are in that row."""
    wanted = daily.select(
        "iso3", "date", "total_cases", "total_deaths", "total_vaccinations",
        "people_fully_vaccinated", "reproduction_rate", "stringency_index",
    )
    last = latest_per_key(wanted, ["iso3"], ["date"])
    return last.select(
        "iso3",
        F.col("date").alias("last_date"),
        "total_cases", "total_deaths", "total_vaccinations", "people_fully_vaccinated",
        F.col("reproduction_rate").alias("last_reproduction_rate"),
        F.col("stringency_index").alias("last_stringency_index"),
        now.alias("updated_at"),
    )
