"""Yearly indicator series from landed API pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.functions import clean, fields
from vitalgrid.refdata import (
    INDICATOR_YEARS,
    WHO_INDICATORS,
    WORLDBANK_INDICATORS,
    pairs,
)
from vitalgrid.sources import payloads

REQUEST = ["iso3", "indicator_code"]
ORDER = ["_page", "_pos"]


def _named(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rows of the configured indicators, with their names (a constant table)."""
    return rows.join(F.broadcast(pairs(rows.sparkSession, names, "indicator_code", "indicator_name")), "indicator_code")


def _requested(pages: DataFrame, countries: list[str], names: dict[str, str]) -> DataFrame:
    wanted = clean.allowed("iso3", countries) & F.col("indicator_code").isin(list(names))
    return pages.withColumn("iso3", clean.code("iso3")).where(wanted)


def who_rows(
    pages: DataFrame,
    countries: list[str] = (),
    years: tuple[int, int] = INDICATOR_YEARS,
    names: dict[str, str] = WHO_INDICATORS,
    strict: bool = False,
) -> DataFrame:
    """Rows of the WHO series in delivery order (``_page``, ``_pos``); keys may repeat.

    Requests that broke off give no rows (``who_outcomes`` names them); ``strict``
    fails the load instead.
    """
    chain = payloads.odata_chain(_requested(pages, list(countries), names), REQUEST)
    return who_from(payloads.accepted(payloads.strict(chain, REQUEST) if strict else chain, REQUEST), years, names)


def who_outcomes(pages: DataFrame, countries: list[str] = (), names: dict[str, str] = WHO_INDICATORS) -> DataFrame:
    return payloads.outcomes(payloads.odata_chain(_requested(pages, list(countries), names), REQUEST), REQUEST)


def who_from(records: DataFrame, years: tuple[int, int] = INDICATOR_YEARS, names: dict[str, str] = WHO_INDICATORS) -> DataFrame:
    """Rows of accepted records.

    A zero number counts as absent and falls back to the text value; without
    that the row is dropped.
    """
    wanted = ["TimeDim", "TimeDimensionValue", "NumericValue", "Value", "Low", "High", "Dim1", "Dim1Type", "Dim2", "Dim2Type"]
    texts, f = fields.unpack(records, "rec", {n: [n] for n in wanted})

    def label(first: str, second: str) -> Column:
        return F.when(f[first].truthy(), f[first].text()).when(f[second].truthy(), f[second].text())

    chosen = fields.once(
        texts,
        f["TimeDim"].truthy().alias("_dim_year"),
        f["NumericValue"].truthy().alias("_numeric"),
        label("Dim1", "Dim1Type").alias("_sex"),
        label("Dim2", "Dim2Type").alias("_age"),
    )
    typed = fields.once(
        chosen,
        F.when(F.col("_dim_year"), f["TimeDim"].whole()).otherwise(f["TimeDimensionValue"].whole()).alias("year"),
        F.when(F.col("_numeric"), f["NumericValue"].number()).otherwise(f["Value"].number()).alias("numeric_value"),
        f["Low"].number().alias("low_value"),
        f["High"].number().alias("high_value"),
        F.upper(clean.label_or("_sex", "BTSX")).alias("sex"),
        clean.label_or("_age", "TOTAL").alias("age_group"),
    ).select(*REQUEST, "year", "numeric_value", "low_value", "high_value", "sex", "age_group", *ORDER)
    kept = typed.where(
        F.col("year").isNotNull() & F.col("numeric_value").isNotNull() & clean.in_years("year", years)
    )
    return _named(kept, names)


def worldbank_rows(
    pages: DataFrame,
    countries: list[str] = (),
    years: tuple[int, int] = INDICATOR_YEARS,
    names: dict[str, str] = WORLDBANK_INDICATORS,
    strict: bool = False,
) -> DataFrame:
    """Rows of the World Bank series in delivery order; broken requests as in ``who_rows``."""
    chain = payloads.pair_chain(_requested(pages, list(countries), names), REQUEST)
    return worldbank_from(payloads.accepted(payloads.strict(chain, REQUEST) if strict else chain, REQUEST), years, names)


def worldbank_outcomes(pages: DataFrame, countries: list[str] = (), names: dict[str, str] = WORLDBANK_INDICATORS) -> DataFrame:
    return payloads.outcomes(payloads.pair_chain(_requested(pages, list(countries), names), REQUEST), REQUEST)


def worldbank_from(records: DataFrame, years: tuple[int, int] = INDICATOR_YEARS, names: dict[str, str] = WORLDBANK_INDICATORS) -> DataFrame:
    """Rows of accepted records; zero is a value here."""
    texts, f = fields.unpack(records, "rec", {"date": ["date"], "value": ["value"]})
    typed = fields.once(texts, f["date"].whole().alias("year"), f["value"].number().alias("value")).select(
        *REQUEST, "year", "value", *ORDER
    )
    kept = typed.where(F.col("year").isNotNull() & F.col("value").isNotNull() & clean.in_years("year", years))
    return _named(kept, names)
