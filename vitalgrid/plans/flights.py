"""Airports, seat capacity and country-pair passenger volumes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.functions import clean
from vitalgrid.operators import mobility
from vitalgrid.operators.pick import last_write_wins
from vitalgrid.refdata import MAX_UNREACHABLE, aircraft_seats, iso_codes
from vitalgrid.sources import payloads


def airport_rows(raw: DataFrame, order: list[str]) -> DataFrame:
    """Airports of an airport file, one per code."""
    cleaned = mobility.clean_airports(raw, iso_codes(raw.sparkSession))
    return last_write_wins(cleaned, ["icao_code"], order)


def aircraft_rows(spark: SparkSession) -> DataFrame:
    """The built-in seat capacities; a type goes by its own code."""
    return aircraft_seats(spark).select(
        "icao_type_code", F.col("icao_type_code").alias("name"), "typical_seats", F.lit("MANUAL").alias("source")
    )


def volume_rows(
    log: DataFrame, airports: DataFrame, limit: float = MAX_UNREACHABLE, strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(volumes that pass the gate, coverage) of a fetch log.

    All countries and days of the log in one job. ``strict`` raises on the
    first country-day that fails the gate instead of leaving it out.
    """
    cover = mobility.coverage(payloads.fetch_outcomes(log), airports, limit)
    if strict:
        mobility.require_coverage(cover)
    asked = mobility.with_destination(log.withColumn("queried_airport", clean.code("airport")), airports)
    flights = mobility.with_origin(payloads.arrivals(asked), airports)
    return mobility.gated(mobility.pair_volumes(flights), cover), cover
