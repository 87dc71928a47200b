"""Country-pair passenger volumes, the coverage gate, importation pressure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.functions import clean
from vitalgrid.functions.flights import passengers
from vitalgrid.refdata import AIRPORT_TYPES, DEFAULT_SEATS, MAX_UNREACHABLE


def clean_airports(raw: DataFrame, iso_codes: DataFrame) -> DataFrame:
    """Large and medium airports with a four-letter code in a known country.

    ``iso_codes`` is the constant two-letter to three-letter table, so it is
    broadcast. Columns of ``raw`` beyond the airport fields are passed on.
    """
    icao = clean.code("ident")
    wanted = clean.strip(F.coalesce(F.col("type"), F.lit(""))).isin(AIRPORT_TYPES) & (F.length(icao) == 4)
    fields = {"type", "ident", "iso_country", "iata_code", "name", "latitude_deg", "longitude_deg"}
    rest = [c for c in raw.columns if c not in fields]
    kept = raw.where(wanted).select(
        icao.alias("icao_code"),
        clean.blank_to_null(clean.code("iata_code")).alias("iata_code"),
        clean.strip(F.coalesce(F.col("name"), F.lit(""))).alias("name"),
        clean.code("iso_country").alias("iso2"),
        clean.double_or_null("latitude_deg").alias("latitude"),
        clean.double_or_null("longitude_deg").alias("longitude"),
        clean.strip("type").alias("type"),
        *rest,
    )
    return kept.join(F.broadcast(iso_codes), "iso2").select(
        "icao_code", "iata_code", "name", "iso3", "latitude", "longitude", "type", *rest
    )


def with_destination(requests: DataFrame, airports: DataFrame) -> DataFrame:
    """Add the country of the airport that was asked; unknown airports drop out.

    Meant for the request side, before its flights are expanded: one row per
    request is joined instead of one per flight.
    """
    to = airports.select(F.col("icao_code").alias("queried_airport"), F.col("iso3").alias("destination_iso3"))
    return requests.join(to, "queried_airport")


def with_origin(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """Add the country of the departure airport.

    Unknown departures and flights within one country drop out. The airport
    table is not hinted: it is broadcast if its size allows and shuffled, with
    skew splitting, if not.
    """
    via = airports.select(F.col("icao_code").alias("_dep"), F.col("iso3").alias("origin_iso3"))
    return (
        flights.withColumn("_dep", clean.code("estDepartureAirport"))
        .join(via, "_dep")
        .where(F.col("origin_iso3") != F.col("destination_iso3"))
        .drop("_dep")
    )


def with_seats(flights: DataFrame, seats: DataFrame, type_col: str, default: int = DEFAULT_SEATS) -> DataFrame:
    """Seats of the aircraft type, the default where the type is unknown."""
    known = seats.select(F.col("icao_type_code").alias(type_col), F.col("typical_seats").alias("_seats"))
    return flights.join(known, type_col, "left").withColumn(
        "seats", F.coalesce("_seats", F.lit(default))
    ).drop("_seats")


def pair_volumes(flights: DataFrame, seats: Column | None = None) -> DataFrame:
    """Flights and estimated passengers per (origin, destination, date)."""
    seats = F.lit(DEFAULT_SEATS) if seats is None else seats
    return flights.groupBy("origin_iso3", "destination_iso3", "date").agg(
        F.count("*").cast("int").alias("flight_count"),
        F.sum(passengers(seats)).cast("int").alias("estimated_passengers"),
    )


def day_totals(volumes: DataFrame) -> DataFrame:
    """Origins, flights and passengers per destination and day."""
    return volumes.groupBy("destination_iso3", "date").agg(
        F.count("*").alias("origins"),
        F.sum("flight_count").alias("flights"),
        F.sum("estimated_passengers").alias("passengers"),
    )


def coverage_status(unreachable: Column, airports: Column, limit: float = MAX_UNREACHABLE) -> Column:
    share = unreachable.cast("double") / airports.cast("double")
    return F.when(share > limit, "fail").when(unreachable > 0, "warn").otherwise("ok")


def coverage(outcomes: DataFrame, airports: DataFrame, limit: float = MAX_UNREACHABLE, n: int = 10) -> DataFrame:
    """Share of a country's airports without an answer, per day, and the first ``n`` of them by name.

    The base is every airport of the country, so an airport that was never
    asked counts as unreachable: unknown is not zero. Countries without
    airports do not appear. Airports are never multiplied with days: those that
    answered are counted and taken from the airports there are, and the first
    names without an answer stand in the gaps between the ranks of the others.
    """
    ranked = airports.select(F.col("icao_code").alias("airport"), "iso3").distinct().withColumns(
        {
            "_rank": F.row_number().over(Window.partitionBy("iso3").orderBy("airport")),
            "_airports": F.count("*").over(Window.partitionBy("iso3")),
        }
    )
    asked = outcomes.select("airport", "date", (~F.col("unreachable")).alias("_answered")).join(ranked, "airport")
    day = ["iso3", "date"]
    # Dealt once by country and day; the groupings and the window below keep that.
    per_airport = asked.repartition(*day).groupBy(*day, "_rank", "_airports").agg(F.max("_answered").alias("_answered"))
    earlier = Window.partitionBy(*day).orderBy("_rank").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.when(F.col("_answered"), F.col("_rank"))
    last, before = F.coalesce(F.max(reached).over(earlier), F.lit(0)), F.count(reached).over(earlier)
    # A gap that starts with more than n missing names before it shows none of its own.
    gap = F.col("_answered") & (F.col("_rank") > F.col("_last") + 1) & (F.col("_last") - F.col("_before") <= n)
    gaps = per_airport.withColumns({"_last": last, "_before": before}).withColumn(
        "_gap", F.when(gap, F.sequence(F.col("_last") + 1, F.least(F.col("_rank") - 1, F.col("_last") + n + 1)))
    )
    top = F.coalesce(F.max(F.when(F.col("_answered"), F.col("_rank"))), F.lit(0))
    counted = gaps.groupBy(*day).agg(
        F.max("_airports").alias("airports"),
        (F.max("_airports") - F.count(F.when(F.col("_answered"), 1))).alias("unreachable"),
        F.flatten(F.collect_list("_gap")).alias("_inner"),  # at most n + 1 gaps of n + 1 ranks
        top.alias("_top"),
    )
    end = F.when(F.col("_top") < F.col("airports"), F.sequence(F.col("_top") + 1, F.least(F.col("airports").cast("int"), F.col("_top") + n + 1)))
    missing = F.slice(F.array_sort(F.concat("_inner", F.coalesce(end, F.array().cast("array<int>")))), 1, n + 1)
    counted = counted.select(*day, "airports", "unreachable", missing.alias("_missing"))
    named = (
        counted.select(*day, F.explode_outer("_missing").alias("_rank"), "airports", "unreachable")
        .join(ranked.select("iso3", "_rank", "airport"), ["iso3", "_rank"], "left")
        .groupBy(*day, "airports", "unreachable")
        .agg(F.array_sort(F.collect_list("airport")).alias("_names"))
    )
    listed = F.when(
        F.size("_names") > 0,
        F.concat(F.array_join(F.slice("_names", 1, n), ", "), F.when(F.size("_names") > n, " ...").otherwise("")),
    )
    return named.select(
        *day, "airports", "unreachable",
        (F.col("unreachable") / F.col("airports")).alias("share"),
        coverage_status(F.col("unreachable"), F.col("airports"), limit).alias("status"),
        listed.alias("listed"),
    )


def gated(volumes: DataFrame, cover: DataFrame) -> DataFrame:
    """Volumes of the country-days whose coverage did not fail."""
    passing = cover.where(F.col("status") != "fail").select(
        F.col("iso3").alias("destination_iso3"), "date"
    )
    return volumes.join(passing, ["destination_iso3", "date"], "left_semi").select(*volumes.columns)


def require_coverage(cover: DataFrame) -> None:
    """Raise if any country-day failed the gate; reads one row."""
    bad = cover.where(F.col("status") == "fail").take(1)
    if bad:
        r = bad[0]
        raise RuntimeError(
            f"partial day refused: {r.unreachable}/{r.airports} airports unreachable "
            f"for {r.iso3} on {r.date}: {r.listed}"
        )


def importation(volumes: DataFrame, states: DataFrame) -> DataFrame:
    """Importation pressure per destination and day.

    The sum over origins of passengers times prevalence over population of the
    origin. ``states``: ``iso3, prevalence, population``.
    """
    origin = states.select(
        F.col("iso3").alias("origin_iso3"),
        (F.col("prevalence") / F.col("population")).alias("_rate"),
    )
    return (
        volumes.join(origin, "origin_iso3")
        .groupBy("destination_iso3", "date")
        .agg(F.sum(F.col("estimated_passengers") * F.col("_rate")).alias("beta_import"))
    )
