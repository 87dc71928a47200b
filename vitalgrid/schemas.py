"""Declared tables: schema, key, the columns an upsert may change, defaults."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalgrid.refdata import COVID_METRICS


@dataclass(frozen=True)
class Table:
    """A keyed table. ``update_cols`` is what a matching incoming row overwrites."""

    name: str
    ddl: str
    keys: list[str]
    update_cols: list[str]
    defaults: dict[str, object] = field(default_factory=dict)
    partition_by: list[str] = field(default_factory=list)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    def default_columns(self, now: Column) -> dict[str, Column]:
        """Column defaults on first insert; the value NOW stands for load time."""
        return {k: now if v == NOW else F.lit(v) for k, v in self.defaults.items()}


NOW = object()

AIRPORTS = Table(
    "airports",
    "icao_code string, iata_code string, name string, iso3 string, "
    "latitude double, longitude double, type string",
    ["icao_code"],
    ["iata_code", "name", "iso3", "latitude", "longitude", "type"],
)

AIRCRAFT = Table(
    "aircraft_seat_capacity",
    "icao_type_code string, name string, typical_seats int, source string",
    ["icao_type_code"],
    ["typical_seats"],
    {"source": "MANUAL"},
)

FLIGHTS = Table(
    "flight_passenger_volumes",
    "origin_iso3 string, destination_iso3 string, date date, flight_count int, "
    "estimated_passengers int, source string, created_at timestamp",
    ["origin_iso3", "destination_iso3", "date"],
    ["flight_count", "estimated_passengers"],
    {"source": "OPENSKY", "created_at": NOW},
    ["date"],
)

WHO = Table(
    "who_gho_indicators",
    "iso3 string, indicator_code string, indicator_name string, year int, "
    "numeric_value double, low_value double, high_value double, sex string, "
    "age_group string, source string, created_at timestamp",
    ["iso3", "indicator_code", "year", "sex", "age_group"],
    ["numeric_value", "low_value", "high_value", "indicator_name"],
    {"source": "WHO_GHO", "created_at": NOW},
    ["year"],
)

WORLDBANK = Table(
    "worldbank_health_indicators",
    "iso3 string, indicator_code string, indicator_name string, year int, "
    "value double, source string, created_at timestamp",
    ["iso3", "indicator_code", "year"],
    ["value", "indicator_name"],
    {"source": "WORLDBANK", "created_at": NOW},
    ["year"],
)

COVID = Table(
    "owid_covid_timeseries",
    "iso3 string, date date, "
    + ", ".join(f"{m} double" for m in COVID_METRICS)
    + ", source string, created_at timestamp",
    ["iso3", "date"],
    list(COVID_METRICS),
    {"source": "OWID", "created_at": NOW},
)

COVID_LATEST = Table(
    "owid_covid_country_latest",
    "iso3 string, last_date date, total_cases double, total_deaths double, "
    "total_vaccinations double, people_fully_vaccinated double, "
    "last_reproduction_rate double, last_stringency_index double, "
    "source string, updated_at timestamp",
    ["iso3"],
    [
        "last_date", "total_cases", "total_deaths", "total_vaccinations",
        "people_fully_vaccinated", "last_reproduction_rate",
        "last_stringency_index", "updated_at",
    ],
    {"source": "OWID"},
)

FERTILITY = Table(
    "asfr_5yr",
    "iso3 string, year int, variant_short_name string, age_min int, age_max int, "
    "asfr double, source string, release string, created_at timestamp",
    ["iso3", "year", "variant_short_name", "age_min", "age_max", "source", "release"],
    ["asfr"],
    {"created_at": NOW},
    ["year"],
)

AGE_PYRAMID = Table(
    "age_pyramid_5yr",
    "iso3 string, year int, age_bin string, pop double, created_at timestamp",
    ["iso3", "year", "age_bin"],
    ["pop"],
    {"created_at": NOW},
    ["year"],
)

RASTERS = Table(
    "raster_objects",
    "id bigint, stage string, filename string, run_id string, sha256 string, "
    "size_bytes bigint, content_type string, lo_oid bigint, created_at timestamp, "
    "exact_total double",
    ["stage", "filename", "sha256"],
    ["exact_total"],
    {"created_at": NOW},
    ["stage"],
)

RUNS = Table(
    "seirs_runs",
    "id string, iso3 string, year int, params variant, created_at timestamp",
    ["id"],
    ["iso3", "year", "params"],
    {"created_at": NOW},
)

POINTS = Table(
    "seirs_series_points",
    "run_id string, t double, population double, infected double",
    ["run_id", "t"],
    ["population", "infected"],
)

TABLES = {
    t.name: t
    for t in (
        AIRPORTS, AIRCRAFT, FLIGHTS, WHO, WORLDBANK, COVID, COVID_LATEST,
        FERTILITY, AGE_PYRAMID, RASTERS, RUNS, POINTS,
    )
}
