"""Passenger estimate and the day window of an arrivals request."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitalgrid.refdata import LOAD_FACTOR


def passengers(seats: Column, load_factor: float = LOAD_FACTOR) -> Column:
    """Seats times load factor, cut to a whole number for every flight.

    The product is taken in double: 150 seats give 122, where a decimal product
    would give 123.
    """
    return (seats.cast("double") * F.lit(float(load_factor))).cast("int")


def day_window(now: Column) -> Column:
    """Struct begin, end (epoch seconds) and date of the whole UTC day before the time ``now``."""
    today = F.unix_date(F.to_date(now))
    return F.struct(
        ((today - 1) * 86400).cast("bigint").alias("begin"),
        (today * 86400).cast("bigint").alias("end"),
        F.date_from_unix_date(today - 1).alias("date"),
    )


def window_date(begin: Column) -> Column:
    """The day an arrivals request asks for, from its begin in epoch seconds."""
    return F.date_from_unix_date((begin / 86400).cast("int"))
