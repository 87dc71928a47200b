"""Age bins: parsing and the fertile window."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitalgrid.functions import clean, fields
from vitalgrid.refdata import (
    AGE_END_NAMES,
    AGE_LABEL_NAMES,
    AGE_START_NAMES,
    FERTILE_AGES,
)


def bin_from_label(label: Column) -> Column:
    """struct(age_min, age_max) of a label such as 40-44 (hyphen or en dash), NULL where it is not a range."""
    # Lambdas hold what is used several times, so that nothing is computed twice.
    numbers = F.transform(F.split(F.translate(label, "–", "-"), "-"), lambda part: F.when(~part.contains("+"), part.try_cast("int")))

    def ends(n: Column) -> Column:
        low, high = F.get(n, F.lit(0)), F.get(n, F.lit(1))
        return F.when((F.size(n) == 2) & low.isNotNull() & high.isNotNull(), F.struct(low.alias("age_min"), high.alias("age_max")))

    return F.get(F.transform(F.array(numbers), ends), F.lit(0))


def parse_bin(has_start: Column, start: Column, has_end: Column, end: Column, label: Column) -> Column:
    """struct(age_min, age_max) of a record.

    Without a start the label decides. With a start but no end the bin is one
    year wide and the label is ignored. An unreadable number gives no bin.
    """
    last = F.when(has_end, end).otherwise(start)
    numbers = F.when(
        start.isNotNull() & last.isNotNull(),
        F.struct(start.alias("age_min"), last.alias("age_max")),
    )
    return F.when(has_start, numbers).otherwise(bin_from_label(label))


# Fields of a record that hold its age bin, for ``fields.unpack``.
BIN_FIELDS = {"start": AGE_START_NAMES, "end": AGE_END_NAMES, "label": AGE_LABEL_NAMES}


def record_bin(f: dict[str, fields.Field]) -> Column:
    """``parse_bin`` on unpacked ``BIN_FIELDS``, their whole numbers in ``start`` and ``end``.

    A label that is not a string cannot look like a range.
    """
    return parse_bin(f["start"].present(), F.col("start"), f["end"].present(), F.col("end"), f["label"].text())


def fertile(age_min: Column, age_max: Column) -> Column:
    low, high = FERTILE_AGES
    return (age_min >= low) & (age_max <= high)


def bin_order(age_bin: Column) -> Column:
    """Position of a bin, for output in bin order."""
    return clean.int_or_null(F.regexp_extract(age_bin, r"^([0-9]+)", 1))
