import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from vitalgrid import refdata
from vitalgrid.functions import clean, files, flights


def one(spark, column_of, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r[0] for r in df.orderBy("i").select(column_of(F.col("c"))).collect()]


def python_float(v):
    try:
        return float(v)
    except (TypeError, ValueError):
        return None


def python_int(v):
    try:
        return int(v)
    except (TypeError, ValueError):
        return None


TEXTS = [
    None, "", " ", "1", " 1.5 ", "\t-2e3\n", "+.5", "5.", ".", "1d", "1f", "0x10", "1_000", "1__0", "_1", "1_",
    "1_0.2_5e1_0", "inf", "-Infinity", "nan", "+NaN", "infin", "1,000", " 3 ", "　7", "1 2", "e5", "1e",
]


def test_double_follows_python_float(spark):
    got = one(spark, clean.double_or_null, TEXTS)
    for text, value in zip(TEXTS, got):
        want = python_float(text)
        if want is not None and math.isnan(want):
            assert value is not None and math.isnan(value), text
        else:
            assert value == want, text


def test_int_follows_python_int(spark):
    texts = [None, "", "2015", " 2015 ", "2015.0", "-3", "+4", "1_0", "x", "20 15", " 2020"]
    assert one(spark, clean.int_or_null, texts) == [python_int(t) for t in texts]


def test_date_needs_ten_characters_and_a_real_day(spark):
    texts = ["2020-01-31", " 2020-02-29 ", "2020-1-1", "2020-13-01", "2021-02-29", "20200101", "2020-01-01T00", None, "2020/01/01"]
    d = dt.date
    assert one(spark, clean.date_or_null, texts) == [d(2020, 1, 31), d(2020, 2, 29)] + [None] * 7


def test_strip_matches_python(spark):
    texts = [" a ", " b ", "é", " é\t", "", "\n\t", "a b", "\u0085x", "x　 "]
    assert one(spark, clean.strip, texts) == [t.strip() for t in texts]


def test_code_and_labels(spark):
    assert one(spark, clean.code, [None, " fra ", "De\t"]) == ["", "FRA", "DE"]
    assert one(spark, lambda c: clean.label_or(c, "BTSX"), [None, "", "  ", " x "]) == ["BTSX", "BTSX", "", "x"]
    assert one(spark, clean.blank_to_null, ["", "a"]) == [None, "a"]


def test_fallbacks_treat_zero_differently(spark):
    df = spark.createDataFrame([(0.0, 2.0), (None, 3.0), (1.0, 4.0), (0.0, None)], "a double, b double")
    assert [r[0] for r in df.select(clean.number_or("a", "b")).collect()] == [2.0, 3.0, 1.0, None]
    assert [r[0] for r in df.select(F.coalesce("a", "b")).collect()] == [0.0, 3.0, 1.0, 0.0]


def test_allow_list():
    assert clean.allow_list(" fra, ,deu") == ["FRA", "DEU"]
    assert clean.allow_list(None, " usa ") == ["USA"]
    assert clean.allow_list("", None) == []


def test_any_present_counts_zero(spark):
    df = spark.createDataFrame([(None, 0.0), (None, None)], "a double, b double")
    assert [r[0] for r in df.select(clean.any_present(["a", "b"])).collect()] == [True, False]


@pytest.mark.parametrize("seats,want", [(120, 98), (150, 122), (300, 245), (50, 41)])
def test_passengers_truncate_in_double(spark, seats, want):
    assert int(seats * 0.82) == want
    assert spark.range(1).select(flights.passengers(F.lit(seats))).first()[0] == want


def test_day_window(spark):
    now = dt.datetime(2024, 3, 1, 5, 30, tzinfo=dt.timezone(dt.timedelta(hours=9)))
    begin, end, day = spark.range(1).select(flights.day_window(F.lit(now)).alias("w")).select("w.*").first()
    assert day == dt.date(2024, 2, 28) and end - begin == 86400
    assert begin == int(dt.datetime(2024, 2, 28, tzinfo=dt.timezone.utc).timestamp())


def test_human_bytes_and_percent(spark):
    df = spark.createDataFrame([(0,), (1023,), (1280,), (1536,), (5 * 1024**2,), (3 * 1024**4,)], "n bigint")
    got = [r[0] for r in df.select(files.human_bytes(F.col("n"))).collect()]
    assert got == ["0 B", "1023 B", "1.2 KiB", "1.5 KiB", "5.0 MiB", "3072.0 GiB"]
    df = spark.createDataFrame([(0, 0), (100, 60)], "b bigint, a bigint")
    assert [round(r[0], 6) for r in df.select(files.percent_saved(F.col("b"), F.col("a"))).collect()] == [0.0, 40.0]


def test_reference_tables(spark):
    assert len(refdata.INDICATOR_COUNTRIES) == 185 and len(set(refdata.INDICATOR_COUNTRIES)) == 185
    assert len(refdata.ISO2_TO_ISO3) == 188
    assert len(refdata.AIRCRAFT_SEATS) == 58
    assert len(refdata.COVID_METRICS) == 22
    assert (len(refdata.WHO_INDICATORS), len(refdata.WORLDBANK_INDICATORS)) == (10, 16)
    everyone = refdata.raster_countries()
    assert len(everyone) == 243 and {"ABW", "UMI", "ZWE"} <= set(everyone) and "ATA" not in everyone
    missing = set(refdata.INDICATOR_COUNTRIES) - set(refdata.ISO2_TO_ISO3.values())
    assert missing == {"ALA", "AND", "LCA", "STP", "SYC", "VCT", "WSM"}
