import json

from pyspark.sql import functions as F

from conftest import rows
from vitalgrid import refdata
from vitalgrid.functions import ages
from vitalgrid.operators import agebands, fertility
from vitalgrid.plans import demography
from vitalgrid.sources import payloads


def rec(sex=2, variant="Median", start=20, end=24, value=1.0, **more):
    out = {"sexId": sex, "variantShortName": variant, "ageStart": start, "ageEnd": end, "value": value, **more}
    return {k: v for k, v in out.items() if v is not None}


def pages(spark, slices):
    data = [(iso3, year, 1, 200, json.dumps(body)) for (iso3, year), body in slices.items()]
    return spark.createDataFrame(data, "iso3 string, year int, page int, status int, body string")


def full(**kw):
    return [rec(variant=v, **kw) for v in ("Lower80", " median ", "HIGH")]


def test_choice_and_bins(spark):
    slices = {
        # LOWER80 and HIGH stand in for their buckets
        ("A", 1): {"data": full() + [rec(variant="Lower95", sex=3)]},
        # sex 3 only
        ("B", 1): full(sex=3),
        # sex 2 is there but lacks a bucket: sex 3 is not tried
        ("C", 1): full(sex=3) + [rec(variant="Median", sex=2)],
        # no usable sex
        ("D", 1): full(sex=1),
        # the best variant has junk bins only: its bucket is empty, the others stay
        ("E", 1): {"items": full() + [rec(variant="LOWER95", start="x")]},
        # blank variant, missing sex, junk sex
        ("F", 1): full() + [rec(variant=" ", sex=2), rec(sex=None), rec(sex="both"), "text", 7],
        ("G", 1): [],
    }
    got = rows(demography.fertility_rows(pages(spark, slices)), "iso3", "variant_short_name", "age_min", "asfr")
    three = ["LOWER95", "MEDIAN", "UPPER95"]
    want = [(s, v, 20, 1.0) for s in "ABF" for v in three] + [("E", "MEDIAN", 20, 1.0), ("E", "UPPER95", 20, 1.0)]
    assert got == sorted(want)


def test_bin_parsing_and_window(spark):
    def m(**kw):
        return rec(variant="MEDIAN", **kw)

    body = [
        rec(variant="LOW"), rec(variant="UPPER95"),
        m(start=None, end=None, ageLabel="40–44", value=1),
        m(start=None, end=99, AgeLabel=" 45 - 49 ", value=2),
        m(start=None, end=None, ageLabel="15+", value=3),
        m(start=30, end=None, ageLabel="35-39", value=4),
        m(start=None, AgeStart="25", end=29.9, value=None, Val="5.5"),
        m(start=10, end=14, value=6), m(start=50, end=54, value=7), m(start=15, end=50, value=8),
        m(start="2.5", end=9, value=9), m(start=20, end="x", value=10), m(start=20, end=24, value="junk"),
        m(start=35, end=39, value=11), m(start=35, end=39, value=12),
        m(start=0, age_start=16, end=20, value=13),
    ]
    got = rows(demography.fertility_rows(pages(spark, {("A", 1): body})).where("variant_short_name = 'MEDIAN'"), "age_min", "age_max", "asfr")
    assert got == [(25, 29, 5.5), (30, 30, 4.0), (35, 39, 12.0), (40, 44, 1.0), (45, 49, 2.0)]


def test_bin_summary(spark):
    body = [rec(start=a, end=a) for a in range(15, 50)] + [rec(start=60, end=64, variant="x")]
    records = payloads.envelope_records(pages(spark, {("A", 1): body}), ["iso3", "year"])
    got = {r.variant: r for r in fertility.bin_summary(fertility.groupable(records)).collect()}
    assert got["MEDIAN"].n_bins == 35
    assert got["MEDIAN"].head.startswith("15-15,16-16") and got["MEDIAN"].tail.endswith("49-49")
    assert (got["X"].n_bins, got["X"].head) == (0, "")


def test_rebin(spark):
    codes = refdata.RASTER_AGE_CODES
    assert len(codes) == 20 and codes[:3] == ["00", "01", "05"] and codes[-2:] == ["85", "90"]
    data = [("A", c, float(2**i)) for i, c in enumerate(codes)] + [("B", c, 1.0) for c in codes if c not in ("85", "10")]
    df = spark.createDataFrame(data, "iso3 string, age_code string, total double")
    got = {(r.iso3, r.age_bin): r.pop for r in agebands.rebin(df, ["iso3"]).collect()}
    assert len(got) == 34
    assert got["A", "0-4"] == 3.0 and got["A", "5-9"] == 4.0 and got["A", "80+"] == float(2**17 + 2**18 + 2**19)
    assert sum(v for (k, _), v in got.items() if k == "A") == float(2**20 - 1)
    assert got["B", "10-14"] == 0.0 and got["B", "80+"] == 2.0
    order = [r.age_bin for r in agebands.rebin(df, ["iso3"]).where("iso3 = 'A'").orderBy(ages.bin_order(F.col("age_bin"))).collect()]
    assert order == list(refdata.AGE_BINS)
