import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from vitalgrid.operators import pick
from vitalgrid.plans import indicators
from vitalgrid.sources import payloads

PAGES = "iso3 string, indicator_code string, page int, status int, body string"


def pages(spark, data):
    return spark.createDataFrame([(*r[:4], r[4] if isinstance(r[4], (str, type(None))) else json.dumps(r[4])) for r in data], PAGES)


def test_who_rows(spark):
    code = "WHOSIS_000001"
    recs = [
        {"TimeDim": 2015, "NumericValue": 0, "Value": None},
        {"TimeDim": 2016, "NumericValue": 0, "Value": "0"},
        {"TimeDim": 2017, "NumericValue": 0, "Value": 0},
        {"TimeDim": 2018, "NumericValue": None, "Value": "70 [60-80]"},
        {"TimeDim": "2019", "NumericValue": 71.5, "Low": "70", "High": "x", "Dim1": " fmle ", "Dim2": " Y15 "},
        {"TimeDim": "2019.0", "NumericValue": 1},
        {"TimeDim": 2020.7, "NumericValue": 2, "Dim1": "", "Dim1Type": "Sex"},
        {"TimeDim": 0, "TimeDimensionValue": "2021", "NumericValue": "3"},
        {"TimeDim": 1999, "NumericValue": 4},
        {"NumericValue": 4},
    ]
    df = pages(
        spark,
        [
            (" fra ", code, 1, 200, {"value": recs, "@odata.nextLink": "x"}),
            ("FRA", code, 2, 200, {"value": [{"TimeDim": 2016, "NumericValue": 9.5}]}),
            ("DEU", code, 1, 200, {"value": [{"TimeDim": 2015, "NumericValue": 1}]}),
            ("DEU", code, 2, 404, None),
            ("ITA", code, 1, 200, {}),
            ("ITA", "OTHER", 1, 200, {"value": [{"TimeDim": 2015, "NumericValue": 1}]}),
        ],
    )
    got = rows(indicators.who_rows(df), "iso3", "year", "numeric_value", "low_value", "high_value", "sex", "age_group", "indicator_name")
    name = "Life expectancy at birth"
    assert got == sorted(
        [
            ("FRA", 2016, 0.0, None, None, "BTSX", "TOTAL", name),
            ("FRA", 2016, 9.5, None, None, "BTSX", "TOTAL", name),
            ("FRA", 2017, 0.0, None, None, "BTSX", "TOTAL", name),
            ("FRA", 2019, 71.5, 70.0, None, "FMLE", "Y15", name),
            ("FRA", 2020, 2.0, None, None, "SEX", "TOTAL", name),
            ("FRA", 2021, 3.0, None, None, "BTSX", "TOTAL", name),
        ],
        key=str,
    )
    last = pick.last_write_wins(indicators.who_rows(df), ["iso3", "indicator_code", "year", "sex", "age_group"], indicators.ORDER)
    assert [r[0] for r in last.where("year = 2016").select("numeric_value").collect()] == [9.5]


def test_worldbank_rows(spark):
    code = "SP.POP.TOTL"

    def page(n, *recs):
        return [{"pages": n}, list(recs)]

    def rec(date, value):
        return {"date": date, "value": value}

    df = pages(
        spark,
        [
            ("FRA", code, 1, 200, page(3, rec("2015", 0), rec("2016", None), rec("2017.0", 1), "junk", rec(2018, "5"))),
            ("FRA", code, 2, 200, page("3", rec("2019", 6))),
            ("FRA", code, 3, 200, page(3, rec("2020", 7))),
            ("FRA", code, 4, 200, page(3, rec("2021", 8))),
            ("DEU", code, 1, 200, [{"message": [{"id": "120"}]}]),
            ("ITA", code, 1, 200, page(9, rec("2015", 1))),
            ("ITA", code, 2, 200, [{"pages": 9}, None]),
            ("ITA", code, 3, 200, page(9, rec("2016", 1))),
            ("ESP", code, 1, 200, page(2, rec("2015", 1))),
            ("ESP", code, 2, 404, "not json"),
            ("PRT", code, 1, 200, [{}, [rec("2015", 3)]]),
            ("PRT", code, 2, 200, page(9, rec("2016", 4))),
        ],
    )
    got = rows(indicators.worldbank_rows(df), "iso3", "year", "value")
    assert got == [
        ("FRA", 2015, 0.0), ("FRA", 2018, 5.0), ("FRA", 2019, 6.0), ("FRA", 2020, 7.0),
        ("ITA", 2015, 1.0), ("PRT", 2015, 3.0),
    ]


def test_who_chains(spark):
    code = "WHOSIS_000001"

    def page(year, more=False):
        return {"value": [{"TimeDim": year, "NumericValue": 1}], **({"@odata.nextLink": "x"} if more else {})}

    data = {
        "WHOLE": [(1, 200, page(2001, True)), (2, 200, page(2002))],
        "GAP": [(1, 200, page(2001, True)), (3, 200, page(2003))],
        "OPEN": [(1, 200, page(2001, True))],
        "LATE": [(2, 200, page(2002))],
        "FAILED": [(1, 200, page(2001, True)), (2, 503, None), (3, 200, page(2003))],
        "AGAIN": [(1, 200, page(2001, True)), (2, 503, None), (2, 200, page(2002)), (2, None, None)],
        "CUT": [(1, 200, page(2001, True)), (2, 200, '{"value":[{"TimeDim":2002,')],
        "GONE": [(1, 200, page(2001, True)), (2, 503, None), (3, 404, None)],
        "BEYOND": [(1, 200, page(2001)), (2, 500, None)],
        "NOBODY": [(1, 200, None)],
        "NOPAGE": [(None, 200, page(2001))],
        "LIST": [(1, 200, [1, 2])],
    }
    df = pages(spark, [(iso, code, *p) for iso, ps in data.items() for p in ps]).repartition(3)
    status = {r.iso3: (r.state, r.at_page, r.pages, r.records) for r in indicators.who_outcomes(df).collect()}
    assert status == {
        "WHOLE": ("complete", 2, 2, 2), "GAP": ("gap", 2, 2, 0), "OPEN": ("open", 2, 1, 0), "LATE": ("gap", 1, 1, 0),
        "FAILED": ("failed", 2, 3, 0), "AGAIN": ("complete", 2, 4, 2), "CUT": ("malformed", 2, 2, 0), "GONE": ("gone", 2, 3, 0),
        "BEYOND": ("complete", 1, 2, 1), "NOBODY": ("malformed", 1, 1, 0), "NOPAGE": ("open", 1, 1, 0), "LIST": ("complete", 1, 1, 0),
    }
    assert rows(indicators.who_rows(df), "iso3", "year") == [("AGAIN", 2001), ("AGAIN", 2002), ("BEYOND", 2001), ("WHOLE", 2001), ("WHOLE", 2002)]
    with pytest.raises(Exception, match="request (GAP|OPEN|LATE|FAILED|CUT|NOBODY|NOPAGE)/WHOSIS_000001 is"):
        indicators.who_rows(df, strict=True).collect()
    good = df.where(F.col("iso3").isin("WHOLE", "AGAIN", "GONE"))
    assert indicators.who_rows(good, strict=True).count() == 4
    assert indicators.who_outcomes(df.limit(0)).count() == 0
    kept, bad, _ = payloads.split(payloads.odata_chain(df, indicators.REQUEST), indicators.REQUEST)
    assert kept.count() == 5 and rows(bad, "iso3", "state") == [(k, v[0]) for k, v in sorted(status.items()) if v[0] not in ("complete", "gone")]


def test_worldbank_chains(spark):
    code = "SP.POP.TOTL"

    def page(n, year):
        return [{"pages": n}, [{"date": str(year), "value": 1}]]

    data = {
        "WHOLE": [(1, 200, page(2, 2001)), (2, 200, page(2, 2002))],
        "GAP": [(1, 200, page(3, 2001)), (3, 200, page(3, 2003))],
        "OPEN": [(1, 200, page(3, 2001)), (2, 200, page(3, 2002))],
        "FAILED": [(1, 500, None)],
        "CUT": [(1, 200, page(3, 2001)), (2, 200, "<html>"), (3, 200, page(3, 2003))],
        "SHORT": [(1, 200, page(9, 2001)), (2, 200, [{"pages": 9}, None]), (5, 500, None)],
        "GONE": [(1, 200, page(9, 2001)), (2, 404, "not json")],
        "TWICE": [(1, 200, page(9, 2001)), (1, 200, page(1, 2002)), (1, 404, None)],
    }
    df = pages(spark, [(iso, code, *p) for iso, ps in data.items() for p in ps]).repartition(3)
    status = {r.iso3: (r.state, r.at_page, r.pages, r.records) for r in indicators.worldbank_outcomes(df).collect()}
    assert status == {
        "WHOLE": ("complete", 2, 2, 2), "GAP": ("gap", 2, 2, 0), "OPEN": ("open", 3, 2, 0), "FAILED": ("failed", 1, 1, 0),
        "CUT": ("malformed", 2, 3, 0), "SHORT": ("complete", 2, 3, 1), "GONE": ("gone", 2, 2, 0), "TWICE": ("complete", 1, 3, 2),
    }
    assert rows(indicators.worldbank_rows(df), "iso3", "year") == [("SHORT", 2001), ("TWICE", 2001), ("TWICE", 2002), ("WHOLE", 2001), ("WHOLE", 2002)]


def test_one_scan_and_one_parse(spark, tmp_path):
    path = str(tmp_path / "landed")
    pages(spark, [("FRA", "SP.POP.TOTL", 1, 200, "[]")]).write.parquet(path)
    for plan_of in (indicators.who_rows, indicators.worldbank_rows, indicators.worldbank_outcomes):
        plan = plan_of(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == plan.count("parseJson(") == plan.count("Exchange hashpartitioning") == 1


def test_envelopes(spark):
    df = spark.createDataFrame(
        [
            (1, 1, 200, '[{"a":1}]'),
            (2, 1, 200, '{"data":{"a":1},"items":[{"a":2},{"a":3}]}'),
            (3, 1, 200, '{"records":[],"result":[{"a":9}]}'),
        ],
        "k int, page int, status int, body string",
    )
    got = rows(payloads.envelope_records(df, ["k"]).select("k", "_pos", F.variant_get("rec", "$.a", "int")))
    assert got == [(1, 0, 1), (2, 0, 2), (2, 1, 3)]
    bad = spark.createDataFrame([(1, 1, 200, '{"other":[]}')], df.schema)
    with pytest.raises(Exception, match="no record list"):
        payloads.envelope_records(bad, ["k"]).collect()
    mixed = df.unionByName(bad).unionByName(spark.createDataFrame([(5, 1, 500, None), (6, 1, 200, "{")], df.schema))
    chain = payloads.envelope_chain(mixed, ["k"])
    assert payloads.accepted(chain, ["k"]).count() == 3
    assert rows(payloads.rejected(chain, ["k"]), "k", "state") == [(1, "malformed"), (5, "failed"), (6, "malformed")]


def test_malformed_answers_are_set_aside(spark):
    day = 19000 * 86400
    log = spark.createDataFrame(
        [("A", day, day + 86400, 1, 200, "[{"), ("B", day, day + 86400, 1, 200, '{"a":1}'), ("B", day, day + 86400, 2, 200, '[{"icao24":"x"}]'),
         ("C", day, day + 86400, 1, 200, None), ("D", day, day + 86400, 1, 404, "<"), ("E", day, day + 86400, 1, None, None)],
        "airport string, begin bigint, end bigint, attempt int, status int, body string",
    )
    good, bad = payloads.quarantined(log)
    assert rows(payloads.fetch_outcomes(good), "airport", "unreachable") == [("B", False), ("C", False), ("D", False), ("E", True)]
    assert rows(payloads.arrivals(good), "airport", "icao24") == [("B", "x")]
    assert rows(bad, "airport", "attempt", "state") == [("A", 1, "malformed"), ("B", 1, "malformed")]


def test_arrivals_and_outcomes(spark):
    flight = '[{"estDepartureAirport":"EDDF","icao24":"x","callsign":"c"}]'
    day = 19000 * 86400
    log = spark.createDataFrame(
        [
            (" lfpg", day, day + 86400, 1, 429, None),
            (" lfpg", day, day + 86400, 2, 200, flight),
            (" lfpg", day, day + 86400, 3, 200, flight),
            ("LFPO", day, day + 86400, 1, 404, None),
            ("LFML", day, day + 86400, 1, 200, " null "),
            *[("LFBO", day, day + 86400, n, 503, None) for n in range(1, 5)],
            ("LFBO", day, day + 86400, 5, 200, flight),
        ],
        "airport string, begin bigint, end bigint, attempt int, status int, body string",
    )
    assert rows(payloads.fetch_outcomes(log), "airport", "answered_at", "unreachable") == [
        ("LFBO", 5, False), ("LFML", 1, False), ("LFPG", 2, False), ("LFPO", 1, False),
    ]
    got = payloads.arrivals(log).select("airport", F.col("date").cast("string"), "estDepartureAirport")
    assert rows(got) == [("LFBO", "2022-01-08", "EDDF"), ("LFPG", "2022-01-08", "EDDF")]
