import random

import pytest

from conftest import rows
from vitalgrid.operators import mobility
from vitalgrid.plans import flights

DAY = 19000 * 86400


def test_airports(spark):
    raw = spark.createDataFrame(
        [
            ("large_airport", " lfpg ", "fr", " cdg ", "Paris ", "49.0", "2.5", 0),
            ("large_airport", "LFPG", "FR", "", "Paris CDG", "junk", "2.5", 1),
            ("heliport", "LFPH", "FR", "", "Heli", "1", "1", 2),
            ("medium_airport", "LFP", "FR", "", "short", "1", "1", 3),
            ("medium_airport", "LFPXX", "FR", "", "long", "1", "1", 4),
            ("medium_airport", "XXXX", "QQ", "", "unknown", "1", "1", 5),
        ],
        "type string, ident string, iso_country string, iata_code string, name string, latitude_deg string, longitude_deg string, o int",
    )
    assert rows(flights.airport_rows(raw, ["o"])) == [
        ("LFPG", None, "Paris CDG", "FRA", None, 2.5, "large_airport")
    ]


def test_seats_default(spark):
    f = spark.createDataFrame([("A320",), ("ZZZZ",), (None,)], "t string")
    seats = flights.aircraft_rows(spark)
    assert rows(mobility.with_seats(f, seats, "t"), "t", "seats") == [("A320", 180), ("ZZZZ", 120), (None, 120)]


def world(spark, down):
    """Ten airports in AAA, ``down`` of them unreachable; two in BBB; CCC has none."""
    airports = spark.createDataFrame(
        [(f"AA{i:02d}", "AAA") for i in range(10)] + [("BB00", "BBB"), ("BB01", "BBB")], "icao_code string, iso3 string"
    )
    arrivals = '[{"estDepartureAirport":" bb00 "},{"estDepartureAirport":null},{"estDepartureAirport":"AA01"},{"estDepartureAirport":"QQQQ"}]'
    log = [(f"AA{i:02d}", DAY, DAY + 86400, 1, 503 if i < down else 200, None if i < down else arrivals) for i in range(10)]
    log += [("BB00", DAY, DAY + 86400, 1, 404, None), ("BB01", DAY, DAY + 86400, 1, 200, '[{"estDepartureAirport":"AA00"}]')]
    return airports, spark.createDataFrame(log, "airport string, begin bigint, end bigint, attempt int, status int, body string")


@pytest.mark.parametrize("down,status,written", [(0, "ok", True), (2, "warn", True), (3, "fail", False)])
def test_coverage_gate(spark, down, status, written):
    airports, log = world(spark, down)
    volumes, cover = flights.volume_rows(log, airports)
    assert dict(rows(cover, "iso3", "status")) == {"AAA": status, "BBB": "ok"}
    got = {(r.origin_iso3, r.destination_iso3): (r.flight_count, r.estimated_passengers) for r in volumes.collect()}
    assert got.pop(("AAA", "BBB")) == (1, 98)
    assert got == ({("BBB", "AAA"): (10 - down, 98 * (10 - down))} if written else {})
    if not written:
        with pytest.raises(RuntimeError, match="3/10 airports unreachable for AAA"):
            mobility.require_coverage(cover)


def test_an_airport_never_asked_counts_as_unreachable(spark):
    airports, log = world(spark, 0)
    cover = flights.volume_rows(log.where("airport <> 'AA09'"), airports)[1]
    assert rows(cover.where("iso3 = 'AAA'"), "airports", "unreachable", "listed") == [(10, 1, "AA09")]


def test_coverage_against_brute_force(spark):
    rnd = random.Random(3)
    airports = [(f"{c}{i:03}", c) for c, n in (("A", 40), ("B", 11), ("C", 1), ("D", 12), ("E", 300)) for i in rnd.sample(range(999), n)]
    asked = {}
    for code, c in airports:
        for day in range(6):
            if rnd.random() < (0.97, 0.5, 0.1, 0.02, 1.0, 0.9)[day] and not (c == "D" and day == 2):
                asked[code, day] = rnd.random() < (0.1, 0.5, 0.0, 1.0, 1.0, 0.02)[day]
    log = [(code, str(day), down) for (code, day), down in asked.items()] * 2 + [("Q1", "1", True)]
    rnd.shuffle(log)
    got = mobility.coverage(
        spark.createDataFrame(log, "airport string, date string, unreachable boolean").repartition(3),
        spark.createDataFrame(airports + airports[:5], "icao_code string, iso3 string"),
    )
    expected = []
    for c in "ABCDE":
        own = sorted(code for code, of in airports if of == c)
        for day in range(6):
            if any((code, day) in asked for code in own):
                down = [code for code in own if asked.get((code, day), True)]
                share = len(down) / len(own)
                listed = ", ".join(down[:10]) + (" ..." if len(down) > 10 else "") if down else None
                expected.append((c, str(day), len(own), len(down), share, "fail" if share > 0.2 else "warn" if down else "ok", listed))
    assert rows(got) == sorted(expected, key=lambda r: r[:2])
    assert mobility.coverage(got.selectExpr("iso3 airport", "date", "true unreachable").limit(0), spark.createDataFrame(airports, "icao_code string, iso3 string")).count() == 0


def test_importation(spark):
    volumes = spark.createDataFrame([("A", "C", "d", 10), ("B", "C", "d", 5), ("X", "C", "d", 7)], "origin_iso3 string, destination_iso3 string, date string, estimated_passengers int")
    states = spark.createDataFrame([("A", 2.0, 100), ("B", 1.0, 10)], "iso3 string, prevalence double, population bigint")
    got = rows(mobility.importation(volumes, states))
    assert got[0][:2] == ("C", "d") and abs(got[0][2] - (10 * 0.02 + 5 * 0.1)) < 1e-12


def test_day_totals(spark):
    volumes = spark.createDataFrame([("A", "C", "d", 2, 10), ("B", "C", "d", 1, 5)], "origin_iso3 string, destination_iso3 string, date string, flight_count int, estimated_passengers int")
    assert rows(mobility.day_totals(volumes)) == [("C", "d", 2, 3, 15)]
