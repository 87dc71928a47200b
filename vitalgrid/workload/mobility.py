"""Flights: deliveries as flights, customers and suppliers as airports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.functions.flights import passengers
from vitalgrid.operators import mobility
from vitalgrid.plans import flights as plan
from vitalgrid.sources import payloads
from vitalgrid.sources.tables import lookup
from vitalgrid.workload import table


def _airports(spark: SparkSession, sf: str) -> DataFrame:
    """Customers and suppliers as airports, their nation as the country."""
    nation = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("iso3"))
    sites = (
        table(spark, sf, "customer").select(F.concat(F.lit("C"), "c_custkey").alias("icao_code"), F.col("c_nationkey").alias("n_nationkey"))
        .unionByName(
            table(spark, sf, "supplier").select(F.concat(F.lit("S"), "s_suppkey").alias("icao_code"), F.col("s_nationkey").alias("n_nationkey"))
        )
    )
    return lookup(sites.join(nation, "n_nationkey"), "icao_code", "iso3")


def _flights(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as arrivals: from the supplier, at the customer, on the order day.

    An order is the request; its destination is found before its lines join.
    """
    airports = _airports(spark, sf)
    requests = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.concat(F.lit("C"), "o_custkey").alias("queried_airport"),
        F.col("o_orderdate").cast("date").alias("date"),
    )
    asked = mobility.with_destination(requests, airports).drop("queried_airport")
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", F.concat(F.lit(" s"), "l_suppkey", F.lit(" ")).alias("estDepartureAirport")
    )
    return mobility.with_origin(lines.join(asked, "l_orderkey"), airports)


def _volumes(spark: SparkSession, sf: str) -> DataFrame:
    return mobility.pair_volumes(_flights(spark, sf))


def pair_volumes(spark: SparkSession, sf: str) -> DataFrame:
    return _volumes(spark, sf).withColumn("date", F.col("date").cast("string"))


def pair_day_totals(spark: SparkSession, sf: str) -> DataFrame:
    return mobility.day_totals(_volumes(spark, sf)).withColumn("date", F.col("date").cast("string"))


def importation(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("iso3"))
    states = (
        table(spark, sf, "customer").groupBy("c_nationkey")
        .agg(
            F.sum(F.round(F.col("c_acctbal") * 100).cast("bigint")).alias("prevalence"),
            F.count("*").alias("population"),
        )
        .join(nation, "c_nationkey")
    )
    return mobility.importation(_volumes(spark, sf), states).select(
        "destination_iso3",
        F.col("date").cast("string").alias("date"),
        F.round("beta_import", 2).alias("beta_import"),
    )


def seats_left_default(spark: SparkSession, sf: str) -> DataFrame:
    known = table(spark, sf, "part").where(F.col("p_type") != "PROMO").select(
        F.col("p_partkey").alias("icao_type_code"), (F.col("p_size") * 6).alias("typical_seats")
    )
    flown = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("type_code"), "l_returnflag", "l_linestatus")
    return (
        mobility.with_seats(flown, known, "type_code")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.count("*").alias("flights"),
            F.sum("seats").alias("seats"),
            F.sum(passengers(F.col("seats"))).alias("passengers"),
        )
    )


def _event_airports(spark: SparkSession, sf: str) -> DataFrame:
    users = table(spark, sf, "events").select("user_id").distinct()
    return users.select(
        F.concat(F.lit("U"), "user_id").alias("icao_code"),
        F.concat(F.lit("L"), F.floor(F.col("user_id") / 16).cast("string")).alias("iso3"),
    )


def _fetch_log(spark: SparkSession, sf: str) -> DataFrame:
    """Events as attempts at an arrivals request: one request per user and day,
    the quarter of the day is the attempt, the event type its outcome."""
    kind = F.col("event_type")
    k = F.get_json_object("props", "$.k")

    def flight(dep):
        return F.struct(
            dep.alias("estDepartureAirport"),
            F.col("event_id").cast("string").alias("icao24"),
            F.lit(" ab12 ").alias("callsign"),
        )

    one = F.array(flight(F.concat(F.lit("u"), k)))
    two = F.array(flight(F.concat(F.lit(" U"), k)), flight(F.lit("")), flight(F.col("user_id").cast("string")))
    body = (
        F.when(kind == "click", F.to_json(one))
        .when(kind == "purchase", F.to_json(two))
        .when(kind == "view", "null")
        .otherwise("")
    )
    status = F.when(kind == "error", 503).when(kind == "signup", 404).otherwise(200)
    return table(spark, sf, "events").select(
        F.concat(F.lit("U"), "user_id").alias("airport"),
        (F.unix_date(F.col("ts").cast("date")).cast("bigint") * 86400).alias("begin"),
        ((F.unix_date(F.col("ts").cast("date")).cast("bigint") + 1) * 86400).alias("end"),
        (F.floor(F.hour("ts") / 6) + 1).cast("int").alias("attempt"),
        status.alias("status"),
        body.alias("body"),
    )


def coverage_gate(spark: SparkSession, sf: str) -> DataFrame:
    outcomes = payloads.fetch_outcomes(_fetch_log(spark, sf))
    return mobility.coverage(outcomes, _event_airports(spark, sf)).select(
        "iso3", F.col("date").cast("string").alias("date"), "airports", "unreachable",
        F.round("share", 6).alias("share"), "status", "listed",
    )


def flight_log_volumes(spark: SparkSession, sf: str) -> DataFrame:
    volumes, _ = plan.volume_rows(_fetch_log(spark, sf), _event_airports(spark, sf), limit=0.93)
    return volumes.withColumn("date", F.col("date").cast("string"))


# Nations as two-letter codes; the last two stand for codes the table lacks.
CODES = [
    "AF", "AL", "DZ", "AO", "AR", "AM", "AU", "AT", "AZ", "BS", "BH", "BD", "BB",
    "BY", "BE", "BZ", "BJ", "BT", "BO", "BA", "BW", "BR", "BN", "XX", "",
]
CODES3 = [
    "AFG", "ALB", "DZA", "AGO", "ARG", "ARM", "AUS", "AUT", "AZE", "BHS", "BHR", "BGD", "BRB",
    "BLR", "BEL", "BLZ", "BEN", "BTN", "BOL", "BIH", "BWA", "BRA", "BRN",
]


def airports_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as lines of the airport file."""
    segment = F.col("c_mktsegment")
    kind = (
        F.when(segment == "BUILDING", "large_airport").when(segment == "MACHINERY", " medium_airport ")
        .when(segment == "HOUSEHOLD", "heliport").otherwise("medium_airport")
    )
    # Two customers a code, from the whole key; a code has four characters as long as the key allows.
    digits = F.conv(F.floor(F.col("c_custkey") / 2).cast("string"), 10, 36)
    code = F.when(F.length(digits) < 4, F.lpad(digits, 4, "0")).otherwise(digits)
    return table(spark, sf, "customer").select(
        kind.alias("type"),
        F.concat(F.lit(" "), F.lower(code), F.when(segment == "FURNITURE", "x").otherwise("")).alias("ident"),
        F.lower(F.get(F.array(*[F.lit(c) for c in CODES]), F.col("c_nationkey"))).alias("iso_country"),
        F.when(F.col("c_acctbal") > 0, F.concat(F.lit(" q"), F.col("c_nationkey"))).otherwise(" ").alias("iata_code"),
        F.concat(F.col("c_name"), F.lit(" ")).alias("name"),
        F.when(F.col("c_acctbal") > 1000, F.col("c_acctbal").cast("decimal(18,2)").cast("string")).otherwise("n/a").alias("latitude_deg"),
        F.lit("1_0.5").alias("longitude_deg"),
        "c_custkey",
    )


def airports_clean(spark: SparkSession, sf: str) -> DataFrame:
    return plan.airport_rows(airports_raw(spark, sf), ["c_custkey"])


QUERIES = {
    "pair_volumes": pair_volumes,
    "pair_day_totals": pair_day_totals,
    "importation": importation,
    "seats_left_default": seats_left_default,
    "coverage_gate": coverage_gate,
    "flight_log_volumes": flight_log_volumes,
    "airports_clean": airports_clean,
}

_VOLUMES = """
volumes AS (
  SELECT sn.n_name AS origin_iso3, cn.n_name AS destination_iso3,
         strftime(o_orderdate, '%Y-%m-%d') AS date,
         CAST(count(*) AS INTEGER) AS flight_count,
         CAST(sum(CAST(trunc(120::DOUBLE * 0.82::DOUBLE) AS INTEGER)) AS INTEGER) AS estimated_passengers
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey
  JOIN customer ON o_custkey = c_custkey JOIN nation cn ON c_nationkey = cn.n_nationkey
  WHERE sn.n_name <> cn.n_name
  GROUP BY ALL
)"""

_LOG = """
users AS (
  SELECT DISTINCT 'U' || user_id AS airport, 'L' || (user_id // 16) AS iso3 FROM events
),
log AS (
  SELECT event_id, user_id, 'U' || user_id AS airport, CAST(ts AS DATE) AS d,
         hour(ts) // 6 + 1 AS attempt, event_type,
         CASE event_type WHEN 'error' THEN 503 WHEN 'signup' THEN 404 ELSE 200 END AS status,
         json_extract_string(props, '$.k') AS k
  FROM events
),
outcomes AS (
  SELECT airport, d, min(attempt) FILTER (status IN (200, 404)) AS answered_at FROM log GROUP BY ALL
),
expected AS (
  SELECT u.airport, u.iso3, g.d, (o.answered_at IS NULL) AS unreachable
  FROM users u
  JOIN (SELECT DISTINCT u.iso3, o.d FROM outcomes o JOIN users u USING (airport)) g USING (iso3)
  LEFT JOIN outcomes o ON o.airport = u.airport AND o.d = g.d
),
cover AS (
  SELECT iso3, d, count(*) AS airports, count(*) FILTER (unreachable) AS unreachable FROM expected GROUP BY ALL
)"""

SQL = {
    "pair_volumes": f"WITH {_VOLUMES} SELECT * FROM volumes",
    "pair_day_totals": f"""
WITH {_VOLUMES}
SELECT destination_iso3, date, count(*) AS origins,
       CAST(sum(flight_count) AS BIGINT) AS flights,
       CAST(sum(estimated_passengers) AS BIGINT) AS passengers
FROM volumes GROUP BY ALL""",
    "importation": f"""
WITH {_VOLUMES},
states AS (
  SELECT n_name AS origin_iso3,
         CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS DOUBLE) / count(*) AS rate
  FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name
)
SELECT destination_iso3, date, round(sum(estimated_passengers * rate), 2) AS beta_import
FROM volumes JOIN states USING (origin_iso3) GROUP BY ALL""",
    "seats_left_default": """
SELECT l_returnflag, l_linestatus, count(*) AS flights,
       CAST(sum(seats) AS BIGINT) AS seats,
       CAST(sum(CAST(trunc(CAST(seats AS DOUBLE) * 0.82::DOUBLE) AS BIGINT)) AS BIGINT) AS passengers
FROM (
  SELECT l_returnflag, l_linestatus, coalesce(p_size * 6, 120) AS seats
  FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_type <> 'PROMO') p ON l_partkey = p_partkey
) GROUP BY ALL""",
    "coverage_gate": f"""
WITH {_LOG},
ranked AS (
  SELECT iso3, d, airport, row_number() OVER (PARTITION BY iso3, d ORDER BY airport) AS n
  FROM expected WHERE unreachable
),
listed AS (
  SELECT iso3, d,
         string_agg(airport, ', ' ORDER BY airport) FILTER (n <= 10)
           || CASE WHEN max(n) > 10 THEN ' ...' ELSE '' END AS listed
  FROM ranked GROUP BY ALL
)
SELECT c.iso3, strftime(c.d, '%Y-%m-%d') AS date, airports, unreachable,
       round(CAST(unreachable AS DOUBLE) / airports, 6) AS share,
       CASE WHEN CAST(unreachable AS DOUBLE) / airports > 0.2 THEN 'fail'
            WHEN unreachable > 0 THEN 'warn' ELSE 'ok' END AS status,
       listed
FROM cover c LEFT JOIN listed l ON c.iso3 = l.iso3 AND c.d = l.d""",
    "flight_log_volumes": f"""
WITH {_LOG},
answers AS (
  SELECT l.* FROM log l JOIN outcomes o ON l.airport = o.airport AND l.d = o.d AND l.attempt = o.answered_at
  WHERE status = 200
),
arrivals AS (
  SELECT airport, d, 'U' || k AS dep FROM answers WHERE event_type IN ('click', 'purchase')
)
SELECT o.iso3 AS origin_iso3, q.iso3 AS destination_iso3, strftime(a.d, '%Y-%m-%d') AS date,
       CAST(count(*) AS INTEGER) AS flight_count, CAST(count(*) * 98 AS INTEGER) AS estimated_passengers
FROM arrivals a JOIN users o ON o.airport = a.dep JOIN users q ON q.airport = a.airport
JOIN cover c ON c.iso3 = q.iso3 AND c.d = a.d
WHERE o.iso3 <> q.iso3 AND CAST(c.unreachable AS DOUBLE) / c.airports <= 0.93
GROUP BY ALL""",
    "airports_clean": f"""
WITH codes AS (
  SELECT unnest({CODES[:23]}) AS iso2, unnest({CODES3}) AS iso3
),
raw AS (
  SELECT c_custkey,
         trim(CASE c_mktsegment WHEN 'BUILDING' THEN 'large_airport' WHEN 'HOUSEHOLD' THEN 'heliport'
              ELSE 'medium_airport' END) AS type,
         to_base(c_custkey // 2, 36, 4) || CASE WHEN c_mktsegment = 'FURNITURE' THEN 'X' ELSE '' END AS icao_code,
         ({CODES})[c_nationkey + 1] AS iso2,
         CASE WHEN c_acctbal > 0 THEN 'Q' || c_nationkey END AS iata_code,
         c_name AS name,
         CASE WHEN c_acctbal > 1000 THEN c_acctbal END AS latitude,
         10.5::DOUBLE AS longitude
  FROM customer
),
kept AS (
  SELECT raw.*, iso3, row_number() OVER (PARTITION BY icao_code ORDER BY c_custkey DESC) AS rn
  FROM raw JOIN codes USING (iso2)
  WHERE type IN ('large_airport', 'medium_airport') AND length(icao_code) = 4
)
SELECT icao_code, iata_code, name, iso3, latitude, longitude, type FROM kept WHERE rn = 1""",
}
