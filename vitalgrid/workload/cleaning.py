"""Tolerant casts, filters, fallbacks and file predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.functions import clean, files
from vitalgrid.operators import pick
from vitalgrid.plans import covid, runs
from vitalgrid.sources import listing, requests, tables
from vitalgrid.workload import table


def tolerant_casts(spark: SparkSession, sf: str) -> DataFrame:
    """Event values written well and badly, read back."""
    kind, text = F.col("event_type"), F.col("value").cast("decimal(18,2)").cast("string")
    k = F.get_json_object("props", "$.k")
    number = (
        F.when(kind == "click", F.concat(F.lit(" \t"), text, F.lit("\n")))
        .when(kind == "view", F.concat(text, F.lit("d")))
        .when(kind == "signup", F.concat(F.lit("1_0"), text))
        .when(kind == "error", F.lit(""))
        .otherwise(F.concat(F.lit("+."), k, F.lit("e2")))
    )
    year = (
        F.when(kind == "click", F.concat(F.lit("20"), F.lpad(k, 2, "0"), F.lit(" ")))
        .when(kind == "view", F.concat(F.lit("20"), k, F.lit(".0")))
        .when(kind == "signup", F.concat(F.lit("-"), k))
        .when(kind == "error", F.lit("n/a"))
    )
    day = (
        F.when(kind == "click", F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit(" ")))
        .when(kind == "view", F.concat(F.lit("2024-02-"), F.lpad(k, 2, "0")))
        .when(kind == "signup", F.date_format("ts", "yyyy-M-d"))
        .when(kind == "error", F.date_format("ts", "yyyy/MM/dd"))
    )
    return table(spark, sf, "events").select(
        "event_id",
        clean.double_or_null(number).alias("number"),
        clean.int_or_null(year).alias("year"),
        clean.date_or_null(day).cast("string").alias("day"),
        clean.number_or(F.when(k != "7", F.col("value") * (k.cast("int") % 2)), F.lit(-1.0)).alias("or_number"),
        clean.text_or(F.when(kind == "click", "").otherwise(kind), k).alias("or_text"),
        F.coalesce(F.when(kind == "click", F.lit(0)), k.cast("int")).alias("first_present"),
    )


def covid_raw(spark: SparkSession, sf: str) -> DataFrame:
    """Events as lines of the daily file; errors carry no metric."""
    kind, text = F.col("event_type"), F.col("value").cast("decimal(18,2)").cast("string")
    k = F.get_json_object("props", "$.k").cast("int")
    line = table(spark, sf, "events").select(
        F.when(k < 5, F.lit("owid_wrl")).when(k < 8, F.lit(" ")).otherwise(F.concat(F.lit(" u"), "user_id")).alias("iso_code"),
        F.when(k > 95, F.date_format("ts", "yyyy-M-d")).otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("date"),
        F.when(kind == "click", text).when(kind == "purchase", F.lit("x")).alias("total_cases"),
        F.when(kind == "view", "0").when(kind == "error", "").alias("new_cases"),
        F.when(kind.isin("click", "signup"), k.cast("string")).alias("stringency_index"),
        F.when(kind == "purchase", text).alias("total_deaths"),
        "event_id",
    )
    return line


METRICS = ["total_cases", "new_cases", "stringency_index", "total_deaths"]


def _covid_daily(spark: SparkSession, sf: str) -> DataFrame:
    rows = covid.daily_rows(covid_raw(spark, sf), order=("event_id",), metrics=METRICS)
    return pick.last_write_wins(rows, ["iso3", "date"], ["event_id"])


def any_metric_filter(spark: SparkSession, sf: str) -> DataFrame:
    return _covid_daily(spark, sf).withColumn("date", F.col("date").cast("string"))


def covid_latest(spark: SparkSession, sf: str) -> DataFrame:
    none = F.lit(None).cast("double")
    daily = _covid_daily(spark, sf).withColumns(
        {c: none for c in ("total_vaccinations", "people_fully_vaccinated", "reproduction_rate")}
    )
    latest = covid.country_latest(daily, F.lit("2024-02-01"))
    return latest.select(
        "iso3", F.col("last_date").cast("string").alias("last_date"), "total_cases", "total_deaths",
        "last_stringency_index", "updated_at",
    )


def allow_list(spark: SparkSession, sf: str) -> DataFrame:
    wanted = clean.allow_list(" nation_3, NATION_7 ,,nation_11 ")
    nation = table(spark, sf, "nation").where(clean.allowed(clean.code("n_name"), wanted))
    customer = table(spark, sf, "customer")
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .groupBy("n_name")
        .agg(F.count("*").alias("customers"))
    )


def country_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Equality filter and two-column projection, both at the scan."""
    return tables.lookup(
        tables.where_equal(table(spark, sf, "customer"), c_mktsegment="MACHINERY", c_nationkey=7), "c_custkey", "c_name"
    )


def year_range(spark: SparkSession, sf: str) -> DataFrame:
    year = F.year("o_orderdate")
    return (
        table(spark, sf, "orders").where(clean.in_years(year, (1996, 1998)))
        .groupBy(year.alias("year")).agg(F.count("*").alias("orders"))
    )


def run_params(spark: SparkSession, sf: str) -> DataFrame:
    """Event properties as run parameters."""
    params = runs.with_params(table(spark, sf, "events").select("user_id", "props"), "props")
    k = F.variant_get("props", "$.k", "int")
    return params.groupBy("user_id").agg(F.sum(k).alias("k"), F.count("props").alias("runs"))


def request_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Age raster requests with every supplier as a country."""
    wanted = table(spark, sf, "supplier").select(F.concat(F.lit("S"), "s_suppkey").alias("iso3"))
    # Repeated countries meet before they are expanded. The number of tasks is given, as the rows
    # are small here and 240 times as many later.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    countries = wanted.repartition(tasks, "iso3").groupBy("iso3").agg(F.count("*").alias("times"))
    return requests.age_requests(countries, (2015, 2026), together=True).select(
        "iso3", "age_code", (F.col("times") * F.size("requests")).alias("files"),
        F.array_min("requests.url").alias("first_url"), F.array_max("requests.filename").alias("last_name"),
    )


def _listing(spark: SparkSession, sf: str) -> DataFrame:
    """Pages as files of a folder: country rasters of several years, some in a
    sub-folder, some unfinished, some upper case."""
    n = F.col("page_id")
    name = F.concat(
        F.lit("p"), n, F.when(n % 3 == 0, "_pop_2020_CN_100m").when(n % 3 == 1, "_POP_2020_cn").otherwise("_pop_2021_CN"),
        F.when(n % 5 == 0, "_COG.TIF").when(n % 5 == 1, "_cog.tiff").when(n % 5 == 2, "_cog.tif.partial").otherwise("_cog.tif"),
    )
    return table(spark, sf, "pages").select(
        F.concat(F.when(n % 7 == 0, "/data/old/").otherwise("/data/"), name).alias("path"),
        F.octet_length("html").cast("bigint").alias("length"),
    )


def file_select(spark: SparkSession, sf: str) -> DataFrame:
    found = listing.excluding(listing.year_cogs(_listing(spark, sf), 2020, "/data"), ["p1*_cog.tif"])
    name = files.base_name(F.col("path"))
    return found.select(
        "path", files.name_country(name).alias("iso3"), files.name_year(name).alias("year"),
        files.usable(F.col("length")).alias("usable"), files.content_type(name).alias("content_type"),
    )


def freshness(spark: SparkSession, sf: str) -> DataFrame:
    """Events as file times, twelve hours before a given moment."""
    now = F.lit("2024-01-30 12:00:00").cast("timestamp_ntz")
    fresh = files.is_fresh(F.col("ts"), now)
    return table(spark, sf, "events").groupBy("event_type").agg(
        F.count(F.when(fresh, 1)).alias("fresh"), F.count(F.when(~fresh, 1)).alias("stale")
    )


QUERIES = {
    "tolerant_casts": tolerant_casts,
    "any_metric_filter": any_metric_filter,
    "covid_latest": covid_latest,
    "allow_list": allow_list,
    "country_filter": country_filter,
    "year_range": year_range,
    "run_params": run_params,
    "request_manifest": request_manifest,
    "file_select": file_select,
    "freshness": freshness,
}

COVID_SQL = """
raw AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
),
daily AS (
  SELECT 'U' || user_id AS iso3, strftime(ts, '%Y-%m-%d') AS date, event_id,
         CASE WHEN event_type = 'click' THEN value END AS total_cases,
         CASE WHEN event_type = 'view' THEN 0.0::DOUBLE END AS new_cases,
         CASE WHEN event_type IN ('click', 'signup') THEN k::DOUBLE END AS stringency_index,
         CASE WHEN event_type = 'purchase' THEN value END AS total_deaths
  FROM raw WHERE k >= 8 AND event_type <> 'error'
    AND (k <= 95 OR (month(ts) >= 10 AND day(ts) >= 10))
),
panel AS (
  SELECT DISTINCT ON (iso3, date) * FROM daily ORDER BY iso3, date, event_id DESC
)"""

SQL = {
    "tolerant_casts": r"""
WITH e AS (
  SELECT *, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS t, json_extract_string(props, '$.k') AS k FROM events
)
SELECT event_id,
       CASE event_type WHEN 'click' THEN CAST(t AS DOUBLE) WHEN 'signup' THEN CAST('10' || t AS DOUBLE)
            WHEN 'purchase' THEN CAST('.' || k || 'e2' AS DOUBLE) END AS number,
       CASE event_type WHEN 'click' THEN CAST('20' || lpad(k, 2, '0') AS INTEGER)
            WHEN 'signup' THEN -CAST(k AS INTEGER) END AS year,
       CASE event_type WHEN 'click' THEN strftime(ts, '%Y-%m-%d')
            WHEN 'view' THEN strftime(TRY_CAST('2024-02-' || lpad(k, 2, '0') AS DATE), '%Y-%m-%d')
            WHEN 'signup' THEN CASE WHEN month(ts) >= 10 AND day(ts) >= 10 THEN strftime(ts, '%Y-%m-%d') END END AS day,
       CASE WHEN k = '7' OR CAST(k AS INTEGER) % 2 = 0 OR value = 0 THEN -1.0 ELSE value END AS or_number,
       CASE WHEN event_type = 'click' THEN k ELSE event_type END AS or_text,
       CASE WHEN event_type = 'click' THEN 0 ELSE CAST(k AS INTEGER) END AS first_present
FROM e""",
    "any_metric_filter": f"""
WITH {COVID_SQL}
SELECT iso3, date, total_cases, new_cases, stringency_index, total_deaths FROM panel""",
    "covid_latest": f"""
WITH {COVID_SQL}
SELECT DISTINCT ON (iso3) iso3, date AS last_date, total_cases, total_deaths,
       stringency_index AS last_stringency_index, '2024-02-01' AS updated_at
FROM panel ORDER BY iso3, date DESC""",
    "allow_list": """
SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE n_name IN ('NATION_3', 'NATION_7', 'NATION_11') GROUP BY n_name""",
    "country_filter": "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_nationkey = 7",
    "year_range": """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS orders FROM orders
WHERE year(o_orderdate) BETWEEN 1996 AND 1998 GROUP BY 1""",
    "run_params": """
SELECT user_id, CAST(sum(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS BIGINT) AS k, count(props) AS runs
FROM events GROUP BY user_id""",
    "request_manifest": """
WITH codes AS (
  SELECT unnest(['00', '01', '05', '10', '15', '20', '25', '30', '35', '40', '45', '50', '55', '60', '65',
                 '70', '75', '80', '85', '90']) AS age_code
),
r AS (
  SELECT 'S' || s_suppkey AS iso3, age_code, year,
         's' || s_suppkey || '_t_' || age_code || '_' || year || '_CN_100m_R2025A_v1.tif' AS filename
  FROM supplier CROSS JOIN codes CROSS JOIN (SELECT unnest(range(2015, 2027)) AS year)
)
SELECT iso3, age_code, count(*) AS files,
       min('https://data.worldpop.org/GIS/AgeSex_structures/Global_2015_2030/R2025A/' || year || '/' || iso3
           || '/v1/100m/constrained/' || filename) AS first_url,
       max(filename) AS last_name
FROM r GROUP BY ALL""",
    "file_select": r"""
WITH l AS (
  SELECT 'p' || page_id
         || CASE page_id % 3 WHEN 0 THEN '_pop_2020_CN_100m' WHEN 1 THEN '_POP_2020_cn' ELSE '_pop_2021_CN' END
         || CASE page_id % 5 WHEN 0 THEN '_COG.TIF' WHEN 1 THEN '_cog.tiff' WHEN 2 THEN '_cog.tif.partial'
                 ELSE '_cog.tif' END AS name,
         page_id, html
  FROM pages
)
SELECT '/data/' || name AS path, 'P' || page_id AS iso3, 2020 AS year, strlen(html) > 0 AS usable,
       'image/tiff' AS content_type
FROM l
WHERE page_id % 7 <> 0 AND lower(name) LIKE '%\_pop\_2020\_%' ESCAPE '\'
  AND (lower(name) LIKE '%\_cog.tif' ESCAPE '\' OR lower(name) LIKE '%\_cog.tiff' ESCAPE '\')
  AND NOT (name LIKE 'p1%\_cog.tif' ESCAPE '\')""",
    "freshness": """
SELECT event_type, count(*) FILTER (ts > TIMESTAMP '2024-01-30 00:00:00') AS fresh,
       count(*) FILTER (ts <= TIMESTAMP '2024-01-30 00:00:00') AS stale
FROM events GROUP BY event_type""",
}
