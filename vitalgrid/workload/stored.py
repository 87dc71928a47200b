"""Files and stored tables: written from the tables, read back, and equal to their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitalgrid import schemas
from vitalgrid.functions import files, flights
from vitalgrid.operators import agebands, catalog, pick
from vitalgrid.plans import covid
from vitalgrid.plans import flights as plan
from vitalgrid.session import checkpoint_dir, materialise
from vitalgrid.sinks import csvfiles as out_csv
from vitalgrid.sinks import fs, ordered, rewrite, tables
from vitalgrid.sources import csvfiles, listing
from vitalgrid.sources import tables as source
from vitalgrid.workload import cleaning, mobility, table

SPLIT = 1 << 14  # bytes of a file that one task reads, so that small files have many splits
FIRST, SECOND = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def _folder(spark: SparkSession) -> str:
    """A fresh folder that driver and executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/files_{uuid.uuid4().hex}"


def _at(stamp: str):
    return F.lit(stamp).cast("timestamp")


def _in_splits(spark: SparkSession, read) -> DataFrame:
    """What ``read`` makes of files cut into small splits, in a session of its own."""
    small = spark.newSession()
    small.conf.set("spark.sql.files.maxPartitionBytes", str(SPLIT))
    small.conf.set("spark.sql.session.timeZone", "UTC")
    rows, path = materialise(read(small))
    return spark.read.schema(rows.schema).parquet(path)


def airport_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Customers written as an airport file with quotes and line breaks in names; the last line of a code counts."""
    folder, raw = _folder(spark), mobility.airports_raw(spark, sf)
    lines = raw.withColumn("name", F.concat(F.lit('"The", '), F.trim("name"), F.lit("\nof all")))
    lines = lines.repartitionByRange("c_custkey").sortWithinPartitions("c_custkey").drop("c_custkey")
    lines.write.option("quote", '"').option("escape", '"').csv(folder, header=True)
    return plan.airport_rows(csvfiles.airports(spark, folder), ["_file", "_line"])


def covid_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Events written as the daily file, in the order of their ids, and read in many splits; the last line of a day counts."""
    folder = _folder(spark)
    lines = cleaning.covid_raw(spark, sf).repartitionByRange(3, "event_id").sortWithinPartitions("event_id").drop("event_id")
    lines.write.csv(folder, header=True)
    rows = _in_splits(spark, lambda s: covid.daily_rows(csvfiles.covid(s, folder)))
    daily = pick.last_write_wins(rows, ["iso3", "date"], ["_file", "_line"])
    return daily.select("iso3", F.col("date").cast("string").alias("date"), *cleaning.METRICS, F.col("icu_patients").alias("absent"))


def year_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files by nation and year of orders, those of early years in a folder below; two years are looked for."""
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("iso3"))
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey").join(nation, "c_nationkey")
    orders = table(spark, sf, "orders").join(customer, "o_custkey")
    folder = _folder(spark)
    (
        orders.select("iso3", F.year("o_orderdate").alias("year"), "o_orderkey", F.concat_ws(",", "o_orderkey", "o_custkey").alias("value"))
        .repartition("iso3", "year").sortWithinPartitions("iso3", "year", "o_orderkey").drop("o_orderkey")
        .write.partitionBy("iso3", "year").text(f"{folder}/staged")
    )
    root, below = f"{folder}/rasters", f"{folder}/rasters/old"
    fs.make(spark, below)
    for name in fs.data_files(spark, f"{folder}/staged"):
        iso3, year = (part.split("=", 1)[1] for part in name.split("/")[:2])
        fs.rename(spark, f"{folder}/staged/{name}", f"{below if int(year) < 1996 else root}/{files.COG_NAME % (iso3.lower(), int(year))}")
    found = listing.list_files(spark, root, glob="*_cog.tif", recursive=True, content=True)
    # Order is of no use below: the rows are compared as a bag.
    wanted = [listing.year_cogs(found, year, root) for year in (1995, 1997)]
    rows = catalog.entries(wanted[0].unionByName(wanted[1]), "cog", "run")
    return rows.select("filename", "sha256", "size_bytes", "content_type")


def _loads(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Orders as two loads of an indicator table: those before 1997, then all with another value."""
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("iso3"))
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey").join(nation, "c_nationkey")
    orders = table(spark, sf, "orders").join(customer, "o_custkey").select(
        "iso3", F.col("o_orderpriority").alias("indicator_code"), F.lower("o_orderpriority").alias("indicator_name"),
        F.year("o_orderdate").alias("year"), F.col("o_totalprice").alias("value"), F.col("o_orderkey").alias("_ord"),
    )
    return [orders.where("year < 1997").withColumn("value", F.lit(-1.0)), orders]


def _loaded(spark: SparkSession, sf: str) -> tuple[list[tables.LoadMetrics], DataFrame]:
    path, stamps = f"{_folder(spark)}/worldbank", (FIRST, SECOND)
    metrics = [
        tables.upsert(schemas.WORLDBANK, path, rows, _at(stamp), ["_ord"], "iso3") for rows, stamp in zip(_loads(spark, sf), stamps)
    ]
    return metrics, source.read(spark, schemas.WORLDBANK, path)


def upsert_stored(spark: SparkSession, sf: str) -> DataFrame:
    """The table after both loads; rows of the first keep when they were made."""
    return _loaded(spark, sf)[1].withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd"))


def upsert_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """What was observed while both loads were written."""
    metrics, _ = _loaded(spark, sf)
    rows = [(i + 1, m.rows, m.keys, m.entities) for i, m in enumerate(metrics)]
    return spark.createDataFrame(rows, "load int, rows bigint, keys bigint, entities int")


def slices_stored(spark: SparkSession, sf: str) -> DataFrame:
    """A stored release of all orders, then one of those pending: it replaces the slices it has rows for."""
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("iso3"))
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey").join(nation, "c_nationkey")
    orders = table(spark, sf, "orders").join(customer, "o_custkey").withColumn("year", F.year("o_orderdate"))
    path = f"{_folder(spark)}/asfr"
    for release, rows, stamp in (("2022", orders, FIRST), ("2024", orders.where("o_orderstatus = 'P'"), SECOND)):
        bins = rows.groupBy("iso3", "year", F.col("o_orderpriority").alias("variant_short_name"), (15 + F.col("o_custkey") % 7 * 5).cast("int").alias("age_min")).agg(
            F.count("*").cast("double").alias("asfr")
        )
        bins = bins.withColumns({"age_max": F.col("age_min") + 4, "source": F.lit("X"), "release": F.lit(release)})
        tables.replace_slices(schemas.FERTILITY, path, bins, ["iso3", "year"], _at(stamp))
    stored = source.read(spark, schemas.FERTILITY, path)
    return stored.withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd"))


def bins_in_order(spark: SparkSession, sf: str) -> DataFrame:
    """Parts written in the order of type, size and key, and their place within the type as the files give it."""
    folder = _folder(spark)
    ordered.write_ordered(table(spark, sf, "part").select("p_type", "p_size", "p_partkey", "p_name"), folder, ["p_type", "p_size", "p_partkey"], files=7)
    rows = ordered.read_ordered(spark, folder)
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("p_type").orderBy("_place"))).drop("_place")


def pyramid_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Age pyramids written as one file a slice, and the lines of the files in order."""
    age = F.col("p_size") * 2
    code = F.when(age < 5, "01").when(age >= 90, "90").otherwise(F.format_string("%02d", (F.floor(age / 5) * 5).cast("int")))
    totals = table(spark, sf, "part").select(
        F.regexp_replace("p_brand", "[^A-Za-z0-9]", "").alias("iso3"), (2020 + F.length("p_type") % 3).alias("year"),
        code.alias("age_code"), F.col("p_retailprice").alias("total"),
    )
    folder = _folder(spark)
    out_csv.write_pyramids(agebands.rebin(totals, ["iso3", "year"]), folder)
    lines = csvfiles.with_file_order(spark.read.option("header", True).schema("age_group string, pop string, iso3 string, year int").csv(folder))
    place = Window.partitionBy("iso3", "year").orderBy("_file", "_line")
    return lines.select("iso3", "year", "age_group", F.round(F.col("pop").cast("double"), 2).alias("pop"), F.row_number().over(place).alias("line"))


def rewrite_verified(spark: SparkSession, sf: str) -> DataFrame:
    """Three datasets, one of them in the codec already, rewritten side by side; what they hold afterwards."""
    folder = _folder(spark)
    names = {"customer": "none", "orders": "gzip", "part": "zstd"}
    for name, codec in names.items():
        writer = table(spark, sf, name).write.option("compression", codec)
        (writer.partitionBy("p_brand") if name == "part" else writer).parquet(f"{folder}/{name}")
    done = rewrite.recompress_all(spark, [f"{folder}/{name}" for name in names])
    held = None
    for name, key in (("customer", "c_custkey"), ("orders", "o_orderkey"), ("part", "p_partkey")):
        one = spark.read.parquet(f"{folder}/{name}").select(F.lit(name).alias("name"), F.col(key).alias("key"))
        held = one if held is None else held.unionByName(one)
    held = held.groupBy("name").agg(F.count("*").alias("rows"), F.sum("key").alias("keys"))
    status = done.select(files.base_name(F.col("path")).alias("name"), "status", (F.col("after") > 0).alias("there"))
    return held.join(status, "name")


def day_windows(spark: SparkSession, sf: str) -> DataFrame:
    """The day before each event, as an arrivals request would ask for it."""
    window = flights.day_window(F.col("ts"))
    return table(spark, sf, "events").select("event_id", window.alias("w")).select("event_id", "w.begin", "w.end", F.col("w.date").cast("string").alias("date"))


QUERIES = {
    "airport_csv": airport_csv,
    "covid_csv": covid_csv,
    "year_files": year_files,
    "upsert_stored": upsert_stored,
    "upsert_metrics": upsert_metrics,
    "slices_stored": slices_stored,
    "bins_in_order": bins_in_order,
    "pyramid_csv": pyramid_csv,
    "rewrite_verified": rewrite_verified,
    "day_windows": day_windows,
}

_ORDERS = """
o AS (
  SELECT n_name AS iso3, o_orderpriority AS code, CAST(year(o_orderdate) AS INTEGER) AS year, o_totalprice AS value, o_orderkey, o_custkey, o_orderstatus
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

SQL = {
    "airport_csv": mobility.SQL["airports_clean"].replace("c_name AS name", "'\"The\", ' || c_name || chr(10) || 'of all' AS name"),
    "covid_csv": f"""
WITH {cleaning.COVID_SQL}
SELECT iso3, date, total_cases, new_cases, stringency_index, total_deaths, CAST(NULL AS DOUBLE) AS absent FROM panel""",
    "year_files": f"""
WITH {_ORDERS}
SELECT lower(iso3) || '_pop_1997_CN_100m_R2025A_v1_cog.tif' AS filename, sha256(body) AS sha256, CAST(strlen(body) AS BIGINT) AS size_bytes,
       'image/tiff' AS content_type
FROM (SELECT iso3, string_agg(o_orderkey || ',' || o_custkey || chr(10), '' ORDER BY o_orderkey) AS body FROM o WHERE year = 1997 GROUP BY iso3)""",
    "upsert_stored": f"""
WITH {_ORDERS}
SELECT iso3, code AS indicator_code, lower(code) AS indicator_name, year, arg_max(value, o_orderkey) AS value, 'WORLDBANK' AS source,
       CASE WHEN year < 1997 THEN '2024-01-01' ELSE '2024-02-01' END AS created_at
FROM o GROUP BY iso3, code, year""",
    "upsert_metrics": f"""
WITH {_ORDERS}
SELECT load, count(*) AS rows, count(DISTINCT (iso3, code, year)) AS keys, CAST(count(DISTINCT iso3) AS INTEGER) AS entities
FROM (SELECT 1 AS load, * FROM o WHERE year < 1997 UNION ALL SELECT 2, * FROM o) GROUP BY load""",
    "slices_stored": f"""
WITH {_ORDERS},
bins AS (
  SELECT release, iso3, year, code AS variant_short_name, CAST(15 + o_custkey % 7 * 5 AS INTEGER) AS age_min, CAST(count(*) AS DOUBLE) AS asfr
  FROM (SELECT '2022' AS release, * FROM o UNION ALL SELECT '2024', * FROM o WHERE o_orderstatus = 'P') GROUP BY ALL)
SELECT iso3, year, variant_short_name, age_min, age_min + 4 AS age_max, asfr, 'X' AS source, release,
       CASE release WHEN '2022' THEN '2024-01-01' ELSE '2024-02-01' END AS created_at
FROM bins b WHERE release = '2024' OR NOT EXISTS (SELECT 1 FROM bins n WHERE n.release = '2024' AND n.iso3 = b.iso3 AND n.year = b.year)""",
    "bins_in_order": """
SELECT p_type, p_size, p_partkey, p_name,
       CAST(row_number() OVER (PARTITION BY p_type ORDER BY p_size, p_partkey) AS INTEGER) AS place
FROM part""",
    "pyramid_csv": f"""
WITH names AS (SELECT unnest({["0-4"] + [f"{a}-{a + 4}" for a in range(5, 80, 5)] + ["80+"]}) AS age_group, unnest(range(17)) AS n),
p AS (
  SELECT lower(regexp_replace(p_brand, '[^A-Za-z0-9]', '', 'g')) AS iso3, CAST(2020 + length(p_type) % 3 AS INTEGER) AS year,
         CASE WHEN p_size * 2 < 5 THEN 0 WHEN p_size * 2 >= 80 THEN 16 ELSE (p_size * 2) // 5 END AS n, p_retailprice
  FROM part),
sums AS (SELECT iso3, year, n, sum(p_retailprice) AS pop FROM p GROUP BY ALL)
SELECT k.iso3, k.year, age_group, round(coalesce(pop, 0.0), 2) AS pop, CAST(names.n + 1 AS INTEGER) AS line
FROM (SELECT DISTINCT iso3, year FROM p) k CROSS JOIN names
LEFT JOIN sums ON sums.iso3 = k.iso3 AND sums.year = k.year AND sums.n = names.n""",
    "rewrite_verified": """
SELECT 'customer' AS name, count(*) AS rows, CAST(sum(c_custkey) AS BIGINT) AS keys, 'ok' AS status, true AS there FROM customer
UNION ALL SELECT 'orders', count(*), CAST(sum(o_orderkey) AS BIGINT), 'ok', true FROM orders
UNION ALL SELECT 'part', count(*), CAST(sum(p_partkey) AS BIGINT), 'skip', true FROM part""",
    "day_windows": """
SELECT event_id, (epoch(date_trunc('day', ts))::BIGINT - 86400) AS begin, epoch(date_trunc('day', ts))::BIGINT AS "end",
       strftime(date_trunc('day', ts) - INTERVAL 1 DAY, '%Y-%m-%d') AS date
FROM events""",
}
