"""Latest rows, last writes, candidate choice, age bins, load reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.functions import ages
from vitalgrid.functions.fields import once
from vitalgrid.operators import agebands, fertility, metrics, pick, resolve
from vitalgrid.workload import table


def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    last = pick.latest_per_key(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"])
    return last.select("user_id", "event_id", "event_type", "value", "props")


def last_write_wins(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines keyed by order and line number; the greatest of the rest is last."""
    lines = table(spark, sf, "lineitem")
    rest = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    delivered = lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        F.struct(*rest).alias("_ord"),
    )
    return pick.last_write_wins(delivered, ["l_orderkey", "l_linenumber"], ["_ord"])


BUCKETS = {
    "LOWER95": ["5-LOW", "4-NOT SPECIFIED"],
    "MEDIAN": ["3-MEDIUM"],
    "UPPER95": ["1-URGENT", "2-HIGH"],
}


def candidate_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of a customer: status as the sex, priority as the variant."""
    status = F.col("o_orderstatus")
    rows = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("iso3"), F.lit(2020).alias("year"),
        F.when(status == "F", 2).when(status == "O", 3).otherwise(1).alias("sex"),
        F.col("o_orderpriority").alias("variant"),
    )
    return fertility.chosen_variants(rows, BUCKETS).drop("year")


def _labelled_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Parts with an age bin written in five ways, one per part type."""
    size, kind = F.col("p_size"), F.col("p_type")
    label = (
        F.when(kind == "ECONOMY", F.concat(F.lit(" "), size, F.lit("-"), size + 4))
        .when(kind == "PROMO", F.concat(size, F.lit(" – "), size + 4, F.lit(" ")))
        .when(kind == "STANDARD", F.concat(size, F.lit("+")))
        .otherwise("90-94")
    )
    start = F.when(kind.isin("SMALL", "MEDIUM"), size)
    end = F.when(kind == "SMALL", size + 4)
    parts = once(
        table(spark, sf, "part"),
        label.alias("label"), start.alias("start"), end.alias("end"),
    )
    start, end = F.col("start"), F.col("end")
    return once(parts, ages.parse_bin(start.isNotNull(), start, end.isNotNull(), end, F.col("label")).alias("bin"))


def age_bin_parse(spark: SparkSession, sf: str) -> DataFrame:
    parts = _labelled_parts(spark, sf).select("p_partkey", "bin.age_min", "bin.age_max")
    return parts.where(ages.fertile(F.col("age_min"), F.col("age_max")))


def bin_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = _labelled_parts(spark, sf).select(
        F.col("p_brand").alias("iso3"), F.lit(2024).alias("year"), F.lit(2).alias("sex"),
        F.col("p_type").alias("variant"), "bin",
    )
    return fertility.bin_summary(rows).drop("year", "sex")


def rebin_zero_fill(spark: SparkSession, sf: str) -> DataFrame:
    age = F.col("p_size") * 2
    code = (
        F.when(age < 1, "00").when(age < 5, "01").when(age >= 90, "90")
        .otherwise(F.format_string("%02d", (F.floor(age / 5) * 5).cast("int")))
    )
    totals = table(spark, sf, "part").select(
        F.col("p_brand").alias("iso3"), code.alias("age_code"), F.col("p_retailprice").alias("total")
    )
    return agebands.rebin(totals, ["iso3"]).withColumn("pop", F.round("pop", 2))


def load_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.load_metrics(table(spark, sf, "events"), "user_id")


def rows_per_indicator(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.rows_per(table(spark, sf, "events"), ["event_type", "user_id"])


def first_ten_listed(spark: SparkSession, sf: str) -> DataFrame:
    """The first ten customers of every nation, and whether there are more."""
    return pick.first_n_text(table(spark, sf, "customer"), ["c_nationkey"], "c_name")


def resolve_ids(spark: SparkSession, sf: str) -> DataFrame:
    """The first customer of every nation, found by the nation's name in any case."""
    nation = table(spark, sf, "nation")
    wanted = nation.select(F.lower("n_name").alias("code"))
    offered = table(spark, sf, "customer").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    ).select(F.col("n_name").alias("code"), F.col("c_custkey").alias("id"), F.col("c_custkey").alias("_ord"))
    return resolve.resolve(wanted, offered, "code", ignore_case=True)


QUERIES = {
    "latest_per_key": latest_per_key,
    "last_write_wins": last_write_wins,
    "candidate_fallback": candidate_fallback,
    "age_bin_parse": age_bin_parse,
    "bin_summary": bin_summary,
    "rebin_zero_fill": rebin_zero_fill,
    "load_metrics": load_metrics,
    "rows_per_indicator": rows_per_indicator,
    "first_ten_listed": first_ten_listed,
    "resolve_ids": resolve_ids,
}

_PARTS = r"""
labelled AS (
  SELECT p_partkey, p_brand, p_type,
         CASE p_type WHEN 'ECONOMY' THEN ' ' || p_size || '-' || (p_size + 4)
                     WHEN 'PROMO' THEN p_size || ' – ' || (p_size + 4) || ' '
                     WHEN 'STANDARD' THEN p_size || '+' ELSE '90-94' END AS label,
         CASE WHEN p_type IN ('SMALL', 'MEDIUM') THEN p_size END AS s,
         CASE WHEN p_type = 'SMALL' THEN p_size + 4 END AS e
  FROM part
),
bins AS (
  SELECT p_partkey, p_brand, p_type,
         CASE WHEN s IS NOT NULL THEN s
              ELSE TRY_CAST(regexp_extract(label, '^\s*([0-9]+)\s*[-–]\s*([0-9]+)\s*$', 1) AS INTEGER) END AS age_min,
         CASE WHEN s IS NOT NULL THEN coalesce(e, s)
              ELSE TRY_CAST(regexp_extract(label, '^\s*([0-9]+)\s*[-–]\s*([0-9]+)\s*$', 2) AS INTEGER) END AS age_max
  FROM labelled
)"""

_BINS17 = ["0-4"] + [f"{a}-{a + 4}" for a in range(5, 80, 5)] + ["80+"]

SQL = {
    "latest_per_key": """
SELECT DISTINCT ON (user_id) user_id, event_id, event_type, value, props
FROM events ORDER BY user_id, ts DESC, event_id DESC""",
    "last_write_wins": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
             l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
  FROM lineitem
) WHERE rn = 1""",
    "candidate_fallback": """
WITH r AS (
  SELECT o_custkey AS iso3, CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 3 ELSE 1 END AS sex,
         o_orderpriority AS variant FROM orders
),
cand(bucket, variant, rank) AS (VALUES
  ('LOWER95', '5-LOW', 0), ('LOWER95', '4-NOT SPECIFIED', 1), ('MEDIAN', '3-MEDIUM', 0),
  ('UPPER95', '1-URGENT', 0), ('UPPER95', '2-HIGH', 1)),
sexes AS (SELECT iso3, min(sex) AS sex FROM r WHERE sex IN (2, 3) GROUP BY iso3),
best AS (
  SELECT r.iso3, r.sex, bucket, arg_min(cand.variant, rank) AS variant
  FROM r JOIN sexes s ON r.iso3 = s.iso3 AND r.sex = s.sex JOIN cand ON r.variant = cand.variant
  GROUP BY ALL
)
SELECT iso3, CAST(sex AS INTEGER) AS sex, bucket, variant FROM best
WHERE iso3 IN (SELECT iso3 FROM best GROUP BY iso3 HAVING count(*) = 3)""",
    "age_bin_parse": f"WITH {_PARTS} SELECT p_partkey, age_min, age_max FROM bins WHERE age_min >= 15 AND age_max <= 49",
    "bin_summary": f"""
WITH {_PARTS},
lists AS (
  SELECT p_brand AS iso3, p_type AS variant,
         coalesce(list_sort(list(DISTINCT printf('%02d-%02d', age_min, age_max))
                  FILTER (age_min >= 15 AND age_max <= 49)), []) AS b
  FROM bins GROUP BY ALL
)
SELECT iso3, variant, CAST(len(b) AS INTEGER) AS n_bins, array_to_string(b[1:10], ',') AS head,
       CASE WHEN len(b) > 10 THEN array_to_string(b[-10:], ',') ELSE '' END AS tail
FROM lists""",
    "rebin_zero_fill": f"""
WITH names AS (SELECT unnest({_BINS17}) AS age_bin, unnest(range(17)) AS bin_ord),
binned AS (
  SELECT p_brand, CASE WHEN p_size * 2 < 5 THEN 0 WHEN p_size * 2 >= 80 THEN 16 ELSE (p_size * 2) // 5 END AS bin_ord,
         p_retailprice FROM part
),
sums AS (SELECT p_brand, bin_ord, sum(p_retailprice) AS pop FROM binned GROUP BY ALL)
SELECT b.p_brand AS iso3, CAST(n.bin_ord AS INTEGER) AS bin_ord, n.age_bin, round(coalesce(s.pop, 0.0), 2) AS pop
FROM (SELECT DISTINCT p_brand FROM part) b CROSS JOIN names n
LEFT JOIN sums s ON s.p_brand = b.p_brand AND s.bin_ord = n.bin_ord""",
    "load_metrics": "SELECT count(*) AS rows, count(DISTINCT user_id) AS entities FROM events",
    "rows_per_indicator": "SELECT event_type, user_id, count(*) AS rows FROM events GROUP BY ALL",
    "first_ten_listed": """
SELECT c_nationkey, string_agg(c_name, ', ' ORDER BY c_name) FILTER (n <= 10)
       || CASE WHEN max(n) > 10 THEN ' ...' ELSE '' END AS listed
FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_name) AS n FROM customer)
GROUP BY c_nationkey""",
    "resolve_ids": """
SELECT lower(n_name) AS code, min(c_custkey) AS id
FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY n_name""",
}
