"""Keyed merges over customers, orders and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid import schemas
from vitalgrid.operators import catalog, merge, pick
from vitalgrid.plans import rasters
from vitalgrid.workload import table


def latest_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """A snapshot of the first half of the month, upserted with one of the whole month, signups apart."""
    events = table(spark, sf, "events").select(
        "user_id", "ts", "event_id", "event_type", F.when(F.col("event_type") != "error", F.col("value")).alias("value"), "props"
    )

    def snapshot(rows: DataFrame, stamp: int) -> DataFrame:
        last = pick.latest_per_key(rows, ["user_id"], ["ts", "event_id"])
        return last.select("user_id", "event_id", "event_type", "value", F.lit(stamp).alias("updated_at"))

    day = F.dayofmonth("ts")
    old = snapshot(events.where(day <= 15), 15).withColumn("source", F.lit("OLD"))
    new = snapshot(events, 30).withColumn("source", F.lit("NEW"))
    # A user whose last event is a signup keeps the first snapshot where there is one.
    return merge.upsert(old, new.where(F.col("event_type") != "signup"), ["user_id"], ["event_id", "event_type", "value", "updated_at"])


def upsert_subset_cols(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    old = customer.where(F.col("c_nationkey") < 15).select(
        "c_custkey", "c_name", "c_acctbal", "c_mktsegment", F.lit("OLD").alias("source"), F.lit(1).alias("created")
    )
    new = customer.where(F.col("c_nationkey") >= 10).select(
        "c_custkey",
        F.concat(F.lit("new "), "c_name").alias("c_name"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal") + 1000).alias("c_acctbal"),
        F.lower("c_mktsegment").alias("c_mktsegment"),
    )
    return merge.upsert(
        old, new, ["c_custkey"], ["c_acctbal", "c_mktsegment"], {"source": F.lit("NEW"), "created": F.lit(2)}
    ).withColumn("c_acctbal", F.round("c_acctbal", 2))


def insert_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    """Customers of some nations are there; the first order adds the others."""
    old = table(spark, sf, "customer").where(F.col("c_nationkey") < 10).select(
        F.col("c_custkey").alias("key"), F.lit(-1).cast("bigint").alias("first_order")
    )
    new = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("first_order"), "o_orderdate",
        F.col("o_orderkey").alias("_seq"),
    )
    return merge.insert_if_absent(old, new.select("key", "first_order", "o_orderdate", "_seq"), ["key"], ["o_orderdate", "_seq"])


def _order_rows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("status"), F.year("o_orderdate").alias("year"),
        "o_orderkey", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"), "o_orderpriority",
    )


def slice_replace(spark: SparkSession, sf: str) -> DataFrame:
    rows = _order_rows(spark, sf)
    old = rows.where(F.col("year") <= 1999).withColumn("release", F.lit("A"))
    new = rows.where(
        (F.col("year") > 1999) | ((F.col("year") >= 1998) & (F.col("status") != "O") & (F.col("o_orderpriority") == "1-URGENT"))
    ).withColumn("release", F.lit("B"))
    return merge.replace_slices(old, new, ["status", "year"])


def _catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as stored files of their source; ``id`` grows with the document."""
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"),
        F.when(F.col("lang") == "en", "cog").otherwise("raw").alias("stage"),
        F.concat("source", F.lit("_"), F.floor(F.col("doc_id") / 50).cast("string"), F.lit(".tif")).alias("filename"),
        F.lit("run0").alias("run_id"),
        F.sha2(F.col("text").cast("binary"), 256).alias("sha256"),
        F.octet_length("text").cast("bigint").alias("size_bytes"),
        F.lit("image/tiff").alias("content_type"),
        F.col("doc_id").alias("lo_oid"),
        F.when(F.col("lang") != "fr", F.col("n_chars").cast("double")).alias("exact_total"),
    )


def _stored_again(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    found = documents.where(F.col("toxic") == 1).select(
        F.concat(F.lit("/in/"), "source", F.lit("_"), F.floor(F.col("doc_id") / 50).cast("string"), F.lit(".tif")).alias("path"),
        F.octet_length("text").cast("bigint").alias("length"),
        F.col("text").cast("binary").alias("content"),
        "doc_id",
    )
    return rasters.store(_catalog(spark, sf), found, "raw", "run1", order=["doc_id"])


def catalog_replace(spark: SparkSession, sf: str) -> DataFrame:
    """Files of the toxic documents are stored again and replace what they were; new ids are above all old ones."""
    stored = _stored_again(spark, sf)
    top = _catalog(spark, sf).agg(F.max("id")).first()[0] or 0
    return stored.select(
        *[c for c in stored.columns if c != "id"], F.when(F.col("id") <= top, F.col("id")).alias("old_id"), (F.col("id") > top).alias("new"),
    )


def catalog_store_newest(spark: SparkSession, sf: str) -> DataFrame:
    """The newest row of each file after storing the toxic documents again."""
    return catalog.newest(_stored_again(spark, sf)).select("stage", "filename", "run_id", "sha256", "size_bytes")


def catalog_newest(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.newest(_catalog(spark, sf)).select("stage", "filename", "id", "sha256", "size_bytes")


def set_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Every row of a stage and file gets the total of its file; others keep theirs."""
    stored = _catalog(spark, sf)
    totals = stored.where(F.col("size_bytes") > 5000).groupBy("filename").agg(
        F.sum("size_bytes").cast("double").alias("exact_total")
    ).withColumn("stage", F.lit("raw"))
    done = merge.set_column(stored, totals, ["stage", "filename"], "exact_total")
    return done.select("id", "stage", "filename", "exact_total")


def schema_evolve(spark: SparkSession, sf: str) -> DataFrame:
    """Old rows without a variant become MEDIAN rows of the declared table."""
    old = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("iso3"), F.year("o_orderdate").alias("year"),
        F.lit(15).alias("age_min"), F.lit(19).alias("age_max"),
        F.round("o_totalprice").alias("asfr"), F.lit("UN_WPP").alias("source"), F.col("o_orderstatus").alias("release"),
    )
    new = merge.evolve(old, schemas.FERTILITY.schema, {"variant_short_name": "MEDIAN"})
    again = merge.evolve(new, schemas.FERTILITY.schema, {"variant_short_name": "MEDIAN"})
    return again.withColumn("created_at", F.col("created_at").cast("string"))


def run_points(spark: SparkSession, sf: str) -> DataFrame:
    """Points of the newest run per (iso3, year)."""
    from vitalgrid.plans import runs

    newest = runs.newest_runs(_runs(spark, sf))
    return runs.run_points(newest, _points(spark, sf)).select("run_id", "iso3", "year", "t", "infected")


def _runs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("iso3"), F.year("o_orderdate").alias("year"),
        F.col("o_orderdate").alias("created_at"), "o_orderstatus",
    )


def _points(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("run_id"), F.col("l_linenumber").alias("t"),
        F.col("l_quantity").cast("bigint").alias("infected"),
    )


def run_delete(spark: SparkSession, sf: str) -> DataFrame:
    """Points left after the runs with status P are deleted, each with the number and the sum of those left at its time."""
    left = _runs(spark, sf).where(F.col("o_orderstatus") != "P")
    kept = merge.cascade_delete(left, _points(spark, sf), "id", "run_id")
    # An aggregate and a join, not a window: few times hold all points.
    totals = kept.groupBy(F.col("t").alias("_t")).agg(F.count("*").alias("points_at_t"), F.sum("infected").alias("infected_at_t"))
    return kept.join(totals, F.col("t").eqNullSafe(F.col("_t"))).drop("_t")


QUERIES = {
    "latest_upsert": latest_upsert,
    "upsert_subset_cols": upsert_subset_cols,
    "insert_if_absent": insert_if_absent,
    "slice_replace": slice_replace,
    "catalog_replace": catalog_replace,
    "catalog_store_newest": catalog_store_newest,
    "catalog_newest": catalog_newest,
    "set_totals": set_totals,
    "schema_evolve": schema_evolve,
    "run_points": run_points,
    "run_delete": run_delete,
}

_CATALOG = """
catalog AS (
  SELECT doc_id AS id, CASE WHEN lang = 'en' THEN 'cog' ELSE 'raw' END AS stage,
         source || '_' || CAST(doc_id // 50 AS VARCHAR) || '.tif' AS filename,
         'run0' AS run_id, sha256(text) AS sha256, CAST(strlen(text) AS BIGINT) AS size_bytes,
         'image/tiff' AS content_type, doc_id AS lo_oid,
         CASE WHEN lang <> 'fr' THEN CAST(n_chars AS DOUBLE) END AS exact_total
  FROM documents
)"""

_STORED = """last AS (
  SELECT source || '_' || CAST(doc_id // 50 AS VARCHAR) || '.tif' AS filename, max(doc_id) AS doc_id
  FROM documents JOIN labels USING (doc_id) WHERE toxic = 1 GROUP BY ALL
),
found AS (
  SELECT filename, sha256(text) AS sha256, CAST(strlen(text) AS BIGINT) AS size_bytes FROM last JOIN documents USING (doc_id)
),
merged AS (
  SELECT id, stage, filename, run_id, sha256, size_bytes, content_type, lo_oid, exact_total FROM catalog
  WHERE stage <> 'raw' OR filename NOT IN (SELECT filename FROM found)
  UNION ALL
  SELECT NULL, 'raw', filename, 'run1', sha256, size_bytes, 'image/tiff', NULL, NULL FROM found
)"""

SQL = {
    "latest_upsert": """
WITH e AS (
  SELECT *, CASE WHEN event_type <> 'error' THEN value END AS v FROM events
),
o AS (
  SELECT DISTINCT ON (user_id) user_id, event_id, event_type, v AS value, 15 AS updated_at, 'OLD' AS source
  FROM e WHERE day(ts) <= 15 ORDER BY user_id, ts DESC, event_id DESC
),
every AS (
  SELECT DISTINCT ON (user_id) user_id, event_id, event_type, v AS value, 30 AS updated_at, 'NEW' AS source
  FROM e ORDER BY user_id, ts DESC, event_id DESC
),
n AS (SELECT * FROM every WHERE event_type <> 'signup')
SELECT coalesce(n.user_id, o.user_id) AS user_id,
       CASE WHEN n.user_id IS NOT NULL THEN n.event_id ELSE o.event_id END AS event_id,
       CASE WHEN n.user_id IS NOT NULL THEN n.event_type ELSE o.event_type END AS event_type,
       CASE WHEN n.user_id IS NOT NULL THEN n.value ELSE o.value END AS value,
       CASE WHEN n.user_id IS NOT NULL THEN n.updated_at ELSE o.updated_at END AS updated_at,
       CASE WHEN o.user_id IS NOT NULL THEN o.source ELSE n.source END AS source
FROM o FULL JOIN n ON o.user_id = n.user_id""",
    "upsert_subset_cols": """
WITH o AS (SELECT * FROM customer WHERE c_nationkey < 15),
n AS (
  SELECT c_custkey, 'new ' || c_name AS c_name,
         CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal + 1000 END AS c_acctbal,
         lower(c_mktsegment) AS c_mktsegment
  FROM customer WHERE c_nationkey >= 10
)
SELECT coalesce(n.c_custkey, o.c_custkey) AS c_custkey,
       CASE WHEN o.c_custkey IS NOT NULL THEN o.c_name ELSE n.c_name END AS c_name,
       round(CASE WHEN n.c_custkey IS NOT NULL THEN n.c_acctbal ELSE o.c_acctbal END, 2) AS c_acctbal,
       CASE WHEN n.c_custkey IS NOT NULL THEN n.c_mktsegment ELSE o.c_mktsegment END AS c_mktsegment,
       CASE WHEN o.c_custkey IS NOT NULL THEN 'OLD' ELSE 'NEW' END AS source,
       CASE WHEN o.c_custkey IS NOT NULL THEN 1 ELSE 2 END AS created
FROM o FULL JOIN n ON o.c_custkey = n.c_custkey""",
    "insert_if_absent": """
WITH o AS (SELECT c_custkey AS key, CAST(-1 AS BIGINT) AS first_order FROM customer WHERE c_nationkey < 10)
SELECT * FROM o
UNION ALL
SELECT key, first_order FROM (
  SELECT DISTINCT ON (o_custkey) o_custkey AS key, o_orderkey AS first_order
  FROM orders ORDER BY o_custkey, o_orderdate, o_orderkey
) n WHERE key NOT IN (SELECT key FROM o)""",
    "slice_replace": """
WITH r AS (
  SELECT o_orderstatus AS status, CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(round(o_totalprice * 100) AS BIGINT) AS cents, o_orderpriority, o_orderkey FROM orders
),
n AS (SELECT *, 'B' AS release FROM r WHERE year > 1999 OR (year >= 1998 AND status <> 'O' AND o_orderpriority = '1-URGENT')),
merged AS (
  SELECT *, 'A' AS release FROM r
  WHERE year <= 1999 AND (status, year) NOT IN (SELECT (status, year) FROM n)
  UNION ALL SELECT * FROM n
)
SELECT * FROM merged""",
    "catalog_replace": f"""
WITH {_CATALOG}, {_STORED}
SELECT stage, filename, run_id, sha256, size_bytes, content_type, lo_oid, exact_total,
       CASE WHEN run_id = 'run0' THEN id END AS old_id, run_id = 'run1' AS new
FROM merged""",
    "catalog_store_newest": f"""
WITH {_CATALOG}, {_STORED}
SELECT stage, filename, run_id, sha256, size_bytes FROM merged m
WHERE run_id = 'run1' OR id = (SELECT max(id) FROM merged o WHERE o.stage = m.stage AND o.filename = m.filename)""",
    "catalog_newest": f"""
WITH {_CATALOG}
SELECT DISTINCT ON (stage, filename) stage, filename, id, sha256, size_bytes
FROM catalog ORDER BY stage, filename, id DESC""",
    "set_totals": f"""
WITH {_CATALOG},
totals AS (
  SELECT filename, CAST(sum(size_bytes) AS DOUBLE) AS total FROM catalog WHERE size_bytes > 5000 GROUP BY filename
)
SELECT id, stage, c.filename,
       CASE WHEN stage = 'raw' AND t.filename IS NOT NULL THEN t.total ELSE exact_total END AS exact_total
FROM catalog c LEFT JOIN totals t ON c.filename = t.filename""",
    "schema_evolve": """
SELECT o_orderpriority AS iso3, CAST(year(o_orderdate) AS INTEGER) AS year, 'MEDIAN' AS variant_short_name,
       15 AS age_min, 19 AS age_max, round(o_totalprice) AS asfr, 'UN_WPP' AS source, o_orderstatus AS release, CAST(NULL AS VARCHAR) AS created_at
FROM orders""",
    "run_points": """
WITH newest AS (
  SELECT DISTINCT ON (o_custkey, year(o_orderdate)) o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year
  FROM orders ORDER BY o_custkey, year(o_orderdate), o_orderdate DESC, o_orderkey DESC
)
SELECT o_orderkey AS run_id, o_custkey AS iso3, year, l_linenumber AS t, CAST(l_quantity AS BIGINT) AS infected
FROM newest JOIN lineitem ON l_orderkey = o_orderkey""",
    "run_delete": """
WITH kept AS (
  SELECT l_orderkey AS run_id, l_linenumber AS t, CAST(l_quantity AS BIGINT) AS infected
  FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
),
totals AS (
  SELECT t AS total_t, count(*) AS points_at_t, CAST(sum(infected) AS BIGINT) AS infected_at_t FROM kept GROUP BY t
)
SELECT run_id, t, infected, points_at_t, infected_at_t FROM kept JOIN totals ON t IS NOT DISTINCT FROM total_t""",
}
