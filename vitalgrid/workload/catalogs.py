"""The file catalog with documents as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.functions import files
from vitalgrid.operators import catalog, digest
from vitalgrid.sources import requests
from vitalgrid.workload import table


def content_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Digest, size and type of every document as a file."""
    found = table(spark, sf, "documents").select(
        F.concat(F.lit("/in/d"), "doc_id", F.when(F.col("lang") == "en", ".tif").when(F.col("lang") == "fr", ".csv").otherwise(".bin")).alias("path"),
        F.octet_length("text").cast("bigint").alias("length"),
        F.col("text").cast("binary").alias("content"),
    )
    return catalog.entries(found, "raw", "run1").drop("run_id")


def source_digest(spark: SparkSession, sf: str) -> DataFrame:
    """One digest per source over the whole texts of its documents."""
    text = F.concat_ws("|", "doc_id", "lang", "text").cast("binary")
    return digest.set_digest(table(spark, sf, "documents"), ["source"], text)


def worklist_next_step(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as countries; a year's orders decide which files are there."""
    wanted = table(spark, sf, "customer").select(F.concat(F.lit("C"), "c_custkey").alias("iso3"))
    years = (1995, 2001)
    orders = table(spark, sf, "orders").select(
        F.concat(F.lit("c"), "o_custkey").alias("iso3"), F.year("o_orderdate").alias("year"), "o_orderstatus", "o_totalprice"
    )
    iso3, year, status = F.col("iso3"), F.col("year"), F.col("o_orderstatus")
    urgent = F.col("o_totalprice") > 200000
    listing = orders.select(
        F.inline(
            F.array(
                F.struct(
                    F.concat(F.lit("/data/"), files.raw_name(iso3, year)).alias("path"),
                    F.when(urgent, 100).otherwise(0).alias("length"),
                ),
                F.struct(
                    F.concat(F.lit("/data/"), files.warped_name(iso3, year)).alias("path"),
                    F.when(status == "O", 50).otherwise(0).alias("length"),
                ),
            )
        )
    )
    stored = orders.select(
        F.when(status == "P", "cog").otherwise("raw").alias("stage"),
        F.when(status == "P", files.cog_name(iso3, year)).otherwise(files.raw_name(iso3, year)).alias("filename"),
        F.when(urgent, F.col("o_totalprice")).alias("exact_total"),
    )
    done = catalog.worklist(requests.raster_requests(wanted, years), listing, stored)
    return done.select("iso3", "year", "next_step")


def manifest_diff(spark: SparkSession, sf: str) -> DataFrame:
    """Documents on disk against a listing of the labelled and the English ones."""
    documents = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    labels = table(spark, sf, "labels")
    local = documents.where(F.col("lang") != "fr").select(F.col("doc_id").alias("path"), F.col("n_chars").alias("local_size"))
    size = (
        F.when(F.col("toxic") == 1, F.lit(None)).when(F.col("quality") == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    )
    remote = (
        documents.join(labels, "doc_id", "left")
        .where(F.col("quality").isNotNull() | (F.col("lang") == "en"))
        .select(F.col("doc_id").alias("path"), size.alias("remote_size"))
    )
    return catalog.manifest_diff(local, remote)


def orphan_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Labels as catalog rows pointing at documents, with and without a target."""
    rows = table(spark, sf, "labels").select((F.col("doc_id") * 3).alias("lo_oid"))
    blobs = table(spark, sf, "documents").select(F.col("doc_id").alias("lo_oid"))
    kinds = {
        "live": catalog.live(rows, blobs),
        "stale": catalog.stale(rows, blobs),
        "orphan": catalog.orphans(rows, blobs),
    }
    out = None
    for kind, df in kinds.items():
        part = df.select(F.lit(kind).alias("kind"), "lo_oid")
        out = part if out is None else out.unionByName(part)
    return out


def rewrite_report(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as rewritten files, their outcome read off language and size."""
    n, lang = F.col("n_chars"), F.col("lang")
    status = F.when(n < 500, "skip").when(lang == "fr", "CORRUPT").when(lang == "de", "would-shrink").otherwise("ok")
    results = table(spark, sf, "documents").select(
        status.alias("status"), n.alias("before"),
        F.when(status.isin("ok", "would-shrink"), F.floor(n * 3 / 5)).otherwise(n).alias("after"),
    )
    return catalog.rewrite_report(results)


QUERIES = {
    "content_catalog": content_catalog,
    "source_digest": source_digest,
    "worklist_next_step": worklist_next_step,
    "manifest_diff": manifest_diff,
    "orphan_rows": orphan_rows,
    "rewrite_report": rewrite_report,
}

_SUMS = ", ".join(
    f"sum(CAST('0x' || substr(h, {i + 1}, {min(6, 64 - i)}) AS BIGINT))" for i in range(0, 64, 6)
)


def _human(c: str) -> str:
    return f"""CASE WHEN {c} < 1024 THEN {c} || ' B' WHEN {c} < 1024 * 1024 THEN printf('%.1f', {c} / 1024.0::DOUBLE) || ' KiB'
            WHEN {c} < 1024 * 1024 * 1024 THEN printf('%.1f', {c} / 1048576.0::DOUBLE) || ' MiB'
            ELSE printf('%.1f', {c} / 1073741824.0::DOUBLE) || ' GiB' END"""


SQL = {
    "content_catalog": """
SELECT 'raw' AS stage,
       'd' || doc_id || CASE lang WHEN 'en' THEN '.tif' WHEN 'fr' THEN '.csv' ELSE '.bin' END AS filename,
       sha256(text) AS sha256, CAST(strlen(text) AS BIGINT) AS size_bytes,
       CASE lang WHEN 'en' THEN 'image/tiff' WHEN 'fr' THEN 'text/csv' ELSE 'application/octet-stream' END AS content_type
FROM documents""",
    "source_digest": f"""
WITH h AS (SELECT source, sha256(concat_ws('|', doc_id, lang, text)) AS h FROM documents)
SELECT source, count(*) AS rows, sha256(concat_ws('|', count(*), {_SUMS})) AS digest FROM h GROUP BY source""",
    "worklist_next_step": """
WITH o AS (
  SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, bool_or(o_totalprice > 200000) AS raw_usable,
         bool_or(o_orderstatus <> 'P') AS in_raw, bool_or(o_orderstatus <> 'P' AND o_totalprice > 200000) AS raw_total,
         bool_or(o_orderstatus = 'O') AS warped, bool_or(o_orderstatus = 'P') AS in_cog
  FROM orders GROUP BY ALL
)
SELECT 'C' || c_custkey AS iso3, CAST(y.year AS INTEGER) AS year,
       CASE WHEN NOT coalesce(raw_usable, false) THEN 'download_raw' WHEN NOT in_raw THEN 'store_raw'
            WHEN NOT raw_total THEN 'rio_calc' WHEN NOT warped THEN 'warp_web_mercator'
            WHEN in_cog THEN 'skip' ELSE 'to_cog' END AS next_step
FROM customer CROSS JOIN (SELECT unnest(range(1995, 2002)) AS year) y
LEFT JOIN o ON o.o_custkey = c_custkey AND o.year = y.year""",
    "manifest_diff": """
WITH l AS (SELECT doc_id AS path, n_chars AS local_size FROM documents WHERE lang <> 'fr'),
r AS (
  SELECT d.doc_id AS path,
         CASE WHEN toxic = 1 THEN NULL WHEN quality = 0 THEN n_chars + 1 ELSE n_chars END AS remote_size
  FROM documents d LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL OR lang = 'en'
)
SELECT coalesce(l.path, r.path) AS path, local_size, remote_size,
       CASE WHEN r.path IS NULL THEN 'unlisted' WHEN local_size = remote_size THEN 'keep' ELSE 'refetch' END AS action
FROM l FULL JOIN r ON l.path = r.path""",
    "orphan_rows": """
WITH k AS (SELECT doc_id * 3 AS lo_oid FROM labels)
SELECT 'live' AS kind, lo_oid FROM k WHERE lo_oid IN (SELECT doc_id FROM documents)
UNION ALL SELECT 'stale', lo_oid FROM k WHERE lo_oid NOT IN (SELECT doc_id FROM documents)
UNION ALL SELECT 'orphan', doc_id FROM documents WHERE doc_id NOT IN (SELECT lo_oid FROM k)""",
    "rewrite_report": f"""
WITH r AS (
  SELECT CASE WHEN n_chars < 500 THEN 'skip' WHEN lang = 'fr' THEN 'CORRUPT' WHEN lang = 'de' THEN 'would-shrink'
              ELSE 'ok' END AS status, n_chars AS b,
         CASE WHEN n_chars < 500 OR lang = 'fr' THEN n_chars ELSE CAST(floor(n_chars * 3 / 5) AS BIGINT) END AS a
  FROM documents
),
s AS (
  SELECT CASE WHEN grouping(status) = 1 THEN 'total' ELSE status END AS status, count(*) AS files,
         CAST(sum(b) AS BIGINT) AS before, CAST(sum(a) AS BIGINT) AS after
  FROM r GROUP BY ROLLUP (status)
)
SELECT status, files, before, after, before - after AS saved, {_human('before')} AS before_text,
       {_human('after')} AS after_text, round((1 - after::DOUBLE / before::DOUBLE) * 100, 1) AS percent
FROM s""",
}
