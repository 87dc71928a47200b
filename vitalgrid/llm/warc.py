"""Not-modified revisits of a web archive, resolved to the response they confirm.

Records are dealt by range over canonical URL and time and sorted; one pass over
each part keeps the latest full response of the URL at hand. A URL with very many
records spans several parts: a part's first revisits then take the response that
an earlier part ended with, from a summary of one row a part.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.llm.common import stored, table, whole

# Headers that a not-modified answer may renew (RFC 9110, 15.4.5, and RFC 9111, 3.2).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
TRACKING = r"utm_[a-z]+|ref|fbclid|gclid"


def canonical(url: Column) -> Column:
    """A URL without scheme, www., fragment, tracking parameters and closing slash, its host in lower case."""
    u = F.regexp_replace(F.regexp_replace(url, "#.*$", ""), r"^(?i:https?://)(?i:www\.)?", "")
    u = F.concat(F.lower(F.regexp_extract(u, "^[^/?]*", 0)), F.regexp_replace(u, "^[^/?]*", ""))
    u = F.regexp_replace(u, rf"([?&])(?:{TRACKING})=[^&]*", "$1")
    u = F.regexp_replace(F.regexp_replace(u, "[?&]+$", ""), r"\?&+", "?")
    return F.regexp_replace(F.regexp_replace(u, "&&+", "&"), "/+$", "")


def tag(etag: Column) -> Column:
    """An entity tag for the weak comparison."""
    return F.regexp_replace(F.trim(etag), "^W/", "")


STATE = "target_id bigint, t_headers map<string,string>, t_digest string"


def resolve_revisits(records: DataFrame, permitted=PERMITTED) -> DataFrame:
    """What each not-modified revisit stands for.

    records: record_id bigint, url, ts bigint, full boolean (a whole response, else
    a revisit), headers map<string,string> (names in lower case), digest of the
    payload. Out, a row a revisit: record_id, url_key, ts, status, target_id,
    digest, headers.

    The target is the response of the same canonical URL of latest earlier time
    (same time is not earlier; of equal times the larger record_id). ``status``:
    ``resolved``; ``changed`` if the entity tags, or else the modification times,
    of the two differ; ``unverified`` if they share no validator; ``missing``
    without target. Resolved and unverified revisits get the target's headers with
    the permitted ones renewed, others keep their own. A null URL or time has no
    target; repeated records each give a row; an empty table gives none.
    """
    rows = records.select(
        canonical(F.col("url")).alias("key"), "ts", F.coalesce("full", F.lit(False)).alias("full"), "record_id",
        F.map_entries(F.coalesce("headers", F.create_map().cast("map<string,string>"))).alias("headers"), "digest",
    )
    dealt = rows.repartitionByRange("key", "ts", "full", "record_id").sortWithinPartitions("key", "ts", "full", "record_id")
    shape = pa.list_(pa.struct([("key", pa.string()), ("value", pa.string())]))
    schema = "part int, key string, ts bigint, record_id bigint, headers array<struct<key:string,value:string>>, found boolean, target_id bigint, t_headers array<struct<key:string,value:string>>, t_digest string, summary boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, last, target = TaskContext.get().partitionId(), None, None, None
        start = True
        names = [x.split(" ")[0] for x in schema.replace("array<struct<key:string,value:string>>", "x").split(", ")]
        types = [pa.int32(), pa.string(), pa.int64(), pa.int64(), shape, pa.bool_(), pa.int64(), shape, pa.string(), pa.bool_()]

        def out(found: list) -> pa.RecordBatch:
            columns = list(zip(*found)) or [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)

        for batch in batches:
            found = []
            for x in batch.to_pylist():
                key = x["key"]
                if start:
                    first, start = key, False
                elif key != last:
                    target = None
                last = key
                if x["full"]:
                    if key is not None and x["ts"] is not None:
                        target = (x["record_id"], x["headers"], x["digest"])
                    continue
                usable = target if key is not None and x["ts"] is not None else None
                found.append((part, key, x["ts"], x["record_id"], x["headers"], usable is not None, *(usable or (None, None, None)), False))
            yield out(found)
        if not start:
            # found: whether the part holds one key only
            yield out([(part, last, None, None, None, first == last, *(target or (None, None, None)), True)])

    seen = stored(dealt.mapInArrow(run, schema))
    state, carried = None, []  # one row a part
    for row in sorted(seen.filter("summary").select("part", "key", "found", "target_id", "t_headers", "t_digest").collect()):
        if state:
            carried.append((row["part"], *state))
        if row["target_id"] is not None:
            state = (row["key"], row["target_id"], row["t_headers"], row["t_digest"])
        elif not (row["found"] and state and state[0] == row["key"]):
            state = None
    # A part that begins with another key than the one carried in matches no row.
    spark = records.sparkSession
    pairs = "array<struct<key:string,value:string>>"
    before = spark.createDataFrame(carried, f"c_part int, c_key string, c_target bigint, c_headers {pairs}, c_digest string")
    rows = seen.filter("not summary").join(
        F.broadcast(before), ~F.col("found") & F.col("ts").isNotNull() & (F.col("part") == F.col("c_part")) & (F.col("key") == F.col("c_key")), "left"
    )
    own, base = F.map_from_entries("headers"), F.map_from_entries(F.coalesce("t_headers", "c_headers"))
    rows = rows.select(
        "record_id", F.col("key").alias("url_key"), "ts", F.coalesce("target_id", "c_target").alias("target_id"),
        F.coalesce("t_digest", "c_digest").alias("digest"), own.alias("own"), base.alias("base"),
    )
    checks = [(tag(F.col("own")["etag"]), tag(F.col("base")["etag"])), (F.col("own")["last-modified"], F.col("base")["last-modified"])]
    verdict = F.lit("unverified")
    for mine, theirs in reversed(checks):
        verdict = F.when(mine.isNotNull() & theirs.isNotNull(), F.when(mine == theirs, "resolved").otherwise("changed")).otherwise(verdict)
    status = F.when(F.col("target_id").isNull(), "missing").otherwise(verdict)
    renew = F.map_filter("own", lambda k, v: k.isin(*permitted))
    merged = F.map_concat(F.map_filter("base", lambda k, v: ~F.array_contains(F.map_keys("renew"), k)), F.col("renew"))
    stands = F.col("status").isin("resolved", "unverified")
    return (
        rows.withColumn("status", status)
        .withColumn("renew", renew)
        .select(
            "record_id", "url_key", "ts", "status", "target_id",
            F.when(stands, F.col("digest")).alias("digest"), F.when(stands, merged).otherwise(F.col("own")).alias("headers"),
        )
    )


def header_text(headers: Column) -> Column:
    """Header lines in the order of their names."""
    lines = F.transform(F.array_sort(F.map_entries(headers)), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return F.array_join(lines, "\n")


def captures(pages: DataFrame) -> DataFrame:
    """A crawl of the pages: every page answered in full, then asked for again later.

    Page p is fetched at minute p and again 1 to 5 hours later under the other
    scheme and with a fragment. Of the later answers some carry another entity
    tag, some only a modification time, some no validator, and some precede any
    full response of their URL.
    """
    p = F.col("page_id")
    etag = F.concat(F.lit('"'), F.left(F.md5(whole("html").cast("binary")), F.lit(16)), F.lit('"'))
    fetched = p * 60
    again = F.when(p % 13 == 5, fetched - 30).otherwise(fetched + 3600 * (1 + p % 5))
    modified = (p * 7).cast("string")
    full = pages.select(
        (2 * p).alias("record_id"), "url", fetched.alias("ts"), F.lit(True).alias("full"),
        F.create_map(
            F.lit("content-length"), F.octet_length(whole("html")).cast("string"), F.lit("content-type"), F.lit("text/html"),
            F.lit("date"), fetched.cast("string"), F.lit("etag"), etag, F.lit("last-modified"), modified, F.lit("x-cache"), F.lit("miss"),
        ).alias("headers"),
        F.sha2(whole("html").cast("binary"), 256).alias("digest"),
    )
    other = F.when(F.col("url").startswith("https:"), F.concat(F.lit("HTTP:"), F.substring("url", 7, 1 << 20))).otherwise(F.regexp_replace("url", "^http:", "https:"))
    shown = F.when(p % 7 == 3, F.lit('"other"')).when(p % 2 == 0, F.concat(F.lit("W/"), etag)).otherwise(etag)
    kinds = F.when(p % 11 == 4, F.create_map(F.lit("last-modified"), modified)).when(p % 11 == 8, F.create_map().cast("map<string,string>")).otherwise(F.create_map(F.lit("etag"), shown))
    revisit = pages.select(
        (2 * p + 1).alias("record_id"), F.concat(F.regexp_replace(other, "#.*$", ""), F.lit("#again")).alias("url"), again.alias("ts"), F.lit(False).alias("full"),
        F.map_concat(
            F.create_map(F.lit("cache-control"), F.lit("max-age=60"), F.lit("content-length"), F.lit("0"), F.lit("date"), again.cast("string"), F.lit("x-cache"), F.lit("hit")),
            kinds,
        ).alias("headers"),
        F.lit(None).cast("string").alias("digest"),
    )
    return full.union(revisit)


def op8_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    found = resolve_revisits(captures(table(spark, folder, "pages")))
    return found.select("record_id", "url_key", "ts", "status", "target_id", F.col("digest").alias("payload_sha256"), header_text(F.col("headers")).alias("headers"))


QUERIES = {"op8_warc_revisits": op8_warc_revisits}

SQL = {
    "op8_warc_revisits": r"""
WITH made AS (
  SELECT page_id AS p, url, coalesce(html, '') AS html, '"' || left(md5(coalesce(html, '')), 16) || '"' AS etag, page_id * 60 AS fetched,
         CASE WHEN page_id % 13 = 5 THEN page_id * 60 - 30 ELSE page_id * 60 + 3600 * (1 + page_id % 5) END AS again,
         (page_id * 7)::VARCHAR AS modified
  FROM pages
), keyed AS (
  SELECT *, regexp_replace(regexp_replace(url, '#.*$', ''), '^(?i:https?://)(?i:www\.)?', '') AS bare FROM made
), canon AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
      lower(regexp_extract(bare, '^[^/?]*')) || regexp_replace(bare, '^[^/?]*', ''),
      '([?&])(?:utm_[a-z]+|ref|fbclid|gclid)=[^&]*', '\1', 'g'), '[?&]+$', ''), '\?&+', '?', 'g'), '&&+', '&', 'g'), '/+$', '') AS key
  FROM keyed
), full_ AS (
  SELECT key, fetched, max(2 * p) AS id FROM canon GROUP BY key, fetched
), joined AS (
  SELECT c.*, f.id AS target FROM canon c ASOF LEFT JOIN full_ f ON c.key = f.key AND c.again > f.fetched
), judged AS (
  SELECT j.*, t.html AS t_html, t.etag AS t_etag, t.modified AS t_modified, t.fetched AS t_fetched,
    CASE WHEN j.target IS NULL THEN 'missing'
         WHEN j.p % 11 = 4 THEN CASE WHEN j.modified = t.modified THEN 'resolved' ELSE 'changed' END
         WHEN j.p % 11 = 8 THEN 'unverified'
         WHEN j.p % 7 = 3 OR j.etag <> t.etag THEN 'changed' ELSE 'resolved' END AS status,
    CASE WHEN j.p % 7 = 3 THEN '"other"' WHEN j.p % 2 = 0 THEN 'W/' || j.etag ELSE j.etag END AS shown
  FROM joined j LEFT JOIN made t ON 2 * t.p = j.target
)
SELECT 2 * p + 1 AS record_id, key AS url_key, again AS ts, status, target AS target_id,
  CASE WHEN status IN ('resolved', 'unverified') THEN sha256(t_html) END AS payload_sha256,
  'cache-control: max-age=60' || chr(10) ||
  CASE WHEN status IN ('resolved', 'unverified') THEN
    'content-length: ' || octet_length(encode(t_html))::VARCHAR || chr(10) || 'content-type: text/html' || chr(10) || 'date: ' || again::VARCHAR || chr(10)
      || 'etag: ' || CASE WHEN p % 11 IN (4, 8) THEN t_etag ELSE shown END || chr(10) || 'last-modified: ' || t_modified || chr(10) || 'x-cache: miss'
  ELSE
    'content-length: 0' || chr(10) || 'date: ' || again::VARCHAR || chr(10)
      || CASE WHEN p % 11 = 4 THEN 'last-modified: ' || modified || chr(10) WHEN p % 11 = 8 THEN '' ELSE 'etag: ' || shown || chr(10) END || 'x-cache: hit'
  END AS headers
FROM judged
""",
}
