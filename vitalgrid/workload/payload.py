"""Landed API pages, written from the tables as JSON and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitalgrid.functions import fields
from vitalgrid.operators import pick
from vitalgrid.plans import demography, indicators
from vitalgrid.sources import payloads
from vitalgrid.workload import table


def _field(name: str, raw: Column | str) -> Column:
    """One JSON member from JSON text; NULL leaves the member out."""
    raw = F.lit(raw) if isinstance(raw, str) else raw
    return F.concat(F.lit(f'"{name}":'), raw)


def _quoted(text: Column | str) -> Column:
    text = F.lit(text) if isinstance(text, str) else text
    return F.concat(F.lit('"'), text, F.lit('"'))


def _object(*members: Column) -> Column:
    return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))


WHO_CODES = {
    "click": "HIV_0000000001", "view": "WHOSIS_000001", "signup": "WHS3_49",
    "error": "MDG_0000000020", "purchase": "NCDMORT3070",
}


def _who_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Events as one-record pages; a request is a user and an event type, its pages in the order of their ids.

    Of some requests the second page was not landed, failed or is cut short, or
    the last page names a next one.
    """
    kind, k = F.col("event_type"), F.get_json_object("props", "$.k").cast("int")
    request = Window.partitionBy("user_id", "event_type")
    fault = (F.col("user_id") + F.length("event_type")) % 12
    events = table(spark, sf, "events").withColumns(
        {"page": F.row_number().over(request.orderBy("event_id")), "n": F.count("*").over(request), "fault": fault}
    )
    day = F.dayofmonth("ts")
    year = F.when(day == 31, 1999).otherwise(2000 + day % 27).cast("string")
    text = F.col("value").cast("decimal(18,2)").cast("string")
    record = _object(
        _field("TimeDim", F.when(kind == "click", year).when(kind == "view", _quoted(year))
               .when(kind == "purchase", F.concat(year, F.lit(".7"))).when(kind == "error", "0").otherwise("null")),
        _field("TimeDimensionValue", F.when(kind.isin("signup", "error"), _quoted(year))),
        _field("NumericValue", F.when(k < 10, "0").when(k < 20, "null").otherwise(text)),
        _field("Value", F.when(k < 5, '"0"').when(k < 10, "null").when(k < 15, _quoted(text)).otherwise('"n/a"')),
        _field("Low", F.when(kind == "click", text).when(kind == "view", '" 1.5 "')),
        _field("Dim1", F.when(kind == "click", '" sex_fmle "').when(kind == "view", '""')
               .when(kind == "error", '"  "').when(kind == "purchase", '"SEX_MLE"')),
        _field("Dim1Type", F.when(kind == "view", '"Sex"')),
        _field("Dim2", F.when(kind == "view", '" YEARS15-49 "').when(kind == "purchase", '""')),
    )
    codes = F.create_map(*[F.lit(x) for pair in WHO_CODES.items() for x in pair])
    second = F.col("page") == 2
    link = F.when((F.col("page") < F.col("n")) | (F.col("fault") == 1), ',"@odata.nextLink":"more"').otherwise("")
    return events.where(~(second & (F.col("fault") == 0))).select(
        F.concat(F.lit("u"), "user_id").alias("iso3"),
        codes[kind].alias("indicator_code"),
        "page",
        F.when(second & (F.col("fault") == 2), 503).when(F.col("value") > 300, 404).otherwise(200).alias("status"),
        F.concat(F.lit('{"value":['), record, F.when(second & (F.col("fault") == 3), "").otherwise(F.concat(F.lit("]"), link, F.lit("}")))).alias("body"),
    )


def who_series(spark: SparkSession, sf: str) -> DataFrame:
    rows = indicators.who_rows(_who_pages(spark, sf))
    keys = ["iso3", "indicator_code", "year", "sex", "age_group"]
    return pick.last_write_wins(rows, keys, indicators.ORDER)


def _worldbank_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as pages; a request is an order and a line status, its pages in the order of the lines.

    Of some requests the second page was not landed, failed or is no JSON, or the
    pages announce one more than there are.
    """
    request = Window.partitionBy("l_orderkey", "l_linestatus")
    lines = table(spark, sf, "lineitem").withColumns(
        {
            "page": F.row_number().over(request.orderBy("l_linenumber", "l_shipdate", "l_quantity", "l_discount", "l_tax")),
            "n": F.count("*").over(request),
            "fault": F.col("l_orderkey") % 13,
        }
    )
    year = F.year("l_shipdate").cast("string")
    quantity = F.col("l_quantity").cast("bigint").cast("string")
    percent, tax = [(F.col(c) * 100 + 0.5).cast("int") for c in ("l_discount", "l_tax")]
    records = F.concat(
        F.lit('[{"date":"'), year, F.lit('","value":'), quantity,
        F.lit('},{"date":"'), year, F.lit('.0","value":1},{"date":'), year,
        F.lit(',"value":0},{"date":"1999","value":null}'), F.when(percent == 3, ',"junk"]').otherwise("]"),
    )
    announced = F.when(percent == 2, F.col("page")).when(F.col("fault") == 0, F.col("n") + 1).otherwise(F.col("n")).cast("string")
    second = F.col("page") == 2
    body = (
        F.when(second & (F.col("fault") == 3), "<html>")
        .when(percent == 0, '[{"message":[{"id":"120","value":"none"}]}]')
        .when(percent == 1, '[{"pages":9},null]')
        .otherwise(F.concat(F.lit('[{"pages":'), announced, F.lit("},"), records, F.lit("]")))
    )
    return lines.where(~(second & (F.col("fault") == 1))).select(
        F.concat(F.lit("O"), "l_orderkey").alias("iso3"),
        F.when(F.col("l_linestatus") == "O", "SP.POP.TOTL").otherwise("SH.MED.BEDS.ZS").alias("indicator_code"),
        "page",
        F.when(second & (F.col("fault") == 2), 500).when((tax == 8) & (percent > 5), 404).otherwise(200).alias("status"),
        body.alias("body"),
    )


def worldbank_series(spark: SparkSession, sf: str) -> DataFrame:
    rows = indicators.worldbank_rows(_worldbank_pages(spark, sf))
    return rows.groupBy("iso3", "indicator_code", "indicator_name", "year").agg(
        F.count("*").alias("rows"), F.sum("value").alias("value")
    )


def request_status(spark: SparkSession, sf: str) -> DataFrame:
    """What became of every request of both sources."""
    who = indicators.who_outcomes(_who_pages(spark, sf)).select(F.lit("who").alias("api"), "*")
    bank = indicators.worldbank_outcomes(_worldbank_pages(spark, sf)).select(F.lit("worldbank").alias("api"), "*")
    return who.unionByName(bank)


def fertility_bins(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as one-record payloads; a slice is a nation and an order year."""
    orders = table(spark, sf, "orders").join(
        table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey"
    )
    nation, status, priority = F.col("c_nationkey"), F.col("o_orderstatus"), F.col("o_orderpriority")
    low = 10 + 5 * (F.col("o_custkey") % 9)
    low, high = low.cast("string"), (low + 4).cast("string")
    style, spelling = F.col("o_orderkey") % 4, F.col("o_orderkey") % 5
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    variant = (
        F.when(priority == "1-URGENT", " Upper80 ").when(priority == "2-HIGH", "high")
        .when(priority == "3-MEDIUM", F.when(nation == 24, " ").when(nation >= 20, "Main").otherwise("Median"))
        .when(priority == "4-NOT SPECIFIED", F.when(F.year("o_orderdate") >= 2000, "other").otherwise("Lower95"))
        .otherwise("Low")
    )
    record = _object(
        _field("sexId", F.when(status == "F", F.when(nation < 5, "3").otherwise("2"))),
        _field("SexID", F.when(status == "O", F.when(nation < 5, "1").otherwise('"3"'))),
        _field("sex_id", F.when(status == "P", '"both"')),
        _field("variantShortName", _quoted(variant)),
        _field("ageStart", F.when(style == 0, low)),
        _field("AgeStart", F.when(style == 1, _quoted(low))),
        _field("ageGrpStart", F.when(style == 3, '"x"')),
        _field("ageEnd", F.when(style == 0, high).when(style == 3, high)),
        _field("ageLabel", F.when(style == 2, _quoted(F.concat(low, F.lit(" – "), high))).when(style == 1, '"20-24"')),
        _field("value", F.when(spelling == 1, "null").when(spelling != 0, price)),
        _field("Value", F.when(spelling == 1, '"junk"')),
        _field("Val", F.when(spelling == 0, _quoted(price))),
    )
    listed = F.concat(F.lit("["), record, F.when(style == 3, ',"not an object"]').otherwise("]"))
    name = (
        F.when(priority == "2-HIGH", "data").when(priority == "3-MEDIUM", "items")
        .when(priority == "4-NOT SPECIFIED", "records").otherwise("result")
    )
    bare = priority == "1-URGENT"
    body = F.concat(
        F.when(bare, "").otherwise(F.concat(F.lit('{"count":1,"'), name, F.lit('":'))), listed, F.when(bare, "").otherwise("}")
    )
    pages = orders.select(
        F.concat(F.lit("N"), nation).alias("iso3"), F.year("o_orderdate").alias("year"),
        F.col("o_orderkey").alias("page"), F.lit(200).alias("status"), body.alias("body"),
    )
    return demography.fertility_rows(pages)


def envelope_explode(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns wrapped in a payload and taken out again, text and all."""
    turn = F.struct("turn", "role", "text")
    pages = table(spark, sf, "conversations").select(
        "conv_id",
        F.col("turn").alias("page"),
        F.lit(200).alias("status"),
        F.when(F.col("role") == "user", F.to_json(F.array(turn)))
        .otherwise(F.to_json(F.struct(F.array(turn).alias("records")))).alias("body"),
    )
    records = payloads.envelope_records(pages, ["conv_id"])
    texts, f = fields.unpack(records, "rec", {n: [n] for n in ("turn", "role", "text")})
    text = f["text"].text()
    return texts.select(
        "conv_id",
        f["turn"].whole().alias("turn"),
        f["role"].text().alias("role"),
        F.sha2(text.cast("binary"), 256).alias("sha256"),
        F.length(text).alias("chars"),
    )


QUERIES = {
    "who_series": who_series,
    "worldbank_series": worldbank_series,
    "request_status": request_status,
    "fertility_bins": fertility_bins,
    "envelope_explode": envelope_explode,
}

_WHO = """
named(event_type, indicator_code, indicator_name) AS (VALUES
  ('click', 'HIV_0000000001', 'People living with HIV'),
  ('view', 'WHOSIS_000001', 'Life expectancy at birth'),
  ('signup', 'WHS3_49', 'NTD interventions'),
  ('error', 'MDG_0000000020', 'TB incidence per 100k'),
  ('purchase', 'NCDMORT3070', 'Prob. dying 30-70 from NCD (%)')),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS page,
         count(*) OVER (PARTITION BY user_id, event_type) AS n, (user_id + length(event_type)) % 12 AS fault
  FROM events),
who_read AS (
  SELECT e.*, CASE WHEN page = 2 AND fault = 2 THEN 'failed' WHEN value > 300 THEN 'gone'
                   WHEN page = 2 AND fault = 3 THEN 'malformed' WHEN page = n AND fault <> 1 THEN 'complete' END AS what,
         coalesce(max(page) OVER (PARTITION BY user_id, event_type ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM numbered e WHERE NOT (page = 2 AND fault = 0)),
who_ends AS (
  SELECT user_id, event_type, max(page) AS top, count(*) AS pages, bool_or(coalesce(what = 'gone', false)) AS gone,
         min({'page': CASE WHEN page > before + 1 THEN before + 1 ELSE page END,
              'what': CASE WHEN page > before + 1 THEN 'gap' ELSE what END}) FILTER (what IS NOT NULL OR page > before + 1) AS e
  FROM who_read GROUP BY ALL),
who_state AS (
  SELECT user_id, event_type, pages, CASE WHEN gone THEN 'gone' ELSE coalesce(e.what, 'open') END AS state, coalesce(e.page, top + 1) AS at_page
  FROM who_ends)"""

_BANK = """
bank_lines AS (
  SELECT l_orderkey, l_linestatus, CAST(round(l_discount * 100) AS INTEGER) AS pct, CAST(round(l_tax * 100) AS INTEGER) AS tax,
         CAST(year(l_shipdate) AS INTEGER) AS year, l_quantity, l_orderkey % 13 AS fault,
         row_number() OVER (PARTITION BY l_orderkey, l_linestatus ORDER BY l_linenumber, l_shipdate, l_quantity, l_discount, l_tax) AS page,
         count(*) OVER (PARTITION BY l_orderkey, l_linestatus) AS n
  FROM lineitem),
bank_read AS (
  SELECT *, CASE WHEN page = 2 AND fault = 2 THEN 3 WHEN tax = 8 AND pct > 5 THEN 1 WHEN page = 2 AND fault = 3 THEN 4
                 WHEN pct IN (0, 1) THEN 2 WHEN pct = 2 OR page >= n + CASE WHEN fault = 0 THEN 1 ELSE 0 END THEN 0 END AS code,
         coalesce(max(page) OVER (PARTITION BY l_orderkey, l_linestatus ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM bank_lines WHERE NOT (page = 2 AND fault = 1)),
bank_ends AS (
  SELECT l_orderkey, l_linestatus, max(page) AS top, count(*) AS pages,
         min(CASE WHEN page > before + 1 THEN (before + 1) * 8 + 5 ELSE page * 8 + code END) AS e
  FROM bank_read GROUP BY ALL),
bank_state AS (
  SELECT l_orderkey, l_linestatus, pages, e % 8 AS code, coalesce(e // 8, top + 1) AS at_page,
         coalesce(['complete', 'gone', 'complete', 'failed', 'malformed', 'gap'][e % 8 + 1], 'open') AS state
  FROM bank_ends),
bank_kept AS (
  SELECT r.* FROM bank_read r JOIN bank_state s USING (l_orderkey, l_linestatus)
  WHERE (s.code = 0 AND page <= at_page) OR (s.code = 2 AND page < at_page))"""

_BANK_CODE = "CASE WHEN l_linestatus = 'O' THEN 'SP.POP.TOTL' ELSE 'SH.MED.BEDS.ZS' END"

SQL = {
    "request_status": f"""
WITH {_WHO}, {_BANK}
SELECT 'who' AS api, 'U' || user_id AS iso3, indicator_code, state, CAST(at_page AS INTEGER) AS at_page, pages,
       CASE state WHEN 'complete' THEN at_page ELSE 0 END AS records
FROM who_state JOIN named USING (event_type)
UNION ALL
SELECT 'worldbank', 'O' || l_orderkey, {_BANK_CODE}, state, CAST(at_page AS INTEGER), pages,
       coalesce((SELECT sum(CASE WHEN pct = 3 THEN 5 ELSE 4 END) FROM bank_kept k
                 WHERE k.l_orderkey = s.l_orderkey AND k.l_linestatus = s.l_linestatus), 0)::BIGINT
FROM bank_state s""",
    "who_series": f"""
WITH {_WHO},
e AS (
  SELECT r.*, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM who_read r JOIN who_state s USING (user_id, event_type)
  WHERE state = 'complete'),
rows AS (
  SELECT 'U' || user_id AS iso3, indicator_code, indicator_name, event_id,
         CAST(2000 + day(ts) % 27 AS INTEGER) AS year,
         CASE WHEN k < 5 THEN 0.0 ELSE value END AS numeric_value,
         CASE e.event_type WHEN 'click' THEN value WHEN 'view' THEN 1.5 END AS low_value,
         CAST(NULL AS DOUBLE) AS high_value,
         CASE e.event_type WHEN 'click' THEN 'SEX_FMLE' WHEN 'view' THEN 'SEX' WHEN 'error' THEN ''
              WHEN 'purchase' THEN 'SEX_MLE' ELSE 'BTSX' END AS sex,
         CASE e.event_type WHEN 'view' THEN 'YEARS15-49' ELSE 'TOTAL' END AS age_group
  FROM e JOIN named USING (event_type)
  -- A number of zero falls back to the text value, which is junk from k = 20 on.
  WHERE (k < 5 OR k BETWEEN 10 AND 14 OR (k >= 20 AND value <> 0)) AND day(ts) <> 31
)
SELECT DISTINCT ON (iso3, indicator_code, year, sex, age_group)
       iso3, indicator_code, year, sex, age_group, numeric_value, low_value, high_value, indicator_name
FROM rows ORDER BY iso3, indicator_code, year, sex, age_group, event_id DESC""",
    "worldbank_series": f"""
WITH {_BANK},
rows AS (
  SELECT l_orderkey, l_linestatus, year, unnest([l_quantity, 0.0]) AS value FROM bank_kept)
SELECT 'O' || l_orderkey AS iso3, {_BANK_CODE} AS indicator_code,
       CASE WHEN l_linestatus = 'O' THEN 'Total population' ELSE 'Hospital beds per 1000' END AS indicator_name,
       year, count(*) AS rows, sum(value) AS value
FROM rows WHERE year BETWEEN 2000 AND 2026 GROUP BY ALL""",
    "fertility_bins": """
WITH r AS (
  SELECT 'N' || c_nationkey AS iso3, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey,
         CASE o_orderstatus WHEN 'F' THEN CASE WHEN c_nationkey < 5 THEN 3 ELSE 2 END
              WHEN 'O' THEN CASE WHEN c_nationkey < 5 THEN 1 ELSE 3 END END AS sex,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'UPPER80' WHEN '2-HIGH' THEN 'HIGH'
              WHEN '3-MEDIUM' THEN CASE WHEN c_nationkey = 24 THEN NULL WHEN c_nationkey >= 20 THEN 'MAIN' ELSE 'MEDIAN' END
              WHEN '4-NOT SPECIFIED' THEN CASE WHEN year(o_orderdate) >= 2000 THEN 'OTHER' ELSE 'LOWER95' END
              ELSE 'LOW' END AS variant,
         10 + 5 * (o_custkey % 9) AS a, o_orderkey % 4 AS style, o_orderkey % 5 AS spelling, o_totalprice
  FROM orders JOIN customer ON o_custkey = c_custkey
),
g AS (SELECT * FROM r WHERE sex IS NOT NULL AND variant IS NOT NULL),
sexes AS (SELECT iso3, year, min(sex) AS sex FROM g WHERE sex IN (2, 3) GROUP BY ALL),
cand(bucket, variant, rank) AS (VALUES
  ('LOWER95', 'LOWER95', 0), ('LOWER95', 'LOWER80', 1), ('LOWER95', 'LOW', 2),
  ('MEDIAN', 'MEDIAN', 0), ('MEDIAN', 'EST', 1), ('MEDIAN', 'ESTIMATE', 2), ('MEDIAN', 'MAIN', 3),
  ('UPPER95', 'UPPER95', 0), ('UPPER95', 'UPPER80', 1), ('UPPER95', 'HIGH', 2)),
best AS (
  SELECT g.iso3, g.year, g.sex, bucket, arg_min(cand.variant, rank) AS variant
  FROM g JOIN sexes USING (iso3, year, sex) JOIN cand ON g.variant = cand.variant GROUP BY ALL
),
chosen AS (
  SELECT * FROM best WHERE (iso3, year) IN (SELECT (iso3, year) FROM best GROUP BY iso3, year HAVING count(*) = 3)
),
bins AS (
  SELECT g.iso3, g.year, bucket AS variant_short_name, CAST(a AS INTEGER) AS age_min,
         CAST(CASE WHEN style = 1 THEN a ELSE a + 4 END AS INTEGER) AS age_max, o_totalprice AS asfr, o_orderkey
  FROM g JOIN chosen c ON g.iso3 = c.iso3 AND g.year = c.year AND g.sex = c.sex AND g.variant = c.variant
  WHERE style <> 3 AND spelling <> 1
)
SELECT DISTINCT ON (iso3, year, variant_short_name, age_min, age_max)
       iso3, year, variant_short_name, age_min, age_max, asfr, 'UN_WPP' AS source, '2024' AS release
FROM bins WHERE age_min >= 15 AND age_max <= 49
ORDER BY iso3, year, variant_short_name, age_min, age_max, o_orderkey DESC""",
    "envelope_explode": """
SELECT conv_id, CAST(turn AS INTEGER) AS turn, role, sha256(text) AS sha256, CAST(length(text) AS INTEGER) AS chars
FROM conversations""",
}
