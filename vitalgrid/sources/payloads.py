"""Landed API pages to records.

A landed page is one row: the request's key columns, page number from 1 on, HTTP
status and body. Records come out as VARIANT ``rec`` with ``_page`` and ``_pos``, their delivery
order.

The pages of a request are a chain that is read from the first page to the one
that ends it. How far that goes is data too: ``odata_chain`` and ``pair_chain``
parse every body once and bring the pages of a request together once; what they
give holds the records of the requests that came through (``accepted``), and says
of every other one why not (``outcomes``, ``rejected``). "Nothing there" (404) and
"no answer" are kept apart, and a request that broke off never passes for a short
or an empty one. ``strict`` fails the load at the first such request instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.functions.fields import once
from vitalgrid.functions.flights import window_date
from vitalgrid.refdata import ENVELOPE_NAMES
from vitalgrid.session import materialise

RECORDS = "array<variant>"

# What a page does to the reading of its request, the first of these where a page was landed more than once.
LAST, MISSING, NO_LIST, FAILED, MALFORMED, GAP = range(6)
STATES = {LAST: "complete", MISSING: "gone", NO_LIST: "complete", FAILED: "failed", MALFORMED: "malformed", GAP: "gap"}
OPEN = "open"  # the chain goes on beyond the last page that was landed
GOOD = ("complete", "gone")


def _chain(parsed: DataFrame, keys: list[str], gone_anywhere: bool) -> DataFrame:
    """keys, _page, _state, _at, _records from keys, _page, _what (NULL: the chain goes on), _list.

    ``_at`` is the page at which reading ended or broke off. ``_records`` are
    NULL where the page is not part of what was read. One exchange by request,
    sorted by page, serves all of it; a request is a sequence and stays in one task.
    """
    request = Window.partitionBy(*keys)
    in_order = request.orderBy("_page")
    bad = F.col("_what").isin(FAILED, MALFORMED)
    # A page that was landed again and answered then has not failed.
    answered = F.max(F.coalesce(~bad, F.lit(True))).over(in_order.rangeBetween(Window.currentRow, Window.currentRow))
    following = F.coalesce(F.max("_page").over(in_order.rangeBetween(Window.unboundedPreceding, -1)), F.lit(0)) + 1
    seen = parsed.withColumns({"_answered": answered, "_next": following})
    event = F.least(
        F.when(~(bad & F.col("_answered")), F.col("_page") * 8 + F.col("_what")),
        F.when(F.col("_page") > F.col("_next"), F.col("_next") * 8 + GAP),
    )
    seen = seen.withColumn("_event", event)
    first = F.min("_event").over(request)
    folded = seen.withColumns(
        {
            "_first": first,
            "_top": F.max("_page").over(request),
            "_gone": F.max(F.coalesce(F.col("_what") == MISSING, F.lit(False))).over(request) if gone_anywhere else F.lit(False),
        }
    )
    why, at = F.pmod("_first", F.lit(8)), F.floor(F.col("_first") / 8)
    state = F.when(F.col("_gone"), STATES[MISSING]).when(F.col("_first").isNull(), OPEN)
    for code, name in STATES.items():
        state = state.when(why == code, name)
    read = ~F.col("_gone") & (((why == LAST) & (F.col("_page") <= at)) | ((why == NO_LIST) & (F.col("_page") < at)))
    return folded.select(
        *keys, "_page", state.alias("_state"), F.coalesce(at, F.col("_top") + 1, F.lit(1)).alias("_at"), F.when(read, F.col("_list")).alias("_records")
    )


def _answer(pages: DataFrame, keys: list[str], what: Column, listed: Column) -> DataFrame:
    """The pages with what each does and its records, from the body parsed once (``_doc``, NULL if it is not JSON)."""
    body = F.when(F.col("status") == 200, F.col("body"))
    parsed = once(pages.select(*keys, F.col("page").cast("bigint").alias("_page"), "status", body.alias("_body")), F.try_parse_json("_body").alias("_doc"))
    what = (
        F.when(F.col("status") == 404, MISSING)
        .when(~F.col("status").eqNullSafe(200), FAILED)
        .when(F.col("_doc").isNull(), MALFORMED)
        .otherwise(what)
    )
    return parsed.select(*keys, "_page", what.alias("_what"), listed.alias("_list"))


def odata_chain(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Chains of pages with their records under ``value`` and a link to the next page.

    A page without a link is the last. A 404 on any page empties the whole
    request, earlier pages included. A page without a list holds no records.
    """
    link = F.try_variant_get("_doc", '$["@odata.nextLink"]', "string")
    what = F.when(link.isNull() | (link == ""), LAST)
    return _chain(_answer(pages, keys, what, F.try_variant_get("_doc", "$.value", RECORDS)), keys, True)


def pair_chain(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Chains of ``[metadata, records]`` pages.

    Reading a request ends at its first page that is missing (nothing is kept),
    has no record list (earlier pages are kept), or is the last one announced
    by its metadata (that page is kept too).
    """
    listed = F.try_variant_get("_doc", "$[1]", "variant")
    announced = F.coalesce(F.try_variant_get("_doc", "$[0].pages", "int"), F.lit(1))
    what = F.when(listed.isNull() | F.is_variant_null(listed), NO_LIST).when(F.col("_page") >= announced, LAST)
    return _chain(_answer(pages, keys, what, F.try_variant_get("_doc", "$[1]", RECORDS)), keys, False)


def accepted(chain: DataFrame, keys: list[str]) -> DataFrame:
    """Records of the requests that were read to their end: keys, _page, _pos, rec."""
    return chain.select(*keys, "_page", F.posexplode("_records").alias("_pos", "rec"))


def outcomes(chain: DataFrame, keys: list[str]) -> DataFrame:
    """keys, state, at_page, pages, records of every request.

    ``state`` is complete or gone, or why the request cannot be used: a page
    ``failed``, was ``malformed`` or is not there though later ones are (``gap``),
    or the chain goes on where nothing was landed (``open``); ``at_page`` is that
    page, or the one that ended the request.
    """
    return chain.groupBy(*keys).agg(
        F.max("_state").alias("state"),
        F.max("_at").cast("int").alias("at_page"),
        F.count(F.lit(1)).alias("pages"),
        F.sum(F.when(F.col("_records").isNotNull(), F.size("_records")).otherwise(0)).alias("records"),
    )


def rejected(chain: DataFrame, keys: list[str]) -> DataFrame:
    """The requests that gave nothing because they broke off, and why."""
    return outcomes(chain.where(~F.col("_state").isin(*GOOD)), keys).drop("records")


def strict(chain: DataFrame, keys: list[str]) -> DataFrame:
    """The same chains; reading one that broke off fails."""
    named = F.concat_ws("/", *[F.col(k).cast("string") for k in keys])
    message = F.concat(F.lit("request "), named, F.lit(" is "), F.col("_state"), F.lit(" at page "), F.col("_at"))
    checked = F.when(F.col("_state").isin(*GOOD), F.col("_records")).otherwise(F.raise_error(message).cast(RECORDS))
    return chain.withColumn("_records", checked)


def split(chain: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame, str]:
    """(accepted records, rejected requests, folder): both from one reading of the bodies, kept in the folder."""
    kept, path = materialise(chain)
    return accepted(kept, keys), rejected(kept, keys), path


def _first_list(doc: Column) -> Column:
    """The record list of a document: itself, or the first list under a known name; NULL if there is none."""
    return F.coalesce(*[F.try_variant_get(doc, path, RECORDS) for path in ["$"] + [f"$.{name}" for name in ENVELOPE_NAMES]])


def envelope_chain(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Payloads that wrap their list in different ways: each is whole in itself, so it is used or it is not."""
    body = F.when(F.col("status") == 200, F.col("body"))
    parsed = once(pages.select(*keys, F.col("page").alias("_page"), "status", body.alias("_body")), F.try_parse_json("_body").alias("_doc"))
    listed = once(parsed, _first_list(F.col("_doc")).alias("_records"))
    state = (
        F.when(~F.col("status").eqNullSafe(200), STATES[FAILED])
        .when(F.col("_records").isNull(), STATES[MALFORMED])
        .otherwise(STATES[LAST])
    )
    return listed.select(*keys, "_page", state.alias("_state"), F.col("_page").alias("_at"), "_records")


def envelope_records(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Records of payloads that wrap their list in different ways; one without a list fails the scan."""
    chain = envelope_chain(pages, keys)
    message = F.when(F.col("_state") == STATES[FAILED], F.lit("unexpected HTTP status")).otherwise("payload holds no record list")
    checked = F.when(F.col("_state") == STATES[LAST], F.col("_records")).otherwise(F.raise_error(message).cast(RECORDS))
    return accepted(chain.withColumn("_records", checked), keys)


# Fields of an arrivals record that are read.
ARRIVAL = "array<struct<estDepartureAirport:string,icao24:string,callsign:string>>"


def quarantined(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the log without answers that cannot be read, those answers and why).

    A request whose only answer is malformed then counts as unreachable, and the
    load goes on.
    """
    some = (F.col("status") == 200) & F.col("body").isNotNull() & (F.trim("body") != "null")
    flights = F.try_variant_get(F.try_parse_json("body"), "$", "array<map<string,variant>>")
    marked = once(log, (some & flights.isNull()).alias("_bad"))
    good = marked.where(~F.coalesce("_bad", F.lit(False))).drop("_bad")
    return good, marked.where("_bad").drop("_bad").withColumn("state", F.lit(STATES[MALFORMED]))


def fetch_outcomes(log: DataFrame) -> DataFrame:
    """One row per arrivals request: the attempt that answered, NULL if none did.

    200 and 404 are answers. A request without one is unreachable, which is
    not the same as no flights.
    """
    answered = F.col("status").isin(200, 404)
    return (
        log.groupBy("airport", "begin", "end")
        .agg(F.min(F.when(answered, F.col("attempt"))).alias("answered_at"))
        .select(
            F.upper(F.trim("airport")).alias("airport"), "begin", "end", "answered_at",
            window_date(F.col("begin")).alias("date"),
            F.col("answered_at").isNull().alias("unreachable"),
        )
    )


def arrivals(log: DataFrame) -> DataFrame:
    """Arriving flights of every answered request; a null body means none.

    The first answer ends a request, so later attempts are left out. Columns
    the log has beyond its own are passed on to the flights.
    """
    request = ["airport", "begin", "end"]
    extra = [c for c in log.columns if c not in (*request, "attempt", "status", "body")]
    answers = log.where(F.col("status").isin(200, 404))
    first = answers.groupBy(*request).agg(F.min("attempt").alias("attempt"))
    some = F.col("body").isNotNull() & (F.trim("body") != "null")
    flights = answers.where((F.col("status") == 200) & some).join(first, [*request, "attempt"], "left_semi")
    return flights.select(
        F.upper(F.trim("airport")).alias("airport"),
        window_date(F.col("begin")).alias("date"),
        *extra,
        F.explode(F.from_json("body", ARRIVAL, {"mode": "FAILFAST"})).alias("f"),
    ).select("airport", "date", *extra, "f.*")
