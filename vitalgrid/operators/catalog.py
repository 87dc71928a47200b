"""The file catalog: entries, existence, next step, manifests, rewrite report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.functions import files


def entries(found: DataFrame, stage: str, run_id: str) -> DataFrame:
    """Catalog rows of files read with their content."""
    name = files.base_name(F.col("path"))
    return found.select(
        F.lit(stage).alias("stage"),
        name.alias("filename"),
        F.lit(run_id).alias("run_id"),
        F.sha2("content", 256).alias("sha256"),
        F.col("length").cast("bigint").alias("size_bytes"),
        files.content_type(name).alias("content_type"),
    )


def flags(catalog: DataFrame) -> DataFrame:
    """Per file name: is it cataloged, and does it have a total, for each stage."""
    raw, cog = F.col("stage") == "raw", F.col("stage") == "cog"
    return catalog.groupBy("filename").agg(
        F.max(raw).alias("in_raw"),
        F.max(raw & F.col("exact_total").isNotNull()).alias("raw_total"),
        F.max(cog).alias("in_cog"),
        F.max(cog & F.col("exact_total").isNotNull()).alias("cog_total"),
    )


def newest(catalog: DataFrame) -> DataFrame:
    """The row with the greatest id per (stage, filename)."""
    from vitalgrid.operators.pick import latest_per_key

    return latest_per_key(catalog, ["stage", "filename"], ["id"])


def without_total(catalog_flags: DataFrame, work: DataFrame, stage: str, force: bool = False) -> DataFrame:
    """Work whose total is not stored yet; all of it when forced."""
    if force:
        return work
    done = catalog_flags.where(F.col(f"{stage}_total")).select("filename")
    return work.join(done, "filename", "left_anti")


def step(raw_usable: Column, in_raw: Column, raw_total: Column, warped_usable: Column, in_cog: Column) -> Column:
    """The first step that is still to do."""

    def no(c: Column) -> Column:
        return ~F.coalesce(c, F.lit(False))

    return (
        F.when(no(raw_usable), "download_raw")
        .when(no(in_raw), "store_raw")
        .when(no(raw_total), "rio_calc")
        .when(no(warped_usable), "warp_web_mercator")
        .when(~no(in_cog), "skip")
        .otherwise("to_cog")
    )


def worklist(requests: DataFrame, listing: DataFrame, catalog: DataFrame) -> DataFrame:
    """Requests with their next step.

    ``listing``: ``path, length``; ``requests`` as from ``raster_requests``.
    """
    sizes = listing.groupBy(files.base_name(F.col("path")).alias("name")).agg(F.max("length").alias("length"))
    known = flags(catalog)
    raw = sizes.select(F.col("name").alias("raw_name"), files.usable(F.col("length")).alias("raw_usable"))
    warped = sizes.select(F.col("name").alias("warped_name"), files.usable(F.col("length")).alias("warped_usable"))
    stored = known.select(F.col("filename").alias("raw_name"), "in_raw", "raw_total")
    cogs = known.select(F.col("filename").alias("cog_name"), "in_cog")
    joined = (
        requests.join(raw, "raw_name", "left")
        .join(stored, "raw_name", "left")
        .join(warped, "warped_name", "left")
        .join(cogs, "cog_name", "left")
    )
    next_step = step(*[F.col(c) for c in ("raw_usable", "in_raw", "raw_total", "warped_usable", "in_cog")])
    return joined.select(*requests.columns, next_step.alias("next_step"))


def manifest_diff(local: DataFrame, remote: DataFrame) -> DataFrame:
    """``keep`` where both sizes are known and equal, else ``refetch``.

    ``local``: ``path, local_size``; ``remote``: ``path, remote_size``. Files
    that are only local are listed as ``unlisted``.
    """
    joined = local.withColumn("_l", F.lit(True)).join(
        remote.withColumn("_r", F.lit(True)), "path", "full_outer"
    )
    same = F.col("local_size").isNotNull() & F.col("local_size").eqNullSafe(F.col("remote_size"))
    action = F.when(F.col("_r").isNull(), "unlisted").when(same, "keep").otherwise("refetch")
    return joined.select("path", "local_size", "remote_size", action.alias("action"))


def live(catalog: DataFrame, blobs: DataFrame, key: str = "lo_oid") -> DataFrame:
    """Catalog rows whose blob still exists."""
    return catalog.join(blobs.select(key).distinct(), key, "left_semi")


def stale(catalog: DataFrame, blobs: DataFrame, key: str = "lo_oid") -> DataFrame:
    """Catalog rows whose blob is gone."""
    return catalog.join(blobs.select(key).distinct(), key, "left_anti")


def orphans(catalog: DataFrame, blobs: DataFrame, key: str = "lo_oid") -> DataFrame:
    """Blobs no catalog row points at."""
    return blobs.join(catalog.select(key).distinct(), key, "left_anti")


def rewrite_report(results: DataFrame) -> DataFrame:
    """Counts and sizes per status and over all.

    ``results``: ``status, before, after``; the total row has status ``total``.
    """
    summed = results.rollup("status").agg(
        F.grouping("status").alias("_all"),
        F.count("*").alias("files"),
        F.sum("before").alias("before"),
        F.sum("after").alias("after"),
    )
    before, after = F.col("before"), F.col("after")
    return summed.select(
        F.when(F.col("_all") == 1, "total").otherwise(F.col("status")).alias("status"),
        "files", "before", "after",
        (before - after).alias("saved"),
        files.human_bytes(before).alias("before_text"),
        files.human_bytes(after).alias("after_text"),
        F.round(files.percent_saved(before, after), 1).alias("percent"),
    )
