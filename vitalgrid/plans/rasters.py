"""Raster catalog loads: store files, totals, yearly mosaics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.functions import files
from vitalgrid.operators import catalog as cat
from vitalgrid.operators import merge, pick, raster, warp
from vitalgrid.refdata import NODATA
from vitalgrid.sources.tiles import band, cells


def store(
    catalog: DataFrame, found: DataFrame, stage: str, run_id: str, now: Column | None = None, order: list[str] | None = None
) -> DataFrame:
    """The catalog after storing files: a file replaces its older entries.

    Of several files of one name the last by ``order`` stays. New rows get ids
    above the stored ones and ``created_at``, where the catalog has it; two loads
    at the same time would give equal ids, so one writer at a time.
    """
    found = found.withColumn("_name", files.base_name(F.col("path")))
    new = cat.entries(pick.last_write_wins(found, ["_name"], order) if order else found, stage, run_id)
    if "id" in catalog.columns:
        top = catalog.agg(F.max("id")).first()[0] or 0
        new = new.withColumn("id", F.monotonically_increasing_id() + (top + 1))
    if "created_at" in catalog.columns:
        new = new.withColumn("created_at", F.current_timestamp() if now is None else now)
    return merge.replace_slices(catalog, new, ["stage", "filename"])


def with_totals(
    catalog: DataFrame, tiles: DataFrame, stage: str, force: bool = False, nodata: float = NODATA
) -> DataFrame:
    """The catalog with totals of the files that lack one (all when forced).

    ``tiles`` carries ``filename``. Files with a total are left out before
    their tiles are summed.
    """
    todo = cat.without_total(cat.flags(catalog), band(tiles), stage, force)
    totals = raster.masked_sum(todo, ["filename"], nodata)
    new = totals.select(F.lit(stage).alias("stage"), "filename", F.col("total").alias("exact_total"))
    return merge.set_column(catalog, new, ["stage", "filename"], "exact_total")


def year_mosaic(tiles: DataFrame, nodata: float = NODATA) -> DataFrame:
    """Tiles of one year's countries merged; the later file name wins an overlap."""
    return raster.mosaic(tiles, "filename", nodata)


def world_mosaic(tiles: DataFrame, meta: DataFrame, cell: float, side: int, nodata: float = NODATA) -> DataFrame:
    """The mosaic of rasters of any place, extent and cell size on the Web Mercator grid of the world.

    ``tiles`` are those of ``raster_id`` (the file name) in degrees, ``meta`` says
    how each raster lies; ``cell`` is the size of a target cell in metres, ``side``
    the cells of a target tile.
    """
    rows, cols = warp.world_axes(cell)
    warped = warp.warp(warp.placed(tiles, meta), rows, cols, side, nodata)
    return raster.mosaic(warped, "raster_id", nodata)


def with_overviews(mosaic_tiles: DataFrame, levels: int, side: int, nodata: float = NODATA) -> DataFrame:
    """Valid cells (level, row, col, value) of a mosaic, level 0, and of its overviews."""
    named = mosaic_tiles.withColumn("raster_id", F.lit("combined"))
    base = cells(mosaic_tiles, side, side, nodata).select(F.lit(0).alias("level"), "row", "col", F.col("value").cast("double").alias("value"))
    coarser = raster.overviews(named, levels, side, side, nodata).drop("raster_id")
    return base.withColumns({"row": F.col("row").cast("int"), "col": F.col("col").cast("int")}).unionByName(coarser)


def mosaic_total(mosaic_tiles: DataFrame, nodata: float = NODATA) -> DataFrame:
    """Total of a mosaic. It is taken on resampled cells and so differs from the
    sum of the raw totals."""
    return raster.masked_sum(mosaic_tiles.withColumn("raster_id", F.lit("combined")), ["raster_id"], nodata)
