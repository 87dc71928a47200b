"""Raster tiles: ``raster_id, band, tile_row, tile_col, width, height, nodata, values``.

``values`` is the row-major cell array of one block. Cells are numbered over
the whole raster from the tile's position and the nominal tile size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TILE = (
    "raster_id string, band int, tile_row int, tile_col int, width int, height int, "
    "nodata double, values array<float>"
)


def band(tiles: DataFrame, index: int = 1) -> DataFrame:
    """The tiles of one band. A raster that lacks the band fails the read.

    ``bands`` is the band count of the raster, where the table carries it.
    """
    if index < 1:
        raise ValueError(f"invalid band {index}")
    if "bands" in tiles.columns:
        bad = F.raise_error(F.concat(F.lit(f"invalid band {index} for raster "), F.col("raster_id").cast("string")))
        tiles = tiles.where(F.when(F.col("bands") < index, bad.cast("boolean")).otherwise(True))
    return tiles.where(F.col("band") == index)


def cells(tiles: DataFrame, tile_height: int, tile_width: int, nodata: float | None) -> DataFrame:
    """Valid cells as rows: the tile's other columns, ``row``, ``col``, ``value``."""
    keep = [c for c in tiles.columns if c not in ("values", "tile_row", "tile_col", "width", "height", "nodata")]
    exploded = tiles.select(
        *keep, "tile_row", "tile_col", "width",
        *([] if nodata is not None else ["nodata"]),
        F.posexplode("values").alias("_k", "value"),
    )
    empty = F.lit(nodata) if nodata is not None else F.col("nodata")
    valid = exploded.where(F.col("value").isNotNull() & ~F.col("value").cast("double").eqNullSafe(empty))
    return valid.select(
        *keep,
        (F.col("tile_row") * tile_height + F.floor(F.col("_k") / F.col("width")).cast("int")).alias("row"),
        (F.col("tile_col") * tile_width + F.col("_k") % F.col("width")).alias("col"),
        "value",
    )
