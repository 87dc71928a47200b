"""Raster operators on tile tables: totals, mosaic, overviews.

Totals stay inside the scan stage. Mosaics and overviews move whole tiles or
pieces of them and lay them together with numpy, one tile in memory at a time.
A raster is never one partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.refdata import NODATA
from vitalgrid.sources.tiles import cells

TILE_KEY = ["raster_id", "tile_row", "tile_col"]


def _valid(value: Column, nodata: float | Column) -> Column:
    """Neither NULL nor the NoData value. NaN is a value."""
    empty = F.lit(nodata) if isinstance(nodata, float) else nodata
    return value.isNotNull() & (value.cast("double") != empty)


# --- totals -----------------------------------------------------------------------


def masked_sum(tiles: DataFrame, keys: list[str] | None = None, nodata: float | None = NODATA) -> DataFrame:
    """Sum and count of valid cells per raster, accumulated in double.

    NaN cells are not masked and make the sum NaN. With ``nodata=None`` the
    tile's own NoData value is used. Cells are expanded inside the scan stage
    and summed there; the shuffle carries one row per task and raster.
    """
    keys = keys or ["raster_id"]
    own = [] if nodata is not None else ["nodata"]
    expanded = tiles.select(*keys, *own, F.explode("values").alias("value"))
    empty = F.lit(nodata) if nodata is not None else F.col("nodata")
    masked = F.col("value").isNull() | F.col("value").cast("double").eqNullSafe(empty)
    return expanded.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(~masked, F.col("value").cast("double"))), F.lit(0.0)).alias("total"),
        F.count(F.when(~masked, 1)).alias("valid_count"),
    )


# --- mosaic -----------------------------------------------------------------------


def mosaic_cells(
    tiles: DataFrame, order: str, tile_height: int, tile_width: int, nodata: float = NODATA
) -> DataFrame:
    """Valid cells (row, col, value) of many rasters laid over each other.

    All inputs use one tile grid. Where several hold a valid cell the one with
    the greatest ``order`` wins. A cell is reduced to one candidate per task
    before the shuffle; a numeric ``order`` keeps that a hash aggregation.
    """
    laid = cells(tiles.select("tile_row", "tile_col", "width", "values", order), tile_height, tile_width, nodata)
    return laid.groupBy("row", "col").agg(F.max_by("value", order).alias("value"))


def mosaic(tiles: DataFrame, order: str, nodata: float = NODATA) -> DataFrame:
    """The mosaic as tiles (tile_row, tile_col, width, height, values); a place without a valid cell has none.

    All inputs use one tile grid. The tiles of a place are laid over each other
    in ``order``, the greatest last, while they pass through a task. They are
    dealt by range of place and order, so that a place which very many inputs
    cover is spread; what the first and the last place of a task come to, two
    tiles a task, is laid together in a second step.
    """
    kind = tiles.schema[order].dataType.simpleString()
    own = tiles.where(F.exists("values", lambda v: _valid(v, nodata))).select(
        "tile_row", "tile_col", F.col(order).alias("_order"), "width", "height", F.col("values").cast("array<float>").alias("values")
    )
    place = ["tile_row", "tile_col", "_order"]
    schema = f"tile_row int, tile_col int, _order {kind}, width int, height int, values array<float>, _cut boolean"

    def laid(dealt: DataFrame) -> DataFrame:
        return dealt.sortWithinPartitions(*place).mapInArrow(lambda batches: _laid(batches, nodata), schema)

    first = laid(own.repartitionByRange(*place))
    cut = laid(first.where("_cut").drop("_cut").repartition("tile_row", "tile_col"))
    return first.where("not _cut").unionByName(cut).select("tile_row", "tile_col", "width", "height", "values")


def _laid(batches: Iterator[pa.RecordBatch], nodata: float) -> Iterator[pa.RecordBatch]:
    """One tile for each place of a sorted stream of tiles; ``_cut`` marks the first and the last."""
    at = order = grid = kind = None
    cut, done = True, []

    def out() -> pa.RecordBatch:
        rows, cols, orders, grids, cuts = zip(*done)
        lists = [g.ravel() for g in grids]
        offsets = np.cumsum([0] + [len(x) for x in lists]).astype(np.int32)
        sizes = [pa.array([g.shape[i] for g in grids], pa.int32()) for i in (1, 0)]
        values = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(lists)))
        done.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int32()), pa.array(cols, pa.int32()), pa.array(orders, kind), *sizes, values, pa.array(cuts)],
            ["tile_row", "tile_col", "_order", "width", "height", "values", "_cut"],
        )

    for batch in batches:
        kind = batch.schema.field(2).type
        columns = [batch.column(i).to_pylist() for i in range(5)]
        lists = batch.column(5)
        for row, col, name, width, height, values in zip(*columns, lists):
            tile = values.values.fill_null(nodata).to_numpy(zero_copy_only=False).reshape(height, width)
            if at != (row, col):
                if at is not None:
                    done.append((*at, order, grid, cut))
                    cut = False
                at, grid = (row, col), np.full((height, width), nodata, np.float32)
            if grid.shape[0] < height or grid.shape[1] < width:
                larger = np.full(np.maximum(grid.shape, tile.shape), nodata, np.float32)
                larger[: grid.shape[0], : grid.shape[1]] = grid
                grid = larger
            under = grid[:height, :width]
            np.copyto(under, tile, where=tile.astype(np.float64) != nodata)
            order = name
        if done:
            yield out()
    if at is not None:
        done.append((*at, order, grid, True))
        yield out()


# --- overviews --------------------------------------------------------------------

PIECE = "tile_row int, tile_col int, top int, left int, height int, width int, sums binary, counts binary"


def _pieces(tiles: DataFrame, tile_height: int, tile_width: int, nodata: float, id_type: str) -> DataFrame:
    """What each tile gives to the next coarser level: sums and counts of its part of every 2x2 block.

    Blocks that a tile border cuts are given by several tiles and add up. A tile
    gives to one coarser tile only, a quarter of its size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            row, col, width, height = (batch.column(i).to_numpy().astype(np.int64) for i in range(1, 5))
            values, lengths = batch.column(5).flatten(), batch.column(5).value_lengths().to_numpy(zero_copy_only=False)
            cells = values.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)
            valid = ~values.is_null().to_numpy(zero_copy_only=False) & (cells != nodata)
            cells, starts = np.where(valid, cells, 0.0), np.cumsum(lengths) - lengths
            row0, col0 = row * tile_height, col * tile_width
            made = []
            # Tiles of one shape that start alike within a block are halved together.
            kinds, kind = np.unique(np.stack([height, width, row0 % 2, col0 % 2]), axis=1, return_inverse=True)
            for number, (h, w, odd_row, odd_col) in enumerate(kinds.T.tolist()):
                at = np.flatnonzero(kind.ravel() == number)
                where = (starts[at][:, None] + np.arange(h * w)).reshape(-1, h, w)
                # Start and end at whole blocks.
                pad = ((0, 0), (odd_row, (odd_row + h) % 2), (odd_col, (odd_col + w) % 2))
                shape = len(at), (h + sum(pad[1])) // 2, 2, (w + sum(pad[2])) // 2, 2
                sums = np.pad(cells[where], pad).reshape(shape).sum(axis=(2, 4))
                counts = np.pad(valid[where], pad).reshape(shape).sum(axis=(2, 4), dtype=np.uint8)
                for k in np.flatnonzero(counts.any(axis=(1, 2))):
                    i = at[k]
                    up, back = row[i] // 2, col[i] // 2
                    top, left = row0[i] // 2 - up * tile_height, col0[i] // 2 - back * tile_width
                    made.append((names[i], up, back, top, left, *counts.shape[1:], sums[k].tobytes(), counts[k].tobytes()))
            if made:
                columns = list(zip(*made))
                ints = [pa.array(c, pa.int32()) for c in columns[1:7]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], batch.schema.field(0).type), *ints, pa.array(columns[7], pa.binary()), pa.array(columns[8], pa.binary())],
                    ["raster_id", "tile_row", "tile_col", "top", "left", "height", "width", "sums", "counts"],
                )

    own = tiles.select("raster_id", "tile_row", "tile_col", "width", "height", "values")
    return own.mapInArrow(run, f"raster_id {id_type}, {PIECE}")


def _joined_pieces(pieces: DataFrame, tile_height: int, tile_width: int, nodata: float, id_type: str) -> DataFrame:
    """The tiles that pieces make up; a tile reaches as far as what lies below it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = sums = counts = None
        done, extent, kind = [], [0, 0], None

        def finished() -> tuple:
            h, w = extent
            return (*at, w, h, np.where(counts > 0, sums / np.maximum(counts, 1), nodata)[:h, :w].ravel())

        def out() -> pa.RecordBatch:
            columns = list(zip(*done))
            offsets = np.cumsum([0] + [len(x) for x in columns[5]]).astype(np.int32)
            values = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(columns[5])))
            done.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], kind), *(pa.array(c, pa.int32()) for c in columns[1:5]), values],
                ["raster_id", "tile_row", "tile_col", "width", "height", "values"],
            )

        for batch in batches:
            kind = batch.schema.field(0).type
            for name, row, col, top, left, h, w, s, n in zip(*(batch.column(i).to_pylist() for i in range(9))):
                if at != (name, row, col):
                    if at is not None:
                        done.append(finished())
                    at, extent = (name, row, col), [0, 0]
                    sums, counts = np.zeros((tile_height, tile_width)), np.zeros((tile_height, tile_width), np.uint8)
                part = slice(top, top + h), slice(left, left + w)
                sums[part] += np.frombuffer(s).reshape(h, w)
                counts[part] += np.frombuffer(n, np.uint8).reshape(h, w)
                extent = [max(extent[0], top + h), max(extent[1], left + w)]
            if done:
                yield out()
        if at is not None:
            done.append(finished())
            yield out()

    dealt = pieces.repartition(*TILE_KEY).sortWithinPartitions(*TILE_KEY, "top", "left")
    return dealt.mapInArrow(run, f"raster_id {id_type}, tile_row int, tile_col int, width int, height int, values array<double>")


def overview_tiles(tiles: DataFrame, levels: int, tile_height: int, tile_width: int, nodata: float = NODATA) -> DataFrame:
    """Overview levels 1..levels as tiles of the same nominal size, each the mean of the valid cells of 2x2 blocks of the level before.

    Tiles may have any size, odd ones and strips too. The exchange of a level
    carries a quarter of the cells before it and is read again, not made again,
    by the deeper levels; nothing is written in between.
    """
    id_type = tiles.schema["raster_id"].dataType.simpleString()
    out, current = None, tiles
    for level in range(1, levels + 1):
        pieces = _pieces(current, tile_height, tile_width, nodata, id_type)
        current = _joined_pieces(pieces, tile_height, tile_width, nodata, id_type)
        made = current.select("raster_id", F.lit(level).alias("level"), *current.columns[1:])
        out = made if out is None else out.unionByName(made)
    return out


def overviews(tiles: DataFrame, levels: int, tile_height: int, tile_width: int, nodata: float = NODATA) -> DataFrame:
    """Valid cells (raster_id, level, row, col, value) of every overview level."""
    made = overview_tiles(tiles, levels, tile_height, tile_width, nodata)
    exploded = made.select("raster_id", "level", "tile_row", "tile_col", "width", F.posexplode("values").alias("_k", "value"))
    return exploded.where(_valid(F.col("value"), nodata)).select(
        "raster_id", "level",
        (F.col("tile_row") * tile_height + F.floor(F.col("_k") / F.col("width"))).cast("int").alias("row"),
        (F.col("tile_col") * tile_width + F.col("_k") % F.col("width")).cast("int").alias("col"),
        "value",
    )


# --- cells ------------------------------------------------------------------------


def cells_to_tiles(
    grid: DataFrame, tile_height: int, tile_width: int, nodata: float = NODATA
) -> DataFrame:
    """Cells back to full-size tiles; a group is one tile, so its size is bounded."""
    placed = grid.select(
        "raster_id",
        F.floor(F.col("row") / tile_height).cast("int").alias("tile_row"),
        F.floor(F.col("col") / tile_width).cast("int").alias("tile_col"),
        ((F.col("row") % tile_height) * tile_width + F.col("col") % tile_width).cast("int").alias("k"),
        F.col("value").cast("float").alias("v"),
    )
    grouped = placed.groupBy(*TILE_KEY).agg(F.array_sort(F.collect_list(F.struct("k", "v"))).alias("_c"))
    # Fill the gaps between one valid cell and the next with NoData.
    last = tile_height * tile_width
    empty = F.lit(nodata).cast("float")

    def run(i: Column) -> Column:
        at = F.get(F.col("_c"), i)
        before = F.coalesce(F.get(F.col("_c"), i - 1)["k"], F.lit(-1))
        gap = F.coalesce(at["k"], F.lit(last)) - before - 1
        filler = F.array_repeat(empty, gap)
        return F.when(at.isNull(), filler).otherwise(F.concat(filler, F.array(at["v"])))

    values = F.flatten(F.transform(F.sequence(F.lit(0), F.size("_c")), run))
    return grouped.select(
        *TILE_KEY, F.lit(tile_width).alias("width"), F.lit(tile_height).alias("height"), values.alias("values")
    )
