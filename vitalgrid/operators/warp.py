"""Resampling of raster tiles onto another grid, tiles in and tiles out.

A source tile is sent to the target tiles that its cells can reach, which its
place and the grids tell without a join of cells. There a numpy kernel gathers
the four source centres around every target centre from whole arrays. What the
tiles of one raster give a target tile adds up, so the kernel holds one sum of
weighted values and one of weights, however many source tiles arrive.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.refdata import NODATA

Numbers = dict[str, np.ndarray]

CELLS_AT_ONCE = 1 << 20  # target cells a kernel step works on
SLACK = 1e-6  # of a target cell, against rounding at the edge of what a tile reaches


@dataclass(frozen=True)
class Axis:
    """One axis of a resampling: target index to fractional source index and back.

    Both maps increase. Index 0 is the centre of the first cell. ``uses`` names
    columns that say how each raster lies; ``to_source`` gets them as numbers.
    """

    to_source: Callable[[np.ndarray, Numbers], np.ndarray]
    to_target: Callable[[Column], Column]
    size: int
    uses: tuple[str, ...] = field(default=())


def linear_axis(size: int, scale: float = 1.0, shift: float = 0.0) -> Axis:
    """source = target * scale + shift."""
    return Axis(lambda t, _: t * scale + shift, lambda s: (s - F.lit(shift)) / F.lit(scale), size)


EARTH = 6378137.0  # radius of the Web Mercator sphere, metres
STEEPEST = 89.0  # degrees of latitude that are still mapped


def _northing(lat: Column) -> Column:
    lat = F.least(F.greatest(lat, F.lit(-STEEPEST)), F.lit(STEEPEST))
    return F.lit(EARTH) * F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2))


def _latitude(y: np.ndarray) -> np.ndarray:
    return np.degrees(2 * np.arctan(np.exp(y / EARTH)) - math.pi / 2)


def _mercator(left: float, top: float, cell: float, rows: int, cols: int, lat_top, lon_left, degrees, uses=()) -> tuple[Axis, Axis]:
    """Axes onto a Web Mercator grid; how the source lies is given as numbers or as names of columns."""

    def of(value, numbers: Numbers):
        return numbers[value] if isinstance(value, str) else value

    def column(value) -> Column:
        return F.col(value) if isinstance(value, str) else F.lit(value)

    def row_source(t: np.ndarray, numbers: Numbers) -> np.ndarray:
        return (of(lat_top, numbers) - _latitude(top - (t + 0.5) * cell)) / of(degrees, numbers) - 0.5

    def col_source(t: np.ndarray, numbers: Numbers) -> np.ndarray:
        return (np.degrees((left + (t + 0.5) * cell) / EARTH) - of(lon_left, numbers)) / of(degrees, numbers) - 0.5

    def row_target(s: Column) -> Column:
        return (F.lit(top) - _northing(column(lat_top) - (s + 0.5) * column(degrees))) / F.lit(cell) - 0.5

    def col_target(s: Column) -> Column:
        return (F.lit(EARTH) * F.radians(column(lon_left) + (s + 0.5) * column(degrees)) - F.lit(left)) / F.lit(cell) - 0.5

    return Axis(row_source, row_target, rows, uses), Axis(col_source, col_target, cols, uses)


def mercator_axes(lon_left: float, lat_top: float, degrees: float, width: int, height: int) -> tuple[Axis, Axis, dict[str, float]]:
    """Row and column axes from one north-up degree grid to a Web Mercator grid of its own.

    The target has square cells, sized so that its diagonal holds as many cells
    as that of the source.
    """

    def y_of(lat: float) -> float:
        return EARTH * math.log(math.tan(math.pi / 4 + math.radians(lat) / 2))

    lat_top, lat_bottom = min(lat_top, STEEPEST), max(lat_top - height * degrees, -STEEPEST)
    left, top = EARTH * math.radians(lon_left), y_of(lat_top)
    span_x, span_y = EARTH * math.radians(width * degrees), top - y_of(lat_bottom)
    cell = math.hypot(span_x, span_y) / math.hypot(width, height)
    sizes = [max(1, math.ceil(span / cell - 1e-9)) for span in (span_y, span_x)]
    return *_mercator(left, top, cell, *sizes, lat_top, lon_left, degrees), {"left": left, "top": top, "cell": cell}


# How a raster lies: degrees of its upper left corner and of a cell, and its nominal tile size.
META = ("lat_top", "lon_left", "degrees")


def world_axes(cell: float) -> tuple[Axis, Axis]:
    """Axes of all rasters onto the one Web Mercator grid of square cells that covers the world.

    Each raster brings its ``META`` columns; as the target cells are the same for
    all, what is warped lies on one grid, whatever the extents were.
    """
    edge = math.pi * EARTH
    size = math.ceil(2 * edge / cell)
    return _mercator(-edge, edge, cell, size, size, *META, uses=META)


def placed(tiles: DataFrame, meta: DataFrame) -> DataFrame:
    """The tiles with how their rasters lie (``META``) and their first cell (``row0``, ``col0``).

    ``meta`` has raster_id, lat_top, lon_left, degrees, tile_height, tile_width,
    one row a raster. A tile whose raster it does not know fails the load.
    """
    unknown = F.raise_error(F.concat(F.lit("no georeference for raster "), F.col("raster_id").cast("string")))
    joined = tiles.join(meta.select("raster_id", *META, "tile_height", "tile_width"), "raster_id", "left")
    return joined.select(
        *tiles.columns, *META,
        F.coalesce(F.col("tile_row") * F.col("tile_height"), unknown.cast("int")).alias("row0"),
        (F.col("tile_col") * F.col("tile_width")).alias("col0"),
    )


def _reached(axis: Axis, first: Column, count: Column, side: int) -> Column:
    """Numbers of the target tiles that hold a cell between two centres of which the tile has one."""
    low = F.ceil(axis.to_target((first - 1).cast("double")) - SLACK)
    high = F.floor(axis.to_target((first + count).cast("double")) + SLACK)
    low, high = F.greatest(low, F.lit(0)), F.least(high, F.lit(axis.size - 1))
    tile = lambda t: F.floor(t / side).cast("int")
    return F.when(low <= high, F.sequence(tile(low), tile(high)))


def warp(tiles: DataFrame, rows: Axis, cols: Axis, side: int, nodata: float = NODATA) -> DataFrame:
    """Bilinear resampling: tiles (raster_id, tile_row, tile_col, width, height, values) of ``side`` by ``side`` cells.

    ``tiles`` have raster_id, row0, col0, width, height, values and the columns
    that the axes use. A target cell lies between four source centres and is the
    weighted mean of the valid ones, the weights scaled to one; without any it is
    NoData, and a tile without any cell is absent. NaN is a value.
    """
    uses = list(dict.fromkeys(rows.uses + cols.uses))
    key = ["raster_id", "tile_row", "tile_col"]
    routed = (
        tiles.where(F.exists("values", lambda v: v.isNotNull() & (v.cast("double") != F.lit(nodata))))
        .withColumn("tile_row", F.explode(_reached(rows, F.col("row0"), F.col("height"), side)))
        .withColumn("tile_col", F.explode(_reached(cols, F.col("col0"), F.col("width"), side)))
        .select(
            *key, "row0", "col0", "width", "height",
            *[F.col(c).cast("double").alias(c) for c in uses],
            F.col("values").cast("array<float>").alias("values"),
        )
    )
    id_type = tiles.schema["raster_id"].dataType.simpleString()

    def taps(axis: Axis, tile: np.ndarray, first: np.ndarray, count: int, numbers: Numbers):
        """Index into the tile and weight of the lower and the upper centre of each target cell."""
        t = tile[:, None] * side + np.arange(side)
        s = axis.to_source(t.astype(np.float64), numbers)
        base = np.floor(s)
        for index, weight in ((base, 1 - (s - base)), (base + 1, s - base)):
            index = index - first[:, None]
            inside = (index >= 0) & (index < count) & (t < axis.size)
            yield np.where(inside, index, 0).astype(np.intp), np.where(inside, weight, 0.0)

    def blended(part: Numbers, flat: np.ndarray, valid: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums of weighted values and of weights that each routed tile gives its target."""
        n = len(starts)
        top, weight = np.zeros((n, side, side)), np.zeros((n, side, side))
        shapes = part["height"].astype(np.int64) << 32 | part["width"]
        for shape in np.unique(shapes):
            at = np.flatnonzero(shapes == shape)
            h, w = int(shape >> 32), int(shape & 0xFFFFFFFF)
            numbers = {c: part[c][at][:, None] for c in uses}
            down = list(taps(rows, part["tile_row"][at], part["row0"][at], h, numbers))
            across = list(taps(cols, part["tile_col"][at], part["col0"][at], w, numbers))
            for r, wr in down:
                for c, wc in across:
                    cell = starts[at][:, None, None] + r[:, :, None] * w + c[:, None, :]
                    share = wr[:, :, None] * wc[:, None, :] * valid[cell]
                    top[at] += np.where(share > 0, share * flat[cell], 0.0)
                    weight[at] += share
        return top, weight

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row0", "col0", "width", "height", *uses]
        last = schema_id = None  # the target that may go on: its key and sums

        def out(ids: list, places: np.ndarray, top: np.ndarray, weight: np.ndarray) -> Iterator[pa.RecordBatch]:
            lists, kept = [], []
            for i in range(len(ids)):
                h, w = min(side, rows.size - places[i, 0] * side), min(side, cols.size - places[i, 1] * side)
                t, k = top[i, :h, :w], weight[i, :h, :w]
                if (k > 0).any():
                    kept.append((ids[i], *places[i], w, h))
                    lists.append(np.where(k > 0, t / np.where(k > 0, k, 1.0), nodata).ravel())
            if kept:
                offsets = np.cumsum([0] + [len(x) for x in lists]).astype(np.int32)
                values = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(lists)))
                columns = list(zip(*kept))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], schema_id), *(pa.array([int(x) for x in c], pa.int32()) for c in columns[1:]), values],
                    [*key, "width", "height", "values"],
                )

        for batch in batches:
            if not batch.num_rows:
                continue
            schema_id = batch.schema.field(0).type
            ids = batch.column(0).to_pylist()
            places = np.stack([batch.column(1).to_numpy(), batch.column(2).to_numpy()], axis=1)
            numbers = {c: batch.column(batch.schema.get_field_index(c)).to_numpy() for c in names}
            numbers |= {"tile_row": places[:, 0], "tile_col": places[:, 1]}
            lists = batch.column(batch.schema.get_field_index("values"))
            values = lists.flatten()
            flat = values.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)
            valid = ~values.is_null().to_numpy(zero_copy_only=False) & (flat != nodata)
            starts = np.cumsum(np.r_[0, lists.value_lengths().to_numpy(zero_copy_only=False)[:-1]])
            step = max(1, CELLS_AT_ONCE // (side * side))
            for a in range(0, len(ids), step):
                b = min(a + step, len(ids))
                top, weight = blended({c: v[a:b] for c, v in numbers.items()}, flat, valid, starts[a:b])
                new = np.ones(b - a, bool)
                new[1:] = [ids[i] != ids[i - 1] or (places[i] != places[i - 1]).any() for i in range(a + 1, b)]
                first = np.flatnonzero(new)
                top, weight = np.add.reduceat(top, first, axis=0), np.add.reduceat(weight, first, axis=0)
                heads, where = [ids[a + i] for i in first], places[a + first]
                if last is not None:
                    if last[0] == (heads[0], *where[0]):
                        top[0] += last[1]
                        weight[0] += last[2]
                    else:
                        yield from out([last[0][0]], np.array([last[0][1:]]), last[1][None], last[2][None])
                yield from out(heads[:-1], where[:-1], top[:-1], weight[:-1])
                last = ((heads[-1], *where[-1]), top[-1], weight[-1])
        if last is not None:
            yield from out([last[0][0]], np.array([last[0][1:]]), last[1][None], last[2][None])

    dealt = routed.repartition(*key).sortWithinPartitions(*key)
    return dealt.mapInArrow(run, f"raster_id {id_type}, tile_row int, tile_col int, width int, height int, values array<double>")


def reproject(tiles: DataFrame, rows: Axis, cols: Axis, tile_height: int, tile_width: int, nodata: float = NODATA) -> DataFrame:
    """Cells (raster_id, row, col, value) of a resampling of tiles of one nominal size."""
    side = max(tile_height, tile_width)
    own = tiles.select(
        "raster_id", (F.col("tile_row") * tile_height).alias("row0"), (F.col("tile_col") * tile_width).alias("col0"), "width", "height", "values"
    )
    made = warp(own, rows, cols, side, nodata)
    return made.select("raster_id", "tile_row", "tile_col", "width", F.posexplode("values").alias("_k", "value")).where(
        F.col("value") != F.lit(nodata)
    ).select(
        "raster_id",
        (F.col("tile_row") * side + F.floor(F.col("_k") / F.col("width"))).cast("int").alias("row"),
        (F.col("tile_col") * side + F.col("_k") % F.col("width")).cast("int").alias("col"),
        "value",
    )
