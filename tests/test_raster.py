import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from vitalgrid.operators import digest, raster, warp
from vitalgrid.plans import rasters
from vitalgrid.sources import tiles as source

ND = -99999.0


def cut(spark, grids, side, **extra):
    """Grids (id to 2-d array) as tiles; tiles without any valid cell are left out."""
    data = []
    for rid, g in grids.items():
        for r in range(0, g.shape[0], side):
            for c in range(0, g.shape[1], side):
                t = g[r : r + side, c : c + side]
                if (t != ND).any():
                    data.append((rid, 1, r // side, c // side, t.shape[1], t.shape[0], ND, [float(x) for x in t.ravel()]))
    return spark.createDataFrame(data, source.TILE)


def grid(h, w, seed, holes=0.3):
    rnd = np.random.default_rng(seed)
    g = np.float32(rnd.random((h, w)) * 10)
    g[rnd.random((h, w)) < holes] = ND
    return g


def test_masked_sum(spark):
    g = grid(10, 7, 1)
    empty = np.full((4, 4), ND, dtype=np.float32)
    nan = np.float32([[1, math.nan], [ND, 2]])
    df = cut(spark, {"g": g, "n": nan}, 4).unionByName(
        spark.createDataFrame([("e", 1, 0, 0, 4, 4, ND, [ND] * 16)], source.TILE)
    )
    got = {r.raster_id: r for r in raster.masked_sum(df).collect()}
    assert abs(got["g"].total - g[g != ND].sum(dtype=np.float64)) < 1e-9
    assert got["g"].valid_count == int((g != ND).sum())
    assert (got["e"].total, got["e"].valid_count) == (0.0, 0)
    assert math.isnan(got["n"].total) and got["n"].valid_count == 3
    own = {r.raster_id: r.valid_count for r in raster.masked_sum(df.withColumn("nodata", F.lit(2.0)), nodata=None).collect()}
    assert own["n"] == 3
    assert empty.size == 16


def test_band_check(spark):
    df = cut(spark, {"g": grid(4, 4, 1)}, 4).withColumn("bands", F.lit(1))
    assert source.band(df, 1).count() == 1
    with pytest.raises(ValueError):
        source.band(df, 0)
    with pytest.raises(Exception, match="invalid band 2"):
        source.band(df, 2).collect()


def test_mosaic_later_name_wins(spark):
    grids = {n: grid(8, 12, i, 0.5) for i, n in enumerate(["c.tif", "a.tif", "b.tif"])}
    grids["b.tif"][:, 4:] = ND
    want = np.full((8, 12), ND, dtype=np.float32)
    for name in sorted(grids):
        want = np.where(grids[name] != ND, grids[name], want)
    for parts in (1, 7):
        df = cut(spark, grids, 4).withColumnRenamed("raster_id", "filename").repartition(parts)
        cells = {(r.row, r.col): r.value for r in raster.mosaic_cells(df, "filename", 4, 4).collect()}
        assert cells == {(r, c): float(want[r, c]) for r, c in zip(*np.where(want != ND))}
        back = np.full((8, 12), ND, dtype=np.float32)
        for t in rasters.year_mosaic(df).collect():
            back[t.tile_row * 4 : t.tile_row * 4 + t.height, t.tile_col * 4 : t.tile_col * 4 + t.width] = np.float32(
                t["values"]
            ).reshape(t.height, t.width)
        assert (back == want).all()
        total = rasters.mosaic_total(rasters.year_mosaic(df)).first().total
        assert abs(total - want[want != ND].sum(dtype=np.float64)) < 1e-9


def halved(g):
    h, w = g.shape
    out = np.full(((h + 1) // 2, (w + 1) // 2), ND)
    for r in range(out.shape[0]):
        for c in range(out.shape[1]):
            b = g[2 * r : 2 * r + 2, 2 * c : 2 * c + 2]
            if (b != ND).any():
                out[r, c] = b[b != ND].mean(dtype=np.float64)
    return out


@pytest.mark.parametrize("side,tile_height,tile_width", [(4, 4, 4), (5, 5, 5), (1, 1, 1), (3, 3, 3), (16, 16, 16)])
def test_overviews_inside_and_beyond_a_tile(spark, side, tile_height, tile_width):
    g = grid(11, 18, 4, 0.4)
    g[4:8, 4:8] = ND
    got = {(r.level, r.row, r.col): r.value for r in raster.overviews(cut(spark, {"g": g}, side), 4, tile_height, tile_width).collect()}
    want, level = {}, g.astype(np.float64)
    for n in range(1, 5):
        level = halved(level)
        want.update({(n, r, c): level[r, c] for r, c in zip(*np.where(level != ND))})
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def bilinear(g, fr, fc):
    r0, c0 = math.floor(fr), math.floor(fc)
    top = weight = 0.0
    for r, wr in ((r0, 1 - (fr - r0)), (r0 + 1, fr - r0)):
        for c, wc in ((c0, 1 - (fc - c0)), (c0 + 1, fc - c0)):
            if 0 <= r < g.shape[0] and 0 <= c < g.shape[1] and g[r, c] != ND:
                top, weight = top + wr * wc * float(g[r, c]), weight + wr * wc
    return top / weight if weight > 0 else None


@pytest.mark.parametrize("scale,shift,size", [(0.7, -0.4, 22), (1.0, 0.0, 13), (1.9, 0.3, 7), (1.0, 0.5, 14)])
def test_reproject_linear(spark, scale, shift, size):
    g = grid(11, 13, 5, 0.4)
    g[4:8, 4:8] = ND  # a tile that is not there at all
    axis = warp.linear_axis(size, scale, shift)
    got = {(r.row, r.col): r.value for r in warp.reproject(cut(spark, {"g": g}, 4), axis, axis, 4, 4).collect()}
    want = {}
    for r in range(size):
        for c in range(size):
            v = bilinear(g, r * scale + shift, c * scale + shift)
            if v is not None:
                want[r, c] = v
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_reproject_mercator(spark):
    g = grid(9, 10, 6, 0.2)
    rows_axis, cols_axis, m = warp.mercator_axes(10.0, 60.0, 0.5, 10, 9)
    got = {(r.row, r.col): r.value for r in warp.reproject(cut(spark, {"g": g}, 4), rows_axis, cols_axis, 4, 4).collect()}
    want = {}
    for r in range(rows_axis.size):
        y = m["top"] - (r + 0.5) * m["cell"]
        lat = math.degrees(2 * math.atan(math.exp(y / warp.EARTH)) - math.pi / 2)
        for c in range(cols_axis.size):
            lon = math.degrees((m["left"] + (c + 0.5) * m["cell"]) / warp.EARTH)
            v = bilinear(g, (60.0 - lat) / 0.5 - 0.5, (lon - 10.0) / 0.5 - 0.5)
            if v is not None:
                want[r, c] = v
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-6 for k in want)


LAID = "raster_id string, lat_top double, lon_left double, degrees double, tile_height int, tile_width int"


@pytest.mark.parametrize("at_once", [1 << 20, 1])
def test_rasters_of_any_extent_meet_on_one_grid(spark, monkeypatch, at_once):
    monkeypatch.setattr(warp, "CELLS_AT_ONCE", at_once)
    grids = {"a": grid(9, 14, 1, 0.2), "b": grid(11, 6, 2, 0.2), "c": grid(5, 5, 3)}
    lies = {"a": (61.0, 10.0, 0.5), "b": (60.2, 13.1, 0.7), "c": (-84.0, 178.5, 0.6)}  # c runs over the edges of the world
    tiles = cut(spark, {"a": grids["a"]}, 4).unionByName(cut(spark, {"b": grids["b"], "c": grids["c"]}, 3))
    meta = spark.createDataFrame([(k, *v, 4 if k == "a" else 3, 4 if k == "a" else 3) for k, v in lies.items()], LAID)
    cell, side = 41_000.0, 7
    rows_axis, cols_axis = warp.world_axes(cell)
    made = warp.warp(warp.placed(tiles, meta), rows_axis, cols_axis, side)
    got = {(t.raster_id, t.tile_row * side + k // t.width, t.tile_col * side + k % t.width): v for t in made.collect() for k, v in enumerate(t["values"]) if v != ND}
    edge, want = math.pi * warp.EARTH, {}
    for name, (top, left, deg) in lies.items():
        for r in range(rows_axis.size):
            lat = math.degrees(2 * math.atan(math.exp((edge - (r + 0.5) * cell) / warp.EARTH)) - math.pi / 2)
            fr = (top - lat) / deg - 0.5
            for c in range(cols_axis.size) if -1 < fr < grids[name].shape[0] else ():
                fc = (math.degrees((-edge + (c + 0.5) * cell) / warp.EARTH) - left) / deg - 0.5
                v = bilinear(grids[name], fr, fc)
                if v is not None:
                    want[name, r, c] = v
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)
    laid = {}
    for (_, r, c), v in sorted(want.items()):  # the later name wins
        laid[r, c] = v
    cells = rasters.with_overviews(rasters.world_mosaic(tiles, meta, cell, side), 1, side).collect()
    base = {(x.row, x.col): x.value for x in cells if x.level == 0}
    assert base.keys() == laid.keys() and all(abs(base[k] - laid[k]) < 1e-5 for k in laid)
    blocks = {}
    for (r, c), v in base.items():
        blocks.setdefault((r // 2, c // 2), []).append(v)
    half = {(x.row, x.col): x.value for x in cells if x.level == 1}
    assert half.keys() == blocks.keys() and all(abs(half[k] - sum(v) / len(v)) < 1e-9 for k, v in blocks.items())


def test_a_raster_without_georeference_fails(spark):
    meta = spark.createDataFrame([("other", 1.0, 1.0, 1.0, 4, 4)], LAID)
    with pytest.raises(Exception, match="no georeference for raster g"):
        warp.placed(cut(spark, {"g": grid(4, 4, 1)}, 4), meta).collect()


def test_mosaic_of_one_place_that_very_many_cover(spark):
    grids = {f"{i:03}": grid(3 + i % 2, 4 - i % 3, i, 0.9) for i in range(200)}
    want = np.full((4, 4), ND, np.float32)
    for name in sorted(grids):
        h, w = grids[name].shape
        want[:h, :w] = np.where(grids[name] != ND, grids[name], want[:h, :w])
    df = cut(spark, grids, 4).withColumnRenamed("raster_id", "filename")
    nulls = spark.createDataFrame([("zzz", 1, 0, 0, 4, 4, ND, [None] * 16), ("zzz", 1, 5, 5, 4, 4, ND, [None] * 16)], source.TILE)
    for parts in (1, 9):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            (tile,) = rasters.year_mosaic(df.unionByName(nulls.withColumnRenamed("raster_id", "filename"))).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 8)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        assert (np.float32(tile["values"]).reshape(tile.height, tile.width) == want[: tile.height, : tile.width]).all()
    assert rasters.year_mosaic(df.limit(0)).count() == 0


def test_cells_to_tiles(spark):
    g = grid(8, 8, 7)
    df = cut(spark, {"g": g}, 4)
    cells = source.cells(df, 4, 4, ND)
    assert cells.count() == int((g != ND).sum())
    back = raster.cells_to_tiles(cells, 4, 4)
    assert rows(back.select("tile_row", "tile_col", F.array_join("values", ","))) == rows(
        df.select("tile_row", "tile_col", F.array_join("values", ","))
    )


def test_totals_skip_files_that_have_one(spark):
    g = {"f1": grid(4, 4, 1), "f2": grid(4, 4, 2)}
    df = cut(spark, g, 4).withColumnRenamed("raster_id", "filename")
    catalog = spark.createDataFrame([(1, "raw", "f1", None), (2, "raw", "f2", 5.0), (3, "cog", "f1", None)], "id int, stage string, filename string, exact_total double")
    total = float(g["f1"][g["f1"] != ND].sum(dtype=np.float64))
    got = dict(rows(rasters.with_totals(catalog, df, "raw"), "id", "exact_total"))
    assert abs(got[1] - total) < 1e-9 and got[2] == 5.0 and got[3] is None
    forced = dict(rows(rasters.with_totals(catalog, df, "raw", force=True), "id", "exact_total"))
    assert abs(forced[2] - float(g["f2"][g["f2"] != ND].sum(dtype=np.float64))) < 1e-9


def test_digest(spark):
    df = cut(spark, {"g": grid(8, 8, 3), "h": grid(8, 8, 4)}, 4)
    meta = spark.createDataFrame([("g", 8, 8, "EPSG:4326"), ("h", 8, 8, "EPSG:4326")], "raster_id string, width int, height int, crs string")

    def of(t, m=meta):
        return dict(rows(digest.raster_digest(t, m), "raster_id", "digest"))

    base = of(df)
    assert base == of(df.repartition(5)) and base["g"] != base["h"]
    one = F.transform("values", lambda x, i: F.when((i == 3) & (F.col("tile_row") == 1) & (F.col("tile_col") == 1), x + F.lit(1).cast("float")).otherwise(x))
    changed = of(df.withColumn("values", F.when(F.col("raster_id") == "g", one).otherwise(F.col("values"))))
    assert changed["g"] != base["g"] and changed["h"] == base["h"]
    swapped = of(df.withColumn("tile_col", F.when(F.col("raster_id") == "g", 1 - F.col("tile_col")).otherwise(F.col("tile_col"))))
    assert swapped["g"] != base["g"]
    twice = df.unionByName(df.where("raster_id = 'g' and tile_row = 0 and tile_col = 0"))
    assert of(twice.unionByName(df.where("raster_id = 'g' and tile_row = 0 and tile_col = 0")))["g"] != base["g"]
    assert of(df, meta.withColumn("crs", F.lit("EPSG:3857")))["g"] != base["g"]
    zero = spark.createDataFrame([("g", 1, 0, 0, 1, 1, ND, [0.0])], source.TILE)
    minus = spark.createDataFrame([("g", 1, 0, 0, 1, 1, ND, [-0.0])], source.TILE)
    assert of(zero)["g"] != of(minus)["g"]

