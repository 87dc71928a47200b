"""Raster operators with embeddings as tiles of 8 by 8 cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid import refdata
from vitalgrid.operators import raster, warp
from vitalgrid.plans import demography, rasters
from vitalgrid.refdata import NODATA
from vitalgrid.workload import table

SIDE = 8


def _tiles(spark: SparkSession, sf: str) -> DataFrame:
    """One tile per vector; negative components stand for NoData."""
    nodata = F.lit(NODATA).cast("float")
    return table(spark, sf, "embeddings").select(
        "vec_id", "label",
        F.lit(1).alias("band"), F.lit(SIDE).alias("width"), F.lit(SIDE).alias("height"),
        F.transform("embedding", lambda x: F.when(x < 0, nodata).otherwise(x)).alias("values"),
    )


def micro(value: Column) -> Column:
    """A cell value in whole millionths, for exact comparison."""
    return F.round(value.cast("double") * 1e6).cast("bigint")


def masked_sum(spark: SparkSession, sf: str) -> DataFrame:
    return raster.masked_sum(_tiles(spark, sf), ["label"]).withColumn("total", F.round("total", 3))


def mosaic_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors of a label lie on the same tile; the greatest id wins a cell."""
    tiles = _tiles(spark, sf).select(
        F.col("label").alias("tile_row"), F.lit(0).alias("tile_col"), "width", "height", "values", "vec_id"
    )
    cells = raster.mosaic_cells(tiles, "vec_id", SIDE, SIDE)
    return cells.select("row", "col", micro(F.col("value")).alias("micro"))


def mosaic_tiles(spark: SparkSession, sf: str) -> DataFrame:
    """The same as tiles, sixteen ids and their labels sharing a row of places; ordered by file name."""
    tiles = _tiles(spark, sf).select(
        F.col("label").alias("tile_row"), F.floor(F.col("vec_id") / 16).cast("int").alias("tile_col"),
        "width", "height", "values", F.concat(F.lit("v"), "vec_id", F.lit(".tif")).alias("filename"),
    )
    merged = rasters.year_mosaic(tiles)
    cells = merged.select("tile_row", "tile_col", "width", "height", F.posexplode("values").alias("cell", "value"))
    return cells.where(F.col("value") != NODATA).select("tile_row", "tile_col", "width", "height", "cell", micro(F.col("value")).alias("micro"))


def overview_avg(spark: SparkSession, sf: str) -> DataFrame:
    tiles = _tiles(spark, sf).select(
        F.col("label").alias("raster_id"), F.lit(0).alias("tile_row"), F.col("vec_id").cast("int").alias("tile_col"),
        "width", "height", "values",
    )
    cells = raster.overviews(tiles, 3, SIDE, SIDE)
    return cells.select("raster_id", "level", "row", "col", micro(F.col("value")).alias("micro"))


def _cut(tiles: DataFrame, height: int, width: int) -> DataFrame:
    """Every vector as a raster of its own, cut into tiles of ``height`` by ``width`` cells, smaller at its edges."""
    parts = [
        F.struct(
            F.lit(r // height).alias("tile_row"), F.lit(c // width).alias("tile_col"),
            F.lit(min(width, SIDE - c)).alias("width"), F.lit(min(height, SIDE - r)).alias("height"),
            F.flatten(
                F.array(*[F.slice("values", i * SIDE + c + 1, min(width, SIDE - c)) for i in range(r, min(r + height, SIDE))])
            ).alias("values"),
        )
        for r in range(0, SIDE, height) for c in range(0, SIDE, width)
    ]
    kept = [c for c in tiles.columns if c not in ("width", "height", "values")]
    return tiles.select(*kept, F.col("vec_id").alias("raster_id"), F.inline(F.array(*parts)))


def overview_odd_tiles(spark: SparkSession, sf: str) -> DataFrame:
    """Three levels of rasters cut into tiles of 3 by 5 cells, so that blocks cross their borders."""
    cells = raster.overviews(_cut(_tiles(spark, sf), 3, 5), 3, 3, 5)
    return cells.select("raster_id", "level", "row", "col", micro(F.col("value")).alias("micro"))


def overview_strips(spark: SparkSession, sf: str) -> DataFrame:
    """Three levels of one raster a label, its tiles strips of one row: a row a vector, without the rows of other labels."""
    tiles = _tiles(spark, sf).select(
        F.col("label").alias("raster_id"), F.col("vec_id").cast("int").alias("tile_row"), F.lit(0).alias("tile_col"),
        F.lit(SIDE * SIDE).alias("width"), F.lit(1).alias("height"), "values",
    )
    cells = raster.overviews(tiles, 3, 1, SIDE * SIDE)
    return cells.select("raster_id", "level", "row", "col", micro(F.col("value")).alias("micro"))


WORLD_CELL, WORLD_SIDE = 97_000.0, 16  # metres of a target cell, cells of a target tile


def warp_mosaic_overview(spark: SparkSession, sf: str) -> DataFrame:
    """Rasters of different place, extent and cell size brought onto one grid, laid over each other, and halved twice."""
    vec, label = F.col("vec_id"), F.col("label")
    names = _tiles(spark, sf).withColumn("filename", F.concat(F.lit("v"), vec, F.lit(".tif")))
    tiles = _cut(names, 3, 5).withColumn("raster_id", F.col("filename"))
    meta = names.select(
        F.col("filename").alias("raster_id"),
        (F.lit(72.0) - vec * 31 % 1300 / F.lit(10.0)).alias("lat_top"),
        (vec * 73 % 3300 / F.lit(10.0) - F.lit(170.0)).alias("lon_left"),
        (F.lit(1.1) + label % 5 * F.lit(0.3)).alias("degrees"),
        F.lit(3).alias("tile_height"), F.lit(5).alias("tile_width"),
    )
    base = rasters.world_mosaic(tiles, meta, WORLD_CELL, WORLD_SIDE)
    cells = rasters.with_overviews(base, 2, WORLD_SIDE)
    return cells.select("level", "row", "col", micro(F.col("value")).alias("micro"))


def _quarters(spark: SparkSession, sf: str) -> DataFrame:
    """Every vector as a raster of its own, cut into four tiles of 4 by 4."""
    return _cut(_tiles(spark, sf), SIDE // 2, SIDE // 2)


def reproject_bilinear(spark: SparkSession, sf: str) -> DataFrame:
    """On a finer grid shifted over the upper left edge."""
    axis = warp.linear_axis(11, 0.75, -0.3)
    cells = warp.reproject(_quarters(spark, sf), axis, axis, SIDE // 2, SIDE // 2)
    return cells.select("raster_id", "row", "col", micro(F.col("value")).alias("micro"))


MERCATOR = {"lon_left": 5.0, "lat_top": 62.0, "degrees": 1.5, "width": SIDE, "height": SIDE}


def reproject_mercator(spark: SparkSession, sf: str) -> DataFrame:
    rows, cols, _ = warp.mercator_axes(**MERCATOR)
    cells = warp.reproject(_quarters(spark, sf), rows, cols, SIDE // 2, SIDE // 2)
    return cells.select("raster_id", "row", "col", F.round("value", 5).alias("value"))


def zonal_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Raw totals next to those after resampling, which do not agree."""
    quarters = _quarters(spark, sf)
    raw = raster.masked_sum(quarters).select("raster_id", F.round("total", 4).alias("raw_total"))
    axis = warp.linear_axis(SIDE, 1.0, 0.5)
    warped = warp.reproject(quarters, axis, axis, SIDE // 2, SIDE // 2)
    after = warped.groupBy("raster_id").agg(F.round(F.sum("value"), 4).alias("warped_total"))
    return raw.join(after, "raster_id", "left")


def age_pyramid(spark: SparkSession, sf: str) -> DataFrame:
    """Labels as countries, vectors as rasters of the twenty age codes in turn."""
    codes = F.array(*[F.lit(c) for c in refdata.RASTER_AGE_CODES])
    tiles = _tiles(spark, sf).select(
        F.concat(F.lit("L"), "label").alias("iso3"), F.lit(2020).alias("year"),
        F.get(codes, (F.col("vec_id") % 20).cast("int")).alias("age_code"), "values",
    )
    return demography.pyramid_rows(tiles).withColumn("pop", F.round("pop", 3))


def raster_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Totals for cataloged files that have none yet."""
    tiles = _tiles(spark, sf).withColumn("filename", F.concat(F.lit("f"), F.col("vec_id") % 50))
    # The stored side: one row per vector, some of whose files have a total.
    catalog = tiles.select(
        F.col("vec_id").alias("id"), F.lit("raw").alias("stage"), "filename",
        F.when(F.col("label") == 3, 1.0).alias("exact_total"),
    )
    done = rasters.with_totals(catalog, tiles, "raw")
    return done.select("id", "filename", F.round("exact_total", 3).alias("exact_total"))


QUERIES = {
    "masked_sum": masked_sum,
    "mosaic_last_wins": mosaic_last_wins,
    "mosaic_tiles": mosaic_tiles,
    "overview_avg": overview_avg,
    "overview_odd_tiles": overview_odd_tiles,
    "overview_strips": overview_strips,
    "warp_mosaic_overview": warp_mosaic_overview,
    "reproject_bilinear": reproject_bilinear,
    "reproject_mercator": reproject_mercator,
    "zonal_totals": zonal_totals,
    "age_pyramid": age_pyramid,
    "raster_totals": raster_totals,
}

_CELLS = """
cells AS (
  SELECT vec_id, label, k // 8 AS r, k % 8 AS c, CAST(v AS DOUBLE) AS v
  FROM (SELECT vec_id, label, unnest(embedding) AS v, unnest(range(64)) AS k FROM embeddings)
  WHERE v >= 0
)"""


def _bilinear(targets: str) -> str:
    """Four-neighbour mean of cells for targets(t_row, t_col, fr, fc)."""
    return f"""
t AS ({targets}),
corners AS (
  SELECT t_row, t_col, fr, fc, floor(fr) + dr AS r, floor(fc) + dc AS c,
         (CASE dr WHEN 0 THEN 1 - (fr - floor(fr)) ELSE fr - floor(fr) END)
         * (CASE dc WHEN 0 THEN 1 - (fc - floor(fc)) ELSE fc - floor(fc) END) AS w
  FROM t CROSS JOIN (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) d(dr, dc)
),
warped AS (
  SELECT vec_id, t_row, t_col, sum(w * v) / sum(w) AS value
  FROM corners JOIN cells ON corners.r = cells.r AND corners.c = cells.c
  GROUP BY ALL HAVING sum(w) > 0
)"""


def _linear(size: int, scale: float, shift: float) -> str:
    return f"""
  SELECT a.i AS t_row, b.i AS t_col, a.i * {scale}::DOUBLE + {shift}::DOUBLE AS fr, b.i * {scale}::DOUBLE + {shift}::DOUBLE AS fc
  FROM (SELECT unnest(range({size})) AS i) a CROSS JOIN (SELECT unnest(range({size})) AS i) b"""


_PI = "3.141592653589793::DOUBLE"
_RADIUS = "6378137.0::DOUBLE"


def _own_mercator() -> str:
    """Targets of one raster on a grid of its own, by the formulas of the projection alone."""
    m = MERCATOR
    lat, lon, deg, side = (f"{float(m[k])}::DOUBLE" for k in ("lat_top", "lon_left", "degrees", "width"))
    north = f"{_RADIUS} * ln(tan({_PI} / 4 + radians({{}}) / 2))"
    return f"""
  SELECT a.i AS t_row, b.i AS t_col,
         ({lat} - degrees(2 * atan(exp((top - (a.i + 0.5) * cell) / {_RADIUS})) - {_PI} / 2)) / {deg} - 0.5 AS fr,
         degrees((b.i + 0.5) * cell / {_RADIUS}) / {deg} - 0.5 AS fc
  FROM (
    SELECT top, sqrt(dx * dx + dy * dy) / sqrt(2 * {side} * {side}) AS cell, dx, dy
    FROM (SELECT {north.format(lat)} AS top, {_RADIUS} * radians({side} * {deg}) AS dx,
                 {north.format(lat)} - {north.format(f"({lat} - {side} * {deg})")} AS dy)) g,
    range(40) a(i), range(40) b(i)
  WHERE a.i < ceil(dy / cell - 1e-9) AND b.i < ceil(dx / cell - 1e-9)"""


def _world() -> str:
    """Cells of all rasters on the grid of the world: vec_id, t_row, t_col, value."""
    edge, cell = f"({_PI} * {_RADIUS})", f"{WORLD_CELL}::DOUBLE"
    return f"""
lies AS (
  SELECT vec_id, 72.0::DOUBLE - vec_id * 31 % 1300 / 10.0::DOUBLE AS lat, vec_id * 73 % 3300 / 10.0::DOUBLE - 170.0::DOUBLE AS lon,
         1.1::DOUBLE + label % 5 * 0.3::DOUBLE AS deg
  FROM embeddings),
axis AS (
  SELECT i, degrees(2 * atan(exp(({edge} - (i + 0.5) * {cell}) / {_RADIUS})) - {_PI} / 2) AS lat,
         degrees((-{edge} + (i + 0.5) * {cell}) / {_RADIUS}) AS lon
  FROM range(CAST(ceil(2 * {edge} / {cell}) AS BIGINT)) r(i)),
down AS (SELECT vec_id, i, (l.lat - a.lat) / deg - 0.5 AS f FROM lies l, axis a WHERE f > -1 AND f < 8),
across AS (SELECT vec_id, i, (a.lon - l.lon) / deg - 0.5 AS f FROM lies l, axis a WHERE f > -1 AND f < 8),
corners AS (
  SELECT d.vec_id, d.i AS t_row, x.i AS t_col, floor(d.f) + dr AS r, floor(x.f) + dc AS c,
         (CASE dr WHEN 0 THEN 1 - (d.f - floor(d.f)) ELSE d.f - floor(d.f) END)
         * (CASE dc WHEN 0 THEN 1 - (x.f - floor(x.f)) ELSE x.f - floor(x.f) END) AS w
  FROM down d JOIN across x USING (vec_id) CROSS JOIN (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) k(dr, dc)),
warped AS (
  SELECT n.vec_id, t_row, t_col, CAST(sum(w * v) / sum(w) AS FLOAT) AS value
  FROM corners n JOIN cells ON n.vec_id = cells.vec_id AND n.r = cells.r AND n.c = cells.c GROUP BY ALL HAVING sum(w) > 0)"""


SQL = {
    "masked_sum": f"""
WITH {_CELLS}
SELECT l.label, round(coalesce(sum(v), 0), 3) AS total, count(v) AS valid_count
FROM (SELECT DISTINCT label FROM embeddings) l LEFT JOIN cells ON cells.label = l.label GROUP BY l.label""",
    "mosaic_last_wins": f"""
WITH {_CELLS}
SELECT CAST(label * 8 + r AS INTEGER) AS row, CAST(c AS INTEGER) AS col, CAST(round(v * 1e6) AS BIGINT) AS micro
FROM (SELECT DISTINCT ON (label, r, c) * FROM cells ORDER BY label, r, c, vec_id DESC)""",
    "mosaic_tiles": f"""
WITH {_CELLS},
won AS (
  SELECT DISTINCT ON (label, vec_id // 16, r, c) label, vec_id // 16 AS tc, r, c, v
  FROM cells ORDER BY label, vec_id // 16, r, c, 'v' || vec_id || '.tif' DESC
)
SELECT label AS tile_row, CAST(tc AS INTEGER) AS tile_col, 8 AS width, 8 AS height,
       CAST(r * 8 + c AS INTEGER) AS cell, CAST(round(v * 1e6) AS BIGINT) AS micro
FROM won""",
    "overview_avg": f"""
WITH {_CELLS},
l1 AS (SELECT label, vec_id, r // 2 AS r, c // 2 AS c, avg(v) AS v FROM cells GROUP BY ALL),
l2 AS (SELECT label, vec_id, r // 2 AS r, c // 2 AS c, avg(v) AS v FROM l1 GROUP BY ALL),
l3 AS (SELECT label, vec_id, r // 2 AS r, c // 2 AS c, avg(v) AS v FROM l2 GROUP BY ALL),
a AS (
  SELECT 1 AS level, 4 AS w, * FROM l1 UNION ALL SELECT 2, 2, * FROM l2 UNION ALL SELECT 3, 1, * FROM l3
)
SELECT label AS raster_id, level, CAST(r AS INTEGER) AS row, CAST(vec_id * w + c AS INTEGER) AS col,
       CAST(round(v * 1e6) AS BIGINT) AS micro
FROM a""",
    "overview_odd_tiles": f"""
WITH {_CELLS},
l1 AS (SELECT vec_id, r // 2 AS r, c // 2 AS c, avg(v) AS v FROM cells GROUP BY ALL),
l2 AS (SELECT vec_id, r // 2 AS r, c // 2 AS c, avg(v) AS v FROM l1 GROUP BY ALL),
l3 AS (SELECT vec_id, r // 2 AS r, c // 2 AS c, avg(v) AS v FROM l2 GROUP BY ALL),
a AS (SELECT 1 AS level, * FROM l1 UNION ALL SELECT 2, * FROM l2 UNION ALL SELECT 3, * FROM l3)
SELECT vec_id AS raster_id, level, CAST(r AS INTEGER) AS row, CAST(c AS INTEGER) AS col, CAST(round(v * 1e6) AS BIGINT) AS micro
FROM a""",
    "overview_strips": f"""
WITH {_CELLS},
l1 AS (SELECT label, vec_id // 2 AS r, (r * 8 + c) // 2 AS k, avg(v) AS v FROM cells GROUP BY ALL),
l2 AS (SELECT label, r // 2 AS r, k // 2 AS k, avg(v) AS v FROM l1 GROUP BY ALL),
l3 AS (SELECT label, r // 2 AS r, k // 2 AS k, avg(v) AS v FROM l2 GROUP BY ALL),
a AS (SELECT 1 AS level, * FROM l1 UNION ALL SELECT 2, * FROM l2 UNION ALL SELECT 3, * FROM l3)
SELECT label AS raster_id, level, CAST(r AS INTEGER) AS row, CAST(k AS INTEGER) AS col, CAST(round(v * 1e6) AS BIGINT) AS micro
FROM a""",
    "warp_mosaic_overview": f"""
WITH {_CELLS}, {_world()},
l0 AS (
  SELECT DISTINCT ON (t_row, t_col) t_row AS r, t_col AS c, CAST(value AS DOUBLE) AS v
  FROM warped ORDER BY t_row, t_col, 'v' || vec_id || '.tif' DESC),
l1 AS (SELECT r // 2 AS r, c // 2 AS c, avg(v) AS v FROM l0 GROUP BY ALL),
l2 AS (SELECT r // 2 AS r, c // 2 AS c, avg(v) AS v FROM l1 GROUP BY ALL),
a AS (SELECT 0 AS level, * FROM l0 UNION ALL SELECT 1, * FROM l1 UNION ALL SELECT 2, * FROM l2)
SELECT level, CAST(r AS INTEGER) AS row, CAST(c AS INTEGER) AS col, CAST(round(v * 1e6) AS BIGINT) AS micro FROM a""",
    "reproject_bilinear": f"""
WITH {_CELLS}, {_bilinear(_linear(11, 0.75, -0.3))}
SELECT vec_id AS raster_id, CAST(t_row AS INTEGER) AS row, CAST(t_col AS INTEGER) AS col,
       CAST(round(value * 1e6) AS BIGINT) AS micro
FROM warped""",
    "reproject_mercator": f"""
WITH {_CELLS}, {_bilinear(_own_mercator())}
SELECT vec_id AS raster_id, CAST(t_row AS INTEGER) AS row, CAST(t_col AS INTEGER) AS col, round(value, 5) AS value
FROM warped""",
    "zonal_totals": f"""
WITH {_CELLS}, {_bilinear(_linear(8, 1.0, 0.5))},
raw AS (
  SELECT e.vec_id, round(coalesce(sum(v), 0), 4) AS raw_total
  FROM embeddings e LEFT JOIN cells ON e.vec_id = cells.vec_id GROUP BY e.vec_id
)
SELECT raw.vec_id AS raster_id, any_value(raw_total) AS raw_total, round(sum(value), 4) AS warped_total
FROM raw LEFT JOIN warped ON raw.vec_id = warped.vec_id GROUP BY raw.vec_id""",
    "age_pyramid": f"""
WITH {_CELLS},
names AS (
  SELECT unnest({["0-4"] + [f"{a}-{a + 4}" for a in range(5, 80, 5)] + ["80+"]}) AS age_bin, unnest(range(17)) AS bin_ord
),
binned AS (
  SELECT label, CASE WHEN vec_id % 20 < 2 THEN 0 WHEN vec_id % 20 >= 17 THEN 16 ELSE vec_id % 20 - 1 END AS bin_ord, v
  FROM cells
)
SELECT 'L' || l.label AS iso3, 2020 AS year, CAST(n.bin_ord AS INTEGER) AS bin_ord, n.age_bin,
       round(coalesce(sum(v), 0), 3) AS pop
FROM (SELECT DISTINCT label FROM embeddings) l CROSS JOIN names n
LEFT JOIN binned b ON b.label = l.label AND b.bin_ord = n.bin_ord GROUP BY ALL""",
    "raster_totals": f"""
WITH {_CELLS},
f AS (SELECT vec_id AS id, 'f' || (vec_id % 50) AS filename, CASE WHEN label = 3 THEN 1.0::DOUBLE END AS exact_total FROM embeddings),
todo AS (SELECT filename FROM f GROUP BY filename HAVING count(exact_total) = 0),
totals AS (
  SELECT f.filename, round(coalesce(sum(v), 0), 3) AS total
  FROM f JOIN todo USING (filename) LEFT JOIN cells ON cells.vec_id = f.id GROUP BY f.filename
)
SELECT id, f.filename, coalesce(t.total, exact_total) AS exact_total FROM f LEFT JOIN totals t ON f.filename = t.filename""",
}
