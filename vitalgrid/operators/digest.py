"""Content digests that do not depend on row order or partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A 64-digit hash is cut into pieces of six digits. Their sums stay below 2**63
# for up to 2**39 rows per group.
_PIECES = [(i, min(6, 64 - i)) for i in range(0, 64, 6)]


def set_digest(df: DataFrame, keys: list[str], row_text: Column) -> DataFrame:
    """Rows, and a digest of the bag of row texts, per key.

    Every row is hashed and the hashes are added piece by piece, so the group
    is reduced on the map side to a dozen numbers and never collected. Sums,
    unlike xor, notice a row that is there twice.
    """
    hashed = df.select(*keys, F.sha2(row_text, 256).alias("_h"))
    pieces = [
        F.sum(F.conv(F.substring("_h", i + 1, n), 16, 10).cast("bigint")).alias(f"_p{i}")
        for i, n in _PIECES
    ]
    summed = hashed.groupBy(*keys).agg(F.count("*").alias("rows"), *pieces)
    whole = F.concat_ws("|", F.col("rows"), *[F.col(f"_p{i}") for i, _ in _PIECES])
    return summed.select(*keys, "rows", F.sha2(whole.cast("binary"), 256).alias("digest"))


def tile_text(columns: list[str]) -> Column:
    """Position, shape and cell values of a tile; -0.0, NaN and NULL are told apart."""
    return F.concat_ws("|", *columns, F.sha2(F.col("values").cast("string"), 256)).cast("binary")


def raster_digest(tiles: DataFrame, meta: DataFrame) -> DataFrame:
    """Digest over every band, tile and overview level, and the georeference.

    ``meta``: ``raster_id`` and the columns that must survive a rewrite.
    """
    position = [c for c in ("level", "band", "tile_row", "tile_col", "width", "height") if c in tiles.columns]
    cells = set_digest(tiles, ["raster_id"], tile_text(position))
    described = meta.select(
        "raster_id", F.to_json(F.struct(*[c for c in meta.columns if c != "raster_id"]), {"ignoreNullFields": "false"}).alias("_meta")
    )
    return described.join(cells, "raster_id").select(
        "raster_id", "rows",
        F.sha2(F.concat_ws("|", "_meta", "digest").cast("binary"), 256).alias("digest"),
    )


def table_digest(df: DataFrame) -> DataFrame:
    """Row count and digest of a whole table, schema included."""
    text = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).cast("binary")
    rows = set_digest(df, [], text)
    schema = F.lit(df.schema.simpleString())
    return rows.select("rows", F.sha2(F.concat_ws("|", schema, "digest").cast("binary"), 256).alias("digest"))
