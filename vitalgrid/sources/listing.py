"""File listings as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.functions import files
from vitalgrid.sinks import fs


def list_files(
    spark: SparkSession, root: str, glob: str = "*", recursive: bool = False, content: bool = False
) -> DataFrame:
    """path, length, modificationTime (and content) of files under a folder.

    Without ``content`` the column is never selected, so no file is read. Empty
    files do not appear in the scan, which is how ``files.usable`` sees them too.
    """
    scan = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", recursive)
        .load(root)
    )
    columns = ["path", "length", "modificationTime"] + (["content"] if content else [])
    return scan.select(*columns)


def excluding(df: DataFrame, globs: list[str]) -> DataFrame:
    """Drop files whose name matches any of the glob patterns."""
    name = files.base_name(F.col("path"))
    for glob in globs:
        df = df.where(~name.rlike(glob_pattern(glob)))
    return df


def glob_pattern(glob: str) -> str:
    """A file-name glob as a regular expression."""
    special = {"*": ".*", "?": "."}
    return "^" + "".join(special.get(ch, "\\" + ch if not ch.isalnum() else ch) for ch in glob) + "$"


def year_cogs(listing: DataFrame, year: int, root: str | None = None) -> DataFrame:
    """Finished country rasters of one year, in path order; not from sub-folders."""
    name = files.base_name(F.col("path"))
    found = listing.where(files.is_year_cog(name, year))
    if root is not None:
        # Scans name paths with their file system; a manifest may not.
        names = {root.rstrip("/"), fs.qualified(listing.sparkSession, root)}
        found = found.where(files.folder(F.col("path")).isin(sorted(names)))
    return found.orderBy("path")


def stale(listing: DataFrame, now: Column, hours: int = 12) -> DataFrame:
    """Files too old to be used again."""
    return listing.where(~files.is_fresh(F.col("modificationTime"), now, hours))
