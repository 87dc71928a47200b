"""Moves on the file system Spark writes to (HDFS, object store or local)."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def _handle(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as scans name it."""
    fs, p = _handle(spark, path)
    return fs.makeQualified(p).toString().rstrip("/")


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _handle(spark, path)
    return fs.exists(p)


def size(spark: SparkSession, path: str) -> int:
    fs, p = _handle(spark, path)
    return int(fs.getContentSummary(p).getLength())


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _handle(spark, path)
    fs.delete(p, True)


def make(spark: SparkSession, path: str) -> None:
    """Create a folder and those above it."""
    fs, p = _handle(spark, path)
    fs.mkdirs(p)


def rename(spark: SparkSession, src: str, dst: str) -> None:
    fs, s = _handle(spark, src)
    _, d = _handle(spark, dst)
    if not fs.rename(s, d):
        raise OSError(f"cannot rename {src} to {dst}")


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Data files of a dataset, in its partition folders too, as paths below it."""
    fs, p = _handle(spark, path)
    top, found, listed = fs.makeQualified(p).toString().rstrip("/"), [], fs.listFiles(p, True)
    while listed.hasNext():
        found.append(listed.next().getPath().toString()[len(top) + 1 :])
    return sorted(f for f in found if not any(x.startswith(("_", ".")) for x in f.split("/")))


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Columns that a dataset is partitioned by, from its folder names."""
    files = data_files(spark, path)
    return [x.split("=", 1)[0] for x in files[0].split("/")[:-1] if "=" in x] if files else []


def staging_path(path: str) -> str:
    """A fresh sibling, on the same file system, that scans do not pick up."""
    head, _, tail = path.rstrip("/").rpartition("/")
    return f"{head}/_staged_{tail}_{uuid.uuid4().hex}"


def _previous(path: str) -> str:
    head, _, tail = path.rstrip("/").rpartition("/")
    return f"{head}/_previous_{tail}"


@contextmanager
def only_writer(spark: SparkSession, path: str) -> Iterator[None]:
    """Refuse a second writer of a table for the time of the block.

    The file system creates the mark beside the table or says that it is there.
    A writer that was killed leaves its mark behind; who knows that it is
    gone removes it.
    """
    head, _, tail = path.rstrip("/").rpartition("/")
    mark = f"{head}/_writing_{tail}"
    fs, p = _handle(spark, mark)
    fs.mkdirs(p.getParent())
    if not fs.createNewFile(p):
        raise RuntimeError(f"another writer is at the table: {mark}")
    try:
        yield
    finally:
        fs.delete(p, False)


def swap_in(spark: SparkSession, staged: str, path: str) -> None:
    """Put a finished dataset in place of another.

    The old one is set aside first and dropped last; between the two renames
    readers find neither, and ``recover`` puts the old one back if the swap was
    cut short there. One writer at a time: see ``only_writer``.
    """
    recover(spark, path)
    old = _previous(path)
    if exists(spark, path):
        rename(spark, path, old)
    rename(spark, staged, path)
    if exists(spark, old):
        remove(spark, old)


def recover(spark: SparkSession, path: str) -> None:
    """Undo or finish a swap that was cut short."""
    old = _previous(path)
    if exists(spark, old):
        if exists(spark, path):
            remove(spark, old)
        else:
            rename(spark, old, path)
