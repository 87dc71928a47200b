"""What several corpus operators share: tables, the word rule, stored intermediate rows."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of anything but these six; the same rule as a Java, a Python
# text and a Python byte pattern (bytes above 0x7F are never white space).
WORD = r"[^\x20\x09-\x0D]+"
WORD_BYTES = re.compile(rb"[^\x20\x09-\x0D]+")

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

# The files of the current run: a list of its own for each ``scratch`` block.
_STORED: ContextVar[list[str]] = ContextVar("stored", default=[])
_LOCAL: list[str] = []  # the folder of a session that names none


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder.rstrip('/')}/{name}.parquet")


def whole(text: str | Column = "text") -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """The words of a text in order."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    A cluster names it in ``spark.checkpoint.dir``; a test session that leaves
    the setting empty runs on one machine and gets a folder there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if not _LOCAL:
            _LOCAL.append("file://" + tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        folder = _LOCAL[0]
    return folder.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """The rows, written once to the shared folder and read back from there.

    Cuts the lineage, so a lost executor costs no earlier stage again, and
    computes rows that are read several times only once.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/rows_{uuid.uuid4().hex}"
    df.write.parquet(path)
    _STORED.get().append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def release(df: DataFrame) -> None:
    """Delete the files of a frame that ``stored`` returned and that nothing reads any more."""
    _STORED.get().remove(df.stored_at)
    _delete(df.sparkSession, df.stored_at)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is stored inside the block is deleted at its end; frames that read it end with it."""
    mark = _STORED.set([])
    try:
        yield
    finally:
        for path in _STORED.get():
            _delete(spark, path)
        _STORED.reset(mark)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def row_key(text_hash: Column) -> Column:
    """doc_id (a null one as the empty string) and a hash of the text, as one key."""
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text_hash.cast("string"))


def one_of_each(docs: DataFrame, key: Column, stay: DataFrame) -> DataFrame:
    """One row of ``docs`` for each key of ``stay`` (key, distinct).

    Rows of one key share doc_id and text; the one with the least hash of its
    columns stays. The grouping is by the key of the join and needs no shuffle
    of its own.
    """
    kept = docs.select(key.alias("_key"), F.struct(*(docs[c] for c in docs.columns)).alias("_row")).join(
        stay.withColumnRenamed("key", "_key"), "_key", "left_semi"
    )
    plain = [F.col("_row")[c] for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    return kept.groupBy("_key").agg(F.min_by("_row", F.xxhash64(*plain)).alias("_row")).select("_row.*")
