"""Exact duplicates by content sort.

Rows are dealt by range over their normalised bytes and sorted by Spark's
external sort, so equal texts stand side by side; each text is compared in full
with the one before it, and a run of equal ones gives its rows their least and
largest id and its length. Splitters are sampled from a short sort key (first
bytes, hash, id), never from whole texts. A text with very many copies is dealt
over several tasks by the id: only the first and the last run of a task may go
on in another one, and these, two a task at most, are brought together by digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.llm.common import one_of_each, row_key, stored, table, whole

HEAD = 16  # bytes of text in the range key


def unchanged(text: Column) -> Column:
    return text


def content_runs(docs: DataFrame, normal: Callable[[Column], Column] = unchanged) -> DataFrame:
    """doc_id, text_sha256, least, largest, size, edge, opens of every row in content order.

    ``least``, ``largest`` and ``size`` are those of the row's run of equal texts
    in its task; ``edge`` marks the first and last run of a task and ``opens``
    one row of each of these.
    """
    body = normal(whole()).cast("binary")
    rows = docs.select("doc_id", body.alias("body")).select(
        F.substring("body", 1, HEAD).alias("head"), F.xxhash64("body").alias("hash"), "doc_id", "body"
    )
    dealt = rows.repartitionByRange("head", "hash", "doc_id").sortWithinPartitions("head", "hash", "body", "doc_id")

    def out(runs: list[tuple[bytes, list]], edge: bool) -> pa.RecordBatch:
        ids, digests, least, largest, sizes, opens = [], [], [], [], [], []
        for body, of in runs:
            known = [i for i in of if i is not None]
            ids += of
            digests += [hashlib.sha256(body).hexdigest()] * len(of)
            least += [min(known, default=None)] * len(of)
            largest += [max(known, default=None)] * len(of)
            sizes += [len(of)] * len(of)
            opens += [edge] + [False] * (len(of) - 1)
        longs = (pa.array(x, pa.int64()) for x in (least, largest, sizes))
        flags = pa.array([edge] * len(ids), pa.bool_()), pa.array(opens, pa.bool_())
        columns = [pa.array(ids, pa.int64()), pa.array(digests, pa.string()), *longs, *flags]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "text_sha256", "least", "largest", "size", "edge", "opens"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, last = True, None
        for batch in batches:
            done = []
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                body = value.as_py()
                if last and last[0] == body:
                    last[1].append(doc_id)
                    continue
                if last and first:
                    yield out([last], True)
                    first = False
                elif last:
                    done.append(last)
                last = (body, [doc_id])
            if done:
                yield out(done, False)
        if last:
            yield out([last], True)

    return dealt.select("doc_id", "body").mapInArrow(
        run, "doc_id bigint, text_sha256 string, least bigint, largest bigint, size bigint, edge boolean, opens boolean"
    )


def exact_duplicates(docs: DataFrame, normal: Callable[[Column], Column] = unchanged, largest: bool = False) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row.

    Texts are equal if they are the same bytes after ``normal``; a null text is
    an empty one. The row with the smallest doc_id (``largest``: the largest)
    stays; a row without doc_id stays only if none of its group has one. Rows
    that repeat the doc_id that stays are all marked kept. An empty table gives
    no rows; other columns are not looked at.
    """
    rows = stored(content_runs(docs, normal))
    # At most two runs a task, whatever the table holds.
    cut = rows.filter("opens").groupBy(F.col("text_sha256").alias("_sha")).agg(
        F.min("least").alias("_least"), F.max("largest").alias("_largest"), F.sum("size").alias("_size")
    )
    whole_runs = rows.join(F.broadcast(cut), F.col("edge") & (F.col("text_sha256") == F.col("_sha")), "left")
    keep = F.when(F.col("edge"), F.col("_largest" if largest else "_least")).otherwise(F.col("largest" if largest else "least"))
    return whole_runs.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("_size", "size").alias("group_size"), F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256"
    )


def without_exact_duplicates(docs: DataFrame, normal: Callable[[Column], Column] = unchanged, largest: bool = False) -> DataFrame:
    """The documents with one row of each group of equal texts left, also where a row is repeated."""
    stay = exact_duplicates(docs, normal, largest).filter("kept").select(row_key(F.col("text_sha256")).alias("key")).distinct()
    return one_of_each(docs, row_key(F.sha2(normal(whole()).cast("binary"), 256)), stay)


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(table(spark, folder, "documents"), largest=True)


QUERIES = {"op6_exact_dedup": op6_exact_dedup}

SQL = {
    "op6_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
}
