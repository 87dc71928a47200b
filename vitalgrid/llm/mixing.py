"""Mixing sources to target weights with hash-threshold histograms.

Sizes are summed by source and hash bucket. A source whose target is between
one and two times its size takes every document once and those below a hash
threshold once more. The threshold comes from the running sums over buckets;
only the bucket that the target falls into is split further, so no document is
ever sorted, and a higher budget takes a superset of a lower one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitalgrid.llm.common import stored, table, whole, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5  # of all sizes
MOST = 2.0  # times a source's size
BITS = 12  # of the hash in one histogram: 4096 buckets a source
LEVELS = 5  # histograms at most; together all 60 bits of the hash


def place(doc_id: Column) -> Column:
    """A document's fixed position in 0 .. 2^60 - 1: the first 60 bits of its id's MD5."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Target of each source.

    sizes: source, source_size. Sources in code-point order, null last, weigh
    ``weights`` in turn and share ``share`` of all sizes; a target stops at
    ``most`` times its source's size and the excess is shared again by weight.
    Only one row a source is held here; a round of sharing sends two sums to the
    driver.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = F.array(*[F.lit(float(w)) for w in weights])
    ranked = stored(
        sizes.withColumn("weight", F.element_at(turn, (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")))
    )
    limit = most * F.col("source_size")
    budget = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    rate = 0.0  # target of one unit of weight
    while True:
        full = F.col("weight") * F.lit(rate) > limit
        held, weight = ranked.agg(
            F.sum(F.when(full, limit)), F.sum(F.when(~full, F.col("weight")))
        ).first()
        following = (budget - (held or 0.0)) / weight if weight else rate
        if following <= rate:
            break
        rate = following
    return ranked.withColumn("target", F.least(limit, F.col("weight") * F.lit(rate)))


def thresholds(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size, target, rounds and known of each source.

    A row is taken ``rounds`` times, and once more if its place is below ``known``.
    """
    sized = stored(docs.select("source", word_count(whole()).alias("size"), place(F.col("doc_id")).alias("place")))
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = stored(
        targets(sizes, weights, share, most)
        .withColumn("rounds", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
        .withColumn("rest", F.col("target") - F.col("rounds") * F.col("source_size"))
        .withColumn("known", F.lit(0).cast("long"))
        .withColumn("below", F.lit(0).cast("long"))
    )
    for level in range(1, LEVELS + 1):
        goal, still_open = narrowed(sized, goal, level)
        if not still_open:
            break
    return goal.select("source", "source_size", "target", "rounds", "known")


def with_copies(docs: DataFrame, cut: DataFrame, most: float) -> DataFrame:
    """The rows with the ``source_size``, ``target`` and ``copies`` that the thresholds give them, never more than ``most`` rounded up."""
    cut = cut.select(F.col("source").alias("_source"), F.struct("source_size", "target", "rounds", "known").alias("_cut"))
    taken = F.col("_cut.rounds") + (place(F.col("doc_id")) < F.col("_cut.known")).cast("int")
    return (
        docs.join(cut, F.col("source").eqNullSafe(F.col("_source")))
        .withColumns({"source_size": F.col("_cut.source_size"), "target": F.col("_cut.target"), "copies": F.least(taken, F.lit(math.ceil(most))).cast("int")})
        .drop("_source", "_cut")
    )


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken of every row.

    ``taken`` is size times copies, 0 to ``most`` copies rounded up. Each source
    comes to its target within half the size of one document (or of the rows that
    share a doc_id). A null text has size 0; null is a source of its own; rows
    with the same or a null doc_id are taken alike; an empty table gives no rows.
    Other columns, whatever their names, are not looked at.
    """
    docs = docs.select("doc_id", "source", "text")
    return (
        with_copies(docs, thresholds(docs, weights, share, most), most)
        .withColumn("size", word_count(whole()))
        .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))
    )


def mixed_documents(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """The documents as the mix takes them: rows taken twice come twice, those not taken go."""
    chosen = with_copies(docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "source"), thresholds(docs, weights, share, most), most)
    return chosen.select("_row", F.explode(F.array_repeat(F.lit(1), F.col("copies")))).select("_row.*")


def narrowed(sized: DataFrame, goal: DataFrame, level: int) -> tuple[DataFrame, int]:
    """Thresholds after one more histogram, and how many boundary buckets hold more than one place.

    The histogram of level k covers the rows of each source's boundary bucket of
    level k - 1, which starts at ``known`` and is 2^(60 - 12 (k - 1)) wide.
    """
    wide, shift = 1 << (60 - BITS * (level - 1)), 60 - BITS * level
    start = goal.select(F.col("source").alias("_source"), F.col("known").alias("_known"))
    inside = sized.join(
        start,
        F.col("source").eqNullSafe(F.col("_source")) & (F.col("place") >= F.col("_known")) & (F.col("place") - F.col("_known") < F.lit(wide)),
        "inner",
    )
    buckets = inside.groupBy("source", F.shiftright("place", shift).alias("bucket")).agg(
        F.sum("size").alias("size"), F.min("place").alias("least"), F.max("place").alias("last")
    )
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = (
        buckets.withColumn("upto", F.sum("size").over(running))
        .select(F.col("source").alias("_source"), "bucket", "size", "upto", "least", "last")
        .join(goal, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("upto", F.col("upto") + F.col("below"))
    )
    # The first bucket that goes beyond the rest; if it is a single place, it is
    # taken where that ends nearer to the target.
    over = F.col("upto") > F.col("rest")
    single = F.col("least") == F.col("last")
    nearer = F.col("upto") - F.col("rest") < F.col("rest") - (F.col("upto") - F.col("size"))
    found = summed.groupBy("source").agg(
        F.min(F.when(over, F.struct("bucket", "upto", "size", single.alias("single"), nearer.alias("nearer"), F.col("last").alias("last")))).alias("b"),
        F.max("last").alias("end"),
        F.max("upto").alias("all"),
    )
    b = F.col("b")
    known = (
        F.when(F.col("end").isNull(), F.col("known"))
        .when(b.isNull(), F.col("end") + 1)
        .when(b["single"] & b["nearer"], b["last"] + 1)
        .otherwise(F.shiftleft(b["bucket"], shift))
    )
    below = F.when(F.col("end").isNull(), F.col("below")).when(b.isNull(), F.col("all")).when(b["single"] & b["nearer"], b["upto"]).otherwise(b["upto"] - b["size"])
    done = stored(
        goal.join(found.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")), "left").select(
            "source", "source_size", "target", "rounds", "rest", known.alias("known"), below.alias("below"), F.coalesce(~b["single"] & (F.col("rest") > below), F.lit(False)).alias("open")
        )
    )
    return done.drop("open"), done.filter("open").count()


def op2_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {"op2_mix_sources": op2_mix_sources}

SQL = {
    "op2_mix_sources": r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || left(md5(coalesce(doc_id::VARCHAR, '')), 15))::BIGINT AS place
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, ([5.0, 2.0, 1.0])[((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1)::INT]::DOUBLE AS weight
  FROM sources
), rates AS (
  SELECT 0 AS step, 0::DOUBLE AS rate
  UNION ALL
  SELECT step + 1,
    (SELECT (1.5::DOUBLE * sum(source_size) - coalesce(sum(CASE WHEN weight * rate > 2.0::DOUBLE * source_size THEN 2.0::DOUBLE * source_size END), 0))
            / sum(CASE WHEN weight * rate <= 2.0::DOUBLE * source_size THEN weight END)
     FROM ranked)
  FROM rates WHERE step < 64
), goal AS (
  SELECT *, least(2.0::DOUBLE * source_size, weight * (SELECT max(rate) FROM rates)) AS target FROM ranked
), parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS rounds FROM goal
), places AS (
  SELECT source, place, sum(size)::BIGINT AS size FROM sized GROUP BY source, place
), running AS (
  SELECT source, place, size, sum(size) OVER (PARTITION BY source ORDER BY place) AS upto FROM places
), once_more AS (
  SELECT r.source, r.place FROM running r JOIN parts p ON r.source IS NOT DISTINCT FROM p.source
  WHERE r.upto <= p.target - p.rounds * p.source_size
     OR (r.upto - r.size < p.target - p.rounds * p.source_size
         AND r.upto - (p.target - p.rounds * p.source_size) < (p.target - p.rounds * p.source_size) - (r.upto - r.size))
)
SELECT s.doc_id, s.size, p.source_size, p.target,
       (s.size * (p.rounds + CASE WHEN o.place IS NOT NULL THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source
LEFT JOIN once_more o ON s.source IS NOT DISTINCT FROM o.source AND s.place = o.place
""",
}
