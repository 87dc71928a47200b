"""Quality rules: base counts, and a hashed n-gram likelihood ratio between trusted and raw text.

Words and word pairs are hashed to buckets. Two smoothed multinomials, one of
trusted documents and one of all documents, give each bucket a log ratio; a
document's verdict is its mean ratio against a fixed threshold.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.llm.common import WORD, table, whole, words

BUCKETS = 1 << 14
UNIT = 1 << 32  # log ratios are added as whole numbers of 1 / UNIT, so that no order of addition changes a sum
THRESHOLD = -0.1  # mean log ratio per n-gram
SMOOTHING = 1.0  # added to each bucket's count
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of words in repeated windows
WINDOW = 3  # words
FEW = 32  # repeated windows of a text that are looked for one by one
SYMBOLS = r"[#*$%&|<>]"


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """A column computed once a row, also where a lambda reads it many times."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def neighbours(w: Column, n: int) -> Column:
    """For each word a struct x0, x1, ... of it and the n - 1 that follow, null beyond the end."""
    from_each = [F.slice(w, k + 1, F.greatest(F.size(w) - k, F.lit(0))).alias(f"x{k}") for k in range(n)]
    return F.arrays_zip(*from_each)


def bucket(*grams: str) -> Column:
    return F.xxhash64(*grams).bitwiseAND(BUCKETS - 1).cast("int")


def bucket_counts(texts: DataFrame) -> DataFrame:
    """bucket, n over the n-grams of all rows; one row a bucket leaves each task."""
    rows = once(texts.select(whole().alias("body")), "w", words(F.col("body")))
    grams = rows.select(F.explode(neighbours(F.col("w"), 2)).alias("x"))
    both = F.when(F.col("x.x1").isNull(), F.array(bucket("x.x0"))).otherwise(F.array(bucket("x.x0"), bucket("x.x0", "x.x1")))
    return grams.select(F.explode(both).alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


def log_ratios(trusted: DataFrame, raw: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> list[float]:
    """log P(bucket | trusted) - log P(bucket | raw) of each bucket; zeros if nothing is trusted."""
    target, corpus = [0] * buckets, [0] * buckets
    for counts, rows in ((target, trusted), (corpus, raw)):
        for bucket, n in bucket_counts(rows).collect():  # one row a bucket
            counts[bucket] = n
    if not sum(target):
        return [0.0] * buckets
    shift = math.log(sum(target) + smoothing * buckets) - math.log(sum(corpus) + smoothing * buckets)
    return [math.log(t + smoothing) - math.log(c + smoothing) - shift for t, c in zip(target, corpus)]


def base_counts(rows: DataFrame) -> DataFrame:
    """The rows (with ``body`` and its words ``w``) and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    A window counts as repeated by its 64-bit hash. Windows are sorted only in a
    text that repeats one.
    """
    n = F.size("w")
    lines = F.filter(F.split("body", "\n"), lambda x: x.rlike(WORD))
    rows = rows.withColumns(
        {
            "n_words": n.cast("long"),
            "word_chars": F.length(F.array_join("w", "")).cast("long"),
            "n_symbols": F.regexp_count("body", F.lit(SYMBOLS)).cast("long"),
        }
    )
    rows = once(rows, "_lines", lines).withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long")).drop("_lines")
    windows = F.transform(F.slice(neighbours(F.col("w"), WINDOW), F.lit(1), F.greatest(n - WINDOW + 1, F.lit(0))), lambda x: F.xxhash64(x))
    rows = once(rows, "_win", windows)
    repeats = F.size(F.array_distinct("_win")) < F.size("_win")
    rows = once(rows, "_low", F.when(repeats, F.sort_array("_win")).otherwise(F.array().cast("array<bigint>")))
    doubled = F.filter(F.arrays_zip(F.col("_low").alias("a"), F.slice("_low", 2, F.greatest(F.size("_low") - 1, F.lit(0))).alias("b")), lambda p: p["a"] == p["b"])
    rows = once(rows, "_twice", F.array_distinct(F.transform(doubled, lambda p: p["a"]))).drop("_low")
    # Where few windows repeat they are looked for one by one, else in sorted order.
    placed = F.transform("_win", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    rows = once(rows, "_sorted", F.when(F.size("_twice") > FEW, F.sort_array(placed)).otherwise(none))
    same = lambda p, k: F.coalesce(F.get("_sorted", k)["h"] == p["h"], F.lit(False))
    by_order = F.sort_array(F.transform(F.filter("_sorted", lambda p, k: same(p, k - 1) | same(p, k + 1)), lambda p: p["i"]))
    one_by_one = F.transform(F.filter(placed, lambda p: F.array_contains("_twice", p["h"])), lambda p: p["i"])
    at = F.when(F.size("_twice") == 0, F.array().cast("array<int>")).when(F.size("_twice") > FEW, by_order).otherwise(one_by_one)
    start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
    covered = F.aggregate(at, start, lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")), lambda a: a["n"])
    return rows.withColumn("n_repeat_words", covered.cast("long")).drop("_win", "_twice", "_sorted")


def judge(docs: DataFrame, ratios: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, the base counts, base_failed, log_ratio, kept of every row.

    ``log_ratio`` is the mean over the n-grams of the whole text. A null text
    counts as empty: no words, log_ratio zero, base_failed. Equal texts get equal
    verdicts; an empty table gives no rows; other columns are not looked at.
    """
    weights = F.from_json(F.lit(json.dumps([round(r * UNIT) for r in ratios])), "array<bigint>")
    rows = once(docs.select("doc_id", whole().alias("body")), "w", words(F.col("body")))
    rows = base_counts(rows).withColumn("row", F.monotonically_increasing_id())
    kept = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    # The words of a row are summed in its task; one row a document is shuffled.
    grams = rows.select("row", *kept, F.explode_outer(neighbours(F.col("w"), 2)).alias("x"))
    weight = F.when(F.col("x.x0").isNull(), 0).otherwise(F.get(weights, bucket("x.x0"))) + F.when(F.col("x.x1").isNull(), 0).otherwise(
        F.get(weights, bucket("x.x0", "x.x1"))
    )
    summed = grams.groupBy("row").agg(*[F.first(c).alias(c) for c in kept], F.sum(weight).alias("total"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    ratio = F.col("total") / UNIT / F.greatest(2 * F.col("n_words") - 1, F.lit(1))
    return (
        summed.withColumns({"base_failed": failed, "log_ratio": ratio})
        .withColumn("kept", ~F.col("base_failed") & (F.col("log_ratio") >= threshold))
        .select(*kept, "base_failed", "log_ratio", "kept")
    )


def trusted_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All documents labelled good and not toxic, once however often the label is repeated.

    Their number grows with the corpus, so ids and texts meet in a shuffle at every size.
    """
    good = labels.filter("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select(F.col("doc_id").alias("_id"))
    return docs.join(good.hint("merge"), F.col("doc_id") == F.col("_id"), "left_semi")


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    ratios = log_ratios(trusted_documents(docs, table(spark, folder, "labels")), docs)
    return judge(docs, ratios)


QUERIES = {"op9_quality_rules": op9_quality_rules}

SQL: dict[str, str] = {}
