"""Quality by cumulative-link regression on graded ratings.

One weight vector over hashed text features gives a document's latent quality;
ordered thresholds cut it into grades: P(grade >= k) = sigmoid(score - cut[k]).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.llm.common import WORD_BYTES, table, whole

SPACE_OF = 1 << 14  # hashed features
MOST_RATED = 8192  # rated rows that a model is fitted on: those of least hash of the id
ROUNDS = 400
DECAY = 1e-3
LEAST_PROBABILITY = 0.5
SIGNS = b"#*$%&|<>{}[]\\^~=_@"
PART = 1 << 16  # words counted at once


def features(text: bytes) -> dict[int, float]:
    """Hashed features of a whole text: its words, and how it is made.

    Words are lower-cased (A-Z) and weigh the root of their share. What a text is
    made of (repeats, signs, capitals, digits, line shape) gives features for
    each level that a ratio reaches, so that neighbouring ratios share weight.
    """
    counts, n, again, chars, before = Counter(), 0, 0, 0, None
    found = (m.group() for m in WORD_BYTES.finditer(text)) if len(text) > PART * 64 else iter(WORD_BYTES.findall(text))
    while part := list(islice(found, PART)):
        counts.update(part)
        again += sum(map(bytes.__eq__, part, [before, *part[:-1]])) if before else sum(map(bytes.__eq__, part[1:], part))
        before, n, chars = part[-1], n + len(part), chars + sum(map(len, part))
    out: dict[int, float] = {}

    def put(name: bytes, value: float) -> None:
        h = xxhash.xxh32_intdigest(name) % SPACE_OF
        out[h] = out.get(h, 0.0) + value

    def ratio(name: bytes, share: float, levels=(0.01, 0.03, 0.06, 0.1, 0.2, 0.3, 0.5, 0.7, 0.9)) -> None:
        for level in levels:
            if share >= level:
                put(b"\x00%s>=%g" % (name, level), 0.5)

    put(b"\x00any", 1.0)
    if not n:
        put(b"\x00empty", 1.0)
        return out
    for word, count in counts.items():
        put(word.lower(), 0.3 * (count / n) ** 0.5)
    lines = [x for x in text.split(b"\n") if x.strip()]
    ratio(b"again", again / n)
    ratio(b"repeated", (n - len(counts)) / n)
    ratio(b"signs", (len(text) - len(text.translate(None, SIGNS))) / chars)
    ratio(b"capitals", (len(text) - len(text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))) / chars)
    ratio(b"digits", (len(text) - len(text.translate(None, b"0123456789"))) / chars)
    ratio(b"marks", (len(text) - len(text.translate(None, b"!?"))) / chars)
    ratio(b"lines", len(lines) / n)
    ratio(b"same lines", (len(lines) - len(set(lines))) / max(1, len(lines)))
    for level in (2, 5, 10, 20, 50, 100, 300, 1000, 5000):
        if n >= level:
            put(b"\x00words>=%d" % level, 0.2)
    # Repetition weighs otherwise in a text of some length.
    if n >= 20:
        ratio(b"repeated, long", (n - len(counts)) / n)
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


@dataclass
class Model:
    """``weights`` over hashed features and ascending ``cuts``, one between each two grades."""

    weights: np.ndarray
    cuts: np.ndarray

    def score(self, text: bytes) -> float:
        x = features(text)
        return float(self.weights[list(x)] @ np.fromiter(x.values(), float, len(x)))

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 .. highest, a column each."""
        return sigmoid(np.asarray(score)[:, None] - self.cuts[None, :])


def fit_rows(lengths, keys, shares, grades, n_grades: int, rounds: int = ROUNDS, decay: float = DECAY) -> Model:
    """Maximum-likelihood fit by Adam steps; cuts stay ordered as a first cut and positive gaps.

    ``keys`` and ``shares`` hold the features of all rows one after another, ``lengths`` how many each has.
    """
    n = len(grades)
    at, col, val = np.repeat(np.arange(n), lengths), np.asarray(keys), np.asarray(shares)
    theta = np.zeros(SPACE_OF + n_grades - 1)
    theta[SPACE_OF] = -1.0
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    gap = lambda: np.exp(theta[SPACE_OF + 1 :])
    for step in range(1, rounds + 1):
        cuts = np.r_[-np.inf, theta[SPACE_OF] + np.r_[0.0, np.cumsum(gap())], np.inf]
        score = np.bincount(at, theta[col] * val, n)
        upper, lower = sigmoid(cuts[grades + 1] - score), sigmoid(cuts[grades] - score)
        p = np.maximum(upper - lower, 1e-9)
        du, dl = upper * (1 - upper) / p, lower * (1 - lower) / p  # slopes of log p at the two cuts
        slope = np.zeros_like(theta)
        slope[:SPACE_OF] = np.bincount(col, (du - dl)[at] * val, SPACE_OF) / n
        cut = (np.bincount(grades, dl, n_grades)[1:] - np.bincount(grades, du, n_grades)[:-1]) / n
        slope[SPACE_OF] = cut.sum()
        slope[SPACE_OF + 1 :] = np.cumsum(cut[::-1])[::-1][1:] * gap()
        slope[:SPACE_OF] += decay * theta[:SPACE_OF]
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        theta -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Model(theta[:SPACE_OF].copy(), theta[SPACE_OF] + np.r_[0.0, np.cumsum(gap())])


def fit(docs: DataFrame, ratings: DataFrame, n_grades: int, most: int = MOST_RATED) -> Model:
    """Fit on up to ``most`` of the ``ratings`` (doc_id, grade 0 .. n_grades - 1) and their documents.

    The sample is the ratings of least hash; it is bounded, so it is broadcast to
    the documents. Of rows that repeat a doc_id the text of least hash counts. Features are made on the executors and only they reach the
    driver. Other grades and null ones are left out; without any rating every
    document gets the same score.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(x.as_py()) for x in batch.column(0)]
            keys = pa.array([np.fromiter(r, np.int32, len(r)) for r in rows], pa.list_(pa.int32()))
            shares = pa.array([np.fromiter(r.values(), np.float32, len(r)) for r in rows], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), keys, shares], ["doc_id", "grade", "keys", "shares"])

    ratings = ratings.filter(F.col("grade").between(0, n_grades - 1) & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").alias("_id"), F.col("grade").cast("int").alias("grade")
    )
    sample = ratings.orderBy(F.xxhash64("_id"), "_id", "grade").limit(most)
    # One text a document, so that rows which repeat an id neither weigh more nor reach the driver.
    ids = sample.select(F.col("_id").alias("_rated")).distinct()
    texts = docs.select("doc_id", whole().cast("binary").alias("text")).join(F.broadcast(ids), F.col("doc_id") == F.col("_rated"), "left_semi")
    texts = texts.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least"))
    rows = texts.select("doc_id", "least.text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))
    got = rows.select("text", "doc_id", "grade").mapInArrow(run, "doc_id bigint, grade int, keys array<int>, shares array<float>")
    got = got.toArrow().sort_by([("doc_id", "ascending"), ("grade", "ascending")]).combine_chunks()
    if not got.num_rows:
        return Model(np.zeros(SPACE_OF), np.arange(n_grades - 1, dtype=float))
    keys, shares = (pa.chunked_array([c for c in got.column(x).chunks]).combine_chunks() for x in ("keys", "shares"))
    return fit_rows(keys.value_lengths().to_numpy(), keys.flatten().to_numpy(), shares.flatten().to_numpy(), got.column("grade").to_numpy(), n_grades)


def rate(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, expected_grade, tail array<double> of every row, from whole texts.

    ``tail[k - 1]`` is P(grade >= k). A null text counts as empty and gets the
    score of one; equal texts score alike; an empty table gives no rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in batches:
            score = np.array([m.score(x.as_py()) for x in batch.column(1)], float)
            tails = m.tails(score)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array(tails.sum(axis=1)), pa.array(list(tails), pa.list_(pa.float64()))],
                ["doc_id", "score", "expected_grade", "tail"],
            )

    return docs.select("doc_id", whole().cast("binary").alias("text")).mapInArrow(
        run, "doc_id bigint, score double, expected_grade double, tail array<double>"
    )


N_GRADES = 3


def ratings(labels: DataFrame) -> DataFrame:
    """Grades from labels: 0 for poor text, 1 for good text with toxic passages, 2 for good text."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    return labels.filter("quality is not null").select("doc_id", grade.alias("grade"))


def selected(docs: DataFrame, model: Model, grade: int = 1, least: float = LEAST_PROBABILITY) -> DataFrame:
    """The rows, all columns, whose P(grade >= ``grade``) is at least ``least``."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def tail(text):
        m = held.value
        return text.map(lambda t: float(m.tails(np.array([m.score(t)]))[0, grade - 1]))

    return docs.filter(tail(whole().cast("binary")) >= least)


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = fit(docs, ratings(table(spark, folder, "labels")), N_GRADES)
    return rate(docs, model).select(
        "doc_id", "expected_grade", F.col("tail")[0].alias("p_good"), (F.col("tail")[0] >= LEAST_PROBABILITY).alias("kept")
    )


QUERIES = {"op7_quality": op7_quality}

SQL: dict[str, str] = {}
