"""Toxicity by weak supervision.

Lexicon and pattern voters look at every text. A generative label model of how
often each voter fires on toxic and on other texts, with joint tables for voters
that depend on each other, is estimated from vote patterns alone; a linear
classifier on hashed words is then trained on its posterior labels.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.llm.common import stored, table, whole

# Voters: word lists by kind of insult and language.
LEXICONS = {
    "wits": "idiot idiots idiotic moron morons moronic imbecile cretin dimwit halfwit nitwit simpleton",
    "dull": "stupid dumb brainless clueless ignorant foolish fool fools dunce blockhead",
    "worth": "worthless useless pathetic pitiful hopeless",
    "failure": "loser losers failure coward cowards weakling wimp",
    "filth": "trash garbage scum vermin filth filthy rubbish dirtbag",
    "disgust": "disgusting revolting repulsive vile gross sickening",
    "mockery": "clown clowns buffoon freak freaks weirdo joke laughable",
    "abuse": "bastard jerk creep pig swine rat snake parasite",
    "german": "dummkopf trottel depp blödmann versager abschaum widerlich",
    "french": "imbécile crétin abruti débile connard minable raclure",
    "spanish": "imbécil estúpido estúpida inútil basura asqueroso patético",
}
# Voters: patterns over the lower-cased text. A look at the first letter comes before the dearer look for a word's border.
PATTERNS = {
    "you are": r"(?=[uy])\b(you are|you're|youre|u r)( all| just| such)? (a|an|the)\b",
    "shut up": r"(?=[dgins])\b(shut up|get lost|go away|drop dead|i hate you|nobody likes)\b",
    "marks": r"[!?]{3,}",
}
TOKEN = r"[\p{L}\p{N}]+"
BITS = 16  # of the hashed feature space
MOST_TRAINED = 16384  # documents the classifier is trained on: those of least hash of the id
FOLDS = 5  # fold 0 is held out
ROUNDS = 200
STEM_LENGTHS = (4, 5, 6, 7, 8, 9, 10)  # of token beginnings looked for in labelled texts
MOST_STEMS = 256
STEM_VOTERS = 4
LEAST_SEEN = 6  # texts
LEAST_SHARE = 0.5
HEADS = (4, 6, 8, 9)  # lengths of token beginnings among the features
DEPENDENT = 0.002  # conditional mutual information (nats) from which two voters get a joint table
PENALTY = 3e-4
CUT = 0.5


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def tokens_of(docs: DataFrame) -> DataFrame:
    """The rows with ``low``, the lower-cased text, and ``tokens``, its distinct tokens."""
    rows = docs.withColumn("low", F.lower(whole())).drop("text")
    return rows.select("*", F.explode(F.array(F.array_distinct(F.regexp_extract_all("low", F.lit(TOKEN), F.lit(0))))).alias("tokens"))


def heads(n: int) -> Column:
    """The distinct first ``n`` characters of the tokens, of shorter ones all."""
    return F.array_distinct(F.transform("tokens", lambda t: F.left(t, F.lit(n))))


def stem_like(stems: list[str], n: int = min(STEM_LENGTHS)) -> Column:
    """The tokens that may begin with a stem, by their first ``n`` characters: few, so that each list looks at these only."""
    near = sorted({stem[:n] for stem in stems if len(stem) >= n})
    tests = [(k, sorted({stem for stem in stems if len(stem) == k})) for k in sorted({len(stem) for stem in stems if len(stem) < n})]
    tests += [(n, near)] if near else []

    def may_begin(t: Column) -> Column:
        return reduce(lambda a, b: a | b, [F.left(t, F.lit(k)).isin(own) for k, own in tests], F.lit(False))

    return F.filter("tokens", may_begin)


def begun(stems: list[str], tokens: str = "tokens") -> Column:
    """Whether any token begins with one of the stems, looked up by length."""
    by_length: dict[int, list[str]] = {}
    for stem in stems:
        by_length.setdefault(len(stem), []).append(stem)

    def any_of(n: int, own: list[str]) -> Column:
        return F.exists(tokens, lambda t: F.left(t, F.lit(n)).isin(own))

    return reduce(lambda a, b: a | b, [any_of(n, own) for n, own in sorted(by_length.items())], F.lit(False))


def with_votes(rows: DataFrame, stems: list[str]) -> DataFrame:
    """The rows of ``tokens_of`` with ``votes``: bit j is set if voter j fires.

    Voters are the word lists, the patterns, and the stems dealt in STEM_VOTERS lists.
    """
    lists = [words.split() for words in LEXICONS.values()]
    every = F.array(*[F.lit(w) for w in sorted({w for words in lists for w in words})])
    rows = rows.select("*", F.explode(F.array(F.array_intersect("tokens", every))).alias("hits"))
    fires = [F.arrays_overlap("hits", F.array(*[F.lit(w) for w in words])) for words in lists] + [F.col("low").rlike(p) for p in PATTERNS.values()]
    rows = rows.select("*", F.explode(F.array(stem_like(stems))).alias("stem_like"))
    for k in range(STEM_VOTERS):
        fires.append(F.when(F.size("stem_like") > 0, begun(stems[k::STEM_VOTERS], "stem_like")))
    votes = reduce(lambda a, b: a.bitwiseOR(b), [F.when(f, 1 << j).otherwise(0) for j, f in enumerate(fires)])
    return rows.withColumn("votes", votes).drop("hits", "stem_like")


N_VOTERS = len(LEXICONS) + len(PATTERNS) + STEM_VOTERS


def find_stems(labelled: DataFrame) -> list[str]:
    """Beginnings of tokens that go with toxic labels; at most MOST_STEMS come to the driver.

    ``labelled`` has tokens and toxic. A stem must be in LEAST_SEEN texts and the
    lower end of its share of toxic ones (two standard errors) reach LEAST_SHARE
    and a quarter more than the share among all.
    A stem that goes on a shorter chosen one is dropped.
    """
    base = labelled.agg(F.avg("toxic")).first()[0] or 0.0
    found = F.array_distinct(F.flatten(F.array(*[heads(n) for n in STEM_LENGTHS])))
    rows = labelled.select("toxic", F.explode(found).alias("stem")).groupBy("stem").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("k"))
    share = F.col("k") / F.col("n")
    low = share - 2 * F.sqrt((share * (1 - share) + 1 / F.col("n")) / F.col("n"))
    chosen = rows.filter((F.col("n") >= LEAST_SEEN) & (low >= max(LEAST_SHARE, 1.25 * base))).orderBy(F.desc("k"), F.length("stem"), "stem").limit(MOST_STEMS)
    stems: list[str] = []
    for (stem,) in chosen.select("stem").collect():
        if not any(stem.startswith(s) for s in stems):
            stems = [s for s in stems if not s.startswith(stem)] + [stem]
    return stems


@dataclass
class LabelModel:
    """P(toxic), and for each group of one or two voters the table P(its votes | class)."""

    prior: float
    groups: list[tuple[int, ...]]
    tables: list[np.ndarray]  # class by pattern of the group's votes

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        log = np.log([[1 - self.prior], [self.prior]]) + np.zeros((2, len(votes)))
        for group, t in zip(self.groups, self.tables):
            log = log + np.log(t)[:, cells(votes, group)]
        return 1 / (1 + np.exp(log[0] - log[1]))

    def rates(self) -> dict[int, tuple[float, float]]:
        """How often each voter fires on other and on toxic texts."""
        return {v: tuple(float(t[y][[c for c in range(t.shape[1]) if c >> k & 1]].sum()) for y in (0, 1)) for g, t in zip(self.groups, self.tables) for k, v in enumerate(g)}


def cells(votes: np.ndarray, group: tuple[int, ...]) -> np.ndarray:
    return sum((votes >> v & 1) << k for k, v in enumerate(group))


def estimate(votes, counts, known, groups, posterior, rounds: int = ROUNDS) -> tuple[LabelModel, np.ndarray]:
    """Expectation-maximisation from a first posterior of each vote pattern; ``known`` classes (else NaN) stay as they are."""
    for _ in range(rounds):
        mass = np.stack([counts * (1 - posterior), counts * posterior])
        tables = []
        for group in groups:
            at, size = cells(votes, group), 1 << len(group)
            t = np.stack([np.bincount(at, m, size) for m in mass]) + 0.01
            tables.append(t / t.sum(axis=1, keepdims=True))
        model = LabelModel(float(np.clip(mass[1].sum() / max(counts.sum(), 1), 1e-4, 0.5)), groups, tables)
        before, posterior = posterior, np.where(np.isnan(known), model.posterior(votes), known)
        if np.abs(before - posterior).max() < 1e-7:
            break
    return model, posterior


def dependence(votes: np.ndarray, counts: np.ndarray, posterior: np.ndarray, a: int, b: int) -> float:
    """Mutual information of two voters' votes given the class, in nats."""
    total = 0.0
    for mass in (counts * (1 - posterior), counts * posterior):
        t = np.bincount(cells(votes, (a, b)), mass, 4).reshape(2, 2) / max(counts.sum(), 1)
        if t.sum():
            apart = t.sum(0) * t.sum(1)[:, None] / t.sum()
            some = t > 0
            total += float((t[some] * np.log(t[some] / apart[some])).sum())
    return total


def label_model(patterns: dict[tuple[int, int | None], int], n_voters: int = N_VOTERS) -> LabelModel:
    """From the number of documents of each vote pattern and known label, None for the many without (3 * 2^n_voters at most).

    First all voters on their own; then pairs that depend on each other within a
    class, strongest first, are given joint tables and the model is estimated
    again. Without known labels the class that more votes go with is the toxic one.
    """
    keys = sorted(patterns, key=str)
    votes = np.array([v for v, _ in keys], np.int64)
    known = np.array([np.nan if y is None else float(y) for _, y in keys])
    counts = np.array([patterns[k] for k in keys], float)
    posterior = np.where(np.isnan(known), np.where(np.bitwise_count(votes) > 0, 0.9, 0.02), known)
    model, posterior = estimate(votes, counts, known, [(v,) for v in range(n_voters)], posterior)
    found = sorted(((dependence(votes, counts, posterior, a, b), a, b) for a in range(n_voters) for b in range(a)), reverse=True)
    groups, used = [], set()
    for strength, a, b in found:
        if strength >= DEPENDENT and not {a, b} & used:
            groups.append((b, a))
            used |= {a, b}
    if groups:
        model, _ = estimate(votes, counts, known, groups + [(v,) for v in range(n_voters) if v not in used], posterior)
    return model


def featured(voted: DataFrame, bits: int = BITS) -> DataFrame:
    """Rows with ``buckets``: the hashes of tokens, of the beginnings of longer ones, and of the voters that fire.

    A bucket may come several times; its first place is that of the first term in it.
    """

    def bucket(term: Column) -> Column:
        return F.hash(term).bitwiseAND((1 << bits) - 1)

    def first(n: int) -> Column:
        return F.transform(F.filter("tokens", lambda t: F.length(t) > n), lambda t: bucket(F.left(t, F.lit(n))))

    fired = F.filter(F.array(*[F.when(F.col("votes").bitwiseAND(1 << j) != 0, bucket(F.lit(f"\x00{j}"))) for j in range(N_VOTERS)]), lambda x: x.isNotNull())
    parts = [F.transform("tokens", bucket), *[first(n) for n in HEADS], fired]
    return voted.withColumn("buckets", F.concat(*parts)).drop("low", "tokens")


@F.udf(VectorUDT())
def presence(buckets):
    """One for each bucket, as a vector to train on."""
    found = sorted(set(buckets))
    return Vectors.sparse(1 << BITS, found, [1.0] * len(found))


@dataclass
class Trained:
    stems: list[str]
    labels: LabelModel
    weights: np.ndarray  # by bucket
    intercept: float

    def chance(self) -> Column:
        """P(toxic) of the rows of ``featured``."""
        used = np.flatnonzero(self.weights).tolist()  # few: the penalty leaves most buckets without weight
        if not used:
            return F.lit(1 / (1 + math.exp(-self.intercept)))
        # A map is searched from its start, so the weights are dealt over many small ones by the low bits of their bucket.
        maps: list[list[Column]] = [[F.lit(-1), F.lit(0.0)] for _ in range(256)]
        for b in used:
            maps[b % 256] += [F.lit(b), F.lit(float(self.weights[b]))]
        weights = F.array(*[F.create_map(*pairs) for pairs in maps])
        hits = F.array_intersect("buckets", F.array(*[F.lit(b) for b in used]))
        margin = F.aggregate(hits, F.lit(self.intercept), lambda total, b: total + F.get(weights, b.bitwiseAND(255))[b])
        return 1 / (1 + F.exp(-margin))


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_TRAINED) -> Trained | None:
    """Stems, label model and classifier, from rows that are not held out; None if there are none.

    ``labels`` (doc_id, toxic 0 or 1) of such rows give the stems and anchor the
    label model, whose vote patterns are counted over all rows. Stems come from up
    to ``most`` labelled rows, the classifier from up to ``most`` rows: those of
    least hash of the id. Their ids, so bounded, are broadcast to the documents.
    """
    rows = docs.select("doc_id", "text").filter((fold(F.col("doc_id")) != 0) & F.col("doc_id").isNotNull())
    known = labels.filter((fold(F.col("doc_id")) != 0) & F.col("toxic").isin(0, 1)).groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("_id")
    some = known.orderBy(order, "_id").limit(most).select("_id", "toxic", F.lit(False).alias("train"))
    others = rows.select(F.col("doc_id").alias("_id")).distinct().orderBy(order, "_id").limit(most)
    wanted = some.union(others.select("_id", F.lit(None).cast("int"), F.lit(True))).groupBy("_id").agg(F.max("toxic").alias("toxic"), F.max("train").alias("train"))
    sample = stored(tokens_of(rows.join(F.broadcast(wanted), F.col("doc_id") == F.col("_id")).drop("_id")))
    stems = find_stems(sample.filter("toxic is not null"))
    voted = with_votes(tokens_of(rows), stems).select("doc_id", "votes").join(known, F.col("doc_id") == F.col("_id"), "left")
    patterns = {(v, y): n for v, y, n in voted.groupBy("votes", "toxic").count().collect()}  # bounded by the number of voters
    if not patterns:
        return None
    model = label_model(patterns)
    seen = sorted({v for v, _ in patterns})
    chance = F.create_map(*[F.lit(x) for v, p in zip(seen, model.posterior(np.array(seen, np.int64))) for x in (v, float(p))])
    weighed = featured(with_votes(sample.filter("train"), stems).withColumn("p", chance[F.col("votes")]))
    sides = F.array(*[F.struct(F.lit(y).alias("label"), w.alias("weight")) for y, w in ((1.0, F.col("p")), (0.0, 1 - F.col("p")))])
    examples = stored(weighed.select(presence("buckets").alias("features"), F.inline(sides)).filter("weight > 0.001"))
    classifier = LogisticRegression(weightCol="weight", regParam=PENALTY, elasticNetParam=1.0, maxIter=60, tol=1e-5).fit(examples)
    return Trained(stems, model, classifier.coefficients.toArray(), float(classifier.intercept))


def score(docs: DataFrame, trained: Trained | None) -> DataFrame:
    """doc_id, held_out, score, predicted of every row, from whole texts.

    Only the text is looked at. A null text scores as an empty one; equal texts
    score alike; without a model every score is 0. An empty table gives no rows.
    """
    held = (fold(F.col("doc_id")) == 0).alias("held_out")
    if trained is None:
        return docs.select("doc_id", held, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    rows = featured(with_votes(tokens_of(docs.select("doc_id", "text")), trained.stems)).select("doc_id", trained.chance().alias("score"))
    return rows.select("doc_id", held, "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return score(docs, train(docs, table(spark, folder, "labels")))


QUERIES = {"op5_toxicity": op5_toxicity}

SQL: dict[str, str] = {}
