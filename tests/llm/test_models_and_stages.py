"""Fitted models against plain formulas, and the pipeline's stages on awkward rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import tiktoken
import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from vitalgrid.llm import bpe, common, quality, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_log_likelihood(weights, cuts, rows, grades, decay):
    """Mean log probability of the grades of a cumulative-link model, less the penalty, by the textbook formula."""
    total = 0.0
    for x, grade in zip(rows, grades):
        score = sum(weights[k] * v for k, v in x.items())
        link = lambda c: 1 / (1 + math.exp(-(c - score)))
        upper = 1.0 if grade == len(cuts) else link(cuts[grade])
        lower = 0.0 if grade == 0 else link(cuts[grade - 1])
        total += math.log(upper - lower)
    return total / len(grades) - decay / 2 * float((weights**2).sum())


def test_fitted_weights_stand_at_the_top_of_the_likelihood():
    rnd = random.Random(3)
    rows, grades = [], []
    for _ in range(300):
        x = {rnd.randrange(12): rnd.choice((0.2, 0.5, 1.0)) for _ in range(4)}
        z = 3 * x.get(1, 0) - 2 * x.get(2, 0) + x.get(5, 0) + rnd.gauss(0, 1)
        rows.append(x)
        grades.append(int(z > 0) + int(z > 1.2) + int(z > 2.5))
    decay = 0.01
    model = quality.fit_rows([len(x) for x in rows], [k for x in rows for k in x], [v for x in rows for v in x.values()], np.array(grades), 4, rounds=4000, decay=decay)
    assert (np.diff(model.cuts) > 0).all() and not model.weights[12:].any()
    top = plain_log_likelihood(model.weights, model.cuts, rows, grades, decay)
    step = 1e-4
    for k in range(12):
        near = []
        for sign in (1, -1):
            moved = model.weights.copy()
            moved[k] += sign * step
            near.append(plain_log_likelihood(moved, model.cuts, rows, grades, decay))
        assert abs(near[0] - near[1]) / (2 * step) < 2e-3 and max(near) < top + 1e-6
    for k in range(3):
        near = []
        for sign in (1, -1):
            cuts = model.cuts.copy()
            cuts[k] += sign * step
            near.append(plain_log_likelihood(model.weights, cuts, rows, grades, decay))
        assert abs(near[0] - near[1]) / (2 * step) < 2e-3 and max(near) < top + 1e-6
    tails = model.tails(np.array([0.3]))[0]
    assert np.allclose(tails, [1 / (1 + math.exp(c - 0.3)) for c in model.cuts])


def plain_em(patterns, n_voters, rounds=500):
    """Posterior of each vote pattern by naive-Bayes EM over single documents, written out with dictionaries."""
    rows = [(v, y) for (v, y), n in patterns.items() for _ in range(n)]
    q = {(v, y): (0.9 if v else 0.02) if y is None else float(y) for v, y in rows}
    for _ in range(rounds):
        mass = [sum(1 - q[r] for r in rows), sum(q[r] for r in rows)]
        prior = min(max(mass[1] / len(rows), 1e-4), 0.5)
        fires = [[(sum((q[r] if c else 1 - q[r]) for r in rows if r[0] >> j & 1) + 0.01) / (mass[c] + 0.02) for j in range(n_voters)] for c in (0, 1)]
        new = {}
        for v, y in q:
            both = [(1 - prior), prior]
            for c in (0, 1):
                for j in range(n_voters):
                    both[c] *= fires[c][j] if v >> j & 1 else 1 - fires[c][j]
            new[v, y] = both[1] / sum(both) if y is None else float(y)
        change = max(abs(new[k] - q[k]) for k in q)
        q = new
        if change < 1e-10:
            break
    return q


def test_label_model_equals_plain_em():
    rnd = random.Random(1)
    patterns = Counter()
    for _ in range(1500):
        toxic = rnd.random() < 0.15
        votes = sum((rnd.random() < ((0.7, 0.5, 0.4, 0.6)[j] if toxic else (0.05, 0.02, 0.1, 0.01)[j])) << j for j in range(4))
        patterns[votes, int(toxic) if rnd.random() < 0.2 else None] += 1
    model = toxicity.label_model(dict(patterns), 4)
    assert sorted(g for g in model.groups) == [(0,), (1,), (2,), (3,)]  # drawn apart, so no pair depends
    plain = plain_em(patterns, 4)
    for (v, y), p in plain.items():
        if y is None:
            assert abs(float(model.posterior(np.array([v]))[0]) - p) < 1e-3


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, tie bigint, _row int, size bigint"


def awkward():
    rnd = random.Random(4)
    words = [f"word{i}" for i in range(500)]
    prose = lambda n: " ".join(rnd.choice(words) for _ in range(n)) + "."
    texts = [prose(rnd.randint(30, 200)) for _ in range(40)]
    texts += [None, "", "", " \n", "one", prose(30_000), "x" * 150_000, texts[0], texts[0], texts[1]]
    long = prose(900).split()
    texts += [" ".join(long), " ".join(long[:-1] + ["changed"])]
    rows = [(i if i % 13 else None, t, "en", None if i % 7 == 0 else f"s{i % 3}", len(t or ""), "k", 1, 2, 3) for i, t in enumerate(texts)]
    return rows + rows[3:6] + rows[3:5]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    rows = awkward()
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    labels = [(r[0], int(i % 3 > 0), int(i % 9 == 1)) for i, r in enumerate(rows)] + [(5, 1, 0), (None, 0, 0), (7, None, None)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def bag(rows):
    return Counter((r.doc_id, r.text, r.source) for r in rows)


def test_stages_on_awkward_rows(spark, folder):
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.createDataFrame(awkward(), SCHEMA).repartition(3)
    for name, stage in stages.items():
        empty = stage(spark, docs.limit(0), folder)
        assert empty.count() == 0, name
        out = stage(spark, docs, folder)
        if name == "byte-level BPE":
            library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(public_tokenizers.path(bpe.VOCABULARY)), special_tokens={})
            short = [r for r in awkward() if len(r[1] or "") < 50_000]
            expected = Counter((r[0], len(library.encode_ordinary(r[1] or ""))) for r in short)
            got = Counter((r.doc_id, r.n_tokens) for r in out.collect())
            assert sum(got.values()) == len(awkward()) and not expected - got
            continue
        assert out.columns == docs.columns, name
        rows, before = bag(out.collect()), bag(docs.collect())
        if name == "mixing sources":
            assert set(rows) <= set(before) and all(n <= 2 * before[k] for k, n in rows.items())
            continue
        assert not rows - before, name
        if name == "exact dedup":
            kept = {t or "" for _, t, _ in rows}
            assert sum(rows.values()) == len(kept) == len({r[1] or "" for r in awkward()})
            least = {}
            for i, t, *_ in awkward():
                if i is not None:
                    least[t or ""] = min(i, least.get(t or "", i))
            assert all(i == least.get(t or "") for i, t, _ in rows)
        if name == "SimHash near-dedup":
            assert len({t for _, t, _ in rows if t and len(t.split()) in (900,)}) == 1  # one word of 900 changed
            texts = Counter(t or "" for _, t, _ in rows)
            assert max(texts.values()) == 1 and sum(1 for t in texts if not WORD.findall(t)) == 1


def test_pipeline_leaves_only_its_stages_behind(spark, folder, monkeypatch):
    stored = []
    monkeypatch.setattr(common.uuid, "uuid4", lambda make=common.uuid.uuid4: stored.append(make()) or stored[-1])
    assert corpus_pipeline.run(spark, folder).count() > 0
    top = common.shared_folder(spark)
    handle = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(top)
    names = {s.getPath().getName() for s in handle.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(handle)}
    own = {n for n in names if any(u.hex in n for u in stored)}
    assert own and all(n.startswith("stage_") for n in own)


def test_a_session_without_a_shared_folder(monkeypatch, tmp_path):
    from types import SimpleNamespace

    monkeypatch.setattr(common, "_LOCAL", [])
    made = lambda master: SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master=master))
    first = common.shared_folder(made("local[2]"))
    assert first.startswith("file:///tmp/run-") and common.shared_folder(made("local[2]")) == first
    with pytest.raises(ValueError):
        common.shared_folder(made("spark://host:7077"))


def test_stored_rows_belong_to_their_block(spark):
    with common.scratch(spark):
        outer = common.stored(spark.range(3))
        with common.scratch(spark):
            inner = common.stored(spark.range(4))
            assert inner.count() == 4
        assert outer.count() == 3  # the inner block's end leaves it alone
        with pytest.raises(Exception):
            spark.read.parquet(inner.stored_at).count()
        other = common.stored(spark.range(5).select(F.col("id")))
        common.release(other)
        with pytest.raises(Exception):
            spark.read.parquet(other.stored_at).count()
    with pytest.raises(Exception):
        spark.read.parquet(outer.stored_at).count()
