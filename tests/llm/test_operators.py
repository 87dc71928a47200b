"""Operators against brute force, on rows with nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
import xxhash
from pyspark.sql import functions as F

from vitalgrid.llm import bpe, exact, licenses, mixing, quality, rules, simhash, toxicity, warc, wordpiece
from vitalgrid.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row int, size bigint, fp bigint, tokens int, votes int, w int, body int, path_ string"


def made():
    rnd = random.Random(5)
    vocabulary = ["".join(rnd.choice("abcdeéßœ一,.!") for _ in range(rnd.randint(1, 9))) for _ in range(400)]
    texts = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(1, 120))) for _ in range(60)]
    texts += [None, "", " \n\t", "one", "one two", "A B\nA B\n\n x", "idiot " * 40, "|| ## x y\x1cz", "  \x85 é" * 30]
    texts += [" ".join(rnd.choice(vocabulary) for _ in range(90_000)), "x" * 200_000]
    texts += [texts[0]] * 30 + [texts[1] + " end", texts[1]]
    rows = [(i if i % 17 else None, t, "en", None if i % 9 == 0 else f"s{i % 4}", 0) for i, t in enumerate(texts)]
    return rows + rows[3:6]  # the same rows again


@pytest.fixture(scope="module")
def docs(spark):
    rows = [r + (1, 2, 3, 4, 5, 6, 7, "p") for r in made()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def same(df, expected):
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted((tuple(r) for r in df.collect()), key=key) == sorted(expected, key=key)


def test_word_pieces(docs, none):
    path = public_tokenizers.path(wordpiece.VOCABULARY)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    known = {model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}

    def greedy(word):
        i, n, mark = 0, 0, "▁"
        while i < len(word) or mark:
            j = next((j for j in range(min(len(word), i + 40), i - bool(mark), -1) if mark + word[i:j] in known), None)
            if j is None:
                return 0
            i, n, mark = j, n + 1, ""
        return n

    expected = []
    for i, t, *_ in made():
        ns = [greedy(w) for w in WORD.findall(t or "")]
        expected.append((i, len(ns), sum(n or 1 for n in ns), sum(not n for n in ns)))
    automaton = wordpiece.load(path)
    same(wordpiece.token_counts(docs, automaton), expected)
    assert wordpiece.token_counts(none, automaton).count() == 0


def test_automaton_without_cover():
    a = wordpiece.Automaton.of(["ab", "abcd", "a"], ["c", "cde", "d"])
    assert [a.count(w) for w in ("abcd", "abcde", "abc", "abx", "x", "acd")] == [1, 0, 2, 0, 0, 3]


def test_mix_meets_targets(docs, none):
    got = mixing.mix(docs).collect()
    rows = made()
    assert Counter((r.doc_id, r.source, r["size"]) for r in got) == Counter((i, s, len(WORD.findall(t or ""))) for i, t, _, s, _ in rows)
    sizes, taken, targets, largest = Counter(), Counter(), {}, Counter()
    for r in got:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        targets[r.source] = r.target
        largest[r.source] = max(largest[r.source], r["size"])
        assert 0 <= r.taken <= 2 * r["size"] and r.source_size >= r["size"] and r.copies <= 2
    assert abs(sum(targets.values()) - 1.5 * sum(sizes.values())) < 1e-6 * sum(sizes.values())
    for s in sizes:
        assert targets[s] <= 2 * sizes[s] + 1e-6 and abs(taken[s] - targets[s]) <= 3 * largest[s]
    again = mixing.mix(docs.repartition(5)).collect()
    assert Counter((r.doc_id, r.taken) for r in got) == Counter((r.doc_id, r.taken) for r in again)
    assert mixing.mixed_documents(docs).count() == sum(r.copies for r in got)
    assert mixing.mix(none).count() == 0 and mixing.mixed_documents(none).columns == docs.columns


def test_byte_bpe_equals_the_library(docs, none):
    ranks = bpe.load_ranks(public_tokenizers.path(bpe.VOCABULARY))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    expected = []
    for i, t, *_ in made():
        ids = library.encode_ordinary(t or "") if len(t or "") < 150_000 else [x for w in [t] for x in bpe.fold(w.encode(), ranks)]
        expected.append((i, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())))
    same(bpe.digests(docs, ranks, public_tokenizers.PATTERN), expected)
    back = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks)
    same(back.select("doc_id", F.col("decoded").cast("string")), [(i, t or "") for i, t, *_ in made()])
    assert bpe.digests(none, ranks, public_tokenizers.PATTERN).count() == 0


def test_fold_in_spark_functions(spark):
    ranks = bpe.load_ranks(public_tokenizers.path(bpe.VOCABULARY))
    words = ["the", " hello", "straßenbahn", "a", "zzzzqqq", " 一二", None, "the"]
    got = bpe.fold_words(spark.createDataFrame([(w,) for w in words], "word string"), ranks)
    same(got.select("word", "ids"), [(w, bpe.fold(w.encode(), ranks)) for w in {*words} - {None}])


def fingerprint(text, n=3):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) << b for b in range(64))


def test_index_spares_joined_nodes():
    rnd = np.random.default_rng(3)
    codes = np.sort(rnd.integers(0, 1 << 12, 300).astype(np.uint64))[:, None]
    labels = np.arange(300) // 20
    index = simhash.Index(codes, np.zeros(300, int))
    pairs = lambda *x: {(int(i), int(j)) for a, b in index.pairs(4, *x) for i, j in zip(a, b)}
    every = {(i, j) for i in range(300) for j in range(i + 1, 300) if int(codes[i, 0] ^ codes[j, 0]).bit_count() <= 4}
    assert pairs() == every and pairs(labels) == {(i, j) for i, j in every if labels[i] != labels[j]}


def test_simhash_components(docs, none):
    rows = [(i, fingerprint(t or "")) for i, t, *_ in made()]
    prints = [p for _, p in rows]
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2 and label[a] != label[b]:
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    least = {x: min((i for (i, _), y in zip(rows, label) if x == y and i is not None), default=None) for x in label}
    got = simhash.near_duplicates(docs)
    same(got.select("doc_id", "fp", "component_id"), [(i, p - (1 << 64) * (p >> 63), least[x]) for (i, p), x in zip(rows, label)])
    assert {r.component_id for r in got.filter("stays").collect()} == set(least.values())
    left = simhash.without_near_duplicates(docs)
    assert simhash.near_duplicates(none).count() == 0 and left.columns == docs.columns and left.count() == len(least)


def test_index_finds_all_links_of_a_crowd(spark):
    rnd = np.random.default_rng(3)
    prints = {int(b) ^ sum(1 << int(k) for k in set(rnd.integers(0, 64, 4).tolist())) for b in rnd.integers(0, 2**63, 9) for _ in range(150)}
    codes = np.array(sorted(prints), np.uint64)
    label = np.arange(len(codes))
    for i in range(len(codes)):
        near = np.flatnonzero(np.bitwise_count(codes[i + 1 :] ^ codes[i]) <= 2) + i + 1
        label = simhash.joined(label, np.full(len(near), i), near)
    expected = Counter(label.tolist())
    df = spark.createDataFrame([(int(x),) for x in codes.view(np.int64)], "fp bigint")
    got = Counter(r.root for r in components(simhash.links(df)).collect())
    assert sorted(n for n in expected.values() if n > 1) == sorted(got.values())


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, 5), (None, 3), (7, 6), (6, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**dict.fromkeys(range(100, 161), 100), 6: 6, 7: 6}


@pytest.mark.parametrize("largest", [False, True])
def test_exact_duplicates(docs, none, largest):
    groups = {}
    for i, t, *_ in made():
        groups.setdefault(t or "", []).append(i)
    keep = {t: (max if largest else min)((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    expected = [(i, keep[t], len(ids), i == keep[t], hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for i in ids]
    same(exact.exact_duplicates(docs, largest=largest), expected)
    left = exact.without_exact_duplicates(docs, largest=largest)
    assert left.columns == docs.columns and left.count() == left.select("text").na.fill("").distinct().count() == len(groups)
    assert exact.exact_duplicates(none).count() == 0


def test_quality_orders_grades(spark, docs, none):
    good = [(i, " ".join(random.Random(i).choices("the of and to in river hill".split(), k=60))) for i in range(300)]
    poor = [(i, "| # x | " * (i % 9 + 3)) for i in range(300, 600)]
    middle = [(i, t + " | #" * 6) for i, t in ((i, good[i - 600][1]) for i in range(600, 900))]
    rated = spark.createDataFrame(good + poor + middle, "doc_id bigint, text string")
    grade = F.when(F.col("doc_id") < 300, 2).when(F.col("doc_id") < 600, 0).otherwise(1)
    model = quality.fit(rated.filter("doc_id % 5 != 0"), rated.select("doc_id", grade.alias("grade")), 3)
    assert (np.diff(model.cuts) > 0).all()
    held = quality.rate(rated.filter("doc_id % 5 = 0"), model).withColumn("grade", grade).collect()
    assert np.mean([round(r.expected_grade) == r.grade for r in held]) > 0.95
    assert all(r.tail[0] >= r.tail[1] and abs(sum(r.tail) - r.expected_grade) < 1e-9 for r in held)
    assert quality.rate(docs, model).count() == docs.count() and quality.rate(none, model).count() == 0
    chosen = quality.selected(docs, model)
    assert chosen.columns == docs.columns
    assert chosen.count() == quality.rate(docs, model).filter("tail[0] >= 0.5").count()
    blank = quality.fit(none, spark.createDataFrame([], "doc_id bigint, grade int"), 3)
    assert len({r.score for r in quality.rate(docs, blank).collect()}) == 1


def test_revisits(spark):
    h = lambda **x: {k.replace("_", "-"): v for k, v in x.items()}
    rows = [
        (1, "http://www.A.com/p/?utm_source=x", 10, True, h(etag='"1"', server="a", content_length="5"), "d1"),
        (2, "https://a.com/p#f", 10, False, h(etag='"1"'), None),  # same time: not earlier
        (3, "https://a.com/p", 20, False, h(etag='W/"1"', date="20", content_length="0"), None),
        (4, "http://a.com/p", 30, True, h(last_modified="m"), "d4"),
        (5, "http://a.com/p/", 40, False, h(etag='"1"', last_modified="m"), None),
        (6, "http://a.com/p", 41, False, h(last_modified="n"), None),
        (7, "http://a.com/p", 42, False, None, None),
        (8, None, 50, False, h(), None),
        (9, "http://b.com/", None, False, h(), None),
    ]
    schema = "record_id bigint, url string, ts bigint, full boolean, headers map<string,string>, digest string"
    got = {r.record_id: (r.status, r.target_id, r.digest, r.headers) for r in warc.resolve_revisits(spark.createDataFrame(rows, schema)).collect()}
    assert got[2][:2] == ("missing", None) and got[8][0] == got[9][0] == "missing"
    assert got[3] == ("resolved", 1, "d1", {"etag": 'W/"1"', "server": "a", "content-length": "5", "date": "20"})
    assert got[5] == ("resolved", 4, "d4", {"last-modified": "m", "etag": '"1"'})
    assert got[6] == ("changed", 4, None, {"last-modified": "n"}) and got[7][:3] == ("unverified", 4, "d4")
    assert warc.resolve_revisits(spark.createDataFrame([], schema)).count() == 0


def test_revisits_of_one_hot_address(spark):
    rows = [(i, "http://hot.com/", i // 3, i % 7 == 0, {"etag": '"e"'}, f"d{i}") for i in range(3000)]
    schema = "record_id bigint, url string, ts bigint, full boolean, headers map<string,string>, digest string"
    full = [r for r in rows if r[3]]
    expected = {r[0]: max(((f[2], f[0]) for f in full if f[2] < r[2]), default=(0, None))[1] for r in rows if not r[3]}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = warc.resolve_revisits(spark.createDataFrame(rows, schema).repartition(4)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert {r.record_id: r.target_id for r in got} == expected


def test_base_counts_and_ratio(docs, none):
    ratios = [((b * 7919) % 1000 - 500) / 1000 for b in range(rules.BUCKETS)]
    bucket = lambda h: h & rules.BUCKETS - 1
    expected, totals = [], []
    for i, t, *_ in made():
        t = t or ""
        w = WORD.findall(t)
        seen = Counter(zip(w, w[1:], w[2:]))
        again = {k + d for k in range(len(w) - 2) if seen[w[k], w[k + 1], w[k + 2]] > 1 for d in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
        hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in w]
        pairs = [xxhash.xxh64_intdigest(b.encode(), a) for a, b in zip(hashes, w[1:])]
        mean = sum(ratios[bucket(h)] for h in hashes + pairs) / max(1, len(hashes + pairs))
        totals.append((i, len(w), round(mean, 6)))
        expected.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again), failed, not failed and mean >= -0.1))
    got = rules.judge(docs, ratios, -0.1).cache()
    same(got.drop("log_ratio"), expected)
    same(got.select("doc_id", "n_words", F.round("log_ratio", 6)), totals)
    assert rules.judge(none, ratios).count() == 0


def test_ratios_of_trusted_and_raw(spark, docs):
    trusted = docs.filter("text is not null").limit(5)
    ratios = np.array(rules.log_ratios(trusted, docs))
    counts = [np.zeros(rules.BUCKETS), np.zeros(rules.BUCKETS)]
    for n, rows in zip(counts, (trusted, docs)):
        for r in rows.collect():
            w = WORD.findall(r.text or "")
            h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in w]
            for x in h + [xxhash.xxh64_intdigest(b.encode(), a) for a, b in zip(h, w[1:])]:
                n[x & rules.BUCKETS - 1] += 1
    p, q = ((n + 1) / (n.sum() + rules.BUCKETS) for n in counts)
    assert np.allclose(ratios, np.log(p / q))
    assert set(rules.log_ratios(docs.limit(0), docs)) == {0.0}


def test_label_model_recovers_rates():
    rnd = np.random.default_rng(1)
    y = rnd.random(20_000) < 0.2
    votes = sum(((rnd.random(len(y)) < np.where(y, a, b)).astype(int) << j) for j, (a, b) in enumerate([(0.6, 0.02), (0.5, 0.01), (0.4, 0.05), (0.0, 0.0)]))
    votes |= (votes & 1) << 4  # a voter that repeats the first
    patterns = Counter((int(v), int(t) if k % 3 == 0 else None) for k, (v, t) in enumerate(zip(votes, y)))
    model = toxicity.label_model(patterns, 5)
    assert (0, 4) in model.groups and abs(model.prior - 0.2) < 0.02
    assert abs(model.rates()[1][1] - 0.5) < 0.03 and model.rates()[1][0] < 0.03


def test_toxicity(spark, docs, none):
    rnd = random.Random(4)
    plain = [" ".join(rnd.choice("river hill stone water light paper green".split()) for _ in range(30)) for _ in range(600)]
    insults = "idiot loser clown trash stupid pathetic".split()  # each on its own, as the label model takes voters to be
    rows = [(i, " ".join([t, *(rnd.sample(insults, rnd.randint(1, 3)) if i % 2 else [])])) for i, t in enumerate(plain)]
    rows += [(1000 + i, plain[i] + " zworkel") for i in range(100)]
    texts = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = texts.select("doc_id", ((F.col("doc_id") >= 1000) | (F.col("doc_id") % 2 == 1)).cast("int").alias("toxic"))
    trained = toxicity.train(texts, labels)
    got = toxicity.score(texts, trained).join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.toxic for r in got if r.held_out]) > 0.95
    assert any("zworkel".startswith(s) for s in trained.stems)
    assert all(0 <= r.score <= 1 for r in toxicity.score(docs, trained).collect())
    assert toxicity.score(docs, trained).count() == docs.count() and toxicity.score(none, trained).count() == 0
    assert toxicity.train(texts.limit(0), labels) is None and toxicity.score(docs, None).filter("score = 0").count() == docs.count()


def test_licenses(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    files = [
        (1, "a/LICENSE", mit), (2, "a/b/c/x.txt", "nothing here"), (3, "a/b/LICENSE.md", "Intro. " + gpl), (4, "a/y.txt", None),
        (5, "a/b/c/z.txt", "word " * 50_000 + "\n" + mit), (6, "q.txt", "a license to drive"), (7, None, mit), (8, None, ""), (2, "a/b/c/x.txt", "nothing here"),
        (9, "ab/y.txt", "x"),
    ]
    df = spark.createDataFrame([(*f, "clash") for f in files], "doc_id bigint, path string, text string, license string")
    expected = [
        (1, "MIT", "own"), (2, "GPL-3.0", "inherited"), (2, "GPL-3.0", "inherited"), (3, "GPL-3.0", "own"), (4, "MIT", "inherited"),
        (5, "MIT", "own"), (6, None, "none"), (7, "MIT", "own"), (8, None, "none"), (9, None, "none"),
    ]
    same(licenses.scan(df).select("doc_id", "license", "origin"), expected)
    assert licenses.scan(df.limit(0)).count() == 0


def test_license_notices_inside_sentences(spark):
    terms = "you can redistribute it and/or modify\n# it under the terms of the GNU {}General Public License as published by\n# the Free Software Foundation; either version {} of the License, or any later version."
    bsd = "Copyright (c) 2020 Jane Doe\nAll rights reserved.\n\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:"
    texts = [
        ("This project is licensed under the MIT License.", "MIT"), ("Foo is released under the MIT License.", "MIT"),
        ("This project is licensed under the Apache License, Version 2.0.", "Apache-2.0"),
        ("Copyright (c) 2020 Jane Doe, all rights reserved.", "proprietary"),
        ("# This program is free software: " + terms.format("", 2), "GPL-2.0"), ("# This is free software: " + terms.format("", 3), "GPL-3.0"),
        ("# This library is free software; " + terms.format("Lesser ", 2.1), "LGPL-2.1"), ("# Bar: " + terms.format("Affero ", 3), "AGPL-3.0"),
        (bsd, "BSD-2-Clause"),
        (bsd + " ...\n" + "word " * 60 + "3. Neither the name of the University nor the names of its\n   contributors may be used to endorse or promote products derived from\n   this software without specific prior written permission.", "BSD-3-Clause"),
        (bsd + " ...\n3. Neither the name of the copyright holder nor the names of its\n   contributors may be used to endorse or promote products derived from\n   this software without specific prior written permission.", "BSD-3-Clause"),
        ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.", "ISC"),
        ("This project is licensed under the Foo License.", None), ("Copyright (c) 2020 Jane Doe", None), ("a driving licence", None),
    ]
    df = spark.createDataFrame([(i, f"d{i}/x", t) for i, (t, _) in enumerate(texts)], "doc_id bigint, path string, text string")
    same(licenses.scan(df).select("doc_id", "license"), [(i, name) for i, (_, name) in enumerate(texts)])


def test_license_cosines_equal_plain_tfidf(spark):
    rnd = random.Random(12)
    notes = [t for texts in licenses.TEMPLATES.values() for t in texts]
    words = "the of license licensed under copyright a software this spdx public domain gnu foo bar baz reserved rights version 2".split()
    texts = []
    for i in range(150):
        note = rnd.choice(notes).split()
        note = [w for w in note if rnd.random() > 0.15]
        fill = lambda n: [rnd.choice(words + [f"x{rnd.randint(0, 40)}"]) for _ in range(rnd.randint(0, n))]
        texts.append(" ".join(fill(40) + note + fill(40) + (rnd.choice(notes).split() if i % 3 == 0 else [])))
    texts += ["", "license", "licensed " * 300, "SPDX-License-Identifier: Apache-2.0", "the gnu gpl"]
    df = spark.createDataFrame([(i, f"f{i}", t) for i, t in enumerate(texts)], "doc_id bigint, path string, text string")
    found = [r.passage for r in licenses.passages(df).collect()]
    templates = licenses.notices()
    total, seen = len(found) + len(templates), Counter()
    for ws in [p.split() for p in found] + [ws for _, ws in templates]:
        seen.update(set(ws))
    idf = {w: np.log((1 + total) / (1 + n)) + 1 for w, n in seen.items()}

    def vector(ws):
        return {w: n * idf[w] for w, n in Counter(ws).items()}

    def norm(v):
        return np.sqrt(sum(x * x for x in v.values()))

    expected = {}
    for p in set(found):
        ws, cue = p.split(), len(p.split("\n")[0].split())
        for number, (name, t) in enumerate(templates):
            n, b = min(len(t), len(ws)), vector(t)
            for at in range(len(ws) - n + 1):
                if not at <= cue < at + n and len(ws) > n:
                    continue
                run = ws[at : at + n]
                a = vector(run)
                cosine = round(float(sum(a[w] * b.get(w, 0.0) for w in a) / norm(a) / norm(b)), 9)
                if cosine >= 0.6 and re.search(licenses.CUE, " ".join(run)):
                    key = (licenses.PART_OF_OTHERS.get(name, 0), -cosine, number)
                    expected[p] = min(expected.get(p, (9,)), (*key, name))
    got = {r.passage: (r.license, r.cosine) for r in licenses.matches(licenses.passages(df)).collect()}
    assert got.keys() == expected.keys() and len(got) > 100
    near = licenses.candidates(licenses.passages(df).select("passage", F.lit(1).alias("id")), licenses.reference(spark.createDataFrame([(w, float(x)) for w, x in idf.items()], "word string, idf double")))
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "NestedLoop", "Cartesian"))
    assert all(got[p][0] == e[3] and abs(got[p][1] + e[1]) < 2e-9 for p, e in expected.items())


def test_identifier_lines_and_short_forms(spark):
    texts = [
        ("// SPDX-License-Identifier: Apache-2.0", "Apache-2.0"), ("# SPDX-License-Identifier: MIT\nimport os", "MIT"), ("SPDX-License-Identifier: GPL-3.0", "GPL-3.0"),
        ("This tool is distributed under the GNU GPL v3.", "GPL-3.0"), ("The code is GPLv2 licensed.", "GPL-2.0"), ("Use of this source code is governed by a BSD-style license.", "BSD-style"),
        ("made available under the terms of the Eclipse Public License 2.0 which is available at", "EPL-2.0"), ("Licensed under the EUPL, Version 1.2 only", "EUPL-1.2"),
        ("This is free and unencumbered software released into the public domain.", "Unlicense"), ("Distributed under the Boost Software License, Version 1.0. (See accompanying file", "BSL-1.0"),
        ("SPDX-License-Identifier: NoSuchThing-9.9", None),
    ]
    df = spark.createDataFrame([(i, f"d{i}/x", t) for i, (t, _) in enumerate(texts)], "doc_id bigint, path string, text string")
    same(licenses.scan(df).select("doc_id", "license"), [(i, name) for i, (_, name) in enumerate(texts)])


def test_license_words_weigh_by_their_count(spark):
    # Each of these words stands in every passage, so none of them weighs more than a template's.
    df = spark.createDataFrame([(i, "x", f"zebra quagga licensed under the mit license okapi n{i}") for i in range(40)], "doc_id bigint, path string, text string")
    words = {r.passage.split()[0] for r in licenses.passages(df).collect()}
    assert words == {"zebra"}
    assert {r.license for r in licenses.scan(df).collect()} == {"MIT"}


def test_quality_takes_one_text_a_document(spark):
    docs = spark.createDataFrame([(i, f"good prose number {i} " * 5 if i % 2 else f"|| spam {i} ## " * 5) for i in range(40)], "doc_id bigint, text string")
    ratings = spark.createDataFrame([(i, 2 * (i % 2)) for i in range(40)], "doc_id bigint, grade int")
    repeated = docs.union(docs.filter("doc_id = 3").crossJoin(spark.range(200)).select("doc_id", "text"))
    one, many = (quality.fit(d, ratings, 3) for d in (docs, repeated))
    assert one.score(b"good prose") == many.score(b"good prose")


def test_toxicity_score_looks_once_at_tokens(spark):
    """Scores equal a sum over exploded terms; only the few tokens like a stem are looked up in the lists."""
    texts = ["", None, "Lügen lügen abcdefghijk abcd", "x xy lügner!!! abcdefg", "you are a moron x", "abcdef shut up, 日本語日本語日本語 " * 3]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    stems = ["x", "lüg", "abcde", "abcdef", "日本語日"]
    n = toxicity.N_VOTERS
    labels = toxicity.LabelModel(0.1, [(v,) for v in range(n)], [np.full((2, 2), 0.5)] * n)
    weights = np.where(np.arange(1 << toxicity.BITS) % 3 == 0, 0.0, np.arange(1 << toxicity.BITS) % 1000 / 4000 - 0.1)
    weights[np.arange(1 << toxicity.BITS) % 40 > 0] = 0.0
    tokens = toxicity.tokens_of(docs)
    voted = toxicity.with_votes(tokens, stems)
    apart = tokens.select("doc_id", F.explode_outer("tokens").alias("t"))
    first = n - toxicity.STEM_VOTERS
    for k in range(toxicity.STEM_VOTERS):
        own = stems[k :: toxicity.STEM_VOTERS]
        want = {r.doc_id for r in apart.collect() if r.t is not None and any(r.t.startswith(s) for s in own)}
        assert {r.doc_id for r in voted.collect() if r.votes >> first + k & 1} == want
    # Every bucket of the terms has weight, so that repeats would show.
    terms = apart.select("doc_id", F.explode(F.array("t", *[F.left("t", F.lit(h)) for h in toxicity.HEADS])).alias("x")).filter("x is not null")
    fired = [(r.doc_id, f"\x00{j}") for r in voted.collect() for j in range(n) if r.votes >> j & 1]
    terms = terms.union(spark.createDataFrame(fired, "doc_id bigint, x string"))
    found = terms.select("doc_id", F.pmod(F.hash("x"), F.lit(1 << toxicity.BITS)).alias("b")).distinct().collect()
    for r in found:
        weights[r.b] = (r.b % 1000 + 1) / 4000
    want = {i: 1 / (1 + np.exp(1 - sum(weights[r.b] for r in found if r.doc_id == i))) for i in range(len(texts))}
    scored = toxicity.score(docs, toxicity.Trained(stems, labels, weights, -1.0))
    got = {r.doc_id: r.score for r in scored.collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-12 for i in want)
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "exists(tokens#" not in plan and "exists(stem_like#" in plan
    assert "array_distinct(concat(" not in plan
