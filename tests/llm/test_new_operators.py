"""Operators 11 to 13 against brute force, on rows with nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from vitalgrid.llm import conversations, substrings, whitening

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = {"s": conversations.S, "u": conversations.U, "a": conversations.A}


def cheapest(rows):
    """(cost, audit, lines) by trying all edits of each prefix; rows are (role, text, fault)."""
    best = {"": (0, "", ())}

    def inserts(found):
        for _ in range(3):
            for state, (cost, audit, lines) in list(found.items()):
                to = "a" if state == "u" else "u"
                new = (cost + 5, audit + "I", (*lines, ("user:" if to == "u" else "assistant:")))
                if to not in found or new < found[to]:
                    found[to] = new
        return found

    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    for role, text, fault in rows:
        after = {}
        for state, (cost, audit, lines) in inserts(dict(best)).items():
            options = [(state, 2, "D", ())]
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                if role[:1] and role[:1] in follow[state]:
                    options.append((role[:1], extra, "K", (f"{role}:{text}",)))
                to = "a" if state == "u" else "u"
                options.append((to, 1 + extra, "R", (f"{'user' if to == 'u' else 'assistant'}:{text}",)))
            for to, price, letter, line in options:
                new = (cost + price, audit + letter, (*lines, *line))
                if to not in after or new < after[to]:
                    after[to] = new
        best = after
    return min(v for k, v in inserts(dict(best)).items() if k in ("", "a"))


def judged(rows):
    seen, out = set(), []
    for role, text in rows:
        words = text.strip(" \t\n\v\f\r")
        out.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def repaired(rows):
    """What the contract wants of the rows (turn, role, text) of a conversation, in order."""
    found = judged([r[1:] for r in rows])
    cost, audit, lines = cheapest([(role, text, fault) for (_, role, text), fault in zip(rows, found)])
    turns = {t for t, *_ in rows if t is not None}
    heads = [r[1][:1] for r in rows]
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(found.count(x) for x in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(heads, heads[1:])),
        cost,
        audit,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


ROLES = ["user", "assistant", "system", "tool", "", "User", "unicorn", "sage"]


def test_tables_find_the_cheapest_edits_and_least_letters():
    rnd = random.Random(4)
    names = ["", "blank", "truncated"]
    strings = [list(x) for n in range(4) for x in itertools.product([(r, f) for r in ROLES[:4] for f in names], repeat=n)][:2500]
    strings += [[(rnd.choice(ROLES), rnd.choice(names)) for _ in range(rnd.randint(4, 30))] for _ in range(400)]
    t = conversations.tables()
    for string in strings:
        codes = bytes(conversations.GONE if f == "blank" else conversations.symbol(r[:1], f == "truncated") for r, f in string)
        rows = [(r, f"t{i}", f) for i, (r, f) in enumerate(string)]
        cost, audit, lines = cheapest(rows)
        got = conversations.written([r for r, *_ in rows], [x for _, x, _ in rows], t.trace(codes, 0, [conversations.START], True))
        assert (t.cost(codes), got[0], tuple(got[1])) == (cost, audit, lines), string
        for cut in {1, len(codes) // 2} - {0, len(codes)}:  # a chunk is a map from vector to vector and from state to state
            behind, paid, _ = t.backward(codes[cut:], np.zeros(1, np.int64))
            first = list(t.trace(codes[:cut], int(behind[0]), [conversations.START], False))
            state = first[-1][2] if first else conversations.START
            rest = list(t.trace(codes[cut:], 0, [state], True))
            assert "".join(x for _, x, _ in first + rest) == audit


def talks():
    rnd = random.Random(8)
    says = ["Well.", "Yes!", "No", "", " \n", "What? ", "long " * 30 + ".", "é\x85"]
    rows = [(c, t, rnd.choice(ROLES[:3] * 4 + ROLES), rnd.choice(says)) for c in range(60) for t in range(rnd.randint(1, 9))]
    rows += [(200, t, ["user", "assistant"][t % 2], rnd.choice(says)) for t in range(700)]  # a long one
    rows += [(None, 1, "user", "Hi."), (None, None, None, None), (201, None, "user", "Null turn."), (201, None, "assistant", None), (202, 5, "user", "Same.")]
    rows += [(203, 1, "user", "Again.")] * 40 + [(204, 3, "user", f"Tie {i}.") for i in range(5)] + [(205, 10, "system", "Alone."), (205, 2, "user", "x")]
    return rows + rows[:4]


TALK = "conv_id bigint, turn bigint, role string, text string, part int, seen string, same int, n long"


def brute_damage(rows):
    out = []
    for c, t, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(c, t, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


@pytest.mark.parametrize("chunk", [1 << 14, 7])
def test_conversations(spark, monkeypatch, chunk):
    monkeypatch.setattr(conversations, "CHUNK", chunk)
    df = spark.createDataFrame([r + (1, "x", 2, 3) for r in talks()], TALK).repartition(4)
    damaged = conversations.damaged(df)
    order = lambda r: tuple((x is None, str(x)) for x in r)
    rows = brute_damage(talks())
    assert sorted(map(tuple, damaged.collect()), key=order) == sorted(rows, key=order)
    ties = {r.text: r.tie for r in damaged.selectExpr("text", "xxhash64(text) tie").collect()}
    expected = []
    for c in {r[0] for r in rows}:
        own = sorted((r[1:] for r in rows if r[0] == c), key=lambda r: (r[0] is not None, r[0] or 0, r[1], ties[r[2]]))
        expected.append((c, *repaired(own)))
    got = [tuple(r) for r in conversations.structure(damaged).collect()]
    assert sorted(got, key=order) == sorted(expected, key=order)
    assert conversations.structure(damaged.limit(0)).count() == 0


def texts():
    rnd = random.Random(6)
    vocabulary = [f"w{i}" for i in range(300)]
    some = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    passages = [some(n) for n in (19, 20, 21, 27, 60, 200)]
    out = [None, "", " \n", some(5), passages[1], passages[1] + " x", "y\t" + passages[1], passages[0] + " q", passages[0]]
    out += ["a " * 70, "a b " * 50, "a " * 21, some(10) + " " + "a " * 25]
    out += ["p q r s t " * 6, "only once " * 12, some(30) + " m n o" * 9]
    for _ in range(60):
        out.append(" ".join(rnd.choice([some(rnd.randint(0, 40)), rnd.choice(passages), rnd.choice(passages)[5:-9]]) for _ in range(rnd.randint(1, 6))))
    out += [out[20]] * 25 + [some(70_000) + " " + passages[4], "z" * 100_000, passages[5] + " " + passages[5]]
    rows = [(i if i % 23 else None, t) for i, t in enumerate(out)]
    return rows + rows[30:33] + [(40, out[41]), (40, out[42])]


def brute_removed(rows, tie):
    """Per row (doc_id, text): words left, by looking at all windows in order."""
    first = {}
    order = sorted({(i is None, (tie[t] & (1 << 64) - 1) >> 2 if i is None else i, tie[t or "", "tie"], i, t or "") for i, t in rows}, key=lambda r: r[:3])
    out = {}
    for *_, i, t in order:
        words = WORD.findall(t)
        gone = [False] * len(words)
        for at in range(len(words) - 19):
            window = tuple(words[at : at + 20])
            if first.setdefault(window, (i, t, at)) != (i, t, at):
                gone[at : at + 20] = [True] * 20
        out[i, t] = [w for w, g in zip(words, gone) if not g]
    return out


@pytest.mark.parametrize("partitions,piece", [(3, 1 << 18), (60, 1 << 18), (5, 3000)])
def test_substrings(spark, monkeypatch, partitions, piece):
    monkeypatch.setattr(substrings, "PIECE", piece)
    rows = texts()
    df = spark.createDataFrame([(i, t, 1, "p", 2) for i, t in rows], "doc_id bigint, text string, doc int, places string, tie int").repartition(5)
    keys = substrings.keyed(df).selectExpr("cast(text as string) text", "doc", "tie").distinct().collect()
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = substrings.substring_duplicates(df).collect()
        empty = substrings.substring_duplicates(df.limit(0)).count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    hashes = {r.text: r.doc for r in spark.createDataFrame([(t,) for t in {t or "" for _, t in rows}], "text string").selectExpr("text", "xxhash64(text) doc").collect()}
    tie = {**hashes, None: hashes[""], **{(r.text, "tie"): r.tie for r in keys}}
    kept = brute_removed(rows, tie)
    expected = []
    for i, t in rows:
        body = " ".join(kept[i, t or ""])
        expected.append((i, len(WORD.findall(t or "")), len(WORD.findall(t or "")) - len(kept[i, t or ""]), hashlib.sha256(body.encode()).hexdigest(), body))
    order = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted(map(tuple, got), key=order) == sorted(expected, key=order)
    assert empty == 0


def test_hashes_of_runs():
    h = np.random.default_rng(1).integers(0, 1 << 63, 50).astype(np.uint64)
    runs = substrings.Runs(h, substrings.BASES[1])
    for n in (1, 2, 7, 8, 20):
        at = np.arange(50 - n + 1)
        direct = [sum(int(h[i + j]) * pow(substrings.BASES[1], j, 1 << 64) for j in range(n)) % (1 << 64) for i in at]
        assert runs.of(at, at + n).tolist() == direct


def test_phrases_are_windows_of_one_place():
    rnd = random.Random(2)
    for _ in range(300):
        texts = [[rnd.choice("abc")] * rnd.randint(0, 60) if rnd.random() < 0.2 else [rnd.choice("abcdefgh"[: rnd.randint(1, 8)]) for _ in range(rnd.randint(0, 30))] * rnd.randint(1, 4) for _ in range(5)]
        column = pa.array([" ".join(t).encode() for t in texts], pa.binary())
        (words,) = substrings.pieces(column)
        order = {}
        got = {(r, f + k): (a, r, f) for a, _, r, f, c in zip(*(x.tolist() for x in words.phrases())) for k in range(c)}
        expected = {}
        for r, text in enumerate(texts):
            own = words.hashes[words.bounds[r] : words.bounds[r + 1]]
            grams = [int(substrings.stirred(substrings.Runs(own[i : i + 8], substrings.BASES[0]).of(np.array([0]), np.array([8])))[0]) for i in range(len(own) - 7)]
            for at in range(len(text) - 19):
                window = grams[at : at + 13]
                spot = at + window.index(min(window))
                expected[r, at] = (min(window), r, order.setdefault((r, spot, min(window)), at))
        assert got == expected


@pytest.mark.parametrize("piece", [8, 64, 1 << 18])
def test_words_of_a_column(monkeypatch, piece):
    monkeypatch.setattr(substrings, "PIECE", piece)
    bodies = [b"", b"one two", b"two", b" \t\n", b"one  two\x0bthree " * 30, "é\x85 x".encode(), b"w" * 500 + b" one", b"one"]
    column = pa.array([b"before", *bodies], pa.binary())[1:]
    known, counts, seen = {}, {}, set()
    for words in substrings.pieces(column):
        for k, row in enumerate(words.rows.tolist()):
            text = WORD.findall(bodies[row].decode())
            own = words.hashes[words.bounds[k] : words.bounds[k + 1]].tolist()
            first = words.base
            assert own == [known.setdefault(w, h) for w, h in zip(text[first:], own)] and len(own) <= len(text) - first
            seen |= {(row, first + i) for i in range(len(own))}
            counts[row] = max(counts.get(row, 0), first + len(own))
    assert counts == {i: len(WORD.findall(b.decode())) for i, b in enumerate(bodies)}
    assert len(set(known.values())) == len(known) and len(seen) == sum(counts.values())


def vectors(rnd, n, d):
    base = rnd.standard_normal((n, d)) * np.linspace(1, 0.1, d) @ np.linalg.qr(rnd.standard_normal((d, d)))[0]
    return np.float32(base + rnd.standard_normal((4, d))[rnd.integers(0, 4, n)])


def test_whitening(spark):
    rnd = np.random.default_rng(2)
    data = vectors(rnd, 500, 24)
    rows = [(int(i) if i % 9 else None, [float(x) for x in v], 1, 2) for i, v in enumerate(data)]
    bad = [(900, None), (901, []), (902, [1.0, None] * 12), (903, [float("nan")] * 24), (904, [float("inf")] + [0.0] * 23), (905, [1.0] * 3), (906, [1e30] * 24)]
    rows += [(i, v, 1, 2) for i, v in bad] + rows[10:13]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, n int, dim int").repartition(4)
    fit = [(i, v) for i, v, *_ in rows if i is None or i < 900]
    x = np.floor(1024 * np.array([v for _, v in fit], np.float64)).astype(np.int64) + 100_000
    n, total = len(x), x.sum(axis=0)
    centred = (n * x - total) / n
    e, q = np.linalg.eigh(centred.T @ centred / n)
    e, q = e[::-1][:8], q[:, ::-1][:, :8]
    got = whitening.whiten(df).collect()
    assert len(got) == 8 * n and {r.n for r in got} == {n} and max(r.identity_error for r in got) < 1e-9
    assert sorted(r.deviation for r in got) == sorted(int(s) for s in ((n * x - total) ** 2).sum(axis=1) for _ in range(8))
    for k in range(8):
        own = [r for r in got if r.component == k + 1]
        assert abs(own[0].explained / (e[k] / (centred**2).sum() * n) - 1) < 1e-10
        direct = centred @ q[:, k] / np.sqrt(e[k])
        key = lambda i: (i is None, i or 0)
        left = sorted(((key(r.vec_id), r.whitened) for r in own))
        for sign in (1, -1):
            right = sorted((key(i), sign * float(w)) for (i, _), w in zip(fit, direct))
            if np.allclose([w for _, w in left], [w for _, w in right], atol=1e-8):
                break
        else:
            raise AssertionError(k)


def test_bidiagonalisation_finds_equal_and_missing_values():
    rnd = np.random.default_rng(5)
    q = np.linalg.qr(rnd.standard_normal((40, 12)))[0]
    r = np.linalg.qr(rnd.standard_normal((12, 12)))[0]
    for values in ([5.0] * 12, [9, 9, 9, 4, 4, 1, 1, 1, 0.5, 0, 0, 0], [7] + [0] * 11, np.geomspace(100, 1e-3, 12)):
        x = q * np.array(values) @ r.T
        got, vectors_ = whitening.bidiagonalise(lambda w: x.T @ (x @ w), 12, float((x**2).sum()), 8)  # noqa: B023
        assert np.allclose(got, sorted(values)[::-1][:8], atol=1e-6)
        assert np.allclose(vectors_.T @ vectors_, np.eye(8), atol=1e-12)
        assert np.allclose(x.T @ (x @ vectors_), vectors_ * got**2, atol=1e-9 * max(values) ** 2)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_whiten(spark, rows):
    assert whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).count() == 0
