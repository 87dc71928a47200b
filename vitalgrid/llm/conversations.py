"""Repair of conversation structure by least-cost edits, with Four-Russians block tables.

A conversation is a string over nine symbols: a row that has to go, or a row of
one of four role initials that ends well or is cut short. What the rows behind a
place still cost from each of the four states of the grammar is a vector; less its
least entry only few vectors exist. Tables give, for each of them and each block
of BLOCK symbols, the vector before the block and what it costs, so the way from
the end to the start is one lookup a block. On the way back to the end each block
is expanded again symbol by symbol from the vector behind it, which gives all
cheapest edits at a place, and the least letter is taken: ties are safe.

Rows are dealt by range of conversation and turn. What lies whole inside a task is
repaired there; a conversation that is cut, by a task border or for its length, is
taken in chunks, each of which is a map from vector to vector and from state to
state, and only these maps are put in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.llm.common import stored, table

WHITE = " \t\n\v\f\r"
ENDS = ".!?"
BLOCK = 4  # symbols
CHUNK, CHUNK_BYTES = 1 << 14, 1 << 23  # rows and text bytes of a conversation taken at once
DELETE, REROLE, INSERT, CUT_SHORT = 2, 1, 5, 5  # costs; a kept row costs nothing
LEGAL = {"su", "ua", "au"}

# States of the grammar (s?(ua)+)?: nothing yet, after s, after u, after a.
START, S, U, A = range(4)
KEEPS = {(START, "s"): S, (START, "u"): U, (S, "u"): U, (U, "a"): A, (A, "u"): U}
TURNS_TO = (U, U, A, U)  # the state after a row made user or assistant, by state
MADE = {U: "user", A: "assistant"}
GONE, INITIALS = 0, "sua?"
SYMBOLS = 1 + 2 * len(INITIALS)


def symbol(initial: str, cut_short: bool) -> int:
    return 1 + 2 * INITIALS.index(initial if initial in ("s", "u", "a") else "?") + cut_short


def with_inserts(costs: list[int]) -> list[int]:
    for _ in range(3):
        costs = [min(c, INSERT + costs[TURNS_TO[q]]) for q, c in enumerate(costs)]
    return costs


def edits(code: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of what may be done with a row in a state."""
    out = [("D", DELETE, state)]
    if code != GONE:
        initial, extra = INITIALS[(code - 1) // 2], CUT_SHORT * ((code - 1) % 2)
        if (state, initial) in KEEPS:
            out.append(("K", extra, KEEPS[state, initial]))
        out.append(("R", REROLE + extra, TURNS_TO[state]))
    return out


class Tables:
    """The vectors, and their transitions by symbol and by block; vector 0 stands behind the last row."""

    def __init__(self):
        far = 1 << 20
        last = with_inserts([0, far, far, 0])
        self.vectors, numbers, self.step, self.paid = [tuple(last)], {tuple(last): 0}, [], []
        for vector in self.vectors:  # grows on the way
            self.step.append([])
            self.paid.append([])
            for code in range(SYMBOLS):
                before = self.before(vector, code)
                least = min(before)
                normal = tuple(c - least for c in before)
                if normal not in numbers:
                    numbers[normal] = len(self.vectors)
                    self.vectors.append(normal)
                self.step[-1].append(numbers[normal])
                self.paid[-1].append(least)
        step, paid = np.array(self.step), np.array(self.paid)
        self.blocks, self.block_paid = step, paid
        for _ in range(BLOCK - 1):  # [vector][first symbol + SYMBOLS * (the block behind it)]
            behind = self.blocks
            self.blocks = step[behind].reshape(len(step), -1)
            self.block_paid = (self.block_paid[:, :, None] + paid[behind]).reshape(len(step), -1)

    @staticmethod
    def before(vector: tuple[int, ...], code: int) -> list[int]:
        return with_inserts([min(cost + vector[to] for _, cost, to in edits(code, q)) for q in range(4)])

    @cache
    def choice(self, number: int, code: int, state: int) -> tuple[str, int]:
        """The least letter among the cheapest edits before a row, and the next state; an insert leaves the row for later."""
        vector = self.vectors[number]
        before = self.before(vector, code)
        good = [(letter, to) for letter, cost, to in edits(code, state) if cost + vector[to] == before[state]]
        if INSERT + before[TURNS_TO[state]] == before[state]:
            good.append(("I", TURNS_TO[state]))
        return min(good)

    def cuts(self, codes: bytes) -> tuple[int, np.ndarray]:
        """How many symbols stand before the first whole block, and the number of each block."""
        odd = len(codes) % BLOCK
        rows = np.frombuffer(codes, np.uint8)[odd:].reshape(-1, BLOCK).astype(np.int64)
        return odd, rows @ SYMBOLS ** np.arange(BLOCK)

    def backward(self, codes: bytes, behind: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """From vectors behind the codes to those before, what that costs, and the vectors behind each block."""
        odd, blocks = self.cuts(codes)
        numbers, paid, seen = behind, np.zeros(len(behind), np.int64), []
        for block in blocks[::-1]:
            seen.append(numbers)
            paid = paid + self.block_paid[numbers, block]
            numbers = self.blocks[numbers, block]
        seen.append(numbers)
        for code in codes[:odd][::-1]:
            paid = paid + np.array([self.paid[n][code] for n in numbers])
            numbers = np.array([self.step[n][code] for n in numbers])
        return numbers, paid, seen[::-1]

    def cost(self, codes: bytes) -> int:
        numbers, paid, _ = self.backward(codes, np.zeros(1, np.int64))
        return int(paid[0]) + self.vectors[numbers[0]][START]

    def trace(self, codes: bytes, behind: int, states: list[int], last: bool) -> Iterator[tuple[int, str, int]]:
        """(which, letter, state after) for each edit from each of ``states`` on, the rows in order.

        ``last``: the conversation ends with the codes, so what is missing is added.
        """
        *_, seen = self.backward(codes, np.array([behind]))
        odd = len(codes) % BLOCK
        at = list(states)
        starts = [0, *range(odd, len(codes), BLOCK)] if odd else list(range(0, len(codes), BLOCK))
        ends = [number[0] for number in (seen if odd else seen[1:])]
        for begin, number in zip(starts, ends):
            part = codes[begin : (begin + BLOCK if begin >= odd else odd)]
            numbers = [int(number)]  # behind each symbol of the block, from its end
            for code in part[:0:-1]:
                numbers.append(self.step[numbers[-1]][code])
            for code, after in zip(part, numbers[::-1]):
                for which in range(len(at)):
                    letter = "I"
                    while letter == "I":
                        letter, at[which] = self.choice(after, code, at[which])
                        yield which, letter, at[which]
        while last and any(q in (S, U) for q in at):
            for which, q in enumerate(at):
                if q in (S, U):
                    at[which] = TURNS_TO[q]
                    yield which, "I", at[which]


@cache
def tables() -> Tables:
    return Tables()


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the faults that a hash of conversation and turn deals out; nulls are one space."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    blank = lambda c: F.coalesce(F.col(c), F.lit(" "))
    fault = F.col("fault")
    return (
        rows.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), (F.crc32(key.cast("binary")) % 20).alias("fault"))
        .filter("fault != 0")
        .select(
            "conv_id",
            "turn",
            F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(fault == 1, "").when(fault == 2, F.translate("text", ENDS, "")).otherwise(F.col("text")).alias("text"),
            F.explode(F.array_repeat(F.lit(1), F.when(fault == 3, 2).otherwise(1))).alias("copy"),
        )
        .drop("copy")
    )


class Chunk:
    """Rows of one conversation that stand together."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.roles, self.texts, self.size = conv_id, [], [], [], 0

    def add(self, turn: int | None, role: str, text: str) -> None:
        self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.size += len(text)


def faults(roles: list[str], texts: list[str], seen: set[int] | None = None) -> tuple[bytes, int, int, int]:
    """Symbols of the rows, and how many are blank, duplicate and truncated.

    ``seen`` are the places of rows that occurred before; None: find out here.
    """
    codes, counts, before = bytearray(), [0, 0, 0], set()
    for i, (role, text) in enumerate(zip(roles, texts)):
        words = text.rstrip(WHITE)
        again = (role, text) in before if seen is None else i in seen
        if seen is None:
            before.add((role, text))
        fault = 0 if not words else 1 if again else 2 if words[-1] not in ENDS else None
        if fault is not None:
            counts[fault] += 1
        codes.append(GONE if fault in (0, 1) else symbol(role[:1], fault == 2))
    return bytes(codes), *counts


def turn_span(turns: list[int | None]) -> tuple[int | None, int | None, int]:
    """Least and largest turn and how many different ones, nulls left out."""
    known = {t for t in turns if t is not None}
    return min(known, default=None), max(known, default=None), len(known)


def illegal(initials: list[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


def written(roles: list[str], texts: list[str], steps: Iterator[tuple[int, str, int]]) -> tuple[str, list[str]]:
    """The letters of the edits and the lines they leave."""
    letters, lines, i = [], [], 0
    for _, letter, state in steps:
        letters.append(letter)
        if letter == "I":
            lines.append(MADE[state] + ":")
            continue
        if letter != "D":
            lines.append(f"{roles[i] if letter == 'K' else MADE[state]}:{texts[i]}")
        i += 1
    return "".join(letters), lines


def gaps(least: int | None, largest: int | None, different: int) -> int:
    return 0 if least is None else largest - least + 1 - different


def repaired(chunk: Chunk) -> tuple:
    """The result of a conversation that is whole."""
    codes, *counts = faults(chunk.roles, chunk.texts)
    audit, lines = written(chunk.roles, chunk.texts, tables().trace(codes, 0, [START], True))
    return (
        chunk.conv_id,
        gaps(*turn_span(chunk.turns)),
        *counts,
        illegal([r[:1] for r in chunk.roles]),
        tables().cost(codes),
        audit,
        hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


RESULT = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
RESULT_FIELDS = pa.schema(
    [("conv_id", pa.int64())] + [(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", pa.string()), ("repaired_sha256", pa.string())]
)
CHUNK_FIELDS = pa.schema(
    [("part", pa.int32()), ("seq", pa.int32()), ("least", pa.int64()), ("largest", pa.int64()), ("different", pa.int64())]
    + [("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("same", pa.list_(pa.binary()))]
)
CHUNKED = "part int, seq int, least bigint, largest bigint, different bigint, roles array<string>, texts array<string>, same array<binary>"


def batch_of(rows: list[tuple], fields: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, fields)], schema=fields)


def taken_apart(rows: DataFrame) -> DataFrame:
    """The results of conversations that lie whole in a task, and the chunks (``part`` not null) of the others."""
    dealt = rows.select("conv_id", "turn", "role", "text", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("row"))
    order = "conv_id", "turn", "role", "tie", "row"  # rows of one turn and equal rows may be dealt apart
    dealt = dealt.repartitionByRange(*order).sortWithinPartitions(*order)
    fields = pa.schema([*RESULT_FIELDS, *CHUNK_FIELDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, chunk, cut = TaskContext.get().partitionId(), 0, None, True
        none = (None,) * len(CHUNK_FIELDS)

        def raw(c: Chunk) -> tuple:
            same = [hashlib.sha256(f"{len(r)}:{r}{t}".encode()).digest() for r, t in zip(c.roles, c.texts)]
            return (c.conv_id, *(None,) * (len(RESULT_FIELDS) - 1), part, seq, *turn_span(c.turns), c.roles, c.texts, same)

        for batch in batches:
            out = []
            for conv_id, turn, role, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if chunk is not None and chunk.conv_id != conv_id:
                    out.append(raw(chunk) if cut else (*repaired(chunk), *none))
                    seq, chunk, cut = seq + 1, None, False
                elif chunk is not None and (len(chunk.texts) >= CHUNK or chunk.size >= CHUNK_BYTES):
                    out.append(raw(chunk))
                    seq, chunk, cut = seq + 1, None, True
                if chunk is None:
                    chunk = Chunk(conv_id)
                chunk.add(turn, role, text)
            if out:
                yield batch_of(out, fields)
        if chunk is not None:
            yield batch_of([raw(chunk)], fields)

    return dealt.select("conv_id", "turn", "role", "text").mapInArrow(run, f"{RESULT}, {CHUNKED}")


def with_seen(chunks: DataFrame) -> DataFrame:
    """The chunks with ``seen``, the places of rows whose role and text stand earlier in the conversation."""
    at = F.struct("part", "seq", "at")
    rows = chunks.select("conv_id", "part", "seq", F.posexplode("same").alias("at", "same"))
    firsts = rows.groupBy(F.col("conv_id").alias("_conv"), F.col("same").alias("_same")).agg(F.min(at).alias("first"))
    again = rows.join(firsts, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("same") == F.col("_same"))).filter(at != F.col("first"))
    places = again.groupBy(F.col("part").alias("_part"), F.col("seq").alias("_seq")).agg(F.collect_list("at").alias("seen"))
    joined = chunks.drop("same").join(places, (F.col("part") == F.col("_part")) & (F.col("seq") == F.col("_seq")), "left").drop("_part", "_seq")
    return joined.withColumn("seen", F.coalesce("seen", F.array().cast("array<int>")))


def coded(chunks: DataFrame) -> DataFrame:
    """part, seq, codes, counts, initials at both ends, and the maps from vector to vector of each chunk."""
    fields = pa.schema(
        [("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int32()), ("codes", pa.binary())]
        + [(n, pa.int64()) for n in ("blank", "duplicate", "truncated", "illegal")]
        + [("head", pa.string()), ("tail", pa.string()), ("numbers", pa.binary()), ("paid", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = np.arange(len(tables().vectors))
        for batch in batches:
            for row in batch.to_pylist():
                codes, *counts = faults(row["roles"], row["texts"], set(row["seen"]))
                numbers, paid, _ = tables().backward(codes, every)
                initials = [r[:1] for r in row["roles"]]
                yield batch_of(
                    [(row["conv_id"], row["part"], row["seq"], codes, *counts, illegal(initials), initials[0], initials[-1], numbers.astype(np.int32).tobytes(), paid.tobytes())],
                    fields,
                )

    return chunks.select("conv_id", "part", "seq", "roles", "texts", "seen").mapInArrow(
        run,
        "conv_id bigint, part int, seq int, codes binary, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
        "head string, tail string, numbers binary, paid binary",
    )


def from_the_end(pieces: pd.DataFrame) -> pd.DataFrame:
    """The vector behind each chunk of a conversation, and the conversation's totals, on each of its chunks."""
    pieces = pieces.sort_values(["part", "seq"])
    rows = pieces.to_dict("records")
    behind, number, cost = [], 0, 0
    for row in reversed(rows):
        behind.append(number)
        cost += int(np.frombuffer(row["paid"], np.int64)[number])
        number = int(np.frombuffer(row["numbers"], np.int32)[number])
    out = pieces[["conv_id", "part", "seq"]].copy()
    out["behind"] = behind[::-1]
    out["last"] = [False] * (len(rows) - 1) + [True]
    spans = [r for r in rows if not pd.isna(r["least"])]
    shared = sum(a["largest"] == b["least"] for a, b in zip(spans, spans[1:]))
    out["gaps"] = gaps(int(spans[0]["least"]), int(spans[-1]["largest"]), sum(int(r["different"]) for r in spans) - shared) if spans else 0
    for name in ("blank", "duplicate", "truncated"):
        out[name] = pieces[name].sum()
    out["illegal"] = pieces["illegal"].sum() + sum(a["tail"] + b["head"] not in LEGAL for a, b in zip(rows, rows[1:]))
    out["cost"] = cost + tables().vectors[number][START]
    return out


def from_the_start(pieces: pd.DataFrame) -> pd.DataFrame:
    """The state before each chunk of a conversation."""
    pieces = pieces.sort_values(["part", "seq"])
    states, state = [], START
    for exits in pieces["exits"]:
        states.append(state)
        state = exits[state]
    out = pieces[["part", "seq"]].copy()
    out["state"] = states
    return out


def put_together(chunks: DataFrame) -> DataFrame:
    """The results of conversations that are given in chunks."""
    chunks = stored(with_seen(chunks))
    light = stored(coded(chunks).join(chunks.select("part", "seq", "least", "largest", "different"), ["part", "seq"]))
    totals = stored(
        light.drop("codes")
        .groupBy("conv_id")
        .applyInPandas(
            from_the_end,
            "conv_id bigint, part int, seq int, behind int, last boolean, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint",
        )
    )
    ends = totals.select("part", "seq", "behind", "last")

    def exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int32()), ("exits", pa.list_(pa.int32()))])
        for batch in batches:
            for row in batch.to_pylist():
                states = list(range(4))
                for which, _, state in tables().trace(row["codes"], row["behind"], states, row["last"]):
                    states[which] = state
                yield batch_of([(row["conv_id"], row["part"], row["seq"], states)], fields)

    ways = light.select("conv_id", "part", "seq", "codes").join(ends, ["part", "seq"])
    ways = ways.select("conv_id", "part", "seq", "codes", "behind", "last").mapInArrow(exits, "conv_id bigint, part int, seq int, exits array<int>")
    entries = ways.groupBy("conv_id").applyInPandas(from_the_start, "part int, seq int, state int")

    def rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int32()), ("audit", pa.string()), ("lines", pa.list_(pa.string()))])
        for batch in batches:
            for row in batch.to_pylist():
                steps = tables().trace(row["codes"], row["behind"], [row["state"]], row["last"])
                yield batch_of([(row["conv_id"], row["part"], row["seq"], *written(row["roles"], row["texts"], steps))], fields)

    pieces = chunks.select("conv_id", "part", "seq", "roles", "texts").join(light.select("part", "seq", "codes"), ["part", "seq"])
    pieces = pieces.join(ends, ["part", "seq"]).join(entries, ["part", "seq"])
    pieces = pieces.select("conv_id", "part", "seq", "roles", "texts", "codes", "behind", "last", "state")
    pieces = pieces.mapInArrow(rewritten, "conv_id bigint, part int, seq int, audit string, lines array<string>")
    # A digest of a whole conversation is a fold over its lines in order: one task a conversation, one piece at a time.
    in_order = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = pa.schema([("_conv", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])
        now = letters = digest = None
        for batch in batches:
            for row in batch.to_pylist():
                if now is None or now != (row["conv_id"],):
                    if now is not None:
                        yield batch_of([(*now, "".join(letters), digest.hexdigest())], fields)
                    now, letters, digest, begun = (row["conv_id"],), [], hashlib.sha256(), False
                letters.append(row["audit"])
                for line in row["lines"]:
                    digest.update(("\n" + line if begun else line).encode())
                    begun = True
        if now is not None:
            yield batch_of([(*now, "".join(letters), digest.hexdigest())], fields)

    digests = in_order.select("conv_id", "audit", "lines").mapInArrow(digested, "_conv bigint, audit string, repaired_sha256 string")
    numbers = totals.filter("last").drop("part", "seq", "behind", "last")
    return numbers.join(digests, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")


def structure(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of each conversation of ``rows``.

    ``rows`` have conv_id, turn, role and text, none of the last two null. They
    are taken by turn, nulls first; rows of one turn by role, then by a hash of
    the text; equal rows follow each other. A null conv_id is a conversation.
    Other columns are not looked at; an empty table gives no rows.
    """
    apart = stored(taken_apart(rows))
    names = [f.name for f in RESULT_FIELDS]
    done = apart.filter("part is null").select(*names)
    return done.union(put_together(apart.filter("part is not null").select("conv_id", *(f.name for f in CHUNK_FIELDS))).select(*names))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations")
    found = structure(damaged(rows)).withColumnRenamed("conv_id", "_conv")
    every = rows.select("conv_id").distinct()
    joined = every.join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    return joined.na.fill(0, ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]).na.fill("", ["audit"]).na.fill(hashlib.sha256().hexdigest(), ["repaired_sha256"])


QUERIES = {"op12_conversation_repair": op12_conversation_repair}

SQL = {
    "op12_conversation_repair": r"""
WITH RECURSIVE bits AS (
  SELECT range AS i, range AS c, 0 AS k FROM range(256)
  UNION ALL
  SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
source AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations),
hashed AS (
  SELECT conv_id, turn, role, text,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda x: ascii(x)::BIGINT)),
             lambda c, b: xor(t[(xor(c, b) & 255) + 1], c // 256)), 4294967295) % 20 AS fault
  FROM source, crc),
rows_ AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hashed, range(2) AS copies(copy) WHERE fault != 0 AND (copy = 0 OR fault = 3)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM rows_),
judged AS (
  SELECT *, substr(role, 1, 1) AS ini, rtrim(text, E' \t\n\x0B\x0C\r') AS body,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS prev
  FROM placed),
faulty AS (
  SELECT *, CASE WHEN body = '' THEN 'b' WHEN nth > 1 THEN 'd' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS f
  FROM judged),
counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (f = 'b') AS blank, count(*) FILTER (f = 'd') AS duplicate, count(*) FILTER (f = 't') AS truncated,
         count(*) FILTER (i > 1 AND prev || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id),
moves(q, ini, letter, price, q2) AS (VALUES
  ('-', '*', 'D', 2, '-'), ('s', '*', 'D', 2, 's'), ('u', '*', 'D', 2, 'u'), ('a', '*', 'D', 2, 'a'),
  ('-', 's', 'K', 0, 's'), ('-', 'u', 'K', 0, 'u'), ('s', 'u', 'K', 0, 'u'), ('u', 'a', 'K', 0, 'a'), ('a', 'u', 'K', 0, 'u'),
  ('-', '*', 'R', 1, 'u'), ('s', '*', 'R', 1, 'u'), ('u', '*', 'R', 1, 'a'), ('a', '*', 'R', 1, 'u')),
adds(q, letters, price, q2, lines) AS (VALUES
  ('-', '', 0, '-', []), ('s', '', 0, 's', []), ('u', '', 0, 'u', []), ('a', '', 0, 'a', []),
  ('-', 'I', 5, 'u', ['user:']), ('s', 'I', 5, 'u', ['user:']), ('a', 'I', 5, 'u', ['user:']), ('u', 'I', 5, 'a', ['assistant:']),
  ('-', 'II', 10, 'a', ['user:', 'assistant:']), ('s', 'II', 10, 'a', ['user:', 'assistant:'])),
ways AS (
  SELECT a.q, a.letters || m.letter AS letters, a.price + m.price AS price, m.q2, m.ini, m.letter, a.lines
  FROM adds a JOIN moves m ON a.q2 = m.q),
best AS (
  SELECT conv_id, 0 AS i, '-' AS q, {'cost': 0, 'audit': '', 'lines': []::VARCHAR[]} AS b FROM counts
  UNION ALL
  SELECT r.conv_id, any_value(CAST(r.i AS INTEGER)), w.q2,
         min({'cost': b.b.cost + w.price + CASE WHEN r.f = 't' AND w.letter != 'D' THEN 5 ELSE 0 END,
              'audit': b.b.audit || w.letters,
              'lines': list_concat(b.b.lines, list_concat(w.lines, CASE w.letter WHEN 'D' THEN []
                       WHEN 'K' THEN [r.role || ':' || r.text]
                       ELSE [CASE w.q2 WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || r.text] END))})
  FROM best b JOIN faulty r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i + 1 JOIN ways w ON w.q = b.q
  WHERE (w.ini = '*' OR w.ini = r.ini) AND (r.f NOT IN ('b', 'd') OR w.letter = 'D')
  GROUP BY r.conv_id, w.q2),
final AS (
  SELECT c.conv_id, min({'cost': b.b.cost + a.price, 'audit': b.b.audit || a.letters, 'lines': list_concat(b.b.lines, a.lines)}) AS b
  FROM best b JOIN counts c ON c.conv_id IS NOT DISTINCT FROM b.conv_id AND c.n = b.i JOIN adds a ON a.q = b.q
  WHERE a.q2 IN ('-', 'a') GROUP BY c.conv_id)
SELECT o.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
       coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, CAST(coalesce(f.b.cost, 0) AS BIGINT) AS cost,
       coalesce(f.b.audit, '') AS audit, sha256(coalesce(array_to_string(f.b.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN final f ON f.conv_id IS NOT DISTINCT FROM o.conv_id
"""
}
