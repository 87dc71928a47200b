"""Byte-level BPE: encoding by ranked merges, decoding by joining pieces.

A text is cut into words by the tokenizer's pattern. The merges of a word are a
fold: join the neighbouring pair of lowest rank until no pair has one. Each
distinct word is folded once while a task remembers it, whole texts are then
looked up word by word. ``fold_words`` is the same fold in Spark's higher-order
functions over byte arrays of distinct words, for word lists.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.llm.common import table, whole

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
REMEMBERED = 400_000  # distinct words a task keeps; beyond that it starts anew
LONGEST_REMEMBERED = 256  # characters; longer words are folded each time


_NONE = float("inf")  # rank of a pair that is no token


def read_ranks(lines) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 text and rank."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return read_ranks(f)


def fold(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word.

    A word that is a token is that token. Otherwise the leftmost pair of lowest
    rank is joined again and again. Pairs wait in a heap and pieces are a linked
    list, so a word of n bytes takes n log n steps.
    """
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    if n < 48:
        get, pieces = ranks.get, [word[i : i + 1] for i in range(n)]
        pairs = [get(word[i : i + 2], _NONE) for i in range(n - 1)]
        while pairs and (best := min(pairs)) is not _NONE:
            i = pairs.index(best)
            pieces[i] += pieces.pop(i + 1)
            pairs.pop(i)
            if i:
                pairs[i - 1] = get(pieces[i - 1] + pieces[i], _NONE)
            if i < len(pairs):
                pairs[i] = get(pieces[i] + pieces[i + 1], _NONE)
        return [ranks[p] for p in pieces]
    end = list(range(1, n + 1))  # end of the piece that starts at i; 0: none starts there
    before = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        middle = end[i]
        if not middle or middle >= n or end[middle] != stop:
            continue
        end[i], end[middle] = stop, 0
        if stop < n:
            before[stop] = i
            if (r := ranks.get(word[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (p := before[i]) >= 0 and (r := ranks.get(word[p:stop])) is not None:
            heapq.heappush(heap, (r, p, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


class Folded(dict):
    """Word to ids, filled on demand and emptied when it has grown to its bound."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, word: str) -> list[int]:
        ids = fold(word.encode(), self.ranks)
        if len(word) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = ids
        return ids


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """doc_id and ``ids`` array<int> of every row; a null or empty text has none."""
    held = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, folded = regex.compile(pattern), Folded(held.value)
        for batch in batches:
            for at, text in enumerate(batch.column(1).to_pylist()):
                ids = [i for word in cut.findall(text) for i in folded[word]]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 1), pa.array([ids], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select("doc_id", whole().alias("text")).mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """doc_id and ``decoded`` binary: the pieces of ``ids`` joined; null ids as none."""
    held = encoded.sparkSession.sparkContext.broadcast({rank: piece for piece, rank in ranks.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = held.value.__getitem__
        for batch in batches:
            ids = batch.column(1)
            out = [b"".join(map(piece, ids[i].as_py() or ())) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, decoded binary")


def digests(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encoding, then decoding, of every row.

    Both steps in one pass over the rows, so ids never leave their task. A null
    text counts as empty; rows with the same or no doc_id each give a row; other
    columns are not looked at.
    """
    held = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, folded = regex.compile(pattern), Folded(held.value)
        piece = {rank: p for p, rank in held.value.items()}.__getitem__
        number = {rank: str(rank) for rank in held.value.values()}.__getitem__
        for batch in batches:
            counts, coded, back = [], [], []
            for text in batch.column(1):
                ids = [i for word in cut.findall(text.as_py()) for i in folded[word]]
                counts.append(len(ids))
                coded.append(hashlib.sha256(",".join(map(number, ids)).encode()).hexdigest())
                back.append(hashlib.sha256(b"".join(map(piece, ids))).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(back, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", whole().alias("text")).mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )


def rank_table(ranks: dict[bytes, int], slots: int = 1 << 16) -> Column:
    """The rank map as one literal: an array of small maps, found by the piece's hash.

    A map value is searched from end to end, so one map of all ranks would cost
    tens of thousands of comparisons a look-up; a slot holds about one entry.
    """
    rows: list[list[str]] = [[] for _ in range(slots)]
    for piece, rank in ranks.items():
        rows[xxhash.xxh64_intdigest(piece, 42) % slots].append(f'"{piece.hex().upper()}":{rank}')
    return F.from_json(F.lit("[" + ",".join("{" + ",".join(r) + "}" for r in rows) + "]"), "array<map<string,int>>")


def fold_words(words: DataFrame, ranks: dict[bytes, int], slots: int = 1 << 16) -> DataFrame:
    """word, ``ids`` and ``decoded`` of each distinct word, in Spark's own functions.

    The pieces are an array of binaries; each step of the fold looks up all
    neighbouring pairs and joins the leftmost of lowest rank. Meant for lists of
    distinct words; null words are left out.
    """
    held = rank_table(ranks, slots)

    def rank(piece: Column) -> Column:
        # unsigned hash modulo a power of two: the low bits
        return F.element_at(F.element_at(held, (F.xxhash64(piece).bitwiseAND(F.lit(slots - 1)) + 1).cast("int")), F.hex(piece))

    def step(pieces: Column, _: Column) -> Column:
        pairs = F.filter(
            F.transform(F.slice(pieces, 2, F.size(pieces)), lambda p, i: F.struct(rank(F.concat(F.get(pieces, i), p)).alias("rank"), i.alias("at"))),
            lambda x: x["rank"].isNotNull(),
        )
        best = F.array_min(pairs)["at"]
        joined = F.concat(
            F.slice(pieces, F.lit(1), best),
            F.array(F.concat(F.get(pieces, best), F.get(pieces, best + 1))),
            F.slice(pieces, best + 3, F.size(pieces)),
        )
        return F.when(best.isNull(), pieces).otherwise(joined)

    raw = F.encode("word", "UTF-8")
    rows = words.select("word").filter("word is not null and word != ''").distinct().withColumn("raw", raw)
    single = F.expr("transform(sequence(1, length(raw)), i -> substring(raw, i, 1))")
    folded = F.aggregate(F.sequence(F.lit(1), F.greatest(F.length("raw") - 1, F.lit(1))), single, step)
    whole_rank = rank(F.col("raw"))
    ids = F.when(whole_rank.isNotNull(), F.array(whole_rank)).otherwise(F.transform(folded, rank))
    piece = F.when(whole_rank.isNotNull(), F.array(F.col("raw"))).otherwise(folded)
    return rows.select("word", ids.alias("ids"), piece.alias("_pieces")).select(
        "word", "ids", F.aggregate("_pieces", F.lit(b""), lambda a, p: F.concat(a, p)).alias("decoded")
    )


def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = load_ranks(public_tokenizers.path(VOCABULARY))
    return digests(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)


QUERIES = {"op3_byte_bpe": op3_byte_bpe}

SQL: dict[str, str] = {}
