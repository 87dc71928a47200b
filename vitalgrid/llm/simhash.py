"""Near-duplicates by SimHash with a hierarchical index in Gray order.

Fingerprints within two bits agree on at least two of four 16-bit blocks, so for
each of the six pairs of blocks the fingerprints are turned to have that pair in
front, sorted by Gray rank and dealt by range. A run of equal fronts is the top
of an index: below it, neighbours in Gray order are gathered in nodes that hold
the bit pattern their members share. Two nodes whose shared bits already differ
too often are dropped with all that hangs below; else only the bits that became
known on the way down are counted and added.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.llm.common import WORD_BYTES, one_of_each, row_key, stored, table, whole
from vitalgrid.llm.components import components

SHINGLE = 3  # words
SEED = 42
DIFFERENCES = 2  # bits
BLOCKS = 4
TURNS = [(*front, *(b for b in range(BLOCKS) if b not in front)) for front in combinations(range(BLOCKS), BLOCKS - DIFFERENCES)]
FANOUT = 8
PAIRS = 1 << 17  # pairs of nodes compared at once
SIGN = np.uint64(1 << 63)  # flipped where ranks are signed longs, whose order is then theirs
PART = 1 << 16  # words whose shingles are counted at once


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash: a bit is set if more than half of the shingle hashes have it.

    A-Z are lower-cased. Fewer words than a shingle form one; no word gives zero.
    Words are taken in parts, so a long text needs no list of all its words.
    """
    found = (m.group() for m in WORD_BYTES.finditer(text.lower())) if len(text) > PART * 64 else iter(WORD_BYTES.findall(text.lower()))
    counts, n, last = np.zeros(64, np.int64), 0, []
    while part := list(islice(found, PART)):
        part = last + part
        rows = [b" ".join(x) for x in zip(*(part[i:] for i in range(shingle)))]
        last = part[-(shingle - 1) :]
        if rows:
            counts += votes([xxhash.xxh64_intdigest(s, SEED) for s in rows])
            n += len(rows)
    if not n and last:
        counts, n = votes([xxhash.xxh64_intdigest(b" ".join(last), SEED)]), 1
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def votes(hashes: list[int]) -> np.ndarray:
    """How many hashes have each bit, highest bit first."""
    return np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, tie, fp of every row: the fingerprint as a signed long, and a hash of the text for ties.

    A null text counts as empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(x.as_py(), shingle) for x in batch.column(2)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prints.view(np.int64))], ["doc_id", "tie", "fp"])

    rows = docs.select("doc_id", F.xxhash64(whole()).alias("tie"), whole().cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, tie bigint, fp bigint")


WIDTH = np.uint64(64 // BLOCKS)
BLOCK = np.uint64((1 << 64 // BLOCKS) - 1)


def low_bit(block: int) -> np.uint64:
    """Place of a block's lowest bit; block 0 is the highest."""
    return np.uint64(64) - WIDTH * np.uint64(block + 1)


def turned(codes: np.ndarray, turn: tuple[int, ...]) -> np.ndarray:
    """The codes with their blocks in the order of ``turn``."""
    out = np.zeros_like(codes)
    for place, block in enumerate(turn):
        out |= (codes >> low_bit(block) & BLOCK) << low_bit(place)
    return out


def turned_back(codes: np.ndarray, turns: np.ndarray) -> np.ndarray:
    """Undo turns, given by number."""
    out = np.zeros_like(codes)
    for number, turn in enumerate(TURNS):
        at = turns == number
        out[at] = turned(codes[at], tuple(turn.index(b) for b in range(BLOCKS)))
    return out


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code word in reflected Gray order."""
    for shift in (1, 2, 4, 8, 16, 32):
        codes = codes ^ (codes >> np.uint64(shift))
    return codes


class Index:
    """Nodes over runs of fingerprints that stand in Gray order.

    Level 0 is the fingerprints; a node of a higher level covers up to FANOUT
    neighbours of one run and holds the bits they share; the top level has one
    node a run. ``codes`` has one column for each 64 bits.
    """

    def __init__(self, codes: np.ndarray, runs: np.ndarray):
        self.levels = [(codes, np.full_like(codes, ~np.uint64(0)), np.arange(len(codes)), np.ones(len(codes), np.int64))]
        low, high = codes, codes
        while True:
            starts = np.flatnonzero(np.r_[True, runs[1:] != runs[:-1]])
            if len(starts) == len(runs):
                break
            sizes = np.diff(np.r_[starts, len(runs)])
            within = np.arange(len(runs)) - np.repeat(starts, sizes)
            first = np.flatnonzero(within % FANOUT == 0)
            low, high = np.bitwise_and.reduceat(low, first, axis=0), np.bitwise_or.reduceat(high, first, axis=0)
            self.levels.append((low, ~(low ^ high), first, np.diff(np.r_[first, len(runs)])))
            runs = runs[first]

    def pairs(self, most: int, labels: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of fingerprints of one run that differ in up to ``most`` bits, in parts.

        With ``labels``, only those whose labels differ; nodes all of one label are not opened.
        """
        same = [(labels, labels)]
        for *_, first, _ in self.levels[1:] if labels is not None else []:
            same.append((np.minimum.reduceat(same[-1][0], first), np.maximum.reduceat(same[-1][1], first)))
        top = len(self.levels) - 1
        roots = np.arange(len(self.levels[top][0]))
        todo = [(top, roots, roots, np.zeros(len(roots), np.int64), np.zeros_like(self.levels[top][0]))]
        while todo:
            level, a, b, so_far, settled = todo.pop()
            if len(a) > PAIRS:
                half = len(a) // 2
                todo += [(level, *(x[:half] for x in (a, b, so_far, settled))), (level, *(x[half:] for x in (a, b, so_far, settled)))]
                continue
            pattern, mask, first, width = self.levels[level]
            if labels is not None:
                low, high = same[level]
                open_ = (low[a] != high[b]) | (high[a] != low[b])
                a, b, so_far, settled = a[open_], b[open_], so_far[open_], settled[open_]
            # Word by word: most pairs of wide codes are dropped after the first few.
            for word in range(pattern.shape[1]):
                shared = mask[a, word] & mask[b, word]
                so_far = so_far + np.bitwise_count((pattern[a, word] ^ pattern[b, word]) & shared & ~settled[:, word])
                near = so_far <= most
                a, b, so_far, settled, shared = a[near], b[near], so_far[near], settled[near], shared[near]
                settled[:, word] |= shared
            if level == 0:
                yield a[a < b], b[a < b]
                continue
            # All pairs of children; a node with itself gives each pair once.
            reps = width[a] * width[b]
            which = np.repeat(np.arange(len(a)), reps)
            offset = np.arange(len(which)) - np.repeat(np.cumsum(reps) - reps, reps)
            left, right = first[a[which]] + offset // width[b[which]], first[b[which]] + offset % width[b[which]]
            once = left <= right
            which, left, right = which[once], left[once], right[once]
            if len(left):
                todo.append((level - 1, left, right, so_far[which], settled[which]))


def joined(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after linking places a and b; a label is the least place of its set."""
    while True:
        x, y = labels[a], labels[b]
        apart = x != y
        if not apart.any():
            return labels
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while True:
            shorter = labels[labels]
            if (shorter == labels).all():
                break
            labels = shorter


def linked(turns: np.ndarray, codes: np.ndarray, front: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what the runs hold together, each fingerprint to the first of its set."""
    runs = np.cumsum(np.r_[True, (turns[1:] != turns[:-1]) | ((codes[1:] ^ codes[:-1]) >> np.uint64(64 - front) != 0)])
    many = np.bincount(runs)[runs] > 1
    turns, codes, runs = turns[many], codes[many], runs[many]
    if not len(codes):
        return codes, codes
    labels = np.arange(len(codes))
    for a, b in Index(codes[:, None], runs).pairs(most):
        labels = joined(labels, a, b)
    own = turned_back(codes, turns)
    far = labels != np.arange(len(codes))
    return own[far], own[labels[far]]


def links(prints: DataFrame, most: int = DIFFERENCES) -> DataFrame:
    """a, b: links that connect all of ``prints`` (distinct fp) within ``most`` bits, few for a crowd."""
    if most > DIFFERENCES:
        raise ValueError(f"the turns are made for up to {DIFFERENCES} differing bits")
    front = 64 // BLOCKS * (BLOCKS - DIFFERENCES)

    def turn_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.asarray(batch.column(0)).view(np.uint64)
            for number, turn in enumerate(TURNS):
                rank = gray_rank(turned(codes, turn)) ^ SIGN
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rank), number, np.int32)), pa.array(rank.view(np.int64))], ["turn", "rank"])

    rows = prints.select("fp").mapInArrow(turn_all, "turn int, rank bigint")
    dealt = rows.repartitionByRange("turn", F.shiftright("rank", 64 - front)).sortWithinPartitions("turn", "rank")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_turns, kept_codes = np.zeros(0, np.int32), np.zeros(0, np.uint64)

        def out(turns, codes):
            a, b = linked(turns, codes, front, most)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            rank = np.asarray(batch.column(1)).view(np.uint64) ^ SIGN
            turns = np.r_[kept_turns, np.asarray(batch.column(0))]
            codes = np.r_[kept_codes, rank ^ (rank >> np.uint64(1))]
            # The last run may go on in the next batch.
            same = (turns == turns[-1]) & ((codes ^ codes[-1]) >> np.uint64(64 - front) == 0)
            cut = len(codes) - int(same.sum())
            kept_turns, kept_codes = turns[cut:], codes[cut:]
            if cut:
                yield out(turns[:cut], codes[:cut])
        if len(kept_codes):
            yield out(kept_turns, kept_codes)

    return dealt.mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, most: int = DIFFERENCES) -> DataFrame:
    """doc_id, tie, fp, component_id, stays of every row.

    Rows whose fingerprints differ in up to ``most`` bits are linked; a component
    is what links reach. ``component_id`` is its least doc_id (null if it has
    none), ``stays`` marks its first row by doc_id (null last), then text hash;
    rows equal in both are marked alike. Null and empty texts share the
    fingerprint zero; an empty table gives no rows; other columns are not looked at.
    """
    rows = stored(fingerprints(docs, shingle))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie")
    nodes = stored(rows.groupBy("fp").agg(F.min(order).alias("first")))
    roots = components(links(nodes.select("fp"), most))
    rooted = stored(
        nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
    )
    firsts = rooted.groupBy("root").agg(F.min("first").alias("first"))
    found = rooted.drop("first").join(firsts, "root").select(F.col("fp").alias("_fp"), "first")
    return rows.join(found, F.col("fp") == F.col("_fp")).select(
        "doc_id", "tie", "fp", F.col("first.doc_id").alias("component_id"), (order == F.col("first")).alias("stays")
    )


def without_near_duplicates(docs: DataFrame, **how) -> DataFrame:
    """The documents with one row of each component of ``near_duplicates`` left, also where a row is repeated."""
    stay = near_duplicates(docs, **how).filter("stays").select(row_key(F.col("tie")).alias("key")).distinct()
    return one_of_each(docs, row_key(F.xxhash64(whole())), stay)


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    out = near_duplicates(table(spark, folder, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES = {"op4_simhash": op4_simhash}

SQL: dict[str, str] = {}
