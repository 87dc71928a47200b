"""Repeated passages by relative Lempel-Ziv parsing.

Every window of 20 words has an anchor, the least hash of a run of ANCHOR words in
it, which equal windows share. Consecutive windows of one anchor are a
phrase; a document is a sequence of phrases. All phrases of all documents, sorted
by anchor, content and place and dealt by range, are the reference: each range is
one block, and its order is its index. Every document is parsed against every
block that holds one of its anchors (against any other, no factor could be long
enough): a phrase that starts earlier in the reference is copied from there, and
the greedy factors of a document are the longest runs of words that copied
phrases cover. At the borders of factors stand phrases whose anchor the reference
knows with other words around; only these are looked up window by window. Factors
are 20 words long or more by construction.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.llm.common import WORD_BYTES, stored, table, whole

WINDOW = 20  # words
ANCHOR = 8  # words, less than a window
SPREAD = WINDOW - ANCHOR + 1  # runs of an anchor's length in a window, and windows in a phrase at most
SEED = 42
PIECE = 1 << 18  # bytes of text looked at together
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd
START, LENGTH = 32, 8  # bits of a packed place: start of a phrase, number of its windows

SOLID = np.ones(256, bool)  # bytes that words are made of
SOLID[[0x20, *range(0x09, 0x0E)]] = False


def stirred(h: np.ndarray) -> np.ndarray:
    """The finishing steps of SplitMix64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Runs:
    """Hashes of runs of a sequence of numbers, as polynomials modulo 2^64, from sums over its beginnings.

    Two runs of the same numbers have the same hash wherever they stand.
    """

    powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, numbers: np.ndarray, base: int):
        power, self.inverse = self.tables(base, len(numbers))
        self.sums = np.zeros(len(numbers) + 1, np.uint64)
        np.cumsum(numbers * power[: len(numbers)], out=self.sums[1:])

    @classmethod
    def tables(cls, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Powers of an odd base and of its inverse."""
        if len(cls.powers.get(base, [()])[0]) < n:
            factors = np.ones((2, 1 << max(16, n.bit_length())), np.uint64)
            factors[:, 1:] = np.array([[base], [pow(base, -1, 1 << 64)]], np.uint64)
            cls.powers[base] = tuple(np.cumprod(factors, axis=1))
        return cls.powers[base]

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.inverse[start]


def word_hashes(data: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the bytes of texts that start at ``docs``, and where the words of each text begin and the last end."""
    solid = SOLID[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[docs] = cut[-1] = True
    start = np.flatnonzero(solid & (cut[:-1] | ~np.r_[False, solid[:-1]]))
    end = np.flatnonzero(solid & (cut[1:] | ~np.r_[solid[1:], False])) + 1
    hashes = Runs(data.astype(np.uint64) + np.uint64(1), BASES[0]).of(start, end)
    return stirred(hashes + (end - start).astype(np.uint64) * np.uint64(BASES[1])), np.searchsorted(start, np.r_[docs, len(data)])


class Words:
    """Hashes of the words of some rows, or of a part of one long row.

    ``rows`` are the numbers of the rows, ``bounds`` where their words begin and
    the last end, ``base`` the number of the first word here in its text.
    """

    def __init__(self, rows: np.ndarray, hashes: np.ndarray, bounds: np.ndarray, base: int = 0):
        self.rows, self.hashes, self.bounds, self.base = rows, hashes, bounds, base
        self.runs = [Runs(hashes, b) for b in BASES]

    def windows(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of the windows that start at words of this piece."""
        return tuple(stirred(runs.of(at, at + WINDOW)) for runs in self.runs)

    def phrases(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """anchor, content, row, first window in the text and number of windows of each phrase."""
        n = len(self.hashes) - WINDOW + 1
        if n < 1:
            return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
        grams = np.arange(len(self.hashes) - ANCHOR + 1)
        order = stirred(self.runs[0].of(grams, grams + ANCHOR))
        least, width = order, 1
        while width * 2 <= SPREAD:
            least, width = np.minimum(least[:-width], least[width:]), width * 2
        least = np.minimum(least[:n], least[SPREAD - width : SPREAD - width + n])
        doc = np.repeat(np.arange(len(self.rows)), np.diff(self.bounds))
        whole_ = doc[:n] == doc[WINDOW - 1 :]  # inside one text
        new = whole_ & np.r_[True, (least[1:] != least[:-1]) | (doc[1:n] != doc[: n - 1])]
        # Where an anchor stands twice in a window, the first place counts and a phrase ends with it.
        twice = np.zeros(n + 1, np.int64)
        for d in range(1, SPREAD + 1):
            again = np.flatnonzero(order[:-d] == order[d:]) if d < len(order) else grams[:0]
            np.add.at(twice, np.clip(again + d - SPREAD, 0, n), 1)
            np.add.at(twice, np.clip(again + 2, 0, n), -1)
        near = np.flatnonzero(np.cumsum(twice[:n]))
        if len(near):
            place = np.full(n, -1)
            place[near] = near + np.lib.stride_tricks.sliding_window_view(order, SPREAD)[near].argmin(axis=1)
            new[near[1:]] |= whole_[near[1:]] & (place[near[1:]] != place[near[1:] - 1]) & (place[near[1:] - 1] >= 0)
        first = np.flatnonzero(new)
        passed = np.cumsum(whole_)
        count = np.diff(np.r_[passed[first] - 1, passed[-1]])
        one, two = self.windows(first)[0], self.windows(first + count - 1)[1]
        content = stirred(stirred(one ^ count.astype(np.uint64)) + two * np.uint64(BASES[0]))
        own = doc[first]
        return least[first], content, self.rows[own], first - self.bounds[own] + self.base, count


def pieces(texts: pa.Array) -> Iterator[Words]:
    """The words of a column of texts, a few at a time; parts of a long text repeat the last words of the part before."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(texts):
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + PIECE, "right")) - 1)
        if offsets[row + 1] - offsets[row] <= PIECE:
            here = data[offsets[row] : offsets[last]]
            yield Words(np.arange(row, last), *word_hashes(here, offsets[row:last] - offsets[row]))
            row = last
            continue
        at, end, seen, before = offsets[row], offsets[row + 1], 0, np.zeros(0, np.uint64)
        while at < end:
            to = min(at + PIECE, end)
            while to < end and SOLID[data[to]]:  # not inside a word
                blank = np.flatnonzero(~SOLID[data[to : min(to + PIECE, end)]])
                to = to + int(blank[0]) if len(blank) else min(to + PIECE, end)
            hashes = np.r_[before, word_hashes(data[at:to], np.zeros(1, np.int64))[0]]
            yield Words(np.array([row]), hashes, np.array([0, len(hashes)]), seen - len(before))
            seen += len(hashes) - len(before)
            before, at = hashes[max(0, len(hashes) - WINDOW + 1) :], to
        row += 1


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, doc, tie, text: ``doc`` orders documents, ``tie`` tells rows of one doc_id with other texts apart.

    Rows without doc_id come after all others, in the order of a hash of their texts.
    """
    body = whole()
    late = F.lit(1 << 62).bitwiseOR(F.shiftrightunsigned(F.xxhash64(body), 2))
    return docs.select(
        "doc_id",
        F.coalesce(F.col("doc_id"), late).alias("doc"),
        F.pmod(F.xxhash64(F.lit(SEED), body), F.lit(1 << (62 - START - LENGTH))).alias("tie"),
        body.cast("binary").alias("text"),
    )


def all_phrases(keys: DataFrame) -> DataFrame:
    """anchor, content, doc, place of every phrase; ``place`` packs tie, first window and number of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, ties = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for words in pieces(batch.column(2)):
                anchor, content, row, first, count = words.phrases()
                place = (ties[row] << (START + LENGTH)) + (first << LENGTH) + count
                columns = [pa.array(x.view(np.int64)) for x in (anchor, content, docs[row], place)]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "content", "doc", "place"])

    return keys.select("doc", "tie", "text").mapInArrow(run, "anchor bigint, content bigint, doc bigint, place bigint")


def copied(found: DataFrame) -> DataFrame:
    """doc, place, open of the phrases that start earlier in the reference or that need a look at their windows.

    A phrase whose content stands earlier in its block is copied whole (``open``
    false). The first of each content is open if its anchor comes with other
    contents, or if the anchor reaches the border of the block, beyond which
    other contents may stand. Rows that share doc and place are one phrase.
    """
    order = "anchor", "content", "doc", "place"
    dealt = found.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_anchor = last_content = source = None  # of the run that may go on
        alone = None  # the only first of the last anchor so far
        for batch in batches:
            anchor, content, doc, place = (batch.column(i).to_numpy() for i in range(4))
            if not len(anchor):
                continue
            new_anchor, new = np.ones(len(anchor), bool), np.ones(len(anchor), bool)
            new_anchor[1:] = anchor[1:] != anchor[:-1]
            new[1:] = new_anchor[1:] | (content[1:] != content[:-1])
            new_anchor[0] = anchor[0] != last_anchor
            new[0] = new_anchor[0] or content[0] != last_content
            start = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))
            s_doc, s_place = (np.where(start >= 0, x[start], s) for x, s in zip((doc, place), source or (0, 0)))
            copy = ~new & ((doc != s_doc) | (place != s_place))
            group = np.cumsum(new_anchor)  # 0: the anchor of the batch before
            contents = np.bincount(group, new, minlength=group[-1] + 1)
            open_groups = contents > 1
            if last_anchor is None:
                open_groups[:2] = True  # the first anchor of the block
            elif contents[0]:
                open_groups[0] = True
            out = new & open_groups[group]
            docs_out, places_out, opens = [doc[copy], doc[out]], [place[copy], place[out]], [np.zeros(copy.sum(), bool), np.ones(out.sum(), bool)]
            if alone is not None and contents[0]:  # others came
                docs_out.append([alone[0]]), places_out.append([alone[1]]), opens.append([True])
                alone = None
            if group[-1] > 0:  # the last anchor is a new one
                at = len(new) - 1 - int(np.argmax(new[::-1]))
                alone = None if open_groups[group[-1]] else (int(doc[at]), int(place[at]))
            last_anchor, last_content, source = anchor[-1], content[-1], (int(s_doc[-1]), int(s_place[-1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(docs_out).astype(np.int64)), pa.array(np.concatenate(places_out).astype(np.int64)), pa.array(np.concatenate(opens).astype(bool))],
                ["doc", "place", "open"],
            )
        if alone is not None:
            yield pa.RecordBatch.from_arrays([pa.array([alone[0]]), pa.array([alone[1]]), pa.array([True])], ["doc", "place", "open"])

    return dealt.mapInArrow(run, "doc bigint, place bigint, open boolean")


def tie_of(place: Column) -> Column:
    return F.shiftright(place, START + LENGTH)


def by_document(marks: DataFrame) -> DataFrame:
    """_doc, _tie, places: no more places than the document has words."""
    return marks.groupBy(F.col("doc").alias("_doc"), tie_of(F.col("place")).alias("_tie")).agg(F.collect_list("place").alias("places"))


def unpacked(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First window and number of windows."""
    return (places >> LENGTH) & ((1 << START) - 1), places & ((1 << LENGTH) - 1)


def border_windows(docs: DataFrame) -> DataFrame:
    """one, two, doc, place of every window of the open phrases ``places`` of each of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, ties, lists = batch.column(1).to_numpy(), batch.column(2).to_numpy(), batch.column(4)
            bounds = np.cumsum(np.r_[0, lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)])
            first, count = unpacked(lists.flatten().to_numpy())
            row = np.repeat(np.arange(len(docs)), np.diff(bounds))
            within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            wanted = np.unique(np.stack([np.repeat(row, count), np.repeat(first, count) + within]), axis=1)
            for words in pieces(batch.column(3)):
                part = wanted[:, np.searchsorted(wanted[0], words.rows[0]) : np.searchsorted(wanted[0], words.rows[-1], "right")]
                own = part[0] - words.rows[0]
                at = part[1] - words.base + words.bounds[own]
                here = (at >= words.bounds[own]) & (at + WINDOW <= words.bounds[own + 1])
                row_, start, at = part[0][here], part[1][here], at[here]
                one, two = words.windows(at)
                place = (ties[row_] << (START + LENGTH)) + (start << LENGTH) + 1
                columns = [pa.array(x.view(np.int64)) for x in (one, two, docs[row_], place)]
                yield pa.RecordBatch.from_arrays(columns, ["one", "two", "doc", "place"])

    return docs.select("doc_id", "doc", "tie", "text", "places").mapInArrow(run, "one bigint, two bigint, doc bigint, place bigint")


REPEATED, HEAD, TAIL = 0, 1, 2


def repeated(found: DataFrame) -> DataFrame:
    """doc, place of the windows of ``found`` that start earlier in it."""
    order = "one", "two", "doc", "place"
    dealt = found.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["kind", "one", "two", "doc", "place"]
        last, source = None, (0, 0)

        def single(kind: int, *values: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), *(pa.array([int(x)], pa.int64()) for x in values)], names)

        for batch in batches:
            one, two, doc, place = (batch.column(i).to_numpy() for i in range(4))
            if not len(one):
                continue
            new = np.ones(len(one), bool)
            new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
            if last is None:
                yield single(HEAD, one[0], two[0], doc[0], place[0])
            else:
                new[0] = (one[0], two[0]) != last
            start = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))
            s_doc, s_place = (np.where(start >= 0, x[start], s) for x, s in zip((doc, place), source))
            copy = ~new & ((doc != s_doc) | (place != s_place))
            last, source = (one[-1], two[-1]), (int(s_doc[-1]), int(s_place[-1]))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(copy.sum(), REPEATED, np.int32)), *(pa.array(x[copy]) for x in (one, two, doc, place))], names)
        if last is not None:
            yield single(TAIL, *last, *source)

    marks = stored(dealt.mapInArrow(run, "kind int, one bigint, two bigint, doc bigint, place bigint"))
    # One head and one tail a task: a run that a border cuts starts earlier if another task ends in it before.
    tails = marks.filter(F.col("kind") == TAIL).groupBy(F.col("one").alias("_one"), F.col("two").alias("_two")).agg(F.min(F.struct("doc", "place")).alias("_at"))
    heads = marks.filter(F.col("kind") == HEAD).join(F.broadcast(tails), (F.col("one") == F.col("_one")) & (F.col("two") == F.col("_two")))
    return marks.filter(F.col("kind") == REPEATED).select("doc", "place").union(
        heads.filter(F.col("_at") < F.struct("doc", "place")).select("doc", "place")
    )


def factors(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and end of the greedy factors that copied phrases and windows make up, in order, apart from each other."""
    first, count = unpacked(np.sort(places & ((1 << (START + LENGTH)) - 1)))
    end = np.maximum.accumulate(first + count + WINDOW - 1)
    cut = np.flatnonzero(np.r_[True, first[1:] > end[:-1]])
    return first[cut], end[np.r_[cut[1:] - 1, len(end) - 1]]


def without_factors(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept of ``docs`` with their ``places``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, removed, digests, kept = [], [], [], []
            for text, places in zip(batch.column(3), batch.column(4)):
                words = WORD_BYTES.findall(text.as_py())
                numbers.append(len(words))
                if places.is_valid and len(places):
                    starts, ends = factors(places.values.to_numpy())
                    words = [w for a, b in zip([0, *ends], [*starts, len(words)]) for w in words[a:b]]
                removed.append(numbers[-1] - len(words))
                body = b" ".join(words)
                digests.append(hashlib.sha256(body).hexdigest())
                kept.append(body)
            columns = [batch.column(0), pa.array(numbers, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string()), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    return docs.select("doc_id", "doc", "tie", "text", "places").mapInArrow(run, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept string")


def substring_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept (the words left, joined by one space) of every row.

    A word goes if it stands in a window of 20 words that also starts earlier: in
    a row of smaller doc_id, or in the same one further ahead. A null text has no
    words. Rows equal in doc_id and text are one document and get one result;
    other rows of one doc_id are ordered by a hash of their texts, rows without
    doc_id come last, likewise. An empty table gives no rows; other columns are
    not looked at. Windows are compared by 128 bits of hashes.
    """
    keys = keyed(docs)
    marks = stored(copied(all_phrases(keys)))

    def joined(places: DataFrame, how: str) -> DataFrame:
        # Both joins deal the texts alike.
        return keys.join(places, (F.col("doc") == F.col("_doc")) & (F.col("tie") == F.col("_tie")), how)

    border = repeated(border_windows(joined(by_document(marks.filter("open")), "inner")))
    spans = marks.filter("not open").select("doc", "place").union(border)
    return without_factors(joined(by_document(spans), "left"))


def op13_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_duplicates(table(spark, folder, "documents")).drop("kept")


QUERIES = {"op13_substring_dedup": op13_substring_dedup}

SQL = {
    "op13_substring_dedup": r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
places AS (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS pos FROM docs),
wins AS (SELECT doc_id, pos, array_to_string(list_slice(words, pos, pos + 19), ' ') AS win FROM places),
later AS (
  SELECT doc_id, pos FROM (SELECT *, row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) AS k FROM wins) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS pos FROM later),
every AS (SELECT doc_id, generate_subscripts(words, 1) AS pos, unnest(words) AS word FROM docs),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS body, count(*) AS n
  FROM every ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""
}
