"""Word-piece token counts by a linear longest-match automaton.

The vocabulary is a trie with two roots, one for pieces that begin a word and one
for pieces that go on. A failure link leads from a node to where matching goes on
after the pieces that are then certain; how many those are is kept with the link.
Greedy longest-match lengths thus come from one pass over a word's characters,
and no piece is ever built.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from vitalgrid.llm.common import WORD_BYTES, table, whole

VOCABULARY = "piece_bpe_32k.model"
BEGIN = "▁"  # marks pieces that begin a word in the vocabulary file
REMEMBERED = 200_000  # distinct words a task keeps; beyond that it starts anew
LONGEST_REMEMBERED = 64  # bytes
ROOT, INNER = 0, 1


@dataclass
class Automaton:
    """``step[u]``: character to node; ``fail[u]``: failure link, -1 for none; ``pops[u]``: pieces certain on taking it."""

    step: list[dict[str, int]]
    fail: list[int]
    pops: list[int]

    @classmethod
    def of(cls, begin: Iterable[str], inner: Iterable[str]) -> Automaton:
        """From the pieces that begin a word and those that go on; an empty begin piece stands before any inner one."""
        step, whole_piece = [{}, {}], [False, False]
        for root, pieces in ((ROOT, begin), (INNER, inner)):
            for piece in pieces:
                if root == INNER and not piece:
                    continue
                u = root
                for c in piece:
                    if c not in step[u]:
                        step[u][c] = len(step)
                        step.append({})
                        whole_piece.append(False)
                    u = step[u][c]
                whole_piece[u] = True
        fail, pops = [-1] * len(step), [0] * len(step)
        if whole_piece[ROOT]:
            fail[ROOT], pops[ROOT] = INNER, 1
        todo = deque((ROOT, INNER))
        while todo:
            u = todo.popleft()
            for c, v in step[u].items():
                todo.append(v)
                if whole_piece[v]:
                    fail[v], pops[v] = INNER, 1
                    continue
                z, n = fail[u], pops[u]
                while z >= 0 and c not in step[z]:
                    n += pops[z]
                    z = fail[z]
                if z >= 0:
                    fail[v], pops[v] = step[z][c], n
        return cls(step, fail, pops)

    def count(self, word: str) -> int:
        """Number of greedy longest-match pieces of a word; 0 if it cannot be covered."""
        step, fail, pops = self.step, self.fail, self.pops
        u, n = ROOT, 0
        for c in word:
            while (v := step[u].get(c)) is None:
                if fail[u] < 0:
                    return 0
                n += pops[u]
                u = fail[u]
            u = v
        while u != INNER:
            if fail[u] < 0:
                return 0
            n += pops[u]
            u = fail[u]
        return n


class Counted(dict):
    """Word to number of pieces, filled on demand and emptied when it has grown to its bound."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        n = self.automaton.count(word.decode("utf-8", "replace"))
        if len(word) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = n
        return n


def load(path: str) -> Automaton:
    """From a piece model; control, unknown and byte pieces are no text pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return Automaton.of([p[1:] for p in pieces if p.startswith(BEGIN)], [p for p in pieces if not p.startswith(BEGIN)])


def token_counts(docs: DataFrame, automaton: Automaton) -> DataFrame:
    """doc_id, n_words, n_tokens, n_unknown of every row, from whole texts.

    A word that the vocabulary cannot cover is one unknown token. A null or empty
    text has none; rows that share a doc_id each give a row; an empty table gives
    no rows; other columns are not looked at.
    """
    held = docs.sparkSession.sparkContext.broadcast(automaton)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted = Counted(held.value)
        for batch in batches:
            n_words, n_tokens, n_unknown = [], [], []
            for text in batch.column(1):
                total = n = unknown = 0
                for m in WORD_BYTES.finditer(text.as_py()):
                    pieces = counted[m.group()]
                    n += 1
                    total += pieces or 1
                    unknown += not pieces
                n_words.append(n)
                n_tokens.append(total)
                n_unknown.append(unknown)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (n_words, n_tokens, n_unknown))], ["doc_id", "n_words", "n_tokens", "n_unknown"]
            )

    return docs.select("doc_id", whole().cast("binary").alias("text")).mapInArrow(
        run, "doc_id bigint, n_words bigint, n_tokens bigint, n_unknown bigint"
    )


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"), load(public_tokenizers.path(VOCABULARY)))


QUERIES = {"op1_token_counts": op1_token_counts}

SQL: dict[str, str] = {}
