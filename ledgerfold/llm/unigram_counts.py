"""Token counts of a unigram model by dynamic programming over a trie of pre-tokens.

A pre-token is a run without white space behind the word mark U+2581.  Its token count is
that of its best segmentation: the one of least total cost, fewer tokens first among
equals.  The distinct pre-tokens of a batch are inserted in a trie, and the forward score
(least cost and its token count) is computed once for every trie node, that is, once for a prefix however
many pre-tokens share it; the node at a pre-token's end stores its count.  Documents then sum the
counts of their pre-tokens.

Model: the pieces of a public SentencePiece file with a Zipf cost by their rank, in
integer millinats, so sums and ties are exact: cost(rank) = round(1000 ln((rank + 3) H)),
H the sum of 1 / (rank + 3).  A character in no piece costs ``UNKNOWN`` and counts as its UTF-8
bytes (byte fallback).

The trie belongs to one task and is dropped beyond ``NODES`` nodes; a pre-token over ``LONG``
characters is scored by itself in memory that does not grow with it.  Nothing is shuffled.

Defined results: a null, empty or blank text has 0 pre-tokens, 0 tokens and cost 0;
repeated rows give repeated rows; extra columns are not read; texts are counted whole.
"""

from __future__ import annotations

import gc
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.word_ids import listed, texts_of

MARK, UNKNOWN, NODES, LONG = "▁", 30_000, 500_000, 48
COUNTS = "doc_id long, n_pretokens long, n_tokens long, cost long"


def zipf_costs(path: str) -> dict[str, int]:
    """Piece -> cost, for the ordinary pieces of the model file, by their order in it."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    total = sum(1 / (r + 3) for r in range(len(pieces)))
    return {p: round(1000 * math.log((r + 3) * total)) for r, p in enumerate(pieces)}


class _Node:
    """A prefix of pre-tokens: its forward score and the pieces begun and not ended in it,
    each as (children in the vocabulary, score before the piece)."""

    __slots__ = ("next", "score", "open")

    def __init__(self, score: int, open_: list):
        self.next: dict[str, _Node] | None = None
        self.score, self.open = score, open_


class TrieCounts:
    """Token count and cost of pre-tokens; state shared by prefix.

    A score is cost * 2^32 + tokens, so one integer comparison finds the least cost and
    then the fewest tokens.
    """

    def __init__(self, costs: dict[str, int]):
        self.vocab: dict[str, tuple[dict, int | None]] = {}
        for piece in sorted(costs, key=len, reverse=True):  # longer first: children exist before their parent's score is set
            at = self.vocab
            for c in piece[:-1]:
                at = at.setdefault(c, ({}, None))[0]
            at[piece[-1]] = (at.get(piece[-1], ({}, None))[0], (costs[piece] << 32) + 1)
        self.forget()

    def forget(self) -> None:
        self.root, self.nodes = _Node(0, []), 0

    def _step(self, score: int, open_: list, c: str) -> tuple[int, list]:
        """Forward score after one more character, from all pieces that reach it."""
        best, going = score + (UNKNOWN << 32) + (1 if c < "\x80" else len(c.encode())), []
        for children, before in open_:
            here = children.get(c)
            if here is not None:
                kids, add = here
                if add is not None and before + add < best:
                    best = before + add
                if kids:
                    going.append((kids, before))
        here = self.vocab.get(c)
        if here is not None:
            kids, add = here
            if add is not None and score + add < best:
                best = score + add
            if kids:
                going.append((kids, score))
        return best, going

    def insert(self, word: str) -> tuple[int, int]:
        """(cost, tokens) of a pre-token; scores only the nodes that are new."""
        if len(word) > LONG:
            state = 0, []
            for c in word:
                state = self._step(*state, c)
            return state[0] >> 32, state[0] & 0xFFFFFFFF
        at = self.root
        for c in word:
            if at.next is None:
                at.next = {}
            child = at.next.get(c)
            if child is None:
                child = at.next[c] = _Node(*self._step(at.score, at.open, c))
                self.nodes += 1
            at = child
        return at.score >> 32, at.score & 0xFFFFFFFF


@lru_cache(maxsize=2)
def _trie(path: str) -> TrieCounts:
    return TrieCounts(zipf_costs(path))


def _counter(path: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _trie(path)
        gc.disable()  # nodes form no cycles, and the collector would visit all of them again and again
        for batch in batches:
            at = 0
            for texts in texts_of(batch.column(1)):
                docs = batch.column(0).slice(at, len(texts))
                at += len(texts)
                split = pc.utf8_split_whitespace(texts)
                coded = split.flatten().dictionary_encode()
                found = np.zeros((len(coded.dictionary) + 1, 2), np.int64)
                for k, word in enumerate(listed(coded.dictionary)):
                    if word:  # white space at an end leaves an empty piece
                        if trie.nodes > NODES:
                            trie.forget()
                        found[k] = trie.insert(MARK + word)
                per = np.zeros((len(coded) + 1, 3), np.int64)
                per[1:, :2] = found[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else 0
                per[1:, 2] = per[1:, 1] > 0
                total = np.cumsum(per, axis=0)[split.offsets.to_numpy() - split.offsets[0].as_py()]
                cost, tokens, words = np.diff(total, axis=0).T
                yield pa.RecordBatch.from_arrays([docs, *(pa.array(np.ascontiguousarray(x)) for x in (words, tokens, cost))], names=["doc_id", "n_pretokens", "n_tokens", "cost"])
        gc.enable()

    return rows


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_pretokens, n_tokens and the segmentations' total cost (millinats) for every row."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return d.mapInArrow(_counter(path), COUNTS)
