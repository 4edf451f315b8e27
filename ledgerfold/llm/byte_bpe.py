"""Byte-level BPE by a monoid of boundary-stable encodings.

A pre-token (one match of the split pattern) is encoded by halves: pieces of up to
``LEAF`` bytes by direct merging, and two neighbours are joined by re-encoding a window
around their border.  The window grows until the result is provably that of the whole:

A window ``w`` of the string ``x + y`` is cut at token borders of both sides' encodings.
Encoding by lowest rank is stable under a border exactly if no merge ever spans it, and a
list of tokens t1..tn is the encoding of its bytes iff every neighbouring pair (ti, ti+1)
encodes to itself (``_compatible``: encoding ti + ti+1 alone gives [ti, ti+1] back).
So after re-encoding a window, only the two pairs at its edges need a test: if both hold,
every pair of the joined list holds, and the list is the encoding of the whole.
If one fails, the window grows by one token on that side.  The empty list is the
monoid's unit, and joining is associative since every result equals the direct encoding.

Decoding concatenates tokens' bytes up the same tree (``b"".join``).

Defined results: a null or empty text has no ids and the hash of no bytes; repeated rows
give repeated rows; extra columns are not read; pre-tokens of any length are encoded whole.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.word_ids import texts_of

#: Bytes that are merged directly; pre-tokens kept by a worker, and the bytes beyond which one is not kept.
LEAF, KEPT, KEPT_BYTES = 32, 400_000, 64
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class ByteBpe:
    """Encoder and decoder for the rank file at ``path`` and the split pattern."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, f))}
        self.bytes = {i: t for t, i in self.ranks.items()}
        self.split = regex.compile(pattern).findall
        self.known: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    def _merge(self, piece: bytes) -> list[int]:
        """Direct encoding: merge the leftmost pair of lowest rank until none has a rank."""
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        parts = [piece[i:i + 1] for i in range(len(piece))]
        cost = [ranks.get(a + b) for a, b in zip(parts, parts[1:])]
        while True:
            best = min((c for c in cost if c is not None), default=None)
            if best is None:
                return [ranks[p] for p in parts]
            i = cost.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del cost[i]
            if i < len(cost):
                cost[i] = ranks.get(parts[i] + parts[i + 1])
            if i:
                cost[i - 1] = ranks.get(parts[i - 1] + parts[i])

    def _compatible(self, a: int, b: int) -> bool:
        """Whether tokens a, b stay apart when their bytes are encoded together."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= KEPT:
                self.pairs.clear()
            known = self.pairs[a, b] = self._merge(self.bytes[a] + self.bytes[b]) == [a, b]
        return known

    def join(self, x: list[int], y: list[int]) -> list[int]:
        """The encoding of the joined bytes, from both sides' encodings."""
        if not x or not y or self._compatible(x[-1], y[0]):
            return x + y
        left, right = 1, 1
        while True:
            window = b"".join(map(self.bytes.__getitem__, x[-left:] + y[:right]))
            middle = self._merge(window) if len(window) <= 4 * LEAF else self._heap_merge(window)
            grow_left = left < len(x) and not self._compatible(x[-left - 1], middle[0])
            grow_right = right < len(y) and not self._compatible(middle[-1], y[right])
            if not grow_left and not grow_right:
                return x[:len(x) - left] + middle + y[right:]
            # doubling keeps the sum of all windows linear in the last one
            left = min(len(x), 2 * left) if grow_left else left
            right = min(len(y), 2 * right) if grow_right else right

    def _heap_merge(self, piece: bytes) -> list[int]:
        """Direct encoding in O(n log n), for wide windows."""
        import heapq

        ranks, n = self.ranks, len(piece)
        after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, to = heapq.heappop(heap)
            j = after[i] if end[i] else n
            if not end[i] or j >= n or end[j] != to:
                continue  # one side has been merged since
            end[i], end[j], after[i] = to, 0, after[j]
            if after[j] < n:
                before[after[j]] = i
                if (r := ranks.get(piece[i:end[after[j]]])) is not None:
                    heapq.heappush(heap, (r, i, end[after[j]]))
            if (h := before[i]) >= 0 and (r := ranks.get(piece[h:to])) is not None:
                heapq.heappush(heap, (r, h, to))
        return [ranks[piece[i:e]] for i, e in enumerate(end) if e]

    def encode_bytes(self, piece: bytes) -> list[int]:
        """Tree reduction, bottom up: leaves of LEAF bytes, then neighbours joined level by level."""
        if len(piece) <= LEAF:
            return self._merge(piece) if piece else []
        level = [self._merge(piece[i:i + LEAF]) for i in range(0, len(piece), LEAF)]
        while len(level) > 1:
            level = [self.join(*level[i:i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
        return level[0]

    def _known(self, word: str) -> tuple[int, ...]:
        ids = tuple(self.encode_bytes(word.encode()))
        if len(word) <= KEPT_BYTES:
            if len(self.known) >= KEPT:
                self.known.clear()
            self.known[word] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        known, out = self.known, []
        for word in self.split(text):
            out += known.get(word) or self._known(word)
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


@lru_cache(maxsize=2)
def byte_bpe(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def _encoder(path: str, pattern: str, digests: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path, pattern)
        for batch in batches:
            at = 0
            for texts in texts_of(batch.column(1)):
                docs = batch.column(0).slice(at, len(texts))
                at += len(texts)
                ids = [bpe.encode(t) for t in texts.to_pylist()]
                if digests:
                    yield pa.RecordBatch.from_arrays([
                        docs, pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest() for x in ids], pa.string()),
                        pa.array([hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids], pa.string())],
                        names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
                else:
                    yield pa.RecordBatch.from_arrays([docs, pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return rows


def _decoder(path: str, pattern: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path, pattern)
        for batch in batches:
            texts = [None if x is None else bpe.decode(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], names=["doc_id", "decoded"])

    return rows


def _pair(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def encode_texts(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids of every row, in one pass over the texts."""
    return _pair(docs, id_col, text_col).mapInArrow(_encoder(path, pattern, False), "doc_id long, ids array<int>")


def decode_ids(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and decoded bytes of every row of ``encode_texts``."""
    return encoded.select("doc_id", "ids").mapInArrow(_decoder(path, pattern), "doc_id long, decoded binary")


def bpe_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and SHA-256 of the ids and of the bytes decoded from them."""
    return _pair(docs, id_col, text_col).mapInArrow(_encoder(path, pattern, True), DIGESTS)
