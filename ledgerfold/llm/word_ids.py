"""Token ids of whole texts by the ``tokenizers`` library, with each distinct word encoded once.

The vocabulary file's pre-tokenizer never joins text across white space, so a text's ids are
the ids of its white-space-separated words in order.  A batch of texts is split by Arrow
and its distinct words are looked up: short ones all at once in a numpy table by their bytes and
length, longer ones in a dict.  Of new words, one of Latin letters with closing punctuation is its
letters in lower case (the file lowers all text) and its punctuation, which the
pre-tokenizer always parts, any other is taken whole.  What of these is new is encoded by the library,
letters many at a time and cut where a word ends, and ids are gathered with numpy.

A worker keeps what it has seen (``LIMIT_BYTES`` at most, then it starts anew) and splits ``SLICE`` bytes of text at a time, so memory is
bounded whatever the number of distinct words; no text is cut or skipped.  Spark keeps workers for later stages: tasks of
operators without words let the table go (``lean``).
"""

from __future__ import annotations

import codecs
import os
from collections.abc import Callable, Iterator
from functools import lru_cache, wraps
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of words and ids kept by a worker, and what a long word takes beside its characters (its entry and place).
LIMIT_BYTES, WORD_BYTES = 60_000_000, 180
#: Most bytes of a word that is kept as two numbers; masks of the first bytes of eight; a place is where ids start and their number.
SHORT, LENGTH_BITS, LENGTH = 15, 32, (1 << 32) - 1
BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Bytes of text that are split at a time.
SLICE = 1_000_000
#: Letters (all composed, so that normal form C leaves them alone), then at most one run of punctuation.
PUNCTUATION = ".,;:!?*$%&#|()\""
SIMPLE = rf"^[A-Za-zÀ-ÖØ-öø-ÿ]+[{PUNCTUATION}]*$"
LETTERS = "".join(map(chr, [*range(65, 91), *range(97, 123), *range(192, 256)]))
JOIN = 256


def texts_of(column: pa.Array | pa.ChunkedArray, size: int = SLICE) -> Iterator[pa.Array]:
    """Slices of a text column of about ``size`` bytes (one long text may exceed it), nulls as empty.
    A batch is copied a slice at a time, never whole."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, at = np.cumsum(lengths), 0
    while at < len(column):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield pc.fill_null(column.slice(at, to - at).cast(pa.large_string()), "")
        at = to


def free_name(columns: list[str], name: str) -> str:
    """``name`` with as many underscores before it as keep it apart from ``columns``."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs values[s:s+n] one after another."""
    some = np.nonzero(lengths)[0]
    starts, lengths = starts.take(some), lengths.take(some)
    total = int(lengths.sum())
    if not total:
        return values[:0]
    kind = np.int32 if max(total, len(values)) < 1 << 31 else np.int64
    first = np.cumsum(lengths) - lengths
    at = np.repeat((starts - first).astype(kind), lengths)
    at += np.arange(total, dtype=kind)
    return values.take(at)


def listed(column: pa.Array) -> list:
    return column.to_numpy(zero_copy_only=False).tolist()


def _runs(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the ids at ``places``."""
    return places >> LENGTH_BITS, places & LENGTH


def _keys(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes and length of words of up to ``SHORT`` bytes as two numbers each, which no other word has; which words are longer)."""
    words = words.cast(pa.large_string())
    _, offsets, data = words.buffers()
    n = len(words)
    if not n:
        return np.zeros((0, 2), np.uint64), np.zeros(0, np.int64)
    offsets = np.frombuffer(offsets, np.int64, n + 1, 8 * words.offset)
    first, end = int(offsets[0]), int(offsets[-1])
    # some bytes beyond the last word are read, and masked
    raw = b"".join([memoryview(data)[first:end] if end > first else b"", bytes(16)])
    eight = np.ndarray(len(raw) - 7, "<u8", raw, strides=1)
    at, size = offsets[:-1] - first, np.diff(offsets)
    short = np.minimum(size, SHORT)
    keys = np.empty((n, 2), np.uint64)
    keys[:, 0] = eight[at] & BYTES.take(np.minimum(short, 8))
    keys[:, 1] = eight[at + 8 * (short > 8)] & BYTES.take(np.maximum(short - 8, 0)) | short.astype(np.uint64) << np.uint64(56)
    return keys, np.nonzero(size > SHORT)[0]


class _Short:
    """Places by key: rows of both numbers and the place, each in the first free row from the one its key points to.

    The empty word's key is that of a free row, and its place is 0, without ids.
    """

    def __init__(self):
        self.n, self.rows = 0, np.zeros((1 << 14, 3), np.uint64)

    def _at(self, keys: np.ndarray) -> np.ndarray:
        h = keys[:, 0] * np.uint64(0x9E3779B97F4A7C15) ^ keys[:, 1] * np.uint64(0xC2B2AE3D27D4EB4F)
        h = (h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        return (h >> np.uint64(65 - len(self.rows).bit_length())).view(np.int64)

    def size(self, more: int) -> int:
        """Rows with ``more`` keys: three quarters are in use at most."""
        size = len(self.rows)
        while 4 * (self.n + more) > 3 * size:
            size *= 2
        return size

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places, -1 for keys that are not there."""
        out, at, left = np.full(len(keys), -1), self._at(keys), None
        while len(at):
            rows = self.rows.take(at, axis=0)
            same = (rows[:, 0] == keys[:, 0]) & (rows[:, 1] == keys[:, 1])
            found = np.nonzero(same)[0]
            out[found if left is None else left[found]] = rows[:, 2].view(np.int64).take(found)
            more = np.nonzero(~same & (rows[:, 1] != 0))[0]
            left = more if left is None else left[more]
            keys, at = keys.take(more, axis=0), at.take(more) + 1 & len(self.rows) - 1
        return out

    def add(self, keys: np.ndarray, places: np.ndarray) -> None:
        """Keep distinct keys that are not there."""
        size = self.size(len(keys))
        if size > len(self.rows):
            old, self.rows = self.rows, np.zeros((size, 3), np.uint64)
            self._put(old[old[:, 1] != 0])
        self._put(np.column_stack([keys, places.view(np.uint64)]))
        self.n += len(keys)

    def _put(self, rows: np.ndarray) -> None:
        at = self._at(rows)
        while len(at):
            free = np.nonzero(self.rows.reshape(-1).take(3 * at + 1) == 0)[0]
            self.rows[at.take(free)] = rows.take(free, axis=0)  # of keys for one row, the last stays
            there = self.rows.take(at, axis=0)
            rest = np.nonzero((there[:, 0] != rows[:, 0]) | (there[:, 1] != rows[:, 1]))[0]
            rows, at = rows.take(rest, axis=0), at.take(rest) + 1 & len(self.rows) - 1


class WordIds:
    """Ids by the vocabulary file at ``path``; ``encode(texts)`` gives (ids, ids per text)."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # in words of lower-case letters alone the file's normalizer changes nothing and its pre-tokenizer only
        # spells letters beyond ASCII as their bytes: its model (shared) does
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        spelled = {b: x for c in LETTERS for b, x in zip(c.encode(), self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0])}
        self.spelled = "".join(spelled.get(b, chr(b)) for b in range(256))
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.chars = 0
        self.short = _Short()
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0

    def _encode(self, texts: list[str], plain: bool = False) -> list[list[int]]:
        return [e.ids for e in (self.plain if plain else self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)]

    def _one_by_one(self, words: list[str]) -> list[np.ndarray]:
        """Places of the words' ids, new at the end of all ids."""
        out = []
        for at in range(0, len(words), JOIN):
            ids = self._encode(words[at:at + JOIN])
            out.append(self._add(np.array(sum(ids, []), np.uint32), np.array([len(x) for x in ids], np.int64)))
        return out

    def _letters(self, words: list[str]) -> list[np.ndarray]:
        """The same for words of lower-case letters alone: each has exactly one word end."""
        out = []
        for at in range(0, len(words), JOIN):
            some = words[at:at + JOIN]
            spelled = codecs.charmap_decode(" ".join(some).encode(), "strict", self.spelled)[0]
            ids = np.array(self._encode([spelled], True)[0], np.uint32)
            ends = np.nonzero(self.ends[ids])[0] + 1
            if len(ends) != len(some) or ends[-1] != len(ids):
                out += self._one_by_one(some)
            else:
                out.append(self._add(ids, np.diff(ends, prepend=0)))
        return out

    def _add(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used:self.used + len(ids)] = ids
        start = self.used + np.cumsum(lengths) - lengths
        self.used += len(ids)
        return start << LENGTH_BITS | lengths

    def _find(self, words: pa.Array) -> np.ndarray:
        """The places of words, -1 for those not kept."""
        keys, long = _keys(words)
        out = self.short.find(keys)
        if len(long):
            out[long] = np.fromiter(map(self.index.get, listed(words.take(pa.array(long))), repeat(-1)), np.int64, len(long))
        return out

    def _keep(self, words: pa.Array, places: np.ndarray) -> None:
        """Keep distinct words that are not kept yet."""
        keys, long = _keys(words)
        self.short.add(np.delete(keys, long, axis=0), np.delete(places, long))
        if len(long):
            names = listed(words.take(pa.array(long)))
            self.chars += sum(map(len, names))
            self.index.update(zip(names, places[long].tolist()))

    def _fill(self, places: np.ndarray, some: np.ndarray | bool, words: pa.Array, encode: Callable[[list[str]], list[np.ndarray]]) -> None:
        """Encode and keep those of ``some`` words that have no place, and set it."""
        new = np.nonzero((places < 0) & some)[0]
        if len(new):
            words = words.take(pa.array(new))
            places[new] = np.concatenate(encode(listed(words)))
            self._keep(words, places[new])

    def _learn(self, words: pa.Array) -> np.ndarray:
        """Places of distinct words that are not kept: their stems' ids, encoded where new, and their punctuation's."""
        simple = pc.match_substring_regex(words, SIMPLE)
        stems = pc.if_else(simple, pc.utf8_lower(pc.utf8_rtrim(words, PUNCTUATION)), words)
        tails = pc.if_else(simple, pc.utf8_ltrim(pc.utf8_slice_codeunits(words, 1), LETTERS), "").dictionary_encode()
        coded = stems.dictionary_encode()
        place = self._find(coded.dictionary)
        plain = pc.match_substring_regex(coded.dictionary, SIMPLE).to_numpy(zero_copy_only=False)
        self._fill(place, plain, coded.dictionary, self._letters)
        self._fill(place, ~plain, coded.dictionary, self._one_by_one)
        tail = self._find(tails.dictionary)
        self._fill(tail, True, tails.dictionary, self._one_by_one)
        place, tail = place[coded.indices.to_numpy(zero_copy_only=False)], tail[tails.indices.to_numpy(zero_copy_only=False)]
        ended = np.nonzero(tail & LENGTH)[0]
        if len(ended):
            both = np.stack([place[ended], tail[ended]], axis=1)
            place[ended] = self._add(gather(self.ids, *_runs(both.reshape(-1))), (both & LENGTH).sum(axis=1))
        # words with capitals or punctuation: no stem is one of them
        changed = np.nonzero(pc.not_equal(words, stems).to_numpy(zero_copy_only=False))[0]
        self._keep(words.take(pa.array(changed)), place[changed])
        return place

    def _places(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(the place of each word; where each text's begin)."""
        split = pc.ascii_split_whitespace(texts)
        flat, offsets = split.flatten(), split.offsets.to_numpy()
        coded = flat.dictionary_encode()
        words = coded.dictionary
        place = self._find(words)
        new = np.nonzero(place < 0)[0]
        if self._bytes(2 * len(new)) > LIMIT_BYTES:
            self.forget()
            new = np.arange(len(words))
        if len(new):
            place[new] = self._learn(words.take(pa.array(new)))
        return place[coded.indices.to_numpy(zero_copy_only=False)], offsets - offsets[0]

    def _bytes(self, more: int) -> int:
        """What the words take with ``more`` short ones kept."""
        return self.ids.nbytes + 24 * self.short.size(more) + WORD_BYTES * len(self.index) + self.chars

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each). The split words are let go before ids are gathered."""
        places, first = self._places(texts)
        spare()
        starts, lengths = _runs(places)
        ids = gather(self.ids, starts, lengths)
        return ids, np.diff(np.concatenate([[0], np.cumsum(lengths)])[first])


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def spare() -> None:
    """Give back the memory that Arrow keeps for later use."""
    pa.default_memory_pool().release_unused()


def lean(rows: Callable) -> Callable:
    """``rows`` (for ``mapInArrow``), without the word tables that tasks of earlier stages left in the worker and without
    Arrow's spare memory before and after."""
    @wraps(rows)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_ids.cache_clear()
        spare()
        yield from rows(batches)
        spare()

    return task
