"""Adaptive context-mixing range coder for token ids, in independently reset, checksummed blocks.

Three predictions share one interval, by weights that are adaptive probabilities chosen by the confidences:

- order 2 and order 1: tables, empty at the beginning of every block, that hold for a hash of the last
  two ids or the last id the id that followed it and a confidence of 0 to 3;
- order 0: the frequencies of the ids, which the frame's head tells once and every block starts from.  An id that
  occurs in the frame always has a share here, so nothing has to escape.

Coder: 60-bit interval, 20-bit digits; a carry is kept in its digit and passed on when the block ends.
One narrowing codes the choice of order, a second the order-0 id.

All blocks of a frame advance together, one id a step, as numpy vectors; each block has its
own state, so with the head any one can be decoded alone.  A frame is::

    magic "CMR2", u32 block length, u32 blocks, u64 ids, u32 bytes of the table, u32 crc32 of them
    table: zlib of the distinct ids (differences) and their shares of 2^20, as little-endian u32, low bytes of all first
    blocks x (u32 bytes, u32 crc32 of the bytes, u32 crc32 of the ids as little-endian u32)
    digits in pairs, 5 bytes big-endian each, block after block

The last block is filled up with the frame's first id; ``ids`` says where the frame ends.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK, MAGIC, HEAD = 1024, b"CMR2", "<4sIIQII"
#: Bits of a table's index, of the choice between orders, and of the order-0 total; the largest id allowed.
TABLE, CHOICE, TOTAL, MOST = 10, 16, 20, (1 << 19) - 9
FULL, LEAST, DIGIT = 1 << 60, 1 << 40, 20
#: Ids counted at a time; rows turned to columns at a time.
PART, TILE = 1 << 20, 64
#: Least share of 2^16 that an order keeps.
FLOOR = 64


class Prior:
    """Order-0 frequencies of a frame: distinct ids, and the start and size of each one's share of 2^TOTAL."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray):
        self.ids, self.sizes = ids.astype(np.uint32), sizes.astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.number = np.zeros(int(self.ids[-1]) + 1 if len(self.ids) else 1, np.int32)
        self.number[self.ids] = np.arange(len(self.ids))

    @classmethod
    def of(cls, x: np.ndarray) -> Prior:
        x = x.reshape(-1)
        counts = np.zeros(int(x.max()) + 1, np.int64)
        for at in range(0, len(x), PART):
            counts += np.bincount(x[at:at + PART], minlength=len(counts))
        ids = np.nonzero(counts)[0]
        counts = counts[ids]
        free = (1 << TOTAL) - len(ids)
        sizes = 1 + counts * free // max(1, int(counts.sum()))
        sizes[np.argmax(counts)] += (1 << TOTAL) - int(sizes.sum())
        return cls(ids, sizes)

    def pack(self) -> bytes:
        numbers = np.concatenate([np.diff(self.ids.astype(np.int64), prepend=0), self.sizes - 1]).astype("<u4")
        return zlib.compress(numbers.view(np.uint8).reshape(-1, 4).T.tobytes(), 9)

    @classmethod
    def unpack(cls, raw: bytes) -> Prior:
        numbers = np.frombuffer(zlib.decompress(raw), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)
        ids, sizes = np.cumsum(numbers[:len(numbers) // 2]), numbers[len(numbers) // 2:] + 1
        if int(sizes.sum()) != 1 << TOTAL:
            raise ValueError("shares of ids don't add up")
        return cls(ids, sizes)

    def shares(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and size of the share of each id."""
        at = self.number.take(x)
        return self.starts.take(at), self.sizes.take(at)

    def by_id(self) -> tuple[np.ndarray, np.ndarray]:
        """Start of the share, and what the share lacks of 2^TOTAL, at the place of their id."""
        return self.starts.take(self.number), (1 << TOTAL) - self.sizes.take(self.number)

    def places(self) -> np.ndarray:
        """The number of the id at each place of 2^TOTAL."""
        return np.repeat(np.arange(len(self.ids), dtype=np.uint16 if len(self.ids) <= 1 << 16 else np.int32), self.sizes)


def _ones(flags: np.ndarray) -> np.ndarray:
    """1 where true, else 0."""
    return flags.view(np.int8).astype(np.int32)


class _Model:
    """State of ``n`` blocks: order-2 and order-1 predictions and mixing weights.

    Both orders' tables are one array, order 1 first, so that both are read, judged and written as one vector [order, block].
    Vectors are of 32 bits, which numpy works on without casts, and choices between values are sums of masked ones: data
    decide them at random, which a branch can't foresee.
    """

    def __init__(self, n: int):
        self.n = n
        self.at = np.arange(n, dtype=np.int64) + np.array([[0], [n << TABLE]])
        self.at_mix = np.arange(n, dtype=np.int64) << 4
        self.table = np.zeros(2 * n << TABLE, np.int32)
        # weights by both confidences: what is not yet sure begins with little; order 1's is kept above order 2's
        sure = np.arange(16)
        a2 = np.array([600, 8000, 20000, 36000], np.uint32)[sure >> 2]
        a1 = np.array([600, 8000, 16000, 26000], np.uint32)[sure & 3]
        self.weight = np.tile(a1 << np.uint32(16) | a2, n).view(np.int32)
        self.x1, self.old = np.zeros(n, np.uint32), np.zeros(n, np.uint32)
        self.hash = np.zeros((2, n), np.uint32)

    def predict(self) -> tuple[np.ndarray, ...]:
        """Predicted ids [order 1, order 2] and the ends of the shares of 2^CHOICE of order 2 and order 1."""
        last = self.x1 * np.uint32(0x9E3779B1)
        self.hash[0] = last
        np.add(self.x1 * np.uint32(0x85EBCA6B), self.old, out=self.hash[1])
        self.old = last
        i = (self.hash >> np.uint32(32 - TABLE)).astype(np.int64)
        i *= self.n
        i += self.at
        self.i = i.reshape(-1)
        self.e = self.table.take(self.i).reshape(2, self.n)
        self.sure = self.e & 3
        self.mix = self.at_mix + ((self.sure[1] << 2) + self.sure[0])
        both = self.weight.take(self.mix).view(np.uint32)
        end2, m1 = both & np.uint32(0xFFFF), both >> np.uint32(16)
        end1 = end2 + np.uint32(16) + ((np.uint32((1 << CHOICE) - 2 * FLOOR) - end2) * m1 >> np.uint32(CHOICE))
        self.m2, self.m1 = end2.view(np.int32), m1.view(np.int32)
        return self.e >> 2, self.m2, end1.view(np.int32)

    def learn(self, x: np.ndarray, right: np.ndarray) -> None:
        """right [order, block]: 1 if the id was right, whether or not it was needed."""
        other = -_ones(self.sure + (right << 2) == 0)  # all bits set where the entry is another id's from here on
        new = self.e + right * (2 - (self.sure + 1 >> 2)) - 1
        new += ((x << np.uint32(2)).view(np.int32) - new) & other
        self.table[self.i] = new.reshape(-1)
        aim = right * (65000 - FLOOR) + FLOOR
        m2 = self.m2 + (aim[1] - self.m2 >> 5)
        m1 = self.m1 + ((aim[0] - self.m1 >> 5) & right[1] - 1)
        self.weight[self.mix] = (m1 << 16) + m2
        self.x1 = x


def _choice(hit2: np.ndarray, hit: np.ndarray, end2: np.ndarray, end1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and size, of 2^CHOICE, of the order-2 id (``hit2`` 1), the order-1 id (``hit`` 1 alone) or order 0 (neither)."""
    not2, none = hit2 - 1, hit - 1
    more = end1 - end2
    start = (end2 & not2) + (more & none)
    end = end2 + (more & not2) + ((1 << CHOICE) - end1 & none)
    return start.astype(np.int64), (end - start).astype(np.int64)


class _Writer:
    """Digits are kept as rows [place, block]."""

    def __init__(self, n: int):
        self.n, self.low, self.range = n, np.zeros(n, np.int64), np.full(n, FULL, np.int64)
        self.out, self.pos = np.zeros((1024, n), np.int32), np.zeros(n, np.int64)
        self.row = np.arange(n, dtype=np.int64)

    def _shift(self, at: np.ndarray) -> None:
        low, pos = self.low.take(at), self.pos.take(at)
        if int(pos.max()) + 8 > len(self.out):
            self.out = np.concatenate([self.out, np.zeros_like(self.out)])
        self.out.reshape(-1)[pos * self.n + at] = low >> 40
        self.pos[at] = pos + 1
        self.low[at] = (low & (LEAST - 1)) << DIGIT
        self.range[at] = self.range.take(at) << DIGIT

    def put(self, start: np.ndarray, size: np.ndarray, place: np.ndarray, share: np.ndarray) -> None:
        """Narrow to ``size`` of 2^CHOICE, then to ``share`` of 2^TOTAL."""
        r = self.range >> CHOICE
        self.low += r * start
        r = r * size >> TOTAL
        self.low += r * place
        self.range = r * share
        small = np.nonzero(self.range < LEAST)[0]
        while len(small):
            self._shift(small)
            small = small[self.range.take(small) < LEAST]

    def digits(self) -> list[bytes]:
        for _ in range(3):
            self._shift(self.row)
        d = self.out[:int(self.pos.max()) + 1]
        for k in range(len(d) - 1, 0, -1):  # carries, last digit first
            d[k - 1] += d[k] >> DIGIT
        d &= (1 << DIGIT) - 1
        pairs = np.ascontiguousarray(((d[:-1:2].astype(np.int64) << DIGIT) | d[1::2]).T).astype(">i8")
        raw = pairs.view(np.uint8).reshape(self.n, -1, 8)[:, :, 3:]
        return [raw[b, :(n + 1) // 2].tobytes() for b, n in enumerate(self.pos.tolist())]


class _Reader:
    def __init__(self, digits: list[bytes]):
        n, most = len(digits), max(map(len, digits)) // 5
        raw = np.zeros((n, most, 8), np.uint8)
        for b, d in enumerate(digits):
            raw[b, :len(d) // 5, 3:] = np.frombuffer(d, np.uint8).reshape(-1, 5)
        pairs = raw.reshape(n, -1).view(">i8").astype(np.int64)
        words = np.zeros((n, 2 * most + 8), np.int32)  # a block may be read a few digits beyond its end
        words[:, 0:2 * most:2], words[:, 1:2 * most:2] = pairs >> DIGIT, pairs & ((1 << DIGIT) - 1)
        w = words[:, :3].astype(np.int64)
        self.code, self.range = w[:, 0] << 40 | w[:, 1] << 20 | w[:, 2], np.full(n, FULL, np.int64)
        self.at = np.arange(n, dtype=np.int64) * words.shape[1] + 3
        self.flat = words.reshape(-1)

    def choice(self, end2: np.ndarray, end1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether the code lies in the share of order 2, and in that of order 2 or 1: it is compared with their ends, not divided."""
        self.r = self.range >> CHOICE
        return self.code < self.r * end2, self.code < self.r * end1

    def narrow(self, start: np.ndarray, size: np.ndarray) -> None:
        self.code -= self.r * start
        self.r = self.r * size >> TOTAL

    def place(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The place of 2^TOTAL that the code of ``rows`` points to, their codes and units."""
        code, r = self.code.take(rows), self.r.take(rows)
        place = (code.view(np.uint64) // r.view(np.uint64)).view(np.int64)
        return np.minimum(place, (1 << TOTAL) - 1), code, r

    def take(self, rows: np.ndarray, code: np.ndarray, r: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        """Narrow ``rows`` (of ``code`` and unit ``r``) to their shares of 2^TOTAL, others to all of it."""
        self.range = self.r << TOTAL
        self.code[rows] = code - r * start
        self.range[rows] = r * size
        small = np.nonzero(self.range < LEAST)[0]
        while len(small):
            p, wide = self.at.take(small), self.range.take(small) << DIGIT
            self.code[small] = self.code.take(small) << DIGIT | self.flat.take(p, mode="clip")
            self.at[small] = p + 1
            self.range[small] = wide
            small = small[wide < LEAST]


def _turned(x: np.ndarray) -> np.ndarray:
    """Columns as rows, a few rows at a time: their columns are neighbours in the result."""
    out = np.empty(x.shape[::-1], np.uint32)
    for at in range(0, len(x), TILE):
        out[:, at:at + TILE] = x[at:at + TILE].T
    return out


def _encode(x: np.ndarray, prior: Prior) -> list[bytes]:
    """Digits of each row of ``x``."""
    n, steps = x.shape
    m, w = _Model(n), _Writer(n)
    starts, less = prior.by_id()
    for now in _turned(x):
        ids, end2, end1 = m.predict()
        right = _ones(ids == now.view(np.int32))
        hit = right[0] | right[1]
        at, none = now.astype(np.int64), (hit - 1).astype(np.int64)
        w.put(*_choice(right[1], hit, end2, end1), starts.take(at) & none, (1 << TOTAL) - (less.take(at) & none))
        m.learn(now, right)
    return w.digits()


def _decode(digits: list[bytes], steps: int, prior: Prior) -> np.ndarray:
    n = len(digits)
    m, r = _Model(n), _Reader(digits)
    places = prior.places()
    out = np.zeros((steps, n), np.uint32)
    for now in out:
        ids, end2, end1 = m.predict()
        hit2, hit = r.choice(end2, end1)
        rest = np.nonzero(~hit)[0]
        hit2 = _ones(hit2)
        r.narrow(*_choice(hit2, _ones(hit), end2, end1))
        np.add(ids[0], (ids[1] - ids[0]) & -hit2, out=now.view(np.int32))
        place, code, unit = r.place(rest)
        k = places.take(place)
        r.take(rest, code, unit, prior.starts.take(k), prior.sizes.take(k))
        now[rest] = prior.ids.take(k)
        m.learn(now, _ones(ids == now.view(np.int32)))
    return _turned(out)


def encode(ids: np.ndarray, block: int = BLOCK) -> bytes:
    """A frame of ``ids`` (no ids: a frame of no blocks)."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    if len(ids) and int(ids.max()) > MOST:
        raise ValueError(f"ids above {MOST} are not supported")
    n = -(-len(ids) // block)
    x = np.full(n * block, ids[0] if n else 0, "<u4")
    x[:len(ids)] = ids
    x = x.reshape(n, block)
    prior = Prior.of(x) if n else None
    digits = _encode(x, prior) if n else []
    table = prior.pack() if n else b""
    head = struct.pack(HEAD, MAGIC, block, n, len(ids), len(table), zlib.crc32(table)) + table
    index = b"".join(struct.pack("<III", len(d), zlib.crc32(d), zlib.crc32(row)) for d, row in zip(digits, x))
    return head + index + b"".join(digits)


def head(frame: bytes) -> tuple[int, int, int, Prior | None, int]:
    """Block length, blocks, ids, order-0 frequencies (verified by their checksum), and where the index begins."""
    magic, block, n, total, size, crc = struct.unpack_from(HEAD, frame)
    if magic != MAGIC:
        raise ValueError("not a frame of token ids")
    at = struct.calcsize(HEAD)
    table = frame[at:at + size]
    if len(table) != size or zlib.crc32(table) != crc:
        raise ValueError("table of ids: checksum")
    return block, n, total, Prior.unpack(table) if n else None, at + size


def blocks(frame: bytes) -> tuple[int, int, list[tuple[bytes, int]]]:
    """(block length, ids, (digits, crc32 of the ids) of each block), with the digits' checksums verified."""
    block, n, total, _, index = head(frame)
    at, out = index + 12 * n, []
    for b in range(n):
        size, crc, of_ids = struct.unpack_from("<III", frame, index + 12 * b)
        digits = frame[at:at + size]
        if len(digits) != size or zlib.crc32(digits) != crc:
            raise ValueError(f"block {b}: checksum")
        out.append((digits, of_ids))
        at += size
    return block, total, out


def decode(frame: bytes) -> np.ndarray:
    """The frame's ids; a checksum that doesn't hold raises ValueError."""
    block, total, parts = blocks(frame)
    if not parts:
        return np.zeros(0, np.uint32)
    x = _decode([d for d, _ in parts], block, head(frame)[3])
    for b, (row, (_, crc)) in enumerate(zip(x, parts)):
        if zlib.crc32(row) != crc:
            raise ValueError(f"block {b}: checksum of its ids")
    return x.reshape(-1)[:total]
