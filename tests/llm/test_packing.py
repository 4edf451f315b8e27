import bisect
import random
import tracemalloc
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark import TaskContext
from tokenizers import Tokenizer

from ledgerfold.llm import packing as K
from ledgerfold.llm import word_ids as W
from ledgerfold.llm.token_files import vocabulary
from tests.llm.cases import TEXTS, documents


def sequential_best_fit(lengths, capacity):
    gaps, n = [], 0
    for x in sorted(lengths, reverse=True):
        i = bisect.bisect_left(gaps, x)
        left = (gaps.pop(i) if i < len(gaps) else capacity) - x
        n += i >= len(gaps) + (left != capacity - x)
        bisect.insort(gaps, left)
    return len(gaps)


def check(rows, lengths, capacity):
    """rows: (uid, sequence, offset). Every piece once, no gap or overlap, nothing beyond the capacity."""
    assert sorted(r[0] for r in rows) == sorted(range(len(lengths)))
    by = {}
    for uid, seq, offset in rows:
        by.setdefault(seq, []).append((offset, lengths[uid]))
    for pieces in by.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("case", ["mixed", "one_length", "ties", "small", "large", "single"])
def test_places_are_valid_and_near_best_fit(spark, case):
    rng = random.Random(case)
    lengths = {"mixed": [min(2048, int(rng.paretovariate(0.7) * 20)) for _ in range(3000)], "one_length": [700] * 1000, "ties": [1024, 512, 512, 2047, 1] * 200,
               "small": [rng.randint(1, 9) for _ in range(3000)], "large": [rng.randint(1000, 2047) for _ in range(500)], "single": [5]}[case]
    sizes = spark.createDataFrame(list(enumerate(lengths)), "uid long, length long")
    rows = [tuple(r) for r in K.place(spark, sizes).collect()]
    used = check(rows, lengths, K.CAPACITY)
    assert used <= 1.01 * sequential_best_fit(lengths, K.CAPACITY) + 2


def test_no_rows(spark):
    assert K.place(spark, spark.createDataFrame([], "uid long, length long")).collect() == []
    assert K.pack(spark, documents(spark, [])).collect() == []


def test_match_ranges_pairs_with_the_nearest_larger_range():
    ranges = [dict(part=0, pieces=0, longest=None, tokens=0, gaps=2, least_gap=900), dict(part=1, pieces=1, longest=800, tokens=800, gaps=1, least_gap=600),
              dict(part=2, pieces=5, longest=250, tokens=1250, gaps=0, least_gap=None)]
    plan, new = K.match_ranges(ranges, 2048)
    # the piece of 800 takes a gap of 900; two of the small ones share the gap of 600, three the other gap of 900
    assert plan == [(1, 0, 1, 0, 0, 1), (2, 0, 2, 1, 0, 2), (2, 2, 5, 0, 1, 3)] and new == 0


def test_pieces_of_whole_texts(spark):
    t = Tokenizer.from_file(vocabulary())
    want = []
    for doc, text in TEXTS:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at:at + 2048]
            want.append((doc, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    rows = K.pack(spark, documents(spark)).collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted(want, key=key)
    lengths = [r.length for r in rows]
    check([(i, r.sequence_id, r.offset) for i, r in enumerate(rows)], lengths, 2048)


def test_sweeps_let_go_of_the_word_tables(monkeypatch):
    monkeypatch.setattr(TaskContext, "get", lambda: SimpleNamespace(partitionId=lambda: 0))
    W.word_ids.cache_clear()
    W.word_ids(vocabulary())
    rows = pa.RecordBatch.from_arrays([pa.array([K.GAP, K.PIECE], pa.int32()), pa.array([1, 2]), pa.array([5, 3], pa.int32())], names=["kind", "id", "size"])
    assert sum(b.num_rows for b in K._sweep(iter([rows]))) == 2 and W.word_ids.cache_info().currsize == 0


def test_tokenising_takes_little_memory_beside_the_table(monkeypatch):
    w, gather, held = W.WordIds(vocabulary()), W.gather, []
    texts = pa.array(["some words, that come again " * 1000] * 200)
    w.encode(texts.slice(0, 1).cast(pa.large_string()))
    before = pa.total_allocated_bytes()
    monkeypatch.setattr(W, "gather", lambda *a: held.append(pa.total_allocated_bytes() - before) or gather(*a))
    tracemalloc.start()
    n = sum(int(w.encode(x)[1].sum()) for x in W.texts_of(texts))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 200 * 1000 * 6
    assert max(held) < 3_000_000  # a slice, but not its words
    assert most < 25_000_000
