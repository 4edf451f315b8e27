import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ledgerfold.llm import mixing_coder as M
from ledgerfold.llm import token_files as T
from ledgerfold.llm import word_ids as W
from tests.llm.cases import TEXTS, documents


@pytest.mark.parametrize("ids", [[], [5], [0] * 5000, [1, 2, 3, 70000] * 900, [M.MOST] * 10, np.random.default_rng(0).integers(0, 60000, 3000), np.random.default_rng(1).zipf(1.3, 9000) % 50000])
def test_round_trip(ids):
    ids = np.array(ids, np.uint32)
    frame = M.encode(ids)
    assert (M.decode(frame) == ids).all() and len(M.decode(frame)) == len(ids)


def test_repetitive_ids_shrink():
    assert len(M.encode(np.tile([7, 8, 9, 10], 5000))) < 20_000 * 2 / 8


def test_the_order_0_table_of_a_frame():
    ids = np.random.default_rng(3).zipf(1.2, 20_000) % 49_000
    prior = M.Prior.of(ids)
    again = M.Prior.unpack(prior.pack())
    assert (prior.ids == np.unique(ids)).all() and (again.ids == prior.ids).all() and (again.sizes == prior.sizes).all()
    assert int(prior.sizes.sum()) == 1 << M.TOTAL and prior.sizes.min() >= 1
    start, size = prior.shares(ids[:1000])
    places = prior.places()
    assert (prior.ids[places[start]] == ids[:1000]).all() and (prior.ids[places[start + size - 1]] == ids[:1000]).all()
    # what single ids need when nothing repeats in context: their entropy, and a little
    share = np.unique(ids, return_counts=True)[1] / len(ids)
    bits = 8 * (len(M.encode(ids)) - len(prior.pack())) / len(ids)
    assert -(share * np.log2(share)).sum() * 0.97 < bits < -(share * np.log2(share)).sum() * 1.05


def test_text_takes_fewer_bits_than_deflate():
    """Ids of the texts of sf0.1, against zlib at its best on the same ids as 16-bit numbers; README has the figures."""
    import pyarrow.parquet as pq

    column, w, parts = pq.read_table("/root/testdata/sf0.1/documents.parquet")["text"], W.WordIds(T.vocabulary()), []
    for texts in W.texts_of(column):
        parts.append(T.with_end(*w.encode(texts), T.END)[0])
        if sum(map(len, parts)) > 500_000:
            break
    ids = np.concatenate(parts)[:500_000]
    assert len(M.encode(ids)) < 0.92 * len(zlib.compress(ids.astype("<u2").tobytes(), 9))


def test_blocks_are_independent():
    ids = np.random.default_rng(2).zipf(1.4, 5 * M.BLOCK) % 40000
    frame = M.encode(ids)
    block, total, parts = M.blocks(frame)
    third = M._decode([parts[3][0]], block, M.head(frame)[3])[0]
    assert (third == ids[3 * block:4 * block]).all() and zlib.crc32(third.astype("<u4").tobytes()) == parts[3][1]


def test_damage_is_found():
    frame = bytearray(M.encode(np.arange(3000)))
    frame[-5] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        M.decode(bytes(frame))
    frame[-5] ^= 1
    frame[40] ^= 1
    with pytest.raises(ValueError, match="table of ids: checksum"):
        M.decode(bytes(frame))
    with pytest.raises(ValueError):
        M.encode(np.array([M.MOST + 1]))


def test_word_ids_equal_the_library():
    texts = [t for _, t in TEXTS] + ["Erea. erea, EREA!! it's can't ***&&& a.b. É é İstanbul x y \x85z", "lead  trail \n"]
    ids, counts = W.WordIds(T.vocabulary()).encode(next(W.texts_of(pa.array(texts))))
    library = Tokenizer.from_file(T.vocabulary())
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_forgetting_words_changes_nothing(monkeypatch):
    monkeypatch.setattr(W, "LIMIT_BYTES", 5 * W.WORD_BYTES)
    w = W.WordIds(T.vocabulary())
    a = w.encode(pa.array(["one two three four", "five six seven eight"], pa.large_string()))
    b = w.encode(pa.array(["one two three four", "five six seven eight"], pa.large_string()))
    assert (a[0] == b[0]).all() and (a[1] == b[1]).all()


def test_files_hold_all_documents_in_order(spark):
    rows = [(i, t) for i, t in TEXTS]
    path = T.write_token_files(documents(spark, rows), T.scratch(spark, "files"), frame_ids=2000)
    library = Tokenizer.from_file(T.vocabulary())
    want, at = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = library.encode(t or "", add_special_tokens=False).ids + [T.END]
        want.append((i, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    got = [tuple(r) for r in T.token_digests(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    assert sorted(got, key=lambda r: r[1]) == want
    assert {(r.doc_id, r.start, len(r.ids)) for r in T.read_token_files(spark, path).collect()} == {w[:3] for w in want}


def test_no_documents(spark):
    path = T.write_token_files(documents(spark, []), T.scratch(spark, "files"))
    assert T.token_digests(spark, path).collect() == []


class Counting(dict):
    looked = 0

    def get(self, *a):
        Counting.looked += 1
        return dict.get(self, *a)

    def __getitem__(self, k):
        Counting.looked += 1
        return dict.__getitem__(self, k)

    def __contains__(self, k):
        Counting.looked += 1
        return dict.__contains__(self, k)


def test_known_words_are_looked_up_once():
    w = W.WordIds(T.vocabulary())
    texts = pa.array([" ".join(f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(600))], pa.large_string())
    first = w.encode(texts)
    w.index, Counting.looked = Counting(w.index), 0
    again = w.encode(texts)
    assert (first[0] == again[0]).all() and Counting.looked < 610


def test_letters_beyond_ascii_go_through_the_model_alone():
    w, library = W.WordIds(T.vocabulary()), Tokenizer.from_file(T.vocabulary())
    words = [a + b for a in "aàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿßz" for b in "eéßÿ"]
    texts = [" ".join(words), " ".join(x for x in words if "ÿ" not in x).upper()]
    asked, encode = [], w._encode
    w._encode = lambda some, plain=False: asked.append(plain) or encode(some, plain)
    ids, counts = w.encode(pa.array(texts, pa.large_string()))
    assert asked == [True]
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_the_bytes_of_a_frame_stay():
    ids = np.cumsum(np.arange(40_000, dtype=np.uint32) ** 2 % 97) % 5000 // (1 + np.arange(40_000) % 7)
    assert zlib.crc32(M.encode(ids)) == 2516872851


def test_known_words_are_found_without_strings(monkeypatch):
    w = W.WordIds(T.vocabulary())
    texts = pa.array([" ".join(f"Word{chr(97 + k % 26)}{chr(97 + k // 26)}{'.,!é'[k % 4]}" for k in range(600))], pa.large_string())
    first, listed, made = w.encode(texts), W.listed, []
    monkeypatch.setattr(W, "listed", lambda column: made.append(len(column)) or listed(column))
    again = w.encode(texts)
    assert (first[0] == again[0]).all() and sum(made) == 0


def test_words_that_share_bytes_are_kept_apart():
    library = Tokenizer.from_file(T.vocabulary())
    words = [a[:n] + b for a in ("abcdefghijklmnopqrst", "éèéèéèéèéèé", "1234567890123456789", "日本語日本語日本語") for n in range(1, len(a) + 1) for b in ("", "\0", ".", "!.", "\0\0", "A")]
    texts = [" ".join(words), " ".join(words[::-1]).upper(), "", " . ! !. \0 ", " ".join(words)]
    w = W.WordIds(T.vocabulary())
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for order in ([0, 1, 2, 3, 4], [3, 2, 4, 1, 0]):
        ids, counts = w.encode(pa.array([texts[k] for k in order], pa.large_string()))
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [want[k] for k in order]
    sliced = pa.array(["left out", *words, "left out"], pa.large_string()).slice(1, len(words))
    keys, long = W._keys(sliced)
    assert [k for k, x in enumerate(words) if len(x.encode()) > W.SHORT] == long.tolist()
    assert len({tuple(k) for k in np.delete(keys, long, axis=0).tolist()}) == len({x for x in words if len(x.encode()) <= W.SHORT})


def test_the_table_of_short_words_grows():
    rng, table, want = np.random.default_rng(5), W._Short(), {}
    for _ in range(6):
        keys = np.unique(np.stack([rng.integers(0, 50, 9000), rng.integers(1, 3000, 9000)], axis=1).astype(np.uint64), axis=0)
        keys = keys[[tuple(k) not in want for k in keys.tolist()]]
        places = np.arange(len(want), len(want) + len(keys))
        table.add(keys, places)
        want |= dict(zip(map(tuple, keys.tolist()), places.tolist()))
    known = np.array(list(want), np.uint64)
    assert table.n == len(want) > 3 * (1 << 14) // 4 and len(table.rows) > 1 << 14
    assert table.find(known).tolist() == list(want.values())
    assert (table.find(known + np.uint64(5000)) == -1).all() and table.find(np.zeros((1, 2), np.uint64)).tolist() == [0]
