import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest

from ledgerfold.llm import byte_bpe as B
from ledgerfold.llm import unigram_counts as U
from tests.llm.cases import TEXTS, documents, plain

MODEL, RANKS = P.path("piece_bpe_32k.model"), P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def costs():
    return U.zipf_costs(MODEL)


def best(word, costs):
    """(cost, tokens) of the best segmentation, by the plain table over all starts."""
    longest = max(map(len, costs))
    table = [(0, 0)]
    for j in range(1, len(word) + 1):
        ways = [(table[j - 1][0] + U.UNKNOWN, table[j - 1][1] + len(word[j - 1].encode()))]
        ways += [(table[i][0] + costs[word[i:j]], table[i][1] + 1) for i in range(max(0, j - longest), j) if word[i:j] in costs]
        table.append(min(ways))
    return table[-1]


def test_counts_equal_brute_force(spark, costs):
    rows = [(i, t[:3000] if t else t) for i, t in TEXTS]
    want = []
    for i, t in rows:
        words = [best(U.MARK + w, costs) for w in (t or "").split()]
        want.append({"doc_id": i, "n_pretokens": len(words), "n_tokens": sum(n for _, n in words), "cost": sum(c for c, _ in words)})
    columns = ("doc_id", "n_pretokens", "n_tokens", "cost")
    assert plain(U.token_counts(documents(spark, rows), MODEL).collect(), *columns) == plain(want, *columns)
    assert U.token_counts(documents(spark, []), MODEL).collect() == []


def test_counts_equal_a_unigram_model_of_the_library(costs):
    from tokenizers import Tokenizer, models

    library = Tokenizer(models.Unigram([("<unk>", -U.UNKNOWN / 1000), *((p, -c / 1000) for p, c in costs.items())], unk_id=0))
    trie = U.TrieCounts(costs)
    words = [U.MARK + w for w in "unbelievable internationalisation the of thwhed eronnd ciónmente strasse".split()]
    assert [trie.insert(w)[1] for w in words] == [len(library.encode(w).ids) for w in words]


def test_shared_prefixes_are_scored_once(costs):
    trie = U.TrieCounts(costs)
    for w in ("inter", "internal", "internet", "inter"):
        trie.insert(w)
    assert trie.nodes == len("internal") + len("et")


def test_a_full_trie_is_dropped_without_a_change(spark, costs):
    text = " ".join(f"alpha{i} beta{i}" for i in range(400))
    one = U.TrieCounts(costs)
    want = [one.insert(U.MARK + w) for w in text.split()]
    two = U.TrieCounts(costs)
    got = []
    for w in text.split():
        two.forget()
        got.append(two.insert(U.MARK + w))
    assert got == want


@pytest.fixture(scope="module")
def bpe():
    return B.byte_bpe(RANKS, P.PATTERN)


@pytest.fixture(scope="module")
def library(bpe):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


def test_tree_reduction_equals_the_library(bpe, library):
    rng = random.Random(3)
    for _ in range(300):
        letters = rng.choice(["ab", "abcdefgh", "the of and tion", "éüßñ日本😀", "\n\n\t  ", "0123456789", "=-*"])
        s = "".join(rng.choice(letters) for _ in range(rng.choice([1, 31, 33, 64, 100, 700])))
        assert bpe.encode(s) == library.encode_ordinary(s)
        assert bpe.decode(bpe.encode(s)) == s.encode()


def test_joining_is_associative_and_has_a_unit(bpe):
    rng = random.Random(4)
    for _ in range(200):
        x, y, z = (bpe._merge("".join(rng.choice("abnetio") for _ in range(rng.randint(1, 20))).encode()) for _ in range(3))
        assert bpe.join(bpe.join(x, y), z) == bpe.join(x, bpe.join(y, z))
        assert bpe.join([], x) == x == bpe.join(x, [])


def test_wide_windows(bpe, library):
    for s in ("a" * 5000, "ab" * 3000, "é日" * 1000, "xyzzy" * 1500):
        assert bpe.encode(s) == library.encode_ordinary(s)
        assert bpe._heap_merge(s.encode()) == bpe.encode_bytes(s.encode())


def test_digests_and_round_trip(spark, library):
    want = []
    for i, t in TEXTS:
        ids = library.encode_ordinary(t or "")
        want.append({"doc_id": i, "n_tokens": len(ids), "ids_sha256": hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), "decoded_sha256": hashlib.sha256((t or "").encode()).hexdigest()})
    columns = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert plain(B.bpe_digests(documents(spark), RANKS, P.PATTERN).collect(), *columns) == plain(want, *columns)
    decoded = B.decode_ids(B.encode_texts(documents(spark), RANKS, P.PATTERN), RANKS, P.PATTERN).collect()
    assert sorted(bytes(r.decoded) for r in decoded) == sorted((t or "").encode() for _, t in TEXTS)
    assert B.bpe_digests(documents(spark, []), RANKS, P.PATTERN).collect() == []
