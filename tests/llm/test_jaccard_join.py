import collections
import random

import pytest

from ledgerfold.llm import jaccard_join as J
from tests.llm.cases import TEXTS, documents


def brute(rows, share=(4, 5)):
    """(group, links) of each row number, over all pairs that share an n-gram."""
    sets = []
    for _, t in rows:
        w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", t or "") if x]
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    parent, links, inverted = list(range(len(rows))), [0] * len(rows), collections.defaultdict(list)

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        for j, k in collections.Counter(j for g in s for j in inverted[g]).items():
            if share[1] * k >= share[0] * (len(s) + len(sets[j]) - k):
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
        for g in s:
            inverted[g].append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    return [(d, least[find(i)] if sets[i] else d, links[i]) for i, (d, _) in enumerate(rows)]


def key(r):
    return tuple((x is not None, x) for x in r)


def corpus(seed, base, copies, near, words=60):
    """Random texts, each with exact copies and versions with a few words changed."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(base):
        text = [rng.choice(vocabulary) for _ in range(words)]
        rows += [" ".join(text)] * (1 + copies)
        for _ in range(near):
            v = list(text)
            for _ in range(rng.choice([1, 1, 2])):
                v[rng.randrange(len(v))] = rng.choice(vocabulary)
            rows.append(" ".join(v))
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_bands_reach_the_recall():
    bands, rows = J.choose_bands()
    assert 1 - (1 - J.THRESHOLD**rows) ** bands >= J.RECALL and bands * rows <= J.HASHES
    assert J.choose_bands(0.5, 0.9999, 8) == (8, 1)


@pytest.mark.parametrize("block", [J.BLOCK, 300])
def test_groups_and_links_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK", block)  # 300: every bucket of more than five texts is several units
    rows = corpus(1, 12, 2, 4) + [(1000 + i, t) for i, t in corpus(2, 1, 30, 60)]
    got = [(r.doc_id, r.group_id, r.n_links) for r in J.near_duplicates(spark, documents(spark, rows)).collect()]
    assert sorted(got) == sorted(brute(rows))


def test_awkward_rows(spark):
    got = [(r.doc_id, r.group_id, r.n_links) for r in J.near_duplicates(spark, documents(spark)).collect()]
    assert sorted(got, key=key) == sorted(brute(TEXTS), key=key)
    assert J.near_duplicates(spark, documents(spark, [])).collect() == []


def test_a_long_chain_is_one_group(spark):
    edges = spark.createDataFrame([(i.to_bytes(2, "big"), (i + 1).to_bytes(2, "big")) for i in range(40)] + [(b"\x10\x00", b"\x20\x00")], "u binary, v binary")
    got = {bytes(r.cid): bytes(r.root) for r in J.components(spark, edges, J.scratch(spark, "chain")).collect()}
    assert len(got) == 43 and sum(v == b"\x00\x00" for v in got.values()) == 41 and got[b"\x20\x00"] == b"\x10\x00"


def test_stage_leaves_one_row_of_each_group(spark):
    rows = corpus(3, 6, 2, 3) + [(500, None), (501, ""), (None, "a lone text without any number at all")] + [(7000, "said twice by one and the same id")] * 2
    docs = documents(spark, rows)
    out = J.drop_near_duplicates(spark, docs)
    assert out.columns == docs.columns
    groups = {g for _, g, _ in brute(rows)}
    assert sorted(((r.doc_id,) for r in out.collect()), key=key) == sorted(((g,) for g in groups), key=key)


def test_copies_with_null_ids_are_one_group(spark):
    said, near = " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i}" for i in range(59)) + " end"
    other, apart = " ".join(f"x{i}" for i in range(60)), " ".join(f"y{i}" for i in range(60))
    rows = [(None, said), (7, said), (9, said), (None, near), (None, other), (None, other + " "), (None, other + " more"), (3, apart), (None, apart + " end")]
    docs = documents(spark, rows)
    got = [(r.doc_id, r.group_id, r.n_links) for r in J.near_duplicates(spark, docs).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
    classes = {(r.doc_id, r.class_id) for r in J.near_duplicates(spark, docs).collect()}
    assert {(None, 7), (7, 7), (9, 7)} <= classes
    assert sorted(((r.doc_id,) for r in J.drop_near_duplicates(spark, docs).collect()), key=key) == [(None,), (3,), (7,)]


@pytest.mark.parametrize("one_id", [None, 7])
def test_each_class_meets_one_text_whatever_the_ids(spark, monkeypatch, one_id):
    rows = [(one_id, t) for _, t in corpus(4, 2, 1, 12)] + [(one_id, "a text of its own " + str(i)) for i in range(20)]
    rows += rows[:5]
    seen, make = spark.sparkContext.accumulator(0), J._set_maker

    def counted(n):
        inner = make(n)

        def made(batches):
            def each():
                for batch in batches:
                    seen.add(batch.num_rows)
                    yield batch

            yield from inner(each())

        return made

    monkeypatch.setattr(J, "_set_maker", counted)
    got = [(r.doc_id, r.group_id, r.n_links) for r in J.near_duplicates(spark, documents(spark, rows)).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
    assert 0 < seen.value <= len({t for _, t in rows})
