import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np

from ledgerfold.llm import spelling_variants as S
from tests.llm.cases import TEXTS, documents

COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    of = {w: [] for w in words}
    for a, b in itertools.combinations(words, 2):
        if abs(len(a) - len(b)) < 2 and near(a, b):
            of[a].append(b)
            of[b].append(a)
    best = {w: min(x, key=lambda v: (-words[v], v)) for w, x in of.items() if x}
    form = {w: v for w, v in best.items() if words[v] >= 10 * words[w]}
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(of[w]), words[form[w]] if w in form else None))
    return sorted(out, key=lambda r: r[0])


def answer(spark, docs, **more):
    return sorted((tuple(r[c] for c in COLUMNS) for r in S.spelling_variants(spark, docs, **more).collect()), key=lambda r: r[0])


def chained():
    """Words in chains of forms: each ten times rarer than the one before, an edit further; ties; accents."""
    rng = random.Random(5)
    rows, doc = [], 100
    for word, n in (("ringelblume", 9_000), ("ringelblumen", 700), ("ringelbhumen", 55), ("ringelbhumén", 4), ("Straßenbahn", 60), ("straßenbahm", 60), ("straßenbaho", 6), ("permutation", 30), ("permutatoin", 30), ("xxxxxxx", 2), ("xxxxxxxx", 20)):
        for _ in range(n):
            rows.append((doc, word))
            doc += 1
    letters = "aeioulmn"
    stems = ["".join(rng.choice(letters) for _ in range(8)) for _ in range(60)]
    for _ in range(600):
        s = rng.choice(stems)
        at = rng.randrange(8)
        rows.append((doc, " ".join([s, s[:at] + s[at + 1:], s[:at] + rng.choice(letters) + s[at + 1:], s[:at] + rng.choice("éèü") + s[at:]])))
        doc += 1
    return rows


def test_equals_brute_force_and_does_not_depend_on_the_blocks(spark):
    rows = [*TEXTS, *chained()]
    want = brute(rows)
    assert sum(r[1] is not None for r in want) > 20 and any(r[1] and r[1] != r[2] for r in want)
    assert answer(spark, documents(spark, rows)) == want
    assert answer(spark, documents(spark, rows), groups=1, part=7) == want
    assert answer(spark, documents(spark, rows), groups=6, part=50) == want


def test_the_whole_small_table_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert answer(spark, docs) == brute(rows)


def test_empty_table_and_nulls(spark):
    assert answer(spark, documents(spark, [])) == []
    rows = [(1, None), (None, "emptiness emptiness"), (2, ""), (3, "short")]
    assert answer(spark, documents(spark, rows)) == brute(rows)


def test_very_long_words_have_exact_distances(spark):
    long = "ab" * 30_000
    rows = [(1, long), (2, long), (3, long + "a"), (4, long + "a"), (5, long[:-1] + "c"), (6, long[:-1] + "c")]
    want = brute(rows)
    got = answer(spark, documents(spark, rows))
    assert [(r[0], r[4]) for r in got] == [(r[0], r[4]) for r in want]


def test_pairs_of_blocks_meet_once():
    seen = Counter()
    blocks = [",".join(map(str, c)) for c in itertools.product(range(4), repeat=3)]
    for b in blocks:
        assert len(set(S.partners(b))) == len(S.partners(b))
        for p in S.partners(b):
            seen[frozenset((b, p))] += 1
    assert set(seen.values()) == {1}
    for a, b in itertools.combinations(blocks, 2):
        x, y = (np.array(list(map(int, c.split(",")))) for c in (a, b))
        d = y - x
        reachable = abs(d).sum() == 1 or (abs(d).sum() == 2 and d.sum() == 0)
        assert (frozenset((a, b)) in seen) == reachable
