import hashlib
import math
import random
import re

import numpy as np
import pytest

from ledgerfold.llm import personal_data as P
from tests.llm.cases import TEXTS, documents

PRIVATE = [
    (30, "write pa.90@mail2.example.com, 4111 1111 1111 1111 or +1 (017) 555-7713."), (31, "192.168.1.1 300.1.1.1 1.2.3.4.5.6.7.8 0000255.1.1.1 1.2.3"),
    (32, "a@b.c.d@e.f..g x@@y.z @q.r 5@-.-"), (33, "4111-1111-1111-1111-1111 411111111111111 4111 1111  1111 1111"), (34, "+1 234 567 89 10 11 12 13+49 (0)30 1234567+1"),
    (35, "reach jo.doe (at) example (dot) org or (217) 555-0134, node 10[.]0[.]0[.]7, visa 4111.1111.1111.1111"), (36, "1" * 70_000 + "@" + "a" * 70_000), (37, "é😀 über 1.2.3.4 é@x.y"),
]


def spans_by_pattern(text):
    out = []
    for kind, pattern in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            double = sum(sum(divmod(2 * int(d), 10)) if k % 2 else int(d) for k, d in enumerate(reversed(digits)))
            if kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")) or kind == "card" and 12 <= len(digits) <= 19 and double % 10 == 0 or kind == "phone" and 9 <= len(digits) <= 15:
                out.append((m.start(), kind, m.end()))
    return sorted(out, key=lambda s: (s[0], P.KINDS.index(s[1])))


@pytest.fixture(scope="module")
def field():
    return P.train(P.examples([t for _, t in PRIVATE[:3]] + ["the house on the hill was old and nobody came to see it " * 4] * 20))


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    texts = [t for _, t in PRIVATE + TEXTS if t and len(t) < 60_000]
    texts += ["".join(rng.choice("1234560+.@-( )a%\n") for _ in range(rng.randrange(60))) for _ in range(4000)]
    texts += [t for t, _ in P.examples(["carrier words in a row"], 500)]
    for t in texts:
        assert P.base_spans(t) == spans_by_pattern(t), t


def segmentations(found, at=0):
    """All sets of candidates that don't overlap."""
    if at == len(found):
        yield []
        return
    for rest in segmentations(found, at + 1):
        yield rest
        if all(c.start >= found[at].end or c.end <= found[at].start for c in rest):
            yield [found[at], *rest]


def some_candidates(rng):
    spans = sorted({tuple(sorted(rng.sample(range(12), 2))) for _ in range(rng.randrange(1, 8))}, key=lambda s: (s[1], s[0]))
    return [P.Candidate(a, b, rng.choice(P.KINDS), (f"f{a}", f"g{b}")) for a, b in spans]


def test_decoding_and_sums_equal_all_segmentations():
    rng = random.Random(2)
    for _ in range(300):
        found = some_candidates(rng)
        weights = {(c.kind, f): rng.uniform(-2, 2) for c in found for f in c.features}
        model = P.Field(weights, rng.uniform(-1.5, 1.5))
        worth = {}
        for chosen in segmentations(found):
            starts = {c.start for c in chosen}
            worth[frozenset((c.start, c.kind, c.end) for c in chosen)] = sum(map(model.score, chosen)) + model.adjacent * sum(c.end in starts for c in chosen)
        best = frozenset(P.decode(model, found, 0.0))
        assert worth[best] == pytest.approx(max(worth.values()))
        total = sum(map(math.exp, worth.values()))
        log, p, pairs = P._sums(np.array([c.start for c in found]), np.array([c.end for c in found]), np.array([model.score(c) for c in found]), model.adjacent)
        assert log == pytest.approx(math.log(total))
        for c, got in zip(found, p):
            assert got == pytest.approx(sum(math.exp(v) for s, v in worth.items() if (c.start, c.kind, c.end) in s) / total)
        assert pairs == pytest.approx(sum(math.exp(v) * sum(b == a2 for _, _, b in s for a2, _, _ in s) for s, v in worth.items()) / total)


def test_written_forms_that_were_not_learned_are_found(field):
    right = wrong = missed = 0
    for text, spans in P.examples(["other words that carry a form from here to there"], 800, seed=99):
        base = P.base_spans(text)
        got = set(P.decode(field, P.candidates(text, base)))
        right, wrong, missed = right + len(got & spans), wrong + len(got - spans), missed + len(spans - got)
    assert right / (right + wrong) > 0.97 and right / (right + missed) > 0.95


def test_query_columns_on_awkward_rows(spark, field):
    rows = [*TEXTS, *PRIVATE]
    got = sorted(P.find(documents(spark, rows), field).collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in got] == [i for i, _ in want]
    for r, (_, text) in zip(got, want):
        base = P.base_spans(text or "")
        assert [r[f"n_{k}"] for k in P.KINDS] == [sum(s[1] == k for s in base) for k in P.KINDS]
        written = [f"{k}:{a}:{b}" for a, k, b in base]
        assert r.base_sha256 == hashlib.sha256(",".join(written).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert set(written) <= set(spans) and len(spans) == len(base) + r.n_added
        order = [(int(a), P.KINDS.index(k)) for k, a, _ in (s.split(":") for s in spans)]
        assert order == sorted(order)
    added = next(r for r in got if r.doc_id == 35)
    assert added.n_added == 4 and {s.split(":")[0] for s in added.spans.split(",")} == set(P.KINDS)
    assert P.find(documents(spark, []), field).collect() == []


def test_fit_takes_different_texts_and_is_the_same_each_time(spark):
    docs = documents(spark, [*TEXTS, *[(50, "one text that is copied " * 20)] * 500])
    a = P.fit(docs)
    assert a == P.fit(docs.repartition(3)) and a.weights
    assert P.fit(documents(spark, [])).weights


def test_clean_prose_stays_clean(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = P.find(docs, P.fit(docs)).collect()
    clean = [r for r in rows if not (r.n_email or r.n_ip or r.n_card or r.n_phone)]
    assert len(clean) > 500 and sum(r.n_added > 0 for r in clean) <= 0.001 * len(clean)


def test_no_text_is_passed_over(spark):
    """Addresses without a digit, an @ or the word dot."""
    field = P.Field({("email", "bias"): 10.0}, 0.0)
    rows = [(1, "reach jo.doe (at) example.com today"), (2, "or jo at example.org"), (3, "JO [AT] EXAMPLE[.]NET"), (4, "nothing here"), (5, "")]
    got = {r.doc_id: r for r in P.find(documents(spark, rows), field).collect()}
    assert [got[i].n_added for i, _ in rows] == [1, 1, 1, 0, 0]
    for i, text in rows:
        assert got[i].spans == ",".join(f"{kind}:{a}:{b}" for a, kind, b in P.all_spans(text, field)[1])
