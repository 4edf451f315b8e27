import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import types as T

from ledgerfold.llm import conversation_repair as C

SPACE = " \t\n\x0b\x0c\r"
COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def conversations(spark, rows):
    schema = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                           T.StructField("text", T.StringType()), T.StructField("audit", T.StringType()), T.StructField("times", T.IntegerType())])
    return spark.createDataFrame([(*r, "x", 7) for r in rows], schema)


def best_edits(rows):
    """Least (cost, audit) and its repaired rows by trying all edits; rows: (role, text, must_go, truncated)."""
    found = []

    def go(i, cost, audit, out):
        if cost > 2 * len(rows):  # to delete all is legal
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in out)):
            found.append((cost, audit, out))
        for role in ("user", "assistant"):
            go(i, cost + 5, audit + "I", [*out, (role, "")])
        if i < len(rows):
            role, text, must_go, truncated = rows[i]
            go(i + 1, cost + 2, audit + "D", out)
            if not must_go:
                more = 5 if truncated else 0
                if role:
                    go(i + 1, cost + more, audit + "K", [*out, (role, text)])
                for new in ("user", "assistant"):
                    go(i + 1, cost + more + 1, audit + "R", [*out, (new, text)])

    go(0, 0, "", [])
    return min(found, key=lambda f: f[:2])


def plain_table(rows):
    """The same by a table of whole strings, for longer conversations."""
    table = {"": (0, "", [])}
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    for at in range(len(rows) + 1):
        closed = dict(table)
        for _ in range(2):
            for end, (cost, audit, out) in list(closed.items()):
                for new in ("user", "assistant"):
                    option = (cost + 5, audit + "I", [*out, (new, "")])
                    if new[0] in follow[end] and (new[0] not in closed or option[:2] < closed[new[0]][:2]):
                        closed[new[0]] = option
        if at == len(rows):
            return min((closed[e] for e in ("", "a") if e in closed), key=lambda f: f[:2])
        role, text, must_go, truncated = rows[at]
        nxt = {end: (c + 2, a + "D", o) for end, (c, a, o) in table.items()}
        for end, (cost, audit, out) in () if must_go else closed.items():
            for letter, new, price in (("K", role, 0), ("R", "user", 1), ("R", "assistant", 1)):
                option = (cost + price + 5 * truncated, audit + letter, [*out, (new, text)])
                if new and new[0] in follow[end] and (new[0] not in nxt or option[:2] < nxt[new[0]][:2]):
                    nxt[new[0]] = option
        table = nxt


def brute(rows, solve=plain_table, harm=True):
    of = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        held = of.setdefault(conv, [])
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if harm else 19
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        held += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    out = []
    for conv, held in of.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        seen, marked, faults = set(), [], [0, 0, 0]
        for _, role, text in held:
            end = text.rstrip(SPACE)[-1:]
            fault = 0 if not end else 1 if (role, text) in seen else 2 if end not in ".!?" else None
            if fault is not None:
                faults[fault] += 1
            seen.add((role, text))
            marked.append((role, text, fault in (0, 1), fault == 2))
        turns = {t for t, _, _ in held if t is not None}
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, audit, repaired = solve(marked)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *faults, illegal, cost, audit, digest))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0))


def answer(spark, rows, **more):
    got = C.repair_digests(spark, rows, **more).collect()
    return sorted((tuple(r[c] for c in COLUMNS) for r in got), key=lambda r: (r[0] is not None, r[0] or 0))


def random_rows(rng, n):
    return [(rng.choice(["system", "user", "assistant", "tool", ""]), rng.choice(["", "x"]), rng.random() < 0.2, rng.random() < 0.2) for _ in range(n)]


def test_audit_equals_all_edits_tried():
    rng = random.Random(3)
    for n in range(5):
        for _ in range(60):
            rows = random_rows(rng, n)
            want = best_edits(rows)[:2]
            assert plain_table(rows)[:2] == want
            assert C.audit_of((r[:1], m, t) for r, _, m, t in rows) == want


def test_long_audits_and_pieces_equal_whole_strings():
    rng = random.Random(4)
    for _ in range(25):
        rows = random_rows(rng, rng.randrange(100, 300))
        want = plain_table(rows)[:2]
        assert C.audit_of((r[:1], m, t) for r, _, m, t in rows) == want
        whole = C._Whole(1)
        for at in range(0, len(rows), 17):
            piece = C._Piece(1, 0, [0, 1, 2, 3])
            for k, (r, _, m, t) in enumerate(rows[at:at + 17]):
                piece.add(at + k, r[:1], m, False, t, 1)
            whole.add(dict(zip([c.split()[0] for c in C.PIECES.split(", ")], piece.row(0))))
        assert whole.row()[-2:] == want and whole.row()[1] == 0


@pytest.mark.parametrize("modulus", [2, 3, 7, C.MODULUS])
def test_tree_compares_like_strings_even_where_hashes_collide(modulus):
    rng = random.Random(modulus)
    tree, strings = C.AuditTree(modulus), [""]
    for _ in range(300):
        parent = rng.randrange(max(0, len(strings) - 30), len(strings))
        text = "".join(rng.choice("DIKR" if rng.random() < 0.1 else "D") for _ in range(rng.choice([1, 1, 1, 4, 9])))
        strings.append(strings[parent] + text)
        assert tree.add(parent, text) == len(strings) - 1
    assert all(tree.string(k) == s for k, s in enumerate(strings))
    for a, b in itertools.product(range(0, len(strings), 3), repeat=2):
        assert tree.less(a, b) == (strings[a] < strings[b])


AWKWARD = [
    (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes?"), (1, 1, "assistant", "Yes?"), (1, 3, "assistant", "no end"), (1, None, "system", "First."),
    (2, 5, None, None), (2, 6, "", "A."), (3, None, "user", "a."), (3, None, "user", "b."), (None, 1, "user", "u."), (None, 2, "assistant", "a."),
    (4, 2**62, "user", "x" * 70_000 + "."), (4, -(2**62), "assistant", " \t\n\x0b\x0c\r"), (5, 1, "tool", "t."), (6, 0, "Ünser", "é"), (6, 1, "a", "\x1c"), (6, 2, "user", "end.  "),
]


def test_awkward_rows_equal_brute_force(spark):
    rows = [*AWKWARD, *[(c, t, r, "Text %d." % (t // 3)) for c in range(10, 60) for t, r in enumerate(["system", "user", "assistant", "assistant", "user", "user", "assistant"])]]
    assert answer(spark, conversations(spark, rows)) == brute(rows)
    assert answer(spark, conversations(spark, rows), block=2) == brute(rows)


def test_one_conversation_of_most_rows_is_cut_into_pieces(spark):
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice(["One.", "Two!", "", f"{t}?", f"{t}"])) for t in range(3_000)] + [(2, 1, "user", "Same.")] * 500 + [(3, 0, "user", "Hi.")]
    assert answer(spark, conversations(spark, rows), block=100) == brute(rows)


def test_whole_small_table_equals_brute_force(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert answer(spark, table) == brute([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])


def test_repaired_rows_and_empty_table(spark):
    assert answer(spark, conversations(spark, [])) == []
    rows = C.undamaged(conversations(spark, [(1, 0, "user", "Hi."), (1, 1, "user", "There."), (1, 2, "assistant", "Yes."), (2, 0, "assistant", "No."), (2, 1, "assistant", "")]))
    found = C.find_repairs(spark, rows)
    assert {(r.conv_id, r.audit, r.cost) for r in found.collect()} == {(1, "DKK", 2), (2, "DD", 4)}
    assert [tuple(r) for r in C.repaired_rows(rows, found).orderBy("conv_id", "turn").collect()] == [(1, 0, "user", "There."), (1, 1, "assistant", "Yes.")]
