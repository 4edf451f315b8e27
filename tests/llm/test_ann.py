import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerfold.llm import ann as A

SCHEMA = "vec_id long, embedding array<float>, label int, v string, rep int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "v", 1) for i, v in rows], SCHEMA)


def brute(rows, k=20):
    rows = [(i, np.array(v, np.float32).astype(float)) for i, v in rows]
    out = {}
    for q, x in rows:
        if q % 20 == 0:
            near = sorted((-float((x * y).sum()), i) for i, y in rows if i != q and len(y) == len(x))[:k]
            out[q] = [(i, -s) for s, i in near]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_recall_and_exact_scores(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got, want = found(A.search(spark, spark.read.parquet(f"{sf}/embeddings.parquet"), F.col("vec_id") % 20 == 0)), brute(rows)
    assert set(got) == set(want) and all(len(got[q]) == 20 for q in want)
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9
    exact = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    assert all(abs(s - float((exact[q] * exact[i]).sum())) < 1e-12 for q in got for i, s in got[q])


def test_a_group_of_equal_vectors_and_ties(spark):
    rng = np.random.default_rng(1)
    same = rng.normal(size=16).tolist()
    rows = [(i, same if i % 3 == 0 else rng.normal(size=16).tolist()) for i in range(300)]
    got = found(A.search(spark, table(spark, rows), F.col("vec_id") % 20 == 0))
    want = brute(rows)
    for q in range(0, 300, 60):  # copies of the group: the least other ids, in order
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
    assert A.search(spark, table(spark, []), F.col("vec_id") % 20 == 0).collect() == []


def test_blocks_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(200)]
    a = found(A.search(spark, table(spark, rows), F.col("vec_id") % 20 == 0))
    monkeypatch.setattr(A, "BLOCK", 7)
    assert found(A.search(spark, table(spark, rows), F.col("vec_id") % 20 == 0)) == a


def test_few_rows_give_all_candidates_and_bad_vectors_take_no_part(spark):
    good = [(0, [1.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0]), (2, [-1.0, 0.0, 0.0]), (20, [0.0, 0.0, 2.0]), (3, [1.0, 0.0, 0.0])]
    bad = [(40, None), (60, []), (80, [0.0, 0.0, 0.0]), (100, [1.0, None, 0.0]), (120, [float("nan"), 1.0, 0.0]), (140, [float("inf"), 1.0, 0.0]), (None, [1.0, 1.0, 1.0]), (160, [1.0, 1.0]), (0, [2.0, 0.0, 0.0])]
    got = found(A.search(spark, table(spark, good + bad), F.col("vec_id") % 20 == 0))
    assert got == brute(good) | {}
    assert 160 not in got  # alone of its length


def vectors_of(kind, n, d, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    if kind == "clusters":
        x = rng.normal(size=(20, d))[rng.integers(0, 20, n)] + 0.25 * x
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "norms":
        x *= rng.lognormal(0, 0.3, n)[:, None]
    return [(i, v.tolist()) for i, v in enumerate(x)]


@pytest.mark.parametrize("kind,d", [("random", 64), ("random", 256), ("random", 768), ("clusters", 64), ("clusters", 300), ("norms", 64)])
def test_recall_at_any_length_and_shape(spark, kind, d):
    rows = vectors_of(kind, 800, d)
    got, want = found(A.search(spark, table(spark, rows), F.col("vec_id") % 20 == 0)), brute(rows)
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9


def test_clusters_meet_few_pairs(spark):
    """What the measured plan scores on clustered vectors, against all pairs."""
    rows = vectors_of("clusters", 2000, 64)
    df = spark.createDataFrame(rows, "rep long, v array<double>")
    plan = A.measure(df, df.filter("rep % 20 = 0"))
    tables, probes = plan[64]
    x, scored = np.array([v for _, v in rows]), 0
    for t in range(tables):
        size = np.bincount(A.nearest_axes(x, t, 1)[:, 0], minlength=128)
        scored += size[A.nearest_axes(x[::20], t, probes)].sum()
    assert scored < 0.2 * 100 * 2000, plan  # a cluster of a twentieth of the rows is met whole


def test_cheapest_plan():
    ranks = np.array([[0, 5], [0, 5], [9, 0], [3, 3]])
    assert A.cheapest(ranks, 1.0) == (2, 4) and A.cheapest(ranks, 0.5) == (1, 1) and A.cheapest(ranks, 0.75) in ((2, 1), (1, 4))
