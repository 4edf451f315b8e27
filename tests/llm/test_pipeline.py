"""The pipeline against its stages by brute force, on a small table."""

import random

from pyspark.sql import functions as F

import corpus_pipeline as P
from ledgerfold.llm import language_id
from tests.llm.test_jaccard_join import brute, key
from tests.llm.test_packing import check
from tests.llm.test_quality_rules import brute as counts


def text(rng, words):
    stop = "the of and to in a is that for it".split()
    return " ".join(rng.choice(stop) if rng.random() < 0.4 else "".join(rng.choice("bcdfgaeiou") for _ in range(rng.randint(3, 8))) for _ in range(words))


def small(spark):
    rng = random.Random(6)
    rows = [(i, text(rng, rng.randint(60, 400))) for i in range(40)]
    rows += [(100 + i, rows[i][1]) for i in range(5)] + [(200 + i, rows[i][1] + " one more") for i in range(5)]
    rows += [(300, None), (301, ""), (302, "short"), (303, "$$$ ### " * 60), (304, "again and again " * 40), (305, "12 3 456 7 " * 30), (0, rows[0][1])]
    return rows, spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")


def test_stages_equal_brute_force(spark):
    rows, docs = small(spark)
    columns = docs.columns
    assert [n for n, _ in P.STAGES] == ["quality_rules", "language_id", "jaccard_join", "best_fit_packing"]

    first = P.quality_stage(spark, docs, "")
    kept = [r for r in rows if not counts(r[1])[5] and counts(r[1])[2] <= 0.1 * counts(r[1])[0]]
    kept = [r for r in kept if r[0] != 305]  # no stop words
    assert first.columns == columns and sorted(r.doc_id for r in first.collect()) == sorted(i for i, _ in kept)

    second = P.language_stage(spark, first, "")
    assert second.columns == columns and sorted(r.doc_id for r in second.collect()) == sorted(i for i, _ in kept)

    third = P.jaccard_stage(spark, second, "")
    groups = {g for _, g, _ in brute(kept)}
    assert third.columns == columns and sorted(((r.doc_id,) for r in third.collect()), key=key) == sorted(((g,) for g in groups), key=key)

    last = P.packing_stage(spark, third, "").collect()
    assert {r.doc_id for r in last} == groups
    check([(i, r.sequence_id, r.offset) for i, r in enumerate(last)], [r.length for r in last], 2048)


def test_run_reads_and_writes_between_stages(spark):
    sf = "/root/testdata/sf0.001"
    out = P.run(spark, sf)
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert 0.5 * n < out.select("doc_id").distinct().count() < n
    assert language_id.UNKNOWN == "und" and out.agg(F.max("length")).first()[0] <= 2048


def test_an_empty_table(spark):
    _, docs = small(spark)
    d = docs.limit(0)
    for _, stage in P.STAGES:
        d = stage(spark, d, "")
    assert d.collect() == []
